"""Spelling variants by composition of finite-state machines.

The pairs of words that are one edit apart are the accepted pairs of a composed machine:
the minimised acceptor of the vocabulary, a transducer that replaces, inserts or deletes
exactly one code point, and the acceptor again. Its states are (q, e, r): the state of
either acceptor and whether the edit is done. While it is not, both are in the same
state, so the machine is walked as ``near`` of a state; after the edit both must read the
same rest, which is ``common`` of two states. Minimising lets equal rests be one state,
and what a state or a pair of states accepts is found once.

The machine is enumerated by partitions of its initial states. Of two words one edit
apart, the first half or the last half of the shorter one stands whole in both. So a word
starts in the state after its first half, and in that of the reversed machine after its
last half; only words of one such state can be pairs, and each state's part of the
vocabulary is a machine of its own, dealt to tasks. A part of too many words is
dealt again by halves of what follows, until it is small or a few code points are left.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlens.llm.common import fresh, written

#: Words of an initial state that one task composes at once.
PART = 50_000
#: Code points that are left to edit, from which on a state is split whatever its words,
#: and up to which it is never split.
LONG, SHORT = 200, 2
#: A form has this many times the occurrences of its variants.
RATIO = 5


# --- the machine of one initial state


class Machine:
    """The minimised acceptor of sorted distinct words, composed with one edit and itself.

    A state is a number; ``arcs`` are its code points and next states, ``final`` says
    whether a word may end there.
    """

    def __init__(self, words: Iterator[str]):
        self.known: dict[tuple, int] = {}
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        # states of the last word's path that may still get arcs
        path: list[tuple[bool, dict[str, int]]] = [(False, {})]
        last = ""
        for word in words:
            same = 0
            while same < min(len(word), len(last)) and word[same] == last[same]:
                same += 1
            self._close(path, last, same)
            path.extend((False, {}) for _ in word[same:])
            path[-1] = (True, path[-1][1])
            last = word
        self._close(path, last, 0)
        self.start = self._state(*path[0])
        self.pairs: dict[tuple[int, int], list[str]] = {}
        self.edits: dict[int, list[tuple[str, str]]] = {}

    def _close(self, path: list, word: str, keep: int) -> None:
        while len(path) > keep + 1:
            state = self._state(*path.pop())
            path[-1][1][word[len(path) - 1]] = state

    def _state(self, final: bool, arcs: dict[str, int]) -> int:
        key = (final, tuple(arcs.items()))
        if key not in self.known:
            self.known[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
        return self.known[key]

    def common(self, a: int, b: int) -> list[str]:
        """The rests that both states accept."""
        key = (a, b) if a <= b else (b, a)
        if key not in self.pairs:
            one, two = self.arcs[key[0]], self.arcs[key[1]]
            found = [""] if self.final[a] and self.final[b] else []
            for c in one.keys() & two.keys():
                found.extend(c + rest for rest in self.common(one[c], two[c]))
            self.pairs[key] = found
        return self.pairs[key]

    def near(self, q: int) -> list[tuple[str, str]]:
        """The pairs of rests that state q accepts and that are one edit apart, the lesser first."""
        if q not in self.edits:
            found, arcs = [], sorted(self.arcs[q].items())
            for i, (c, after) in enumerate(arcs):
                found.extend((c + one, c + two) for one, two in self.near(after))
                for d, other in arcs[i + 1 :]:  # replaced
                    found.extend((c + rest, d + rest) for rest in self.common(after, other))
                # inserted or deleted
                for rest in self.common(q, after):
                    found.append((rest, c + rest) if rest < c + rest else (c + rest, rest))
            self.edits[q] = found
        return self.edits[q]

    def accepted(self) -> list[tuple[str, str]]:
        """The pairs of words that the composed machine accepts."""
        return self.near(self.start)


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function of rows (key, rest, own, word, n), sorted by key and rest: near words, both ways."""
    rows = chain.from_iterable(zip(*(c.to_pylist() for c in batch.columns)) for batch in batches)

    def pairs() -> Iterator[tuple[str, str, int]]:
        for _, state in groupby(rows, key=lambda row: row[0]):
            words = {rest: (own, word, n) for _, rest, own, word, n in state}
            if len(words) < 2 or not any(own for own, _, _ in words.values()):
                continue
            for one, two in set(Machine(iter(words)).accepted()):
                (own, a, n), (other_own, b, m) = words[one], words[two]
                if own or other_own:
                    yield a, b, m
                    yield b, a, n

    found = pairs()
    while some := list(islice(found, 10_000)):
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*some)], ["word", "other", "other_n"])


# --- partitions of the initial states


def _halved(rows: DataFrame) -> DataFrame:
    """Each row (word, n, key, rest) under the states after either half of its rest.

    ``rest`` is where the edit may be; the key tells all else. Of two rests, the shorter
    one's length s decides: half of it is s // 2 code points. So a rest of m code points
    is under the states for s = m, as one of its own, and for s = m - 1.
    """
    sized = rows.withColumn("s", F.explode(F.array(F.length("rest"), F.length("rest") - 1))).where("s > 0")
    both = sized.withColumn("turned", F.explode(F.array(F.lit(False), F.lit(True))))
    half = F.floor(F.col("s") / 2).cast("int")
    rest, left = F.col("rest"), F.length("rest") - half
    head = F.substring(rest, F.lit(1), F.when(F.col("turned"), left).otherwise(half))
    tail = F.substring(rest, F.when(F.col("turned"), left).otherwise(half) + 1, F.length("rest"))
    whole = F.when(F.col("turned"), F.concat(F.lit("<"), tail)).otherwise(F.concat(F.lit(">"), head))
    return both.select(
        "word",
        "n",
        F.concat_ws("\x00", "key", F.col("s").cast("string"), whole).alias("key"),
        F.when(F.col("turned"), head).otherwise(tail).alias("rest"),
        (F.length("rest") == F.col("s")).alias("own"),
    )


def near_words(
    words: DataFrame, word_col: str = "word", n_col: str = "n", part: int = PART, long: int = LONG
) -> DataFrame:
    """``word, other, other_n``: each pair of words one code point apart, both ways.

    ``words`` has each word once with its count; an empty word has no pair. Initial
    states of more than ``part`` words, or of words with more than ``long`` code points to
    edit, are split until at most ``SHORT`` are left.
    """
    first = words.select(
        F.col(word_col).alias("word"), F.col(n_col).alias("n"), F.lit("").alias("key"), F.col(word_col).alias("rest")
    )
    level, states = written(_halved(first), "spelling-states"), None
    while True:
        sizes = level.groupBy("key").agg(
            F.count(F.lit(1)).alias("held"), F.max("own").alias("own"), F.max(F.length("rest")).alias("longest")
        )
        held, longest = F.col("held"), F.col("longest")
        split = F.col("own") & (longest > SHORT) & ((held > part) | (held > 1) & (longest > long))
        large = written(sizes.where(split).select("key"), "spelling-large")
        last = large.isEmpty()
        small = level if last else level.join(large, "key", "left_anti")
        states = small if states is None else states.unionByName(small)
        if last:
            break
        level = written(_halved(level.join(large, "key", "left_semi")), "spelling-states")
    dealt = states.repartition("key").sortWithinPartitions("key", "rest")
    return (
        dealt.select("key", "rest", "own", "word", "n")
        .mapInArrow(_compose, "word string, other string, other_n long")
        .distinct()
    )


# --- forms


def forms(words: DataFrame, word_col: str = "word", n_col: str = "n", ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each word of a vocabulary with its counts.

    A word's form is its near word of most occurrences (of equals the least in
    code-point order) if that has ``ratio`` times the word's own; else null. The root is
    where the forms lead, the word itself if it has none. As counts grow by ``ratio`` from
    form to form, the chains are short. An empty vocabulary gives no rows; other columns
    are not read.
    """
    plain = written(words.select(F.col(word_col).alias("word"), F.col(n_col).cast("long").alias("n")), "spelling-words")
    best = near_words(plain).groupBy("word").agg(
        F.count(F.lit(1)).alias("near"),
        F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"),
    )
    found = plain.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best")).alias("best"),
    )
    found = written(
        found.select(
            "word", "n", "n_near", F.col("best.other").alias("form"), (-F.col("best.less")).alias("form_n")
        ),
        "spelling-forms",
    )
    # each round, a word's end becomes the end of that end: rounds are the logarithm of the longest chain
    ends = found.where("form is not null").select("word", F.col("form").alias("end"))
    while True:
        on = ends.select(F.col("word").alias("end"), F.col("end").alias("further"))
        longer = written(ends.join(on, "end", "left"), "spelling-ends")
        ends = longer.select("word", F.coalesce("further", "end").alias("end"))
        if longer.where("further is not null").isEmpty():
            break
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("end", "word").alias("root"), "n", "n_near", "form_n"
    )


# --- words of documents


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(text: Column) -> Column:
    """The maximal runs of Latin letters of a text; none for null."""
    return F.regexp_extract_all(text, F.lit("[A-Za-zÀ-ÿ]+"), F.lit(0))


def misspelt(run: Column, doc_id: Column, each: int) -> Column:
    """The run, of which one in ``each`` by the CRC-32 of ``doc_id:run`` loses a code point.

    Runs of a document without an id lose none.
    """
    by = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), run).cast("binary"))
    at = F.pmod(by, F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(by % each == 0, cut).otherwise(run)


def vocabulary(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    each: int | None = None,
    letters: int = 6,
    least: int = 5,
) -> DataFrame:
    """``word, n``: the words of at least ``letters`` code points and ``least`` occurrences.

    Words are ``runs`` with A to Z in lower case. With ``each``, they are misspelt first. Counts are of all whole texts; each task
    counts its own words before they meet. Empty texts and tables give no words.
    """
    run = fresh([id_col, text_col], "run")
    taken = docs.select(F.col(id_col).alias("doc_id"), F.explode(runs(F.col(text_col))).alias(run))
    lowered = taken.where(F.length(run) >= letters).select("doc_id", F.translate(run, UPPER, LOWER).alias(run))
    word = F.col(run) if each is None else misspelt(F.col(run), F.col("doc_id"), each)
    counted = lowered.select(word.alias("word")).where(F.length("word") >= letters)
    return counted.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
