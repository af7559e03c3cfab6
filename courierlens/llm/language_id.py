"""Language identification by rank-order profiles.

A profile lists a language's most frequent letter n-grams by rank. A document's own
most frequent n-grams are compared with each profile: an n-gram counts by how far
it is out of place, one that the profile lacks by the length of the profile. The
language of the least sum is the document's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courierlens.llm.common import fresh, written

#: n-grams of a profile and of a document that are ranked.
RANKS = 300
#: Characters whose n-grams are sorted at once; a longer text is sorted alone.
BLOCK = 400_000
#: Different n-grams that a task holds before it hands them on.
HOLD = 1_000_000
#: Languages whose profiles each task holds at once; more are compared in turns.
TURN_LANGUAGES = 1000
#: The language of texts that tell nothing.
UNKNOWN = "und"

_POINT = 21  # bits of a code point
_tables: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if "letters" not in _tables:
        _tables["letters"] = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _tables["letters"]


def _blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of up to BLOCK characters and 4096 texts."""
    start = held = 0
    for i, text in enumerate(texts):
        if i > start and (held + len(text) > BLOCK or i - start >= 4096):
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def ngrams(texts: list[str], owner: list[int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(owner, gram, count)`` arrays, sorted by owner and gram; owner: the text's index if not given.

    Grams are runs of 1 to 3 characters of a lower-case word with a space before and
    after it, as three 21-bit code points from the left; a space counts only beside
    letters. Words are runs of letters.
    """
    parts = [np.frombuffer(f" {t.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    own = np.arange(len(texts)) if owner is None else np.asarray(owner)
    chars = np.concatenate(parts)
    doc = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    space = ~_letters()[chars]
    keep = np.r_[True, ~(space[1:] & space[:-1] & (doc[1:] == doc[:-1]))]
    chars, doc, space = chars[keep], doc[keep], space[keep]
    chars[space] = 32
    # numbers for the characters that occur, in order; 0: none
    seen = np.zeros(0x110000, bool)
    seen[chars] = True
    points = np.r_[0, np.flatnonzero(seen)]
    number = np.zeros(0x110000, np.int64)
    number[points] = np.arange(len(points))
    code = number[chars]
    bits = int(len(points)).bit_length()
    if int(own.max(initial=0)).bit_length() + 3 * bits > 63:
        raise ValueError("too many texts for so many different characters")
    who = own[doc].astype(np.int64)
    base = who << (3 * bits)
    one = (base | (code << (2 * bits)))[~space]
    inside = doc[1:] == doc[:-1]
    two = base[1:][inside] | (code[:-1][inside] << (2 * bits)) | (code[1:][inside] << bits)
    inside = (doc[2:] == doc[:-2]) & ~space[1:-1]
    three = (
        base[2:][inside]
        | (code[:-2][inside] << (2 * bits))
        | (code[1:-1][inside] << bits)
        | code[2:][inside]
    )
    keys = np.concatenate([one, two, three])
    keys.sort()
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    counts = np.diff(np.r_[first, len(keys)])
    keys = keys[first]
    mask = (1 << bits) - 1
    gram = (
        (points[(keys >> (2 * bits)) & mask] << (2 * _POINT))
        | (points[(keys >> bits) & mask] << _POINT)
        | points[keys & mask]
    )
    return keys >> (3 * bits), gram, counts


def _in_parts(texts: list[str], owner: list[int] | None = None) -> Iterator[tuple[np.ndarray, ...]]:
    """ngrams, in halves where all texts at once have too many different characters."""
    owner = list(range(len(texts))) if owner is None else owner
    if len(texts) == 1:
        who, gram, count = ngrams(texts, [0])
        yield who + owner[0], gram, count
        return
    try:
        yield ngrams(texts, owner)
    except ValueError:
        half = len(texts) // 2
        yield from _in_parts(texts[:half], owner[:half])
        yield from _in_parts(texts[half:], owner[half:])


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, text) to (lang, gram, n): counts of a task's n-grams."""
    names: dict[str, int] = {}
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        who, gram, n = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((gram, who))
        who, gram, n = who[order], gram[order], n[order]
        first = np.flatnonzero(np.r_[True, (who[1:] != who[:-1]) | (gram[1:] != gram[:-1])])
        return who[first], gram[first], np.add.reduceat(n, first)

    def rows(found) -> pa.RecordBatch:
        who, gram, n = found
        langs = np.array(list(names), dtype=object)
        return pa.RecordBatch.from_arrays(
            [pa.array(langs[who], pa.string()), pa.array(gram, pa.int64()), pa.array(n, pa.int64())],
            ["lang", "gram", "n"],
        )

    for batch in batches:
        texts = batch.column("text").to_pylist()
        owner = [names.setdefault(x, len(names)) for x in batch.column("lang").to_pylist()]
        for start, end in _blocks(texts):
            for found in _in_parts(texts[start:end], owner[start:end]):
                if len(found[0]):
                    held.append(found)
            if sum(len(x[0]) for x in held) > HOLD:
                held[:] = [merged()]
                if len(held[0][0]) > HOLD // 2:
                    yield rows(held.pop())
    if held:
        yield rows(merged())


class Profiles:
    """Ranked n-grams of the languages, ready to compare with."""

    def __init__(self, rows: list[tuple[str, int, int]], ranks: int):
        self.ranks = ranks
        self.langs = sorted({lang for lang, _, _ in rows})
        self.grams = np.array(sorted({gram for _, gram, _ in rows}), dtype=np.int64)
        self.place = np.full((len(self.langs), len(self.grams) + 1), ranks, dtype=np.int64)
        at = {gram: i for i, gram in enumerate(self.grams.tolist())}
        for lang, gram, rank in rows:
            self.place[self.langs.index(lang), at[gram]] = rank

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The language of each text and a score from 0 to 1: one less the part of the
        greatest possible distance that it is away."""
        lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.langs:
            return lang, score
        for start, end in _blocks(texts):
            for who, gram, count in _in_parts(texts[start:end]):
                if not len(who):
                    continue
                # most frequent first, then by gram
                n, top = len(who), int(count.max())
                shift = n.bit_length()
                key = (((who << top.bit_length()) | (top - count)) << shift) | np.arange(n)
                key.sort()
                order = key & ((1 << shift) - 1)
                who, gram = who[order], gram[order]
                first = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
                size = np.diff(np.r_[first, n])
                rank = np.arange(n) - np.repeat(first, size)
                keep = rank < self.ranks
                gram, rank = gram[keep], rank[keep]
                size = np.minimum(size, self.ranks)
                docs = who[first]
                begin = np.r_[0, np.cumsum(size)[:-1]]
                at = np.minimum(np.searchsorted(self.grams, gram), len(self.grams) - 1)
                at[self.grams[at] != gram] = len(self.grams)
                away = np.stack([np.add.reduceat(np.abs(p[at] - rank), begin) for p in self.place])
                best = away.argmin(axis=0)
                part = away[best, np.arange(len(docs))] / (size * self.ranks)
                for i, doc in enumerate(docs):
                    lang[start + doc] = self.langs[best[i]]
                score[start + docs] = 1 - part
        return lang, score


def held_out(id_col: Column) -> Column:
    """Rows that nothing is learned from; a null id is not held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _labelled(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(
        "lang IS NOT NULL AND text IS NOT NULL"
    )


def ranked(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", ranks: int = RANKS) -> DataFrame:
    """``lang, gram, place`` of the profiles of all rows with a text and a language."""
    counts = _labelled(docs, text_col, lang_col).mapInArrow(_learn, "lang string, gram long, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return counts.withColumn("rank", rank).where(F.col("rank") <= ranks).select(
        "lang", "gram", (F.col("rank") - 1).alias("place")
    )


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", ranks: int = RANKS) -> Profiles:
    """Profiles from all rows with a text and a language, of which there are not too many for each task to hold."""
    return Profiles([tuple(r) for r in ranked(docs, text_col, lang_col, ranks).collect()], ranks)


def turns(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", ranks: int = RANKS, most: int = TURN_LANGUAGES
) -> Iterator[Profiles]:
    """The profiles of about ``most`` languages at a time; of most tables, all at once."""
    held = _labelled(docs, text_col, lang_col).select("lang").distinct().count()
    n = max(1, -(-held // most))
    if n == 1:
        yield learn(docs, text_col, lang_col, ranks)
        return
    table = written(ranked(docs, text_col, lang_col, ranks), "language-profiles")
    for turn in range(n):
        own = table.where(F.pmod(F.xxhash64("lang"), F.lit(n)) == turn)
        yield Profiles([tuple(r) for r in own.collect()], ranks)


def with_language(docs: DataFrame, text_col: str, profiles: Iterator[Profiles]) -> tuple[DataFrame, str]:
    """Docs with the language and score of each text, and the name of that column.

    Of several turns the best one counts: a language before none, the higher score, the
    first in order. The rows are written between turns.
    """
    name = fresh(docs.columns, "found")
    rows = docs
    for turn, some in enumerate(profiles):
        new = predictor(some)(F.col(text_col))
        if turn == 0:
            rows = docs.withColumn(name, new)
            continue
        other = fresh(rows.columns, "other")
        rows = written(rows, "language-turn").withColumn(other, new)
        order = [
            F.struct((F.col(c)["lang"] == UNKNOWN).alias("u"), (-F.col(c)["score"]).alias("s"), F.col(c)["lang"].alias("l"))
            for c in (name, other)
        ]
        rows = rows.withColumn(name, F.when(order[1] < order[0], F.col(other)).otherwise(F.col(name))).drop(other)
    return rows, name


def predictor(profiles: Profiles):
    @F.pandas_udf("lang string, score double")
    def language(texts: pd.Series) -> pd.DataFrame:
        lang, score = profiles.predict([t if isinstance(t, str) else "" for t in texts])
        return pd.DataFrame({"lang": lang, "score": score})

    return language


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    ranks: int = RANKS,
    most: int = TURN_LANGUAGES,
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for each row of docs.

    Learns from rows that are not held out and have text and language. A text that
    is null or without a letter is ``und`` with score 0; so is any text if there is
    nothing to learn from. Equal distances go to the language first in order. Repeated
    rows are predicted alike, an empty table gives no rows, other columns are not read.
    """
    profiles = turns(docs.where(~held_out(F.col(id_col))), text_col, lang_col, ranks, most)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows, name = with_language(rows, "text", profiles)
    return rows.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col(name)["lang"].alias("lang_pred"),
        F.col(name)["score"].alias("score"),
    )


def keep_known(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", least: float = 0.0
) -> DataFrame:
    """Docs without those whose language is unknown or whose score is below ``least``."""
    profiles = turns(docs.where(~held_out(F.col(id_col))), text_col, lang_col)
    rows, name = with_language(docs, text_col, profiles)
    found = F.col(name)
    return rows.where((found["lang"] != UNKNOWN) & (found["score"] >= least)).drop(name)
