"""Language-model scoring by masked pseudo-likelihood.

A network sees the words on both sides of a hidden one and predicts it. A document's
score is the sum of the log-probabilities of its words, each given its window. Training is
data-parallel: documents are dealt to shards by a hash of their words and id; in each round
a copy of the network is trained on each shard, document after document in the order of
their hashes, and the copies are averaged, weighted by words, block by block. So the
scores depend on the documents, not on how they lie in files and partitions.

The hidden word is predicted in two steps, its class and the word in the class, so
a word costs the square root of the network's numbers. These grow with the corpus, as the
square root of its distinct words. The commonest words have numbers of their own. The
others share numbers by hash; of its number's probability such a word has the share that
it has of the number's occurrences, by the counts of all words. So every word has a
probability of its own, and those of all words of the corpus add up to one.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain, compress, groupby, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from courierlens.llm.common import written

#: Words on either side that are seen.
SIDE = 2
#: Classes at least; more where the distinct words' fourth root is more. The network has CLASSES
#: times CLASSES numbers, of which one in SHARED is shared by hash.
CLASSES = 32
SHARED = 4
#: Commonest words, about, whose shares the tasks hold; the shares of others are joined.
HELD = 200_000
#: Width of the hidden layer.
WIDTH = 16
ROUNDS = 2
#: Words of a training shard, or more where the corpus has more than SHARDS times as many.
SHARD_WORDS = 1_000_000
SHARDS = 1024
RATE = 0.15
#: Words of a training step, and of a scoring step.
BATCH = 8192
#: Parameters are averaged as whole numbers of this unit, so their order doesn't matter.
UNIT = 1 << 24
#: Parameters of a row that goes to be averaged.
BLOCK = 4096
#: Logarithms of shares are added as whole numbers of this part of one.
LOG_UNIT = 10**9


def words(text: str | None) -> list[bytes]:
    """Words of the text, split at ASCII white space, with A-Z in lower case."""
    return (text or "").encode().lower().split()


def _slices(texts: pa.Array, most: int = 16 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes; a longer text is alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield start, stop
        start = stop


def coded(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words of texts, the place of each word among them, and each text's number of words.

    The words are those of ``words``, split for all texts at once.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, sizes = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    there = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not there.all():  # white space at either end
        owner = np.repeat(np.arange(len(sizes)), sizes)[there]
        flat, sizes = flat.filter(pa.array(there)), np.bincount(owner, minlength=len(sizes))
    found = flat.dictionary_encode()
    return found.dictionary.cast(pa.binary()), found.indices.to_numpy(zero_copy_only=False), sizes


class Vocabulary:
    """Numbers of words: the commonest by rank, others by hash.

    ``common`` are the commonest words in order, more than have numbers of their own;
    ``shares`` the logarithms, in units, of what those beyond have of their numbers.
    """

    def __init__(self, common: list[bytes], classes: int = CLASSES, shares: Iterable[int] = ()):
        self.classes, self.size = classes, classes * classes
        self.hashed = self.size // SHARED
        self.own = self.size - self.hashed
        self.rank = {w: i for i, w in enumerate(common)}
        self.number = np.arange(len(common))
        self.number[self.own :] = self.by_hash(common[self.own :])
        self.share = np.zeros(len(common), np.int64)
        self.share[self.own :] = list(shares)
        self.kind = np.dtype(np.uint16 if self.size < 1 << 16 else np.uint32)

    def by_hash(self, tokens: list[bytes]) -> np.ndarray:
        return self.own + np.fromiter(map(zlib.crc32, tokens), np.int64, len(tokens)) % self.hashed

    def look(self, tokens: list[bytes]) -> tuple[np.ndarray, int, list[bytes]]:
        """The tokens' numbers, the sum of the shares that are held, and the tokens whose shares are not."""
        found = np.fromiter(map(self.rank.get, tokens, repeat(-1)), np.int64, len(tokens))
        others = np.flatnonzero(found < 0)
        held = found[found >= 0]
        rest = list(map(tokens.__getitem__, others.tolist()))
        found[found >= 0] = self.number[held]
        found[others] = self.by_hash(rest)
        return found, int(self.share[held].sum()), rest

    def look_each(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each token's number, its share if that is held, and whether it is not."""
        found = np.fromiter(map(self.rank.get, tokens, repeat(-1)), np.int64, len(tokens))
        unknown = found < 0
        numbers, shares = np.empty(len(tokens), np.int64), np.zeros(len(tokens), np.int64)
        numbers[~unknown], shares[~unknown] = self.number[found[~unknown]], self.share[found[~unknown]]
        numbers[unknown] = self.by_hash(list(compress(tokens, unknown.tolist())))
        return numbers, shares, unknown

    def ids(self, tokens: list[bytes]) -> np.ndarray:
        return self.look(tokens)[0]


class Network:
    """Windows to words. Parameters are one flat array with named parts."""

    def __init__(self, classes: int = CLASSES, width: int = WIDTH, side: int = SIDE, flat: np.ndarray | None = None):
        self.classes, self.width, self.side = classes, width, side
        n = classes * classes
        shapes = {
            "seen": (2 * side, n + 1, width),  # the last word is the edge of a document
            "bias": (width,),
            "group": (width, classes),
            "group_bias": (classes,),
            "member": (classes, width, classes),
            "member_bias": (classes, classes),
        }
        sizes = [int(np.prod(s)) for s in shapes.values()]
        if flat is None:
            flat = np.random.default_rng(1).normal(0, 0.1, sum(sizes)).astype(np.float32)
        self.flat = flat
        self.part = self.parts(flat, shapes, sizes)
        self.shapes, self.sizes = shapes, sizes
        self.held: dict[str, np.ndarray] = {}

    @staticmethod
    def parts(flat, shapes, sizes) -> dict[str, np.ndarray]:
        ends = np.cumsum(sizes)
        return {k: flat[e - n : e].reshape(s) for (k, s), n, e in zip(shapes.items(), sizes, ends, strict=True)}

    def room(self, name: str, *shape: int, kind: type | np.dtype | None = None) -> np.ndarray:
        """An array to be filled, in the same memory at each step: fresh memory costs a page fault for each page."""
        kind, size = np.dtype(kind or self.flat.dtype), math.prod(shape)
        held = self.held.get(name)
        if held is None or held.size < size or held.dtype != kind:
            held = self.held[name] = np.empty(size, kind)
        return held[:size].reshape(shape)

    def window(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        steps = [d for d in range(-self.side, self.side + 1) if d]
        return np.stack([ids[at + d] for d in steps])

    def hidden(self, seen: np.ndarray) -> np.ndarray:
        total = self.part["seen"][0].take(seen[0], axis=0)
        for k in range(1, len(seen)):
            total += self.part["seen"][k].take(seen[k], axis=0)
        total += self.part["bias"]
        return np.tanh(total, out=total)

    def steep(self) -> bool:
        """Whether scores may get too large for plain exponentials; hidden units stay within 1."""
        p = self.part
        group = np.abs(p["group"]).sum(axis=0) + np.abs(p["group_bias"])
        member = np.abs(p["member"]).sum(axis=1) + np.abs(p["member_bias"])
        return max(group.max(), member.max()) > 80

    @staticmethod
    def _predict(x: np.ndarray, chosen: np.ndarray, parts: list[slice], steep: bool, train: bool) -> np.ndarray:
        """Log-probabilities of the chosen columns of scores; in training x becomes the scores' gradient, too.

        The exponentials, less the row's maximum if steep, are added up part by part.
        """
        if steep:
            x -= x.max(axis=1, keepdims=True)
        np.exp(x, out=x)
        ones, total = np.ones(x.shape[1], x.dtype), np.empty(len(x), x.dtype)
        for rows in parts:
            np.matmul(x[rows], ones, out=total[rows])
        flat, at = x.reshape(-1), np.arange(len(x)) * x.shape[1] + chosen
        logs = np.log(flat[at] / total)
        if train:
            x /= total[:, None]
            flat[at] -= 1
        return logs

    def step(self, ids: np.ndarray, at: np.ndarray, squares: np.ndarray | None = None, rate: float = RATE):
        """Log-probabilities of the words at the places; with squares (of past gradients), train on them."""
        p, c, train = self.part, self.classes, squares is not None
        target = ids[at]
        order = np.argsort((target // c).astype(np.uint16), kind="stable")  # words of a class side by side
        at, target = at[order], target[order]
        group = target // c
        member = target - group * c
        ends = np.searchsorted(group, np.arange(c + 1)).tolist()
        classes = [(k, slice(lo, hi)) for k, (lo, hi) in enumerate(zip(ends, ends[1:])) if lo < hi]
        seen = self.window(ids, at)
        h = self.hidden(seen)
        # a last unit of ones, so that the biases are rows of the matrices
        wide = np.ones((len(h), self.width + 1), h.dtype)
        wide[:, :-1] = h
        groups = np.vstack([p["group"], p["group_bias"]])
        members = np.concatenate([p["member"], p["member_bias"][:, None]], axis=1)
        steep = self.steep()
        # scores, exponentials, probabilities and gradients in turn, of the class and then of the word in it
        x = np.matmul(wide, groups, out=self.room("scores", len(h), c))
        logs = self._predict(x, group, [slice(None)], steep, train)
        if train:
            grad = self.room("grad", len(self.flat))
            grad[:] = 0
            g = self.parts(grad, self.shapes, self.sizes)
            both = wide.T @ x
            g["group"][:], g["group_bias"][:] = both[:-1], both[-1]
            back = np.matmul(x, p["group"].T, out=self.room("back", *h.shape))
        for k, rows in classes:
            np.matmul(wide[rows], members[k], out=x[rows])
        logs += self._predict(x, member, [rows for _, rows in classes], steep, train)
        if train:
            both, more = np.zeros_like(members), self.room("more", *h.shape)
            for k, rows in classes:
                np.matmul(wide[rows].T, x[rows], out=both[k])
                np.matmul(x[rows], p["member"][k].T, out=more[rows])
            g["member"][:], g["member_bias"][:] = both[:, :-1], both[:, -1]
            back += more
            h *= h
            back *= np.subtract(1, h, out=h)
            g["bias"][:] = back.sum(axis=0)
            columns = self.room("columns", self.width, len(h), kind=np.float64)
            columns[:] = back.T
            for k in range(len(seen)):
                for j in range(self.width):
                    g["seen"][k][:, j] = np.bincount(seen[k], columns[j], c * c + 1)
            grad /= len(at)
            root = np.multiply(grad, grad, out=self.room("root", len(grad)))
            squares += root
            np.sqrt(squares, out=root)
            root += 1e-6
            grad *= rate
            grad /= root
            self.flat -= grad
        out = np.empty_like(logs)
        out[order] = logs
        return out


def _streams(texts: Iterable[np.ndarray], size: int, side: int) -> Iterator[tuple]:
    """``(ids, places, text number of each place)`` of several texts' numbers at once, with edges between them."""
    edge = np.full(side, size, np.int64)
    parts, places, owners, size = [edge], [], [], side
    for number, ids in enumerate(texts):
        parts += [ids, edge]
        places.append(size + np.arange(len(ids)))
        owners.append(np.full(len(ids), number))
        size += len(ids) + side
        if size > 8 * BATCH:
            yield np.concatenate(parts), np.concatenate(places), np.concatenate(owners)
            parts, places, owners, size = [edge], [], [], side
    if places:
        yield np.concatenate(parts), np.concatenate(places), np.concatenate(owners)


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different words of some texts at a time with their counts, which Spark adds up within the task."""
    for batch in batches:
        texts = batch.column("text")
        for start, stop in _slices(texts):
            different, places, _ = coded(texts.slice(start, stop - start))
            n = np.bincount(places, minlength=len(different))
            yield pa.RecordBatch.from_arrays([different, pa.array(n, pa.int64())], ["word", "n"])


def counted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``word, n``: all words of all rows, written to the shared folder."""
    counts = docs.select(F.col(text_col).alias("text")).where("text IS NOT NULL").mapInArrow(
        _counting, "word binary, n long"
    )
    return written(counts.groupBy("word").agg(F.sum("n").alias("n")), "masked-counts")


def _after(last: Row) -> Column:
    """Whether a word comes after the last one by falling count, equal counts by the word."""
    word = F.lit(bytearray(last["word"]))
    return (F.col("n") < last["n"]) | ((F.col("n") == last["n"]) & (F.col("word") > word))


def _shares(counts: DataFrame, own: list[Row], hashed: int) -> DataFrame:
    """``word, n, share`` of the words without numbers of their own; share is a logarithm in units."""
    others = counts.where(_after(own[-1]) if own else F.lit(True))
    others = others.withColumn("number", F.pmod(F.crc32("word"), F.lit(hashed)))
    totals = others.groupBy("number").agg(F.sum("n").alias("total"))
    share = F.round(F.log(F.col("n") / F.col("total")) * LOG_UNIT).cast("long")
    return others.join(F.broadcast(totals), "number").select("word", "n", share.alias("share"))


def known_words(counts: DataFrame) -> tuple[Vocabulary, DataFrame | None]:
    """The vocabulary of counted words, and ``word, share`` of those that it doesn't hold; None if it holds all."""
    distinct = counts.count()
    classes = max(CLASSES, math.ceil(distinct**0.25))
    hashed = classes * classes // SHARED
    n_own = classes * classes - hashed
    order = [F.desc("n"), F.col("word")]
    own = counts.orderBy(*order).limit(n_own).collect()
    if distinct <= n_own:
        return Vocabulary([bytes(r["word"]) for r in own], classes), None
    shares = written(_shares(counts, own, hashed), "masked-shares")
    beyond = distinct - n_own
    least = _count_above(shares, max(1, HELD - n_own), beyond)
    held = shares.where(F.col("n") > least).collect()
    known = Vocabulary([bytes(r["word"]) for r in own + held], classes, [r["share"] for r in held])
    rest = shares.where(F.col("n") <= least).select("word", "share") if beyond > len(held) else None
    return known, rest


def _count_above(shares: DataFrame, most: int, words: int) -> int:
    """A count above which there are about ``most`` of the words, never more than twice as many."""
    if words <= most:
        return 0
    least = shares.agg(F.percentile_approx("n", 1 - most / words, 10_000)).first()[0]
    while shares.where(F.col("n") > least).count() > 2 * most:
        least *= 2
    return least


def vocabulary(docs: DataFrame, text_col: str = "text") -> Vocabulary:
    """The commonest words of all rows; equal counts by the word."""
    return known_words(counted(docs, text_col))[0]


def _numbering(known: Vocabulary):
    """Texts to their words' numbers, held shares, and the words whose shares are not held."""

    def rows(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        different, places, sizes = coded(texts)
        number, share, unknown = known.look_each(different.to_numpy(zero_copy_only=False).tolist())
        numbers, ends = number.astype(known.kind)[places], np.r_[0, np.cumsum(sizes)]
        shares = np.r_[0, np.cumsum(share[places])][ends]
        # the words whose shares are not held, with their counts in each text
        owner = np.repeat(np.arange(len(sizes)), sizes)
        rest = unknown[places]
        pairs, n = np.unique(owner[rest] * max(1, len(different)) + places[rest], return_counts=True)
        per_text = np.bincount(pairs // max(1, len(different)), minlength=len(sizes))
        word = different.take(pa.array(pairs % max(1, len(different)), pa.int64()))
        cells = pa.StructArray.from_arrays([word, pa.array(n, pa.int64())], ["word", "n"])
        raw = numbers.tobytes()
        at = (ends * known.kind.itemsize).tolist()
        return pa.RecordBatch.from_arrays(
            [
                ids,
                pa.array([raw[a:b] for a, b in zip(at, at[1:])], pa.binary()),
                pa.array(np.diff(shares), pa.int64()),
                pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(per_text)], pa.int32()), cells),
            ],
            ["doc_id", "ids", "share", "rest"],
        )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for start, stop in _slices(texts, 4 << 20):  # the arrays by word are several times the text
                yield rows(batch.column("doc_id").slice(start, stop - start), texts.slice(start, stop - start))

    return number


def numbered(docs: DataFrame, known: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row, doc_id, ids, share, rest`` for each row of docs, written to the shared folder."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids binary, share long, rest array<struct<word: binary, n: long>>"
    found = rows.mapInArrow(_numbering(known), schema)
    return written(found.withColumn("row", F.monotonically_increasing_id()), "masked-rows")


def _training(start: np.ndarray, classes: int, kind: np.dtype, rate: float):
    """Numbers, sorted by shard, to (block, seen, part): the shard's words and a block of its trained parameters."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = chain.from_iterable(zip(b.column("shard").to_pylist(), b.column("ids")) for b in batches)
        for _, shard in groupby(rows, key=lambda row: row[0]):
            net = Network(classes, flat=start.copy())
            squares = np.full(len(start), 1e-6, np.float32)
            seen = 0
            texts = (np.frombuffer(x.as_buffer(), kind) for _, x in shard)
            for ids, at, _ in _streams(texts, classes * classes, net.side):
                for i in range(0, len(at), BATCH):
                    net.step(ids, at[i : i + BATCH], squares, rate)
                seen += len(at)
            part = [net.flat[i : i + BLOCK].tobytes() for i in range(0, len(net.flat), BLOCK)]
            yield pa.RecordBatch.from_pydict(
                {"block": pa.array(range(len(part)), pa.int32()), "seen": [seen] * len(part), "part": part}
            )

    return train


def _added(copies: pa.Table) -> pa.Table:
    """The words of all shards and the sums of a block's parameters in units, times the shards' words.

    A sum is two whole numbers, so that it stays exact over any number of shards.
    """
    seen, high, low = 0, 0, 0
    for n, part in zip(copies["seen"].to_pylist(), copies["part"].to_pylist(), strict=True):
        whole = np.rint(np.frombuffer(part, np.float32).astype(np.float64) * UNIT).astype(np.int64) * n
        seen, high, low = seen + n, high + (whole >> 32), low + (whole & 0xFFFFFFFF)
    return pa.table({"block": copies["block"][:1], "seen": [seen], "high": [high.tobytes()], "low": [low.tobytes()]})


def fitted(rows: DataFrame, known: Vocabulary, rounds: int = ROUNDS, rate: float = RATE) -> Network:
    """The network after so many rounds over all numbered rows, dealt to shards."""
    net = Network(known.classes)
    ids = rows.select("ids", F.xxhash64("ids", "doc_id").alias("hash")).where(F.octet_length("ids") > 0)
    held = ids.agg(F.sum(F.octet_length("ids"))).first()[0] or 0
    shards = min(SHARDS, max(1, held // (known.kind.itemsize * SHARD_WORDS)))
    dealt = ids.withColumn("shard", F.pmod("hash", F.lit(shards))).repartition(shards, "shard")
    # read in each round; a part that is lost with its executor is dealt and sorted again
    ids = dealt.sortWithinPartitions("shard", "hash", "ids").select("shard", "ids").persist(StorageLevel.DISK_ONLY)
    for _ in range(rounds):
        train_copy = _training(net.flat, known.classes, known.kind, rate)
        copies = ids.mapInArrow(train_copy, "block int, seen long, part binary")
        sums = copies.groupBy("block").applyInArrow(_added, "block int, seen long, high binary, low binary")
        found = sums.collect()
        if not found:
            break
        flat = np.empty_like(net.flat)
        for block, seen, *parts in found:
            high, low = (np.frombuffer(x, np.int64).tolist() for x in parts)
            mean = [((h << 32) + rest) / (UNIT * seen) for h, rest in zip(high, low, strict=True)]
            flat[block * BLOCK : block * BLOCK + len(mean)] = mean
        net = Network(known.classes, flat=flat)
    ids.unpersist()
    return net


def train(
    docs: DataFrame, known: Vocabulary, text_col: str = "text", rounds: int = ROUNDS, rate: float = RATE
) -> Network:
    """The network after so many rounds over all rows; its size is the vocabulary's."""
    return fitted(numbered(docs, known, text_col, text_col), known, rounds, rate)


def _sums(net: Network, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The number of words of each text and the sum of their numbers' log-probabilities."""
    count, total = np.zeros(len(texts), np.int64), np.zeros(len(texts))
    for ids, at, owner in _streams(texts, net.classes**2, net.side):
        for i in range(0, len(at), BATCH):
            part = owner[i : i + BATCH]
            logs = net.step(ids, at[i : i + BATCH]).astype(np.float64)
            total += np.bincount(part, logs, minlength=len(texts))
            count += np.bincount(part, minlength=len(texts))
    return count, total


def scorer(flat: np.ndarray, known: Vocabulary):
    """Scores of texts by the network alone: a shared number's probability is not yet parted among its words."""

    @F.pandas_udf("n_tokens long, log_prob double")
    def pseudo_likelihood(texts: pd.Series) -> pd.DataFrame:
        count, total = _sums(Network(known.classes, flat=flat), [known.ids(words(t)) for t in texts])
        return pd.DataFrame({"n_tokens": count, "log_prob": np.round(total, 4)})

    return pseudo_likelihood


def _row_scorer(flat: np.ndarray, classes: int, kind: np.dtype):
    @F.pandas_udf("n_tokens long, log_prob double")
    def pseudo_likelihood(ids: pd.Series) -> pd.DataFrame:
        count, total = _sums(Network(classes, flat=flat), [np.frombuffer(x, kind) for x in ids])
        return pd.DataFrame({"n_tokens": count, "log_prob": total})

    return pseudo_likelihood


def score(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, rate: float = RATE
) -> DataFrame:
    """``doc_id, n_tokens, log_prob, mean_log_prob`` for each row of docs, by a network trained on all of them.

    log_prob is the sum over all words of the text, each word's probability being its
    number's times its share of that number. Null and empty texts have no words,
    log_prob 0 and no mean. Repeated rows count in training and are scored alike, an
    empty table gives no rows, other columns are not read.
    """
    known, shares = known_words(counted(docs, text_col))
    rows = numbered(docs, known, id_col, text_col)
    net = fitted(rows, known, rounds, rate)
    by_net = _row_scorer(net.flat, known.classes, known.kind)(F.col("ids"))
    found = rows.select("row", "doc_id", "share", by_net.alias("s"))
    if shares is not None:
        rest = rows.select("row", F.explode("rest").alias("r")).select("row", "r.word", "r.n").join(shares, "word")
        sums = rest.groupBy("row").agg(F.sum(F.col("n") * F.col("share")).alias("more"))
        found = found.join(sums, "row", "left").withColumn("share", F.col("share") + F.coalesce("more", F.lit(0)))
    total = F.round(F.col("s.log_prob") + F.col("share") / LOG_UNIT, 4)
    found = found.select("doc_id", "s.n_tokens", total.alias("log_prob"))
    mean = F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens"))
    return found.withColumn("mean_log_prob", mean)
