"""Near duplicates by SimHash and a self-join of the binary trie of fingerprints.

The join walks down pairs of trie nodes together. Bits in which two nodes differ
add up on the way; a pair of nodes with more of them than the budget is pruned with
all fingerprints below. If at most ``budget`` of 64 bits differ, at least one of
``budget + 1`` spans of the fingerprint is the same in both. So each fingerprint goes into
one trie for each span, rotated until that span leads: there the budget of the
first levels is zero, only nodes paired with themselves pass, and each such subtree
is a unit of work of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courierlens.llm.common import attach, fresh, same, written
from courierlens.llm.components import merge, rooted

SHINGLE = 3
BUDGET = 3
SEED = 42
#: Hashes whose bits are counted at once.
BLOCK = 65_536
#: Fingerprints that a task gathers, in whole subtrees, before it joins them.
GATHER = 200_000
#: Pairs of nodes that are walked at once.
FRONT = 500_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of the text's shingles as a signed 64-bit number; 0 without words."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) < shingle:
        words, shingle = [b" ".join(words)], 1
    n = len(words) - shingle + 1
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, n, BLOCK):
        size = min(BLOCK, n - start)
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(g, SEED) for g, _ in zip(grams, range(size), strict=False)),
            dtype=">u8",
            count=size,
        )
        ones += np.unpackbits(hashes.view(np.uint8).reshape(size, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(shingle: int = SHINGLE):
    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return simhash


def as_hex(number: Column) -> Column:
    return F.lower(F.lpad(F.hex(number), 16, "0"))


def _length(x: np.ndarray) -> np.ndarray:
    """Bits up to and with the highest set one."""
    for step in (1, 2, 4, 8, 16, 32):
        x = x | (x >> np.uint64(step))
    return np.bitwise_count(x).astype(np.uint64)


def _split(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Where the second child of each node [lo, hi) begins; length: of its differing bits."""
    last = length - np.uint64(1)
    return np.searchsorted(keys, (keys[hi - 1] >> last) << last)


def trie_labels(keys: np.ndarray, budget: int, lead: int) -> np.ndarray:
    """For sorted distinct uint64 keys: the least index of each one's component.

    Keys are compared where their first ``lead`` bits agree; they link at up to
    ``budget`` differing bits. A trie node is the range of keys below it, given by its
    ends; its depth is where these first differ. Pairs of nodes are walked from the
    deepest siblings upwards, and pairs whose keys are one component already are done.
    """
    n = len(keys)
    label = np.arange(n)
    start = np.flatnonzero(np.r_[True, (keys[1:] ^ keys[:-1]) >> np.uint64(64 - lead) != 0]) if n else label
    lo, hi = start, np.r_[start[1:], n]
    siblings = []
    while True:
        some = hi - lo > 1
        lo, hi = lo[some], hi[some]
        if not len(lo):
            break
        mid = _split(keys, lo, hi, _length(keys[lo] ^ keys[hi - 1]))
        siblings.append((lo, mid, mid, hi))
        lo, hi = np.r_[lo, mid], np.r_[mid, hi]
    while siblings:
        stack = [siblings.pop()]
        changed = True
        while stack:
            pairs = stack.pop()
            if len(pairs[0]) > FRONT:
                stack.append(tuple(x[FRONT:] for x in pairs))
                pairs = tuple(x[:FRONT] for x in pairs)
            alo, ahi, blo, bhi = pairs
            if changed:  # where the run of equal labels that holds each key ends
                cut = np.r_[np.flatnonzero(label[1:] != label[:-1]) + 1, n]
                end = np.repeat(cut, np.diff(np.r_[0, cut]))
                changed = False
            la, lb = _length(keys[alo] ^ keys[ahi - 1]), _length(keys[blo] ^ keys[bhi - 1])
            differing = np.bitwise_count((keys[alo] ^ keys[blo]) >> np.maximum(la, lb))
            done = (end[alo] >= ahi) & (end[blo] >= bhi) & (label[alo] == label[blo])
            go = (differing <= budget) & ~done
            leaf = go & (la == 0) & (lb == 0)
            if leaf.any():
                merge(label, alo[leaf], blo[leaf])
                changed = True
            for side, (plo, phi, length, qlo, qhi) in enumerate(
                ((alo, ahi, la, blo, bhi), (blo, bhi, lb, alo, ahi))
            ):
                at = go & ~leaf & ((la >= lb) if side == 0 else (la < lb))
                if at.any():
                    mid = _split(keys, plo[at], phi[at], length[at])
                    other = (np.r_[qlo[at], qlo[at]], np.r_[qhi[at], qhi[at]])
                    stack.append((np.r_[plo[at], mid], np.r_[mid, phi[at]], *other))
    return label


def _links(budget: int, lead: int):
    """Arrow function of sorted rows (turn, key): links that connect what is linked below whole subtrees."""
    kind = pa.schema([("turn", pa.int32()), ("u", pa.int64()), ("v", pa.int64())])

    def joined(turn: np.ndarray, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        for t in np.unique(turn):
            own = np.sort(keys[turn == t])
            label = trie_labels(own, budget, lead)
            order = np.argsort(label, kind="stable")
            near = label[order[1:]] == label[order[:-1]]
            u, v = own[order[1:]][near], own[order[:-1]][near]
            if len(u):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(u), t, np.int32)), pa.array(u.view(np.int64)), pa.array(v.view(np.int64))],
                    schema=kind,
                )

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, keys = np.empty(0, np.int32), np.empty(0, np.uint64)
        for batch in batches:
            turn = np.r_[turn, batch.column("turn").to_numpy()]
            keys = np.r_[keys, batch.column("key").to_numpy().view(np.uint64)]
            if len(keys) >= GATHER:
                unit = keys >> np.uint64(64 - lead)
                last = np.flatnonzero((unit != unit[-1]) | (turn != turn[-1]))
                if len(last):
                    cut = last[-1] + 1
                    yield from joined(turn[:cut], keys[:cut])
                    turn, keys = turn[cut:], keys[cut:]
        if len(keys):
            yield from joined(turn, keys)

    return links


def _turned(number: Column, bits: int) -> Column:
    if not bits:
        return number
    return F.shiftleft(number, bits).bitwiseOR(F.shiftrightunsigned(number, 64 - bits))


def near_links(prints: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Links ``u, v`` between fingerprints (distinct, column ``print``).

    They connect exactly what the links of at most ``budget`` differing bits connect;
    there are fewer of them than fingerprints times ``budget + 1``.
    """
    lead = 64 // (budget + 1)
    turns = F.array(
        *[F.struct(F.lit(t).alias("turn"), _turned(F.col("print"), t * lead).alias("key")) for t in range(budget + 1)]
    )
    units = prints.select(F.inline(turns)).withColumn("unit", F.shiftrightunsigned("key", 64 - lead))
    walked = (
        units.repartition("turn", "unit")
        .sortWithinPartitions("turn", "unit")
        .select("turn", "key")
        .mapInArrow(_links(budget, lead), "turn int, u long, v long")
    )
    back = [F.when(F.col("turn") == t, F.struct(
        _turned(F.col("u"), 64 - t * lead if t else 0).alias("u"),
        _turned(F.col("v"), 64 - t * lead if t else 0).alias("v"),
    )) for t in range(budget + 1)]
    return walked.select(F.coalesce(*back).alias("link")).select("link.u", "link.v")


def near_components(prints: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Adds ``root`` to distinct fingerprints, column ``print``: one that is reachable, the same for all that are."""
    roots = rooted(near_links(prints.select("print"), budget))
    return prints.join(roots, prints["print"] == roots["node"], "left").select(
        *[prints[c] for c in prints.columns], F.coalesce("root", "print").alias("root")
    )


def named_groups(rows: DataFrame, budget: int = BUDGET) -> DataFrame:
    """``doc_id, print, root, component_id`` for written rows ``doc_id, print``.

    root is the least (signed) fingerprint reachable.
    """
    prints = written(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "simhash-prints")
    named = written(near_components(prints, budget), "simhash-roots")
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"), F.min("print").alias("first"))
    labels = attach(named.select("print", "root"), ids, "root", "print").select(
        "print", F.col("first").alias("root"), "component_id"
    )
    return attach(rows, labels, "print", "doc_id").select("doc_id", "print", "root", "component_id")


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, budget: int = BUDGET
) -> DataFrame:
    """``doc_id, print, root, component_id`` for each row of docs.

    Whole texts count; null is empty, and texts without words have fingerprint 0.
    Rows of one fingerprint are one node, so copies cost one row each.
    component_id is the least id reachable, null where all of them are null. Repeated
    rows stay, an empty table gives no rows, other columns are not read.
    """
    rows = written(
        docs.select(F.col(id_col).alias("doc_id"), fingerprints(shingle)(F.col(text_col)).alias("print")),
        "simhash-rows",
    )
    return named_groups(rows, budget)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = BUDGET) -> DataFrame:
    """Docs with one row of each group of near duplicates: that of the least id. The columns stay.

    Null and empty texts have one fingerprint and are a group. Repeated rows of that id
    and fingerprint are one. Where all ids of a group are null, one of its rows stays. An
    empty table stays empty.
    """
    mark = fresh(docs.columns, "print")
    marked = written(docs.withColumn(mark, fingerprints()(F.col(text_col))), "simhash-marked")
    rows = marked.select(F.col(id_col).alias("doc_id"), F.col(mark).alias("print"))
    named = named_groups(rows, budget)
    # the least id of a group with its fingerprint; of several such fingerprints the least
    stays = (
        named.where(same(F.col("doc_id"), F.col("component_id")))
        .groupBy("root", "doc_id")
        .agg(F.min("print").alias("print"))
        .select(F.col("doc_id").alias("stay_id"), F.col("print").alias("stay_print"))
    )
    kept = marked.join(
        stays, same(marked[id_col], stays["stay_id"]) & (marked[mark] == stays["stay_print"]), "left_semi"
    )
    number = fresh(kept.columns, "number")
    first = F.row_number().over(Window.partitionBy(id_col, mark).orderBy(text_col))
    return kept.withColumn(number, first).where(F.col(number) == 1).drop(number, mark)
