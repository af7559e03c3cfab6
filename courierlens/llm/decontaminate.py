"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item is in a document if at least ``threshold`` of its word shingles are.
Items are partitioned by their number of shingles, to powers of two. An item's
sketch is its k least shingle hashes (bottom-k MinHash); k is one more than the
shingles that an item of the partition's largest size may lack, so whatever contains
an item contains a hash of its sketch, however long it is. Documents are searched
for all sketches at once; a partition's items are tried only on documents with shingles enough. Each find is
verified by the shingles themselves.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlens.llm.common import attach, fresh, written

SHINGLE = 5
THRESHOLD = Fraction(4, 5)
#: Bytes of different test items that are sent to all tasks at once; more items are searched in turns.
ITEM_BYTES = 16_000_000
FOUND = "array<struct<item: long, shingles: long, shared: long>>"

_WORD = re.compile(r"[^\W_]+")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    """Runs of letters and digits, in lower case."""
    return _WORD.findall(text.lower()) if text else []


def shingle_hashes(tokens: list[str], width: int) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` words; of all words if there are fewer."""
    if not tokens:
        return np.empty(0, np.uint64)
    width = min(width, len(tokens))
    each = np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens))
    n = len(tokens) - width + 1
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = (out ^ each[i : i + n]) * _STEP
        out ^= out >> np.uint64(29)
    return out


def shingles(tokens: list[str], width: int) -> set[tuple[str, ...]]:
    width = min(width, len(tokens))
    return set(zip(*(tokens[i:] for i in range(width)), strict=False)) if tokens else set()


class Items:
    """Test items and their sketches; shingles are made again for the items that are verified."""

    def __init__(self, rows: Iterable[tuple[int | None, str | None]], width: int, threshold: Fraction):
        same: dict[str, list[int | None]] = defaultdict(list)
        for item, text in rows:
            if tokens := words(text):
                same[" ".join(tokens)].append(item)
        self.width, self.threshold = width, threshold
        self.texts = list(same)
        self.ids = [sorted(x, key=lambda i: (i is None, i or 0)) for x in same.values()]
        hashes, owners, least = [], [], []
        # items shorter than a shingle, by length and words: looked up by the texts' runs of that length
        self.short: dict[int, dict[str, int]] = defaultdict(dict)
        for i, text in enumerate(self.texts):
            tokens = text.split(" ")
            own = np.unique(shingle_hashes(tokens, width))
            smallest = 1 << (len(own).bit_length() - 1)
            largest = 2 * smallest - 1
            sketch = own[: largest - self.needed(largest) + 1]
            hashes.append(sketch)
            owners.append(np.full(len(sketch), i, np.int32))
            least.append(self.needed(smallest))
            if len(tokens) < width:
                self.short[len(tokens)][text] = i
        self.least = np.array(least, np.int64)
        every = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.hashes = every[order]
        self.owners = (np.concatenate(owners) if owners else np.empty(0, np.int32))[order]

    def needed(self, size: int) -> int:
        """Of so many shingles, those that must be there."""
        return -(-size * self.threshold.numerator // self.threshold.denominator)

    def shingles(self, item: int) -> set[tuple[str, ...]]:
        return shingles(self.texts[item].split(" "), self.width)

    def find(self, text: str | None) -> list[tuple[int, int, int]]:
        """``(item, its shingles, those shared)`` of the items that the text contains."""
        tokens = words(text)
        if not tokens or not len(self.hashes):
            return []
        own = shingle_hashes(tokens, self.width)
        tries = set()
        at = np.searchsorted(self.hashes, own)
        hit = np.flatnonzero(self.hashes[np.minimum(at, len(self.hashes) - 1)] == own)
        for value in np.unique(own[hit]):
            lo, hi = np.searchsorted(self.hashes, value), np.searchsorted(self.hashes, value, side="right")
            tries.update(i for i in self.owners[lo:hi].tolist() if self.least[i] <= len(own))
        out = []
        if tries:
            have = shingles(tokens, self.width)
            for i in sorted(tries):
                wanted = self.shingles(i)
                shared = len(wanted & have)
                if shared >= self.needed(len(wanted)):
                    out.append((i, len(wanted), shared))
        for size, items in self.short.items():
            if len(tokens) > size:
                runs = {" ".join(run) for run in shingles(tokens, size)}
                out.extend((items[run], 1, 1) for run in sorted(runs) if run in items)
        return out


def finder(items: Items):
    @F.pandas_udf(FOUND)
    def contained(texts: pd.Series) -> pd.Series:
        return pd.Series(
            [[{"item": items.ids[i][0], "shingles": n, "shared": shared} for i, n, shared in items.find(t)] for t in texts]
        )

    return contained


def plain():
    """The words of each text with blanks between; null if there are none."""

    @F.pandas_udf("string")
    def joined(texts: pd.Series) -> pd.Series:
        return pd.Series([" ".join(words(t)) or None for t in texts], dtype=object)

    return joined


def distinct_items(benchmark: DataFrame, item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``item, text, item_ids``: a number for each of the items of equal words, and all their ids, nulls last.

    Words are runs of letters and digits in lower case. Items without words, and null
    ones, are left out. The rows are written to the shared folder.
    """
    item = F.col(item_col).cast("long").alias("item_id")
    rows = benchmark.select(item, plain()(F.col(item_text_col)).alias("text"))
    each = F.struct(F.isnull("item_id").alias("unnamed"), "item_id")
    same = rows.groupBy("text").agg(F.array_sort(F.collect_list(each)).alias("each")).where("text IS NOT NULL")
    same = same.select(F.monotonically_increasing_id().alias("item"), "text", F.col("each.item_id").alias("item_ids"))
    return written(same, "items")


def turns(
    items: DataFrame, width: int = SHINGLE, threshold: Fraction = THRESHOLD, item_bytes: int = ITEM_BYTES
) -> Iterator[Items]:
    """The distinct items in turns of about ``item_bytes`` bytes, so that a task holds one turn.

    A shingle is ``width`` words. An item of fewer words is found as a whole. A turn is
    read when it is asked for.
    """
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-total // item_bytes))
    turn = F.pmod(F.xxhash64("text"), F.lit(n))
    for t in range(n):
        yield Items(map(tuple, items.where(turn == t).select("item", "text").collect()), width, threshold)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    **options,
) -> DataFrame:
    """``doc_id, item_id, item_ids, shingles, shared, containment``: a row for each find.

    A row of docs gives one for each item it contains; repeated rows give theirs each.
    Items of equal words are one find with all their ids, item_id is the least. Null and
    empty texts contain nothing; other columns are not read. More items than one turn
    take a scan each turn, whose finds are written before the next turn is read.
    """
    items, parts = distinct_items(benchmark, item_col, item_text_col), []
    for turn in turns(items, **options):
        found = docs.select(F.col(id_col).alias("doc_id"), F.explode(finder(turn)(F.col(text_col))).alias("f"))
        parts.append(written(found.select("doc_id", "f.*"), "finds"))
    named = attach(reduce(DataFrame.unionByName, parts), items.select("item", "item_ids"), "item", "doc_id")
    share = (F.col("shared") / F.col("shingles")).alias("containment")
    return named.select("doc_id", F.col("item_ids")[0].alias("item_id"), "item_ids", "shingles", "shared", share)


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    **options,
) -> DataFrame:
    """Docs without those that contain a test item; the columns stay.

    Null and empty texts stay. More items than one turn take a written table each turn.
    """
    found = fresh(docs.columns, "found")
    for number, items in enumerate(turns(distinct_items(benchmark, item_col, item_text_col), **options)):
        docs = docs if number == 0 else written(docs, "clean")
        docs = docs.withColumn(found, F.size(finder(items)(F.col(text_col)))).where(F.col(found) == 0).drop(found)
    return docs
