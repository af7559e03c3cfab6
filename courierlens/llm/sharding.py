"""Sharding by Karmarkar-Karp differencing.

Groups of equal texts are indivisible. Partial partitions into k shards are
combined, those of the largest spread first, with their shards in opposite order:
the fullest of one takes the emptiest of the other. So that no task gets all groups,
groups are dealt by hash to buckets; each bucket is differenced on its own, which
leaves one partial partition, and these are differenced in turn, level by level.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courierlens.llm.common import SALTS, attach, salt, written

SHARDS = 40
#: Partial partitions that one task differences.
BUCKET = 20_000
#: Rows that are numbered in one task.
RUN = 100_000


def difference(loads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combine partial partitions, one a row of loads, into one.

    Returns for each of them the shard that each of its k slots ends in, and the
    load of each shard, which is sorted downwards.
    """
    n, k = loads.shape
    order = np.argsort(-loads, axis=1, kind="stable")
    sums = [loads[i, order[i]] for i in range(n)]
    # node i * k + j is slot j of partition i; joined slots point to their new node
    parent = np.full(2 * n * k, -1, dtype=np.int64)
    slots = [i * k + order[i] for i in range(n)]
    heap = [(int(s[-1] - s[0]), i) for i, s in enumerate(sums)]
    heapq.heapify(heap)
    size = n
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        load = sums[a] + sums[b][::-1]
        by = np.argsort(-load, kind="stable")
        nodes = size * k + np.arange(k)
        parent[slots[a][by]] = nodes
        parent[slots[b][::-1][by]] = nodes
        sums.append(load[by])
        slots.append(nodes)
        sums[a] = sums[b] = slots[a] = slots[b] = None
        heapq.heappush(heap, (int(load[by[-1]] - load[by[0]]), size))
        size += 1
    top = heap[0][1]
    shard = np.empty(size * k, dtype=np.int64)
    shard[slots[top]] = np.arange(k)
    for i in range(size - 1, -1, -1):  # what is joined later has larger numbers
        own = slice(i * k, i * k + k)
        if i != top:
            shard[own] = shard[parent[own]]
    return shard[: n * k].reshape(n, k), sums[top]


def _level(shards: int):
    """Pandas function of a bucket: rows (bucket, part, slot, bytes) to their shard in the bucket."""

    def combine(rows: pd.DataFrame) -> pd.DataFrame:
        part, row = np.unique(rows["part"].to_numpy(), return_inverse=True)
        loads = np.zeros((len(part), shards), dtype=np.int64)
        loads[row, rows["slot"].to_numpy()] = rows["bytes"].to_numpy()
        found, _ = difference(loads)
        return pd.DataFrame(
            {"bucket": rows["bucket"], "part": rows["part"], "slot": rows["slot"], "bytes": rows["bytes"],
             "shard": found[row, rows["slot"].to_numpy()]}
        )

    return combine


def group_shards(groups: DataFrame, shards: int = SHARDS, bucket: int = BUCKET) -> DataFrame:
    """``digest, shard`` for ``digest, bytes``: each group gets one shard.

    A bucket holds about ``bucket`` groups, later about ``bucket / shards`` partial
    partitions, however many groups there are.
    """
    n = max(1, -(-groups.count() // bucket))
    groups = groups.select(
        "digest", "bytes", F.xxhash64("digest").alias("part"), F.lit(0).alias("slot")
    ).withColumn("bucket", F.pmod(F.xxhash64("part", F.lit("bucket")), F.lit(n)))
    kind = "bucket long, part long, slot int, bytes long, shard int"
    # equal hashes of two digests would share a slot: their bytes add up, they move together
    loads = groups.groupBy("bucket", "part", "slot").agg(F.sum("bytes").alias("bytes"))
    placed = written(loads.groupBy("bucket").applyInPandas(_level(shards), kind), "shard-level")
    out = placed.select("part", F.col("bucket").alias("held"), F.col("shard").alias("shard_"))
    while n > 1:
        inner = placed.groupBy(F.col("bucket").alias("part"), F.col("shard").alias("slot")).agg(
            F.sum("bytes").alias("bytes")
        )
        n = max(1, -(-n // max(2, bucket // shards)))
        inner = inner.withColumn("bucket", F.pmod(F.xxhash64("part", F.lit("bucket")), F.lit(n)))
        placed = written(inner.groupBy("bucket").applyInPandas(_level(shards), kind), "shard-level")
        moves = placed.select(
            F.col("part").alias("held"), F.col("slot").alias("shard_"), F.col("bucket").alias("next"), "shard"
        )
        # a row for each bucket and shard of the level below
        out = written(
            out.join(moves, ["held", "shard_"]).select(
                "part", F.col("next").alias("held"), F.col("shard").alias("shard_")
            ),
            "shard-map",
        )
    return groups.join(out, "part").select("digest", F.col("shard_").alias("shard"))


def assign(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = SHARDS,
    overhead: int = 16,
    bucket: int = BUCKET,
    run: int = RUN,
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for each row of docs.

    A row's size is the UTF-8 length of its text plus ``overhead``; null counts as
    empty. Rows of equal text share a shard. Slots number the rows of a shard from 0
    without gaps, in runs of about ``run`` rows. Repeated rows and null ids get slots of
    their own. An empty table gives no rows; other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = written(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + overhead).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
        ),
        "shard-rows",
    )
    salted = rows.groupBy("digest", salt("doc_id", SALTS).alias("salt")).agg(F.sum("size").alias("bytes"))
    groups = salted.groupBy("digest").agg(F.sum("bytes").alias("bytes"))
    placed = attach(rows, group_shards(groups, shards, bucket), "digest", "doc_id")
    runs = max(1, -(-rows.count() // (shards * run)))
    numbered = written(
        placed.select("doc_id", "size", "text_crc32", "shard", salt("doc_id", runs).alias("run")), "shard-placed"
    )
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = numbered.groupBy("shard", "run").agg(F.count(F.lit(1)).alias("held")).select(
        "shard", "run", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start")
    )
    within = Window.partitionBy("shard", "run").orderBy("doc_id", "text_crc32", "size")
    return (
        numbered.withColumn("place", F.row_number().over(within) - 1)
        .join(F.broadcast(starts) if runs <= 1000 else starts, ["shard", "run"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("place")).alias("slot"))
    )

