"""Exact duplicates by skew-safe combining, in DataFrame operations only.

1. Each task merges its own rows of equal text: the salt is the task's own, so the
   partial aggregate leaves one row for a text of the task.
2. The merged rows meet by (digest, salt): salted groups.
3. The winners of the salts meet by digest: one winner for each text.

The grouping keys hold the whole text besides the digest at every stage, so two
texts of one digest are never merged. The rows get their winner back by
(digest, salt), of which a text of a third of all rows holds a 64th at most. Where a
digest stands for several texts, its rows are joined by text too.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlens.llm.common import SALTS, salt, same, written


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def salted_groups(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """Rows (digest, text, doc_id) merged in each task, then by digest and the salt of the task.

    Which rows share a salt depends on the tasks, the winners do not.
    """
    return (
        rows.select("digest", "text", "doc_id", F.pmod(F.spark_partition_id(), F.lit(salts)).alias("task"))
        .groupBy("digest", "task", "text")
        .agg(F.max("doc_id").alias("best"), F.count(F.lit(1)).alias("n"))
    )


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    salts: int = SALTS,
) -> DataFrame:
    """One row for each row of docs: its id, digest, group and the row that stays.

    Returns ``doc_id, keep_id, group_size, kept, digest``. Texts are equal when
    identical; a null text counts as empty. The row of the largest id stays; of
    repeated rows with that id all are marked as kept. A null id never stays where
    the group has another id; in a group of null ids, keep_id is null. An empty table gives no rows. Columns other than
    the two named are not read.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).select(
        "doc_id", "text", digest(F.col("text")).alias("digest"), salt("doc_id", salts).alias("salt")
    )
    salted = salted_groups(rows, salts)
    winners = salted.repartition("digest").groupBy("digest", "text").agg(
        F.max("best").alias("keep_id"), F.sum("n").alias("group_size")
    )
    # one text for a digest: the text is needed no more; else it decides
    texts = winners.groupBy("digest").agg(
        F.count(F.lit(1)).alias("texts"),
        F.max("keep_id").alias("keep_id"),
        F.max("group_size").alias("group_size"),
    )
    found = written(texts, "exact-winners")
    narrow = written(rows.select("doc_id", "digest", "salt"), "exact-rows")
    single = found.where("texts = 1").select("digest", "keep_id", "group_size")
    pairs = narrow.select("digest", "salt").distinct().join(single, "digest")
    out = narrow.join(pairs, ["digest", "salt"])
    if not found.where("texts > 1").isEmpty():
        shared = found.where("texts > 1").select("digest")
        clash = rows.join(shared, "digest", "left_semi")
        best = winners.join(shared, "digest", "left_semi")
        pairs = clash.select("digest", "salt", "text").distinct().join(best, ["digest", "text"])
        out = out.unionByName(clash.join(pairs, ["digest", "salt", "text"]).select(out.columns))
    return out.select(
        "doc_id",
        "keep_id",
        "group_size",
        same(F.col("doc_id"), F.col("keep_id")).alias("kept"),
        "digest",
    )
