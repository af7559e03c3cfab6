"""Mixing sources to target weights.

Tokens are summed per source, targets and repetition rates follow from them, and
each document is emitted floor(rate) times, plus once more where a coin seeded by
its id says so; the coin's probability is the fraction of the rate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courierlens.llm.common import fresh, same, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CEILING = 2
SEED = "mix"
#: Up to so many sources their table is sent to every task; beyond, it is joined by shuffling.
BROADCAST_SOURCES = 20_000
#: Words: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def coin(id_col: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the id and the seed alone."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(id_col.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def ranked(sources: DataFrame) -> DataFrame:
    """Sources with ``place``: their number from 0 by code point, null last.

    The sorted partitions are numbered one by one, so no task sees all sources.
    """
    ordered = written(
        sources.withColumn("unnamed", F.col("source").isNull())
        .repartitionByRange("unnamed", "source")
        .withColumn("run", F.spark_partition_id()),
        "mix-sources",
    )
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = (  # a row for each partition
        ordered.groupBy("run").agg(F.count(F.lit(1)).alias("held"))
        .select("run", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start"))
    )
    within = Window.partitionBy("run").orderBy("unnamed", "source")
    return ordered.join(starts, "run").select(
        "source", "source_size", (F.col("start") + F.row_number().over(within) - 1).alias("place")
    )


def targets(
    sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, ceiling: int = CEILING
) -> DataFrame:
    """``source, source_size, target, rate`` from ``source, source_size``.

    Weights go round the sources in their order. All targets together are ``share``
    of all sizes; a target stops at ``ceiling`` times its source's size and what it
    leaves goes to the others by weight, round after round, until none is above. Each
    round is one aggregate over the sources and settles at least one more of them.
    """
    if share > ceiling:
        raise ValueError("no mix reaches the share: it is above the ceiling")
    turn = F.pmod(F.col("place"), F.lit(len(weights))).cast("int")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), turn + 1).cast("long")
    table = written(ranked(sources).withColumn("weight", weight), "mix-weights")
    total = table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    held, level = -1, 0.0
    while True:
        # stopped: sources that the level of the round before lifts to their ceiling
        stopped = F.lit(ceiling) * F.col("source_size") < F.col("weight") * F.lit(level)
        left = table.agg(
            F.count_if(stopped).alias("n"),
            F.coalesce(F.sum(F.when(stopped, F.lit(ceiling) * F.col("source_size"))), F.lit(0)).alias("size"),
            F.coalesce(F.sum(F.when(~stopped, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()
        if left["n"] == held:
            break
        rest = share * total - left["size"]
        held, level = left["n"], rest / left["weight"] if left["weight"] else float("inf")
    target = F.least(
        (F.lit(ceiling) * F.col("source_size")).cast("double"), F.col("weight") * F.lit(level)
    )
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0))
    return table.select(
        "source", "source_size", target.alias("target"), F.least(rate, F.lit(float(ceiling))).alias("rate")
    )


def copies(rate: Column, id_col: Column, seed: str = SEED) -> Column:
    """floor(rate), plus one with the probability of the fraction."""
    whole = F.floor(rate)
    return (whole + (coin(id_col, seed) < rate - whole).cast("int")).cast("long")


def plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    size_col: str | None = None,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    ceiling: int = CEILING,
    seed: str = SEED,
) -> tuple[DataFrame, dict[str, str]]:
    """Docs with four more columns, and the names these got: size, source_size, target, copies.

    Names that docs has are not reused. Null texts have size 0; null is a source
    like any other, the last; null ids share one coin, and repeated rows get the
    same number of copies. An empty table stays empty.
    """
    names: dict[str, str] = {}
    for want in ("size", "source_size", "target", "copies", "rate", "from"):
        names[want] = fresh([*docs.columns, *names.values()], want)
    sized = docs.withColumn(names["size"], words(F.col(text_col)) if size_col is None else F.col(size_col))
    sources = sized.groupBy(F.col(source_col).alias("source")).agg(
        F.sum(names["size"]).alias("source_size")
    )
    aims = targets(sources, weights, share, ceiling).select(
        F.col("source").alias(names["from"]),
        F.col("source_size").alias(names["source_size"]),
        F.col("target").alias(names["target"]),
        F.col("rate").alias(names["rate"]),
    )
    aims = written(aims, "mix-targets")
    if aims.count() <= BROADCAST_SOURCES:
        aims = F.broadcast(aims)
    mixed = sized.join(aims, same(sized[source_col], aims[names["from"]]), "left").withColumn(
        names["copies"], copies(F.col(names["rate"]), F.col(id_col), seed)
    )
    return mixed.drop(names["rate"], names["from"]), names


def mix(docs: DataFrame, **options) -> DataFrame:
    """Docs with each row as often as the mix takes it; the columns stay."""
    mixed, names = plan(docs, **options)
    again = F.explode(F.sequence(F.lit(1), F.col(names["copies"])))
    number = fresh(mixed.columns, "copy")
    return mixed.where(F.col(names["copies"]) > 0).withColumn(number, again).drop(number, *names.values())
