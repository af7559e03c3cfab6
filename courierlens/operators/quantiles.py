"""Exact quartiles of columns with any number of distinct values.

Spark's ``percentile`` keeps every distinct value of a group in one task, which
suits whole minutes but not coordinates. Here one pass finds a bracket round each
quartile with ``percentile_approx``, whose error in ranks is bounded; a second
counts the rows below each bracket, a third the values inside, combined in each
task. The counted values are sorted into ranges, a range to a task, and stored; running
sums over the ranges tell which one holds a rank, and only that one is numbered. So a
quartile costs three passes, whatever the values, and no task holds a bracket.
"""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courierlens.sources import shared

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
#: Ranks found by approximation are off by at most a row in so many.
ACCURACY = 10_000
#: Half the width of a bracket: it exceeds the error by some ranks.
MARGIN = 4 / ACCURACY
#: With so few rows a bracket is the whole column.
FEW = 2 * ACCURACY


@dataclass(frozen=True)
class Figures:
    """Plain statistics of a column and the ends of its quartiles' brackets."""

    name: str
    count: int
    mean: float | None
    std: float | None
    min: float | None
    max: float | None
    brackets: tuple[tuple[float, float], ...]


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def statistics(numeric: DataFrame) -> list[Figures]:
    """The first pass: a dozen numbers per column come to the driver."""
    points = [p for q in QUARTILES.values() for p in (q - MARGIN, q + MARGIN)]
    at = F.array(*[F.lit(p) for p in points])
    row = numeric.agg(*[
        F.struct(
            F.count(_quoted(name)),
            F.avg(_quoted(name)),
            F.stddev_samp(_quoted(name)),
            F.min(_quoted(name)),
            F.max(_quoted(name)),
            F.percentile_approx(_quoted(name), at, F.lit(ACCURACY)),
        ).alias(f"c{i}")
        for i, name in enumerate(numeric.columns)
    ]).first()
    found = []
    for name, (count, mean, std, low, high, marks) in zip(numeric.columns, row, strict=True):
        if count <= FEW:
            marks = [low, high] * len(QUARTILES)
        brackets = tuple(zip(marks[::2], marks[1::2], strict=True)) if count else ()
        found.append(Figures(name, count, mean, std, low, high, brackets))
    return found


def with_quartiles(numeric: DataFrame, figures: list[Figures]) -> DataFrame:
    """A row for each column: its figures and ``q1, median, q3``, none if it is empty.

    Quartiles are linearly interpolated.
    """
    cells = [(f, k, *ends) for f in figures for k, ends in enumerate(f.brackets)]
    below = numeric.agg(
        F.count(F.lit(1)),
        *[F.count_if(_quoted(f.name) < low).alias(f"b{i}") for i, (f, _, low, _) in enumerate(cells)],
    )
    number = {(f.name, k): i for i, (f, k, _, _) in enumerate(cells)}
    none = F.lit(None).cast("long")
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.count).cast("long").alias("count"),
            *[
                F.lit(getattr(f, name)).cast("double").alias(name)
                for name in ("mean", "std", "min", "max")
            ],
            *[
                (F.col(f"b{number[f.name, k]}") if f.brackets else none).alias(f"below{k}")
                for k in range(len(QUARTILES))
            ],
        )
        for f in figures
    ]
    base = below.select(F.inline(F.array(*rows)))
    inside = [
        F.when(
            _quoted(f.name).between(low, high),
            F.struct(
                F.lit(f.name).alias("column_name"), F.lit(k).alias("k"), _quoted(f.name).alias("value")
            ),
        )
        for f, k, low, high in cells
    ]
    nothing = F.lit(None).cast("struct<column_name: string, k: int, value: double>")
    counted = (
        numeric.select(F.inline(F.filter(F.array(nothing, *inside), lambda cell: cell.isNotNull())))
        .groupBy("column_name", "k", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranks = base.select("column_name", "count", F.posexplode(_belows()).alias("k", "below")).where("below IS NOT NULL")
    points = F.array(*[F.lit(p) for p in QUARTILES.values()])
    ranks = ranks.withColumn("place", (F.col("count") - 1) * F.get(points, F.col("k")) - F.col("below"))
    found = values_at(in_ranges(counted), ranks, ["column_name", "k"])
    each = [F.max(F.when(F.col("k") == k, F.col("value"))).alias(label) for k, label in enumerate(QUARTILES)]
    joined = base.join(found.groupBy("column_name").agg(*each), "column_name", "left")
    problem = F.raise_error(F.lit("a quartile lies outside its bracket")).cast("double")
    return joined.select(
        "column_name", "count", "mean", "std", "min", "max",
        *[F.when(F.col("count") > 0, F.coalesce(label, problem)).alias(label) for label in QUARTILES],
    )


def _belows() -> Column:
    return F.array(*[F.col(f"below{k}") for k in range(len(QUARTILES))])


def in_ranges(counted: DataFrame) -> DataFrame:
    """Distinct values (column_name, k, value) with their counts n, stored with their range ``part``.

    Ranges are the partitions of a sort, about as many as ``spark.sql.shuffle.partitions``.
    """
    spark = counted.sparkSession
    path = shared.table_path(spark, f"ranks-{uuid4().hex}")
    ranged = counted.repartitionByRange("column_name", "k", "value").withColumn("part", F.spark_partition_id())
    ranged.write.parquet(path)
    return spark.read.schema(ranged.schema).parquet(path)


def values_at(ranged: DataFrame, ranks: DataFrame, keys: list[str]) -> DataFrame:
    """``value`` at the fractional ``place`` (from 0) of each key, linearly interpolated.

    ``ranks`` has a row for each key, so few that each task can have all. No row comes
    back for a place outside the values.
    """
    running = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy(*keys, "part").agg(F.sum("n").alias("held"))
    starts = starts.select(*keys, "part", "held", F.coalesce(F.sum("held").over(running), F.lit(0)).alias("start"))
    ends = F.array(F.floor("place"), F.ceil("place"))
    wanted = ranks.select(*keys, "place", F.posexplode(ends).alias("upper", "rank"))
    holding = starts.join(F.broadcast(wanted), keys).where(
        (F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("start") + F.col("held"))
    )
    within = Window.partitionBy(*keys, "part", "upper").orderBy("value")
    last = F.col("start") + F.sum("n").over(within)
    at = ranged.join(F.broadcast(holding.drop("held")), [*keys, "part"]).withColumn("last", last)
    hits = at.where((F.col("rank") < F.col("last")) & (F.col("rank") >= F.col("last") - F.col("n")))
    low, high = (F.max(F.when(F.col("upper") == u, F.col("value"))) for u in (0, 1))
    pair = hits.groupBy(*keys).agg(low.alias("low"), high.alias("high"), F.max("place").alias("place"))
    between = F.col("low") + (F.col("high") - F.col("low")) * (F.col("place") - F.floor("place"))
    return pair.select(*keys, F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(between).alias("value"))
