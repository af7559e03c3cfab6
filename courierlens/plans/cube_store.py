"""A report cube that is kept up day by day.

The cube's counts add up, so a day's orders make a delta of their own: a few thousand
rows, whatever the number of orders. A version lists the days and the delta that holds
each. Adding or replacing a day reads that day's orders only; removing one reads nothing.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courierlens.operators import metrics
from courierlens.operators.time_counts import TIME, time_counts
from courierlens.plans.report import CUBE_DIMS
from courierlens.schemas import CLEAN_SCHEMA
from courierlens.sources import versions

DAY = "order_date"
SUMS = ("n", "distance_n", "distance_sum")


def _schema() -> T.StructType:
    """The day, which is a folder of a delta, and the columns of its files."""
    kept = [CLEAN_SCHEMA[c] for c in (DAY, *CUBE_DIMS, TIME)]
    return T.StructType([*kept, *[T.StructField(c, T.LongType()) for c in SUMS]])


def days_of(deliveries: DataFrame) -> list[date]:
    return sorted(r[DAY] for r in deliveries.select(DAY).distinct().collect())


def put_days(spark: SparkSession, path: str, deliveries: DataFrame, days: Iterable[date] | None = None) -> versions.Version:
    """Count the orders of some days anew; their earlier counts no longer apply.

    Without ``days``, all days of ``deliveries``. A day without orders is then empty. The
    filter on the day reaches the scan. A writer that comes second gets
    ``versions.VersionConflict`` and leaves nothing.
    """
    base = versions.newest(spark, path)
    chosen = days_of(deliveries) if days is None else sorted(set(days))
    if not chosen:
        return base

    def write(folder: str) -> dict:
        own = deliveries.where(F.col(DAY).isin(chosen))
        delta = time_counts(own, DAY, *CUBE_DIMS, **metrics.distance_totals())
        sums = [F.col(c).cast("long").alias(c) for c in SUMS]
        delta.select(DAY, *CUBE_DIMS, TIME, *sums).repartition(DAY).write.partitionBy(DAY).parquet(folder)
        name = folder.rsplit("/", 1)[1]
        held = {r[DAY] for r in spark.read.parquet(folder).select(DAY).distinct().collect()} if _has_rows(spark, folder) else set()
        kept = {d: f for d, f in base.details.get("days", {}).items() if date.fromisoformat(d) not in chosen}
        return {"days": kept | {d.isoformat(): name for d in chosen if d in held}}

    return versions.replace(spark, path, write, base)


def _has_rows(spark: SparkSession, folder: str) -> bool:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return not files.where("path LIKE '%.parquet'").select("path").isEmpty()


def drop_days(spark: SparkSession, path: str, days: Iterable[date]) -> versions.Version:
    """Leave some days out from now on; no orders and no counts are read."""
    base = versions.newest(spark, path)
    gone = {d.isoformat() for d in days}
    kept = {d: f for d, f in base.details.get("days", {}).items() if d not in gone}
    return versions.commit(spark, path, base, base.folder or "none", {"days": kept})


def daily_cube(spark: SparkSession, path: str) -> DataFrame:
    """The counts of the newest version by day: ``order_date`` and the cube's columns."""
    held = versions.newest(spark, path).details.get("days", {})
    if not held:
        return spark.createDataFrame([], _schema())
    folders = [f"{path}/{folder}/{DAY}={day}" for day, folder in sorted(held.items())]
    found = spark.read.schema(_schema()).option("basePath", path).parquet(*folders)
    return found.select(*_schema().names)


def cube(spark: SparkSession, path: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """The cube of all days, or of a period: what ``report_cube`` gives of their orders."""
    daily = daily_cube(spark, path)
    if first is not None:
        daily = daily.where(F.col(DAY) >= F.lit(first))
    if last is not None:
        daily = daily.where(F.col(DAY) <= F.lit(last))
    return daily.groupBy(*CUBE_DIMS, TIME).agg(*[F.sum(c).alias(c) for c in SUMS])


def compact(spark: SparkSession, path: str) -> versions.Version:
    """One delta for all days, so that fewer files are read; the counts stay."""
    base = versions.newest(spark, path)
    held = base.details.get("days", {})
    if not held:
        return base

    def write(folder: str) -> dict:
        daily_cube(spark, path).repartition(DAY).write.partitionBy(DAY).parquet(folder)
        return {"days": dict.fromkeys(held, folder.rsplit("/", 1)[1])}

    return versions.replace(spark, path, write, base)
