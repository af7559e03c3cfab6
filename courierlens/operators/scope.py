"""Filter scope of a report: a value object that becomes one predicate."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import accumulate
from operator import and_
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courierlens.functions.rounding import percent
from courierlens.settings import (
    DEFAULT,
    FESTIVAL_CHOICES,
    PERIOD_CHOICES,
    TRAFFIC_DOMAIN,
    SlaConfig,
)
from courierlens.sources import shared

# Which list of a scope filters which column.
LIST_COLUMNS = {
    "cities": "city",
    "traffic": "traffic_density",
    "weather": "weather",
    "vehicles": "vehicle_type",
    "order_types": "order_type",
}


@dataclass(frozen=True)
class Scope:
    """Chosen values per dimension; an empty list or None does not filter.

    An explicit list also drops the rows whose value is null. Festival and period
    must be among the choices there are.
    """

    cities: tuple[str, ...] = ()
    traffic: tuple[str, ...] = ()
    weather: tuple[str, ...] = ()
    vehicles: tuple[str, ...] = ()
    order_types: tuple[str, ...] = ()
    festival: str | None = None
    period: str | None = None

    def __post_init__(self) -> None:
        for name, choices in (("festival", FESTIVAL_CHOICES), ("period", PERIOD_CHOICES)):
            chosen = getattr(self, name)
            if chosen and chosen not in choices:
                raise ValueError(f"{name} {chosen!r} is none of {', '.join(choices)}")

    def predicate(self) -> Column:
        """One conjunction, so all of it can be pushed into the scan."""
        parts = [
            F.col(column).isin(*chosen)
            for name, column in LIST_COLUMNS.items()
            if (chosen := getattr(self, name))
        ]
        if self.festival:
            parts.append(F.col("festival") == self.festival)
        if self.period:
            parts.append(F.col("peak_period") == self.period)
        return reduce(and_, parts, F.lit(True))


def apply_scope(df: DataFrame, scope: Scope) -> DataFrame:
    return df.where(scope.predicate())


def scope_share(
    df: DataFrame, scope: Scope, weight: Column | None = None
) -> DataFrame:
    """Rows in scope, all rows and the share, in one pass.

    ``weight`` is the number of orders a row stands for, one when not given.
    """
    orders = F.lit(1) if weight is None else weight
    inside = F.sum(F.when(scope.predicate(), orders).otherwise(0))
    row = df.agg(
        F.coalesce(inside, F.lit(0)).alias("filtered_orders"),
        F.coalesce(F.sum(orders), F.lit(0)).alias("all_orders"),
    )
    share = percent(F.col("filtered_orders"), F.col("all_orders"))
    return row.withColumn(
        "share_pct", F.when(F.col("all_orders") > 0, share).otherwise(0.0)
    )


def known(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which none of the columns is null."""
    return df.dropna(subset=list(columns))


def in_hours(hours: tuple[int, ...] = DEFAULT.dinner_hours) -> Column:
    return F.col("order_hour").isin(*hours)


def outside_hours(hours: tuple[int, ...] = DEFAULT.dinner_hours) -> Column:
    """Known hours outside the given set; an unknown hour is in neither."""
    return ~F.col("order_hour").isin(*hours)


def distinct_options(df: DataFrame, *columns: str) -> DataFrame:
    """Sorted values that occur in each dimension, from one scan for all."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    options = texts.unpivot([], list(columns), "dimension", "value").where(
        F.col("value").isNotNull()
    )
    return options.distinct().orderBy("dimension", "value")


def domain_order(column: Column, domain: tuple[str, ...] = TRAFFIC_DOMAIN) -> Column:
    """Position in a fixed category order, 0 for values outside it."""
    return F.array_position(F.array(*[F.lit(v) for v in domain]), column)


def domain_options(
    df: DataFrame, column: str, domain: tuple[str, ...] = TRAFFIC_DOMAIN
) -> DataFrame:
    """Values of a fixed domain that occur in the data, in domain order."""
    c = F.col(column)
    found = df.select(column).where(c.isin(*domain)).distinct()
    return found.orderBy(domain_order(c, domain))


def in_domain_order(
    df: DataFrame, column: str, domain: tuple[str, ...] = TRAFFIC_DOMAIN
) -> DataFrame:
    """Sort by a fixed category order; values outside the domain are dropped."""
    c = F.col(column)
    return df.where(c.isin(*domain)).orderBy(domain_order(c, domain))


def numbered(aggregated: DataFrame, *order: Column | str) -> DataFrame:
    """Rows with their place in a sort order, which must leave no ties.

    The rows are sorted into ranges, a range to a task, and stored; each range is
    numbered on its own from where those before it end.
    """
    spark, part = aggregated.sparkSession, "range of the sort"
    ranged = aggregated.repartitionByRange(*order).withColumn(part, F.spark_partition_id())
    path = shared.table_path(spark, f"sorted-{uuid4().hex}")
    ranged.write.parquet(path)
    stored = spark.read.schema(ranged.schema).parquet(path)
    held = {r[part]: r["count"] for r in stored.groupBy(part).count().collect()}
    starts = accumulate([held.get(i, 0) for i in range(max(held, default=0))], initial=0)
    start = F.get(F.array(*[F.lit(n) for n in starts]), F.col(part))
    place = start + F.row_number().over(Window.partitionBy(part).orderBy(*order))
    return stored.withColumn("position", place.cast("int")).drop(part)


def at_least(
    df: DataFrame, column: str, config: SlaConfig = DEFAULT
) -> DataFrame:
    """Groups of a column with at least the minimum number of orders."""
    groups = df.groupBy(column).agg(F.count(F.lit(1)).alias("order_count"))
    return groups.where(F.col("order_count") >= config.rider_min_orders)
