"""Orders counted by delivery minute: the shared first stage of the metrics.

Delivery time is a whole number of minutes with a few dozen values, so counting
rows per (dimension, minute) shrinks any number of orders to a small table in
one hash aggregation with map-side combining. Averages, exact medians and
violations at any threshold are then computed from that table; no group's rows
ever meet in one task, however large the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlens.functions.rounding import percent
from courierlens.settings import DEFAULT

TIME = "delivery_time_min"


def row_count() -> Column:
    return F.count(F.lit(1))


def time_counts(df: DataFrame, *dims: str, **extra: Column) -> DataFrame:
    """Rows per combination of ``dims`` and minute, as ``n``."""
    return df.groupBy(*dims, TIME).agg(
        row_count().alias("n"), *[agg.alias(name) for name, agg in extra.items()]
    )


def time_count_sets(
    df: DataFrame, dims: list[str], n: Column | None = None, **extra: Column
) -> DataFrame:
    """``time_counts`` for each dimension on its own, in one scan.

    Grouping sets instead of one group-by per dimension; ``set_id`` tells which
    dimension a row belongs to (see ``set_of``). Rows that are counts already are
    added up by passing the sum of them as ``n``.
    """
    return df.groupingSets([[d, TIME] for d in dims], *dims, TIME).agg(
        F.grouping_id().cast("int").alias("set_id"),
        (row_count() if n is None else n).alias("n"),
        *[agg.alias(name) for name, agg in extra.items()],
    )


def set_id(dims: list[str], dim: str) -> int:
    """Grouping id of one dimension: a bit per column, set where rolled up."""
    width = len(dims) + 1
    return (1 << width) - 1 - (1 << (width - 1 - dims.index(dim))) - 1


def set_of(sets: DataFrame, dims: list[str], dim: str) -> DataFrame:
    """The rows of one dimension, shaped like ``time_counts(df, dim)``."""
    rows = sets.where(F.col("set_id") == set_id(dims, dim))
    return rows.drop("set_id", *[d for d in dims if d != dim])


def order_count() -> Column:
    return F.sum("n")


def mean_time() -> Column:
    """Mean minutes: one exact integer sum divided by another."""
    return F.sum(F.col(TIME) * F.col("n")) / F.sum("n")


def median_time() -> Column:
    return F.percentile(F.col(TIME), F.lit(0.5), F.col("n"))


def violations(threshold: float = DEFAULT.threshold) -> Column:
    return F.sum(F.when(F.col(TIME) > threshold, F.col("n")).otherwise(0))


def total(counts: DataFrame) -> Column:
    """All counted rows as a scalar subquery over the small table."""
    return counts.agg(F.sum("n")).scalar()


def summarise(
    counts: DataFrame,
    *dims: str,
    threshold: float = DEFAULT.threshold,
    **extra: Column,
) -> DataFrame:
    """Volume, mean, median, violations, rate and share per group.

    The share is of all counted rows, those with a null key included.
    """
    grouped = counts.groupBy(*dims).agg(
        order_count().alias("order_count"),
        mean_time().alias("avg_delivery_time"),
        median_time().alias("median_delivery_time"),
        violations(threshold).alias("sla_violations"),
        *[agg.alias(name) for name, agg in extra.items()],
    )
    orders = F.col("order_count")
    return grouped.withColumns({
        "sla_violation_rate": percent(F.col("sla_violations"), orders),
        "order_share_pct": percent(orders, total(counts)),
    })
