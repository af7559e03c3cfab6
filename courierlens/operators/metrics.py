"""Service-level metrics over the fact table, at any threshold.

Functions ending in ``_from`` work on the small table of ``time_counts``; the
others make that table first. A report shares one table between many of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlens.functions import features
from courierlens.functions.rounding import exact_avg, percent, scaled_sum
from courierlens.operators.time_counts import (
    TIME,
    mean_time,
    median_time,
    order_count,
    set_id,
    summarise,
    time_count_sets,
    time_counts,
    total,
    violations,
)
from courierlens.settings import (
    DEFAULT,
    HISTOGRAM_MAX_BINS,
    SWEEP_THRESHOLDS,
    TIME_PERCENTILES,
    SlaConfig,
)

# The category breakdowns shown side by side.
CATEGORIES = {
    "traffic": "traffic_density",
    "city": "city",
    "weather": "weather",
    "multi": "multiple_deliveries",
    "vehicle": "vehicle_condition",
}

def distance_totals() -> dict[str, Column]:
    """Distance figures that ride along with the counts (distances have 2 dp)."""
    km = F.col("delivery_distance_km")
    return {"distance_n": F.count(km), "distance_sum": scaled_sum(km, 2)}


# --- headline figures -----------------------------------------------------


def kpis(df: DataFrame, threshold: float = DEFAULT.threshold) -> DataFrame:
    counts = time_counts(df, "is_peak_hour", **distance_totals())
    return kpis_from(counts, threshold)


def kpis_from(counts: DataFrame, threshold: float = DEFAULT.threshold) -> DataFrame:
    """One row of headline figures; all zeros when there are no orders.

    The peak share is of all orders, those without a known hour included.
    """
    n = F.col("n")
    avg_km = F.sum("distance_sum") / (F.sum("distance_n") * 100.0)
    peak = F.sum(F.when(F.col("is_peak_hour") == 1, n).otherwise(0))
    figures = counts.agg(
        order_count().alias("total_orders"),
        F.round(mean_time(), 2).alias("avg_time"),
        F.round(median_time(), 1).alias("median_time"),
        violations(threshold).alias("sla_violations"),
        F.round(percent(violations(threshold), F.sum("n")), 2).alias(
            "sla_violation_rate"
        ),
        peak.alias("peak_orders"),
        F.round(percent(peak, F.sum("n")), 2).alias("peak_share_pct"),
        F.round(F.when(F.sum("distance_n") > 0, avg_km), 2).alias("avg_distance"),
    )
    return figures.na.fill(0)


# --- breakdowns -----------------------------------------------------------


def hourly(df: DataFrame, threshold: float = DEFAULT.threshold) -> DataFrame:
    return hourly_from(time_counts(df, "order_hour"), threshold)


def hourly_from(counts: DataFrame, threshold: float = DEFAULT.threshold) -> DataFrame:
    """Volume, mean time and violations by known hour, in hour order."""
    return (
        counts.where(F.col("order_hour").isNotNull())
        .groupBy("order_hour")
        .agg(
            order_count().alias("order_count"),
            mean_time().alias("avg_delivery_time"),
            violations(threshold).alias("sla_violations"),
        )
        .withColumn(
            "sla_violation_rate",
            percent(F.col("sla_violations"), F.col("order_count")),
        )
        .orderBy("order_hour")
    )


def peak_compare(df: DataFrame, threshold: float = DEFAULT.threshold) -> DataFrame:
    return peak_compare_from(time_counts(df, "is_peak_hour"), threshold)


def peak_compare_from(
    counts: DataFrame, threshold: float = DEFAULT.threshold
) -> DataFrame:
    """Dinner hours against the rest; shares are of orders with a known hour."""
    known = counts.where(F.col("is_peak_hour").isNotNull())
    return (
        summarise(known, "is_peak_hour", threshold=threshold)
        .withColumn("period_label", features.window_label(F.col("is_peak_hour")))
        .orderBy("is_peak_hour")
    )


def category(
    df: DataFrame, dim: str, threshold: float = DEFAULT.threshold
) -> DataFrame:
    return category_from(time_counts(df, dim), dim, threshold)


def category_from(
    counts: DataFrame, dim: str, threshold: float = DEFAULT.threshold
) -> DataFrame:
    """Any dimension, slowest first.

    Null keys make no group, yet count in the denominator of the share. They are
    dropped by a count of keys, which stays above the grouping: a plain null
    filter would be pushed into one side of the plan only, and the total could
    then no longer reuse the counted rows.
    """
    return (
        summarise(counts, dim, threshold=threshold, keyed=F.count(dim))
        .where(F.col("keyed") > 0)
        .drop("keyed")
        .orderBy(F.desc("avg_delivery_time"), dim)
    )


def group_stats(df: DataFrame, *dims: str) -> DataFrame:
    """Count, mean and median of delivery time by each dimension, one scan."""
    names = list(dims)
    sets = time_count_sets(df, names)
    value, dimension = F.lit(None).cast("string"), F.lit(None).cast("string")
    for dim in names:
        own = F.col("set_id") == set_id(names, dim)
        value = F.when(own, F.col(dim).cast("string")).otherwise(value)
        dimension = F.when(own, dim).otherwise(dimension)
    return (
        sets.groupBy(dimension.alias("dimension"), value.alias("value"))
        .agg(
            order_count().alias("count"),
            mean_time().alias("mean"),
            median_time().alias("median"),
        )
        .where(F.col("value").isNotNull())
        .orderBy("dimension", "value")
    )


def group_share(df: DataFrame, dim: str) -> DataFrame:
    """Each group's percentage of all rows, null keys a group of their own."""
    counts = df.groupBy(dim).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(
        dim,
        F.col("n").alias("order_count"),
        percent(F.col("n"), total(counts)).alias("order_share_pct"),
    )


def conditional_rates(
    df: DataFrame,
    values: dict[str, Sequence],
    threshold: float = DEFAULT.threshold,
) -> DataFrame:
    """Percentage over the threshold within each named value, in one pass."""
    late = (F.col(TIME) > threshold).cast("int")
    cases = [(dim, v) for dim, chosen in values.items() for v in chosen]
    rates = df.agg(*[
        F.avg(F.when(F.col(dim) == v, late)).alias(f"case{i}")
        for i, (dim, v) in enumerate(cases)
    ])
    rows = F.array(*[
        F.struct(
            F.lit(dim).alias("dimension"),
            F.lit(str(v)).alias("value"),
            (F.col(f"case{i}") * 100).alias("sla_violation_rate"),
        )
        for i, (dim, v) in enumerate(cases)
    ])
    return rates.select(F.inline(rows))


def mean_of_hourly(
    df: DataFrame, config: SlaConfig = DEFAULT, threshold: float | None = None
) -> DataFrame:
    """Dinner hours against the rest, each hour weighing the same."""
    by_hour = hourly(df, config.threshold if threshold is None else threshold)
    in_dinner = F.col("order_hour").isin(*config.dinner_hours)
    aggs = [
        F.round(F.avg(F.when(mask, F.col(source))), 6).alias(f"{side}_{name}")
        for side, mask in (("dinner", in_dinner), ("other", ~in_dinner))
        for name, source in (
            ("mean_of_hourly_time", "avg_delivery_time"),
            ("mean_of_hourly_rate", "sla_violation_rate"),
        )
    ]
    return by_hour.agg(*aggs)


# --- riders ---------------------------------------------------------------


def rider_totals(df: DataFrame, threshold: float = DEFAULT.threshold) -> DataFrame:
    """Every rider's orders, mean rating, mean time and violations.

    A rider with a large part of all orders is combined within each task first.
    """
    orders = F.col("total_orders")
    return (
        df.where(F.col("delivery_person_id").isNotNull())
        .groupBy("delivery_person_id")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            exact_avg(F.col("delivery_person_rating")).alias("avg_rating"),
            (F.sum(TIME) / F.count(F.lit(1))).alias("avg_time"),
            F.count_if(F.col(TIME) > threshold).alias("sla_violations"),
        )
        .withColumn("sla_violation_rate", percent(F.col("sla_violations"), orders))
    )


def active_riders(df: DataFrame, config: SlaConfig = DEFAULT) -> DataFrame:
    """Riders with at least the minimum number of orders."""
    return rider_totals(df, config.threshold).where(
        F.col("total_orders") >= config.rider_min_orders
    )


def riders(df: DataFrame, config: SlaConfig = DEFAULT) -> DataFrame:
    """Leaderboard by volume; equal volumes are settled by the rider id."""
    return (
        active_riders(df, config)
        .orderBy(F.desc("total_orders"), "delivery_person_id")
        .limit(config.rider_top)
    )


# --- distribution of delivery time ----------------------------------------


def threshold_sweep(
    df: DataFrame, thresholds: Sequence[float] = SWEEP_THRESHOLDS
) -> DataFrame:
    """Violations and rate at each threshold, from one scan for all of them."""
    counts = time_counts(df)
    sums = counts.agg(
        F.sum("n").alias("orders"),
        *[violations(t).alias(f"v{i}") for i, t in enumerate(thresholds)],
    )
    rows = F.array(*[
        F.struct(
            F.lit(t).alias("threshold"),
            F.col(f"v{i}").alias("sla_violations"),
            percent(F.col(f"v{i}"), F.col("orders")).alias("sla_violation_rate"),
        )
        for i, t in enumerate(thresholds)
    ])
    return sums.select(F.inline(rows)).orderBy("threshold")


def percentiles(
    df: DataFrame, points: Sequence[float] = TIME_PERCENTILES
) -> DataFrame:
    """Exact, linearly interpolated percentiles of delivery time."""
    at = F.array(*[F.lit(float(p)) for p in points])
    return (
        time_counts(df)
        .agg(F.percentile(F.col(TIME), at, F.col("n")).alias("minutes"))
        .select(F.inline(F.arrays_zip(at.alias("percentile"), F.col("minutes"))))
        .select("percentile", F.round("minutes", 6).alias("minutes"))
        .orderBy("percentile")
    )


# Widths of histogram bins.
BIN_WIDTHS = tuple(step * 10**power for power in range(9) for step in (1, 2, 5))


def bin_width(low: Column, high: Column, max_bins: int = HISTOGRAM_MAX_BINS) -> Column:
    """Smallest of 1, 2, 5, 10, 20, 50 … minutes that keeps within the bins.

    Bins start at multiples of the width, so one more may be needed than the
    spread alone would fill.
    """
    widths = F.array(*[F.lit(float(w)) for w in BIN_WIDTHS])
    fits = F.filter(widths, lambda w: F.floor(high / w) - F.floor(low / w) + 1 <= max_bins)
    return F.get(fits, F.lit(0))


def histogram(
    df: DataFrame,
    threshold: float = DEFAULT.threshold,
    max_bins: int = HISTOGRAM_MAX_BINS,
) -> DataFrame:
    return histogram_from(time_counts(df), threshold, max_bins)


def histogram_from(
    counts: DataFrame,
    threshold: float = DEFAULT.threshold,
    max_bins: int = HISTOGRAM_MAX_BINS,
) -> DataFrame:
    """Orders per bin of delivery time, with the median and threshold marks."""
    ends = counts.agg(F.min(TIME).alias("low"), F.max(TIME).alias("high"), median_time().alias("median"))
    width = bin_width(F.col("low"), F.col("high"), max_bins)
    marks = ends.select(F.struct(width.alias("width"), "median")).scalar()
    width = marks["width"]
    start = F.floor(F.col(TIME) / width) * width
    return (
        counts.groupBy(start.alias("bin_start"))
        .agg(F.sum("n").alias("order_count"))
        .select(
            "bin_start",
            width.alias("bin_width"),
            marks["median"].alias("median_minutes"),
            "order_count",
            F.lit(threshold).alias("sla_threshold"),
        )
        .orderBy("bin_start")
    )


def time_summary(
    df: DataFrame, points: Sequence[float] = TIME_PERCENTILES
) -> DataFrame:
    """Count, mean, sample deviation, extremes and chosen percentiles of the time."""
    x, n = F.col(TIME), F.col("n")
    at = F.array(*[F.lit(float(p)) for p in points])
    total, squares, orders = F.sum(x * n), F.sum(x * x * n), F.sum(n)
    spread = (squares - total * (total / orders)) / (orders - 1)
    figures = time_counts(df).where(x.isNotNull()).agg(
        F.coalesce(orders, F.lit(0)).alias("count"),
        F.round(mean_time(), 6).alias("mean"),
        F.when(orders > 1, F.round(F.sqrt(F.greatest(spread, F.lit(0.0))), 6)).alias("std"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        F.percentile(x, at, n).alias("points"),
    )
    named = [
        F.round(F.col("points")[i], 6).alias(f"p{round(p * 100):02d}")
        for i, p in enumerate(points)
    ]
    return figures.select("count", "mean", "std", "min", *named, "max")


def time_marks(df: DataFrame) -> DataFrame:
    """Median and third quartile of all delivery times, whatever the scope."""
    at = F.array(F.lit(0.5), F.lit(0.75))
    points = time_counts(df).agg(F.percentile(F.col(TIME), at, F.col("n")).alias("p"))
    return points.select(F.col("p")[0].alias("median_minutes"), F.col("p")[1].alias("q3_minutes"))
