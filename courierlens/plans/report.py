"""The whole report for one filter scope and threshold."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlens.operators import display, insights, metrics
from courierlens.operators.scope import Scope, apply_scope, scope_share
from courierlens.operators.time_counts import set_of, time_count_sets, time_counts
from courierlens.settings import DEFAULT, THRESHOLD_RANGE, SlaConfig

REPORT_DIMS = [
    "order_hour",
    "is_peak_hour",
    "traffic_density",
    "city",
    "weather",
    "multiple_deliveries",
    "vehicle_condition",
    "festival",
]
# Everything a scope can filter on and a report can group by.
CUBE_DIMS = [*REPORT_DIMS, "peak_period", "vehicle_type", "order_type"]


def report_cube(deliveries: DataFrame) -> DataFrame:
    """Orders counted by every report and filter dimension and by minute.

    Bounded by the sizes of the domains, whatever the number of orders. Written
    once, it answers any scope at any threshold without the orders themselves;
    only the riders still need those.
    """
    return time_counts(deliveries, *CUBE_DIMS, **metrics.distance_totals())


@dataclass
class Report:
    """Tables by name, and the cached counts they are computed from."""

    tables: dict[str, DataFrame]
    counts: DataFrame

    def __enter__(self) -> Report:
        return self

    def __exit__(self, *_) -> None:
        self.counts.unpersist()


def build_report(
    deliveries: DataFrame,
    scope: Scope = Scope(),
    threshold: float | None = None,
    config: SlaConfig = DEFAULT,
    cube: DataFrame | None = None,
) -> Report:
    """Every metric, chart and insight table of the filtered orders.

    The scope is one predicate on the scan. Counting orders per minute for all
    dimensions takes one pass over the filtered rows; the counts, a few thousand
    rows whatever the number of orders, are cached and all tables but the riders
    and the scope share come from them. Use as a context manager to release them.
    With a stored ``report_cube`` the counts are added up from it instead. A
    threshold outside the range of the control is an error. ``marks`` are of all
    deliveries, whatever the scope.
    """
    limit = config.threshold if threshold is None else threshold
    if not THRESHOLD_RANGE[0] <= limit <= THRESHOLD_RANGE[1]:
        raise ValueError(f"threshold {limit} is outside {THRESHOLD_RANGE}")
    config = replace(config, threshold=limit)
    scoped = apply_scope(deliveries, scope)
    if cube is None:
        share = scope_share(deliveries, scope)
        joint = time_counts(scoped, *REPORT_DIMS, **metrics.distance_totals())
    else:
        share = scope_share(cube, scope, F.col("n"))
        joint = apply_scope(cube, scope)
    sums = {name: F.sum(name) for name in ("n", *metrics.distance_totals())}
    counts = time_count_sets(joint, REPORT_DIMS, **sums)
    counts = counts.persist(StorageLevel.MEMORY_AND_DISK)

    def of(dim: str) -> DataFrame:
        return set_of(counts, REPORT_DIMS, dim)

    hourly = metrics.hourly_from(of("order_hour"), limit)
    by_category = {
        name: metrics.category_from(of(dim), dim, limit)
        for name, dim in metrics.CATEGORIES.items()
    }
    peak = metrics.peak_compare_from(of("is_peak_hour"), limit)
    riders = metrics.riders(scoped, config)
    kpis = metrics.kpis_from(of("is_peak_hour"), limit)
    minutes = of("is_peak_hour").groupBy("delivery_time_min").agg(F.sum("n").alias("n"))
    tables = {
        "scope_share": share,
        "marks": metrics.time_marks(deliveries),
        "kpis": kpis,
        "hourly": hourly,
        "peak": peak,
        **by_category,
        "riders": riders,
        "insights": insights.insights_from(counts, REPORT_DIMS, config),
        "chart_hourly": display.chart_hourly(hourly),
        "chart_traffic": display.chart_traffic(by_category["traffic"]),
        "chart_batching": display.chart_batching(by_category["multi"]),
        "chart_city": display.chart_city(by_category["city"]),
        "chart_weather": display.chart_weather(by_category["weather"]),
        "chart_distribution": metrics.histogram_from(minutes, limit),
        "display_kpis": display.headline_cards(kpis, limit),
        "display_traffic": display.display_format(by_category["traffic"], "traffic"),
        "display_peak": display.display_format(peak, "peak"),
        "display_city": display.display_format(by_category["city"], "city"),
        "display_vehicle": display.display_format(by_category["vehicle"], "vehicle"),
        "display_riders": display.display_format(riders, "riders"),
    }
    return Report(tables, counts)
