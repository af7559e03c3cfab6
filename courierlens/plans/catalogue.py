"""Every operator as a named query over the order log of an events table.

Row-wise cleaning rules read the derived raw log directly. Metrics read the
fact table, which the first of them builds and stores.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlens.functions import features, geo, text, times
from courierlens.operators import cleaning, display, insights, metrics, quality, scope
from courierlens.operators.time_counts import set_of, time_count_sets
from courierlens.plans import query_pack as pack
from courierlens.plans.cleaning_run import event_deliveries, event_table_path
from courierlens.session import build_session
from courierlens.settings import DEFAULT, DINNER_LABEL, TRAFFIC_DOMAIN
from courierlens.sources import fact_table, order_log, shared
from courierlens.sources.event_orders import load_orders

Query = Callable[[SparkSession, str], DataFrame]

col = F.col
SCOPE = scope.Scope(
    cities=("Metropolitian", "Urban"),
    traffic=("Jam", "High"),
    weather=("Fog", "Stormy", "Sunny"),
    vehicles=("scooter", "motorcycle"),
    festival="No",
    period=DINNER_LABEL,
)


# --- sources and sinks ------------------------------------------------------


def scan_raw(spark: SparkSession, data_dir: str) -> DataFrame:
    """Write the raw log as CSV once, then read it as a user's log is read."""
    path = event_table_path(spark, data_dir, "raw_csv")
    if not shared.is_complete(spark, path):
        order_log.write_raw(raw_orders(spark, data_dir), path)
    return order_log.scan_raw(spark, path)


def sink_clean(spark: SparkSession, data_dir: str) -> DataFrame:
    """One copy per application: each call replaces the one before."""
    path = event_table_path(spark, data_dir, "sink")
    fact_table.sink_clean(event_deliveries(spark, data_dir), path)
    return fact_table.scan_clean(spark, path)


def register_table(spark: SparkSession, data_dir: str) -> DataFrame:
    fact_table.register_table(event_deliveries(spark, data_dir))
    return spark.sql("SELECT * FROM deliveries")


def build_if_missing(spark: SparkSession, data_dir: str) -> DataFrame:
    """Ask twice: the second call finds the table and must not build again."""
    event_deliveries(spark, data_dir)
    path = event_table_path(spark, data_dir, "deliveries")

    def rebuild(session: SparkSession) -> DataFrame:
        raise AssertionError("the stored table was built a second time")

    return fact_table.build_if_missing(spark, path, rebuild)


def cache_scope(spark: SparkSession, data_dir: str) -> DataFrame:
    """Several breakdowns from one cached table; the caller releases the cache.

    What is cached are the counts of the scope, a few rows per dimension, not
    the orders in it.
    """
    dims = ["city", "weather"]
    scoped = scope.apply_scope(event_deliveries(spark, data_dir), SCOPE)
    counts = time_count_sets(scoped, dims).persist()
    parts = [
        metrics.category_from(set_of(counts, dims, dim), dim)
        .withColumnRenamed(dim, "value")
        .withColumn("dimension", F.lit(dim))
        for dim in dims
    ]
    return parts[0].unionByName(parts[1])


def query_pack_rows(spark: SparkSession, data_dir: str) -> DataFrame:
    return pack.stored_pack_rows(spark, event_deliveries(spark, data_dir))


def pack_query(name: str) -> Query:
    def run(spark: SparkSession, data_dir: str) -> DataFrame:
        query = pack.query_pack()[name]
        return pack.run_query(spark, query, event_deliveries(spark, data_dir))

    return run


# --- shorthands ---------------------------------------------------------------


def raw_orders(spark: SparkSession, data_dir: str) -> DataFrame:
    return load_orders(spark, data_dir)


def over_raw(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, data_dir: operator(raw_orders(spark, data_dir))


def over_fact(operator: Callable[..., DataFrame], *args, **kwargs) -> Query:
    def run(spark: SparkSession, data_dir: str) -> DataFrame:
        return operator(event_deliveries(spark, data_dir), *args, **kwargs)

    return run


# Columns can be made only once a session runs, so rules are given as functions.
Rule = Callable[[], Column]


def rule(**columns: Rule) -> Query:
    """Order id and the columns of one cleaning rule, for every raw row."""

    def run(raw: DataFrame) -> DataFrame:
        return cleaning.normalise_text(raw).select(
            cleaning.order_key(col("ID")).alias("order_id"),
            *[make().alias(name) for name, make in columns.items()],
        )

    return over_raw(run)


def feature(**columns: Rule) -> Query:
    """Order id and the derived columns, for every clean row."""
    return over_fact(
        lambda df: df.select(
            "order_id", *[make().alias(name) for name, make in columns.items()]
        )
    )


def scoped_rows(chosen: scope.Scope, *shown: str) -> Query:
    return over_fact(
        lambda df: scope.apply_scope(df, chosen).select("order_id", *shown)
    )


def chart(maker: Callable[[DataFrame], DataFrame], dim: str) -> Query:
    return over_fact(lambda df: maker(metrics.category(df, dim)))


# --- the raw columns behind the rules -------------------------------------------

def ordered() -> Column:
    return times.clock_parts(col("Time_Orderd"))


def picked() -> Column:
    return times.clock_parts(col("Time_Order_picked"))


def date() -> Column:
    return times.parse_date(col("Order_Date"))


def gps() -> list[Column]:
    return [col(name) for name in GPS_COLUMNS]


GPS_COLUMNS = (
    "Restaurant_latitude",
    "Restaurant_longitude",
    "Delivery_location_latitude",
    "Delivery_location_longitude",
)


def padded_names(raw: DataFrame) -> DataFrame:
    """The raw log with white space round its column names, then repaired."""
    padded = raw.toDF(*[f" {name}\t" for name in raw.columns])
    return cleaning.strip_column_names(padded)


CLOCKS = {"time_ordered": "Time_Orderd", "time_order_picked": "Time_Order_picked"}


def day_fractions(raw: DataFrame) -> DataFrame:
    """Rows with a clock time written as a fraction of a day."""
    shown, found = [], F.lit(False)
    for name, written in CLOCKS.items():
        shown += [
            times.second_of_day(col(written)).alias(f"{name}_second"),
            times.parse_clock(col(written)).alias(name),
        ]
        found = found | text.number(col(written)).isNotNull()
    return (
        cleaning.normalise_text(raw)
        .where(found)
        .select(cleaning.order_key(col("ID")).alias("order_id"), *shown)
    )


def past_midnight(raw: DataFrame) -> DataFrame:
    """Rows with a clock time written with an hour of 24 or more."""
    shown, found = [], F.lit(False)
    for name, written in CLOCKS.items():
        hour = F.split_part(col(written), F.lit(":"), F.lit(1)).try_cast("int")
        shown += [
            col(written).alias(f"{name}_written"), times.parse_clock(col(written)).alias(name)
        ]
        found = found | F.coalesce((hour >= 24) & col(written).contains(":"), F.lit(False))
    return (
        cleaning.normalise_text(raw)
        .where(found)
        .select(cleaning.order_key(col("ID")).alias("order_id"), *shown)
    )


def wide_rows(raw: DataFrame) -> DataFrame:
    """Every column the cleaning makes, in no order, before the selection."""
    parsed = cleaning.parse_columns(cleaning.add_clock_parts(cleaning.normalise_text(raw)))
    return cleaning.derive_columns(parsed)


def clean_all(spark: SparkSession, data_dir: str) -> DataFrame:
    return cleaning.clean_orders(load_orders(build_session(spark), data_dir))


# The metric behind each report table.
TABLE_METRICS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "traffic": lambda df: metrics.category(df, "traffic_density"),
    "peak": metrics.peak_compare,
    "city": lambda df: metrics.category(df, "city"),
    "vehicle": lambda df: metrics.category(df, "vehicle_condition"),
    "riders": metrics.riders,
}


def shown_table(show: Callable[[DataFrame, str], DataFrame], table: str) -> Query:
    return over_fact(lambda df: show(TABLE_METRICS[table](df), table))


def display_queries() -> dict[str, Query]:
    """Headings and formats of each report table; the first under the plain name."""
    suffix = {table: "" if table == "traffic" else f"_{table}" for table in TABLE_METRICS}
    return {
        **{
            f"proj_display_names{suffix[t]}": shown_table(display.display_names, t)
            for t in TABLE_METRICS
        },
        **{
            f"proj_format{suffix[t]}": shown_table(display.display_format, t)
            for t in TABLE_METRICS
        },
        "proj_format_kpis": over_fact(lambda df: display.headline_cards(metrics.kpis(df))),
    }


def cleaning_queries() -> dict[str, Query]:
    return {
        "clean_colnames": over_raw(padded_names),
        "clean_dedup": over_raw(cleaning.drop_duplicate_rows),
        "clean_order_date": rule(order_date=date),
        "clean_date_parts": rule(
            order_day=lambda: F.dayofmonth(date()),
            order_month=lambda: F.month(date()),
            order_day_name=lambda: times.day_name(date()),
        ),
        "clean_weekend": rule(is_weekend=lambda: times.weekend_flag(date())),
        "clean_date_format": rule(order_date_text=lambda: times.iso_date(date())),
        "clean_time_parse": rule(
            time_ordered=lambda: times.clock(ordered()),
            time_order_picked=lambda: times.clock(picked()),
        ),
        "clean_excel_fraction": over_raw(day_fractions),
        "clean_midnight_rollover": over_raw(past_midnight),
        "clean_order_hour": rule(order_hour=lambda: times.known_hour(ordered())),
        "clean_pickup_delay": rule(
            pickup_delay_minutes=lambda: times.minutes_between(ordered(), picked())
        ),
        "clean_gps_valid": rule(gps_valid=lambda: geo.gps_valid(*gps())),
        "clean_haversine": rule(delivery_distance_km=lambda: geo.haversine_km(*gps())),
        "clean_fill_unknown": rule(
            weather=lambda: text.or_unknown(col("Weather_conditions")),
            traffic_density=lambda: text.or_unknown(col("Road_traffic_density")),
            festival=lambda: text.or_unknown(col("Festival")),
            city=lambda: text.or_unknown(col("City")),
        ),
        "clean_trim_text": rule(
            delivery_person_id=lambda: col("Delivery_person_ID"),
            order_type=lambda: col("Type_of_order"),
            vehicle_type=lambda: col("Type_of_vehicle"),
        ),
        "clean_multi_fill": rule(
            multiple_deliveries=lambda: cleaning.filled_count(col("multiple_deliveries"))
        ),
        "clean_numeric_coerce": rule(
            delivery_person_age=lambda: text.number(col("Delivery_person_Age")),
            rating=lambda: text.number(col("Delivery_person_Ratings")),
        ),
        "clean_rating_cap": rule(
            delivery_person_rating=lambda: cleaning.capped_rating(
                text.number(col("Delivery_person_Ratings"))
            )
        ),
        "clean_int_cast": rule(
            vehicle_condition=lambda: cleaning.required_int(
                col("Vehicle_condition"), "Vehicle_condition"
            ),
            delivery_time_min=lambda: cleaning.required_int(
                col("`Time_taken (min)`"), "Time_taken (min)"
            ),
        ),
        "feat_sla_flag": feature(
            sla_25=lambda: features.sla_flag(col("delivery_time_min"), 25),
            sla_30=lambda: features.sla_flag(col("delivery_time_min")),
        ),
        "feat_peak_period": feature(
            peak_period=lambda: features.peak_period(col("order_hour"))
        ),
        "feat_peak_flag": feature(
            is_peak_hour=lambda: features.peak_flag(col("order_hour"))
        ),
        "clean_select": over_raw(lambda raw: cleaning.select_clean(wide_rows(raw))),
        "clean_all": clean_all,
        "proj_period_label": feature(
            operational_period=lambda: features.operational_period(col("is_peak_hour")),
            period_label=lambda: features.window_label(col("is_peak_hour")),
        ),
        **display_queries(),
    }


def source_queries() -> dict[str, Query]:
    return {
        "scan_raw": scan_raw,
        "scan_clean": event_deliveries,
        "sink_clean": sink_clean,
        "register_table": register_table,
        "query_pack": query_pack_rows,
        "build_if_missing": build_if_missing,
        "cache_scope": cache_scope,
    }


def filter_queries() -> dict[str, Query]:
    return {
        "filter_city": scoped_rows(scope.Scope(cities=("Urban", "Semi-Urban")), "city"),
        "filter_traffic": scoped_rows(
            scope.Scope(traffic=("Jam", "High")), "traffic_density"
        ),
        "filter_weather": scoped_rows(scope.Scope(weather=("Fog", "Stormy")), "weather"),
        "filter_vehicle": scoped_rows(
            scope.Scope(vehicles=("scooter", "bicycle")), "vehicle_type"
        ),
        "filter_festival": scoped_rows(scope.Scope(festival="Yes"), "festival"),
        "filter_period": scoped_rows(scope.Scope(period=DINNER_LABEL), "peak_period"),
        "filter_order_type": scoped_rows(
            scope.Scope(order_types=("Meal", "Snack")), "order_type"
        ),
        "filter_scope": scoped_rows(
            SCOPE, "city", "traffic_density", "weather", "vehicle_type", "delivery_time_min"
        ),
        "scope_share": over_fact(scope.scope_share, SCOPE),
        "filter_not_null": over_fact(
            lambda df: scope.known(df, "order_hour", "is_peak_hour").select(
                "order_id", "order_hour", "is_peak_hour"
            )
        ),
        "filter_hours": over_fact(
            lambda df: df.where(scope.in_hours() | scope.outside_hours()).select(
                "order_id",
                "order_hour",
                F.when(scope.in_hours(), "dinner").otherwise("other").alias("side"),
            )
        ),
        "filter_having": over_fact(scope.at_least, "delivery_person_id"),
        "filter_case_present": over_fact(insights.comparison_sizes),
        "distinct_options": over_fact(
            scope.distinct_options, "city", "weather", "vehicle_type"
        ),
        "domain_options": over_fact(
            lambda df: scope.domain_options(df, "traffic_density").withColumn(
                "position", scope.domain_order(col("traffic_density")).cast("int")
            )
        ),
        "sort_key": over_fact(
            lambda df: scope.numbered(
                df.groupBy("vehicle_type", "vehicle_condition").count(),
                "vehicle_type",
                "vehicle_condition",
            ).withColumnRenamed("count", "order_count")
        ),
        "sort_key_nulls_last": over_fact(
            lambda df: scope.numbered(
                df.groupBy("is_peak_hour").count(), F.desc("is_peak_hour")
            ).withColumnRenamed("count", "order_count")
        ),
        "sort_metric": over_fact(
            lambda df: scope.numbered(
                metrics.category(df, "weather").select(
                    "weather", "order_count", "avg_delivery_time"
                ),
                F.desc("avg_delivery_time"),
                "weather",
            )
        ),
        "sort_domain": over_fact(
            lambda df: scope.numbered(
                scope.in_domain_order(
                    metrics.category(df, "traffic_density"), "traffic_density"
                ).select("traffic_density", "order_count"),
                scope.domain_order(col("traffic_density"), TRAFFIC_DOMAIN),
            )
        ),
        "topk_riders": lambda spark, data_dir: scope.numbered(
            pack_query("sql10_riders")(spark, data_dir),
            F.desc("total_orders_delivered"),
            "sla_violation_rate_pct",
            "delivery_person_id",
        ).select("position", "delivery_person_id", "total_orders_delivered"),
        "limit_head": over_raw(partial(quality.head, key="ID")),
    }


def metric_queries() -> dict[str, Query]:
    sql = {name: pack_query(name) for name in pack.query_pack()}
    categories = {
        f"agg_category_{name}": over_fact(metrics.category, dim)
        for name, dim in metrics.CATEGORIES.items()
    }
    return {
        "agg_kpis": over_fact(metrics.kpis),
        **sql,
        "agg_hourly": over_fact(metrics.hourly),
        "agg_peak_compare": over_fact(metrics.peak_compare),
        "agg_category": over_fact(metrics.category, "festival", 35),
        **categories,
        "agg_riders": over_fact(metrics.riders),
        "agg_group_stats": over_fact(
            metrics.group_stats, "traffic_density", "multiple_deliveries", "city"
        ),
        "agg_share": over_fact(metrics.group_share, "city"),
        "agg_conditional_rate": over_fact(
            metrics.conditional_rates,
            {
                "traffic_density": ("Jam", "Low"),
                "vehicle_condition": (0, 2),
                "festival": ("Yes", "No"),
            },
        ),
        "agg_mean_of_means": over_fact(metrics.mean_of_hourly),
        "agg_threshold_sweep": over_fact(metrics.threshold_sweep),
        "agg_percentiles": over_fact(metrics.percentiles),
        "agg_time_summary": over_fact(metrics.time_summary),
        "agg_time_marks": over_fact(metrics.time_marks),
        "agg_describe": over_raw(lambda raw: quality.describe(quality.numeric_view(raw))),
        "agg_histogram": over_fact(
            lambda df: metrics.histogram(df, max_bins=10).select(
                "bin_start", "bin_width", "order_count"
            )
        ),
    }


def report_queries() -> dict[str, Query]:
    named_insights = {
        f"insight_{c.name}": over_fact(insights.insights, DEFAULT, (c.name,))
        for c in insights.COMPARISONS
    }
    return {
        "dq_report": lambda spark, data_dir: quality.quality_report(
            raw_orders(spark, data_dir), event_deliveries(spark, data_dir)
        ),
        "profile_shape": over_raw(quality.shape),
        "profile_nulls": over_raw(quality.null_counts),
        "profile_duplicates": over_raw(quality.duplicate_count),
        "dq_issue_audit": over_raw(quality.issue_audit),
        **named_insights,
        "insights": over_fact(insights.insights),
        "chart_hourly": over_fact(lambda df: display.chart_hourly(metrics.hourly(df))),
        "chart_traffic": chart(display.chart_traffic, "traffic_density"),
        "chart_batching": chart(display.chart_batching, "multiple_deliveries"),
        "chart_city": chart(display.chart_city, "city"),
        "chart_weather": chart(display.chart_weather, "weather"),
        "chart_distribution": over_fact(display.chart_distribution),
    }


def all_queries() -> dict[str, Query]:
    return {
        **source_queries(),
        **cleaning_queries(),
        **filter_queries(),
        **metric_queries(),
        **report_queries(),
    }
