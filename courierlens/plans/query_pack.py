"""The ten numbered reports as Spark SQL over the ``deliveries`` table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from uuid import uuid4

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlens.functions.rounding import scaled_sum
from courierlens.settings import (
    DEFAULT,
    DINNER_LABEL,
    SQL_NON_PEAK_LABEL,
    SQL_UNKNOWN_HOUR_LABEL,
    SlaConfig,
)
from courierlens.sources import shared

AVG_TIME = "round(avg(delivery_time_min), 2) AS avg_delivery_time_min"
RATE = "round(avg(is_sla_violated) * 100, 2) AS sla_violation_rate_pct"
VIOLATIONS = "sum(is_sla_violated)"


def _with_share(key: str, shown: str, share: str, late: str, order: str) -> str:
    """A breakdown with each group's share of the table.

    Rows are counted first, so the total comes from the same counted rows, by the
    same exchange: no second scan and no window.
    """
    return f"""
        WITH counted AS (
            SELECT {key}, delivery_time_min, is_sla_violated, count(*) AS n
            FROM {{deliveries}} GROUP BY {key}, delivery_time_min, is_sla_violated)
        SELECT {shown}, sum(n) AS total_deliveries,
               round(sum(n) * 100e0 / (SELECT sum(n) FROM counted), 2) AS {share},
               round(sum(delivery_time_min * n) / sum(n), 2) AS avg_delivery_time_min,
               sum(is_sla_violated * n) AS {late},
               round(sum(is_sla_violated * n) / sum(n) * 100, 2) AS sla_violation_rate_pct
        FROM counted GROUP BY {key} ORDER BY {order}"""


def exact_avg_sql(column: str, places: int) -> str:
    """Mean at two decimals of a double that is measured in ``places`` decimals."""
    scale = f"1e{places}"
    total = f"sum(cast(round({column} * {scale}) AS bigint))"
    return (
        f"CASE WHEN count({column}) > 0 "
        f"THEN round({total} / (count({column}) * {scale}), 2) END"
    )


@dataclass(frozen=True)
class PackQuery:
    """One report: its keys, the measures beside them and the SQL text.

    ``groups`` are the columns it groups by, if sums by them are all it needs.
    """

    title: str
    keys: tuple[str, ...]
    measures: tuple[str, ...]
    sql: str
    args: dict[str, object] = field(default_factory=dict)
    groups: tuple[str, ...] | None = None


def _by(column: str, order: str, alias: str | None = None) -> str:
    """Volume, mean time, violations and rate by one column."""
    name = alias or column
    return f"""
        SELECT {column} AS {name}, count(*) AS total_deliveries, {AVG_TIME},
               {VIOLATIONS} AS sla_violations, {RATE}
        FROM {{deliveries}} GROUP BY {column} ORDER BY {order}"""


_BREAKDOWN = (
    "total_deliveries",
    "avg_delivery_time_min",
    "sla_violations",
    "sla_violation_rate_pct",
)


def query_pack(config: SlaConfig = DEFAULT) -> dict[str, PackQuery]:
    """All ten reports by name, in their fixed order."""
    return {
        "sql01_kpis": PackQuery(
            "Overall operational KPIs",
            (),
            (
                "total_deliveries",
                "avg_delivery_time_min",
                "total_sla_violations",
                "sla_violation_rate_pct",
                "avg_distance_km",
            ),
            f"""
            SELECT count(*) AS total_deliveries, {AVG_TIME},
                   {VIOLATIONS} AS total_sla_violations, {RATE},
                   {exact_avg_sql('delivery_distance_km', 2)} AS avg_distance_km
            FROM {{deliveries}}""",
            groups=(),
        ),
        "sql02_peak": PackQuery(
            "Peak against non-peak deliveries",
            ("operational_period",),
            (
                "total_deliveries",
                "pct_of_total_orders",
                "avg_delivery_time_min",
                "total_sla_violations",
                "sla_violation_rate_pct",
            ),
            _with_share(
                "is_peak_hour",
                f"CASE is_peak_hour WHEN 1 THEN '{DINNER_LABEL}' "
                f"WHEN 0 THEN '{SQL_NON_PEAK_LABEL}' "
                f"ELSE '{SQL_UNKNOWN_HOUR_LABEL}' END AS operational_period",
                "pct_of_total_orders",
                "total_sla_violations",
                "is_peak_hour DESC",
            ),
            groups=("is_peak_hour",),
        ),
        "sql03_hourly": PackQuery(
            "Hourly performance",
            ("hour_of_day",),
            (
                "order_volume",
                "avg_delivery_time_min",
                "sla_violations",
                "sla_violation_rate_pct",
            ),
            f"""
            SELECT order_hour AS hour_of_day, count(*) AS order_volume, {AVG_TIME},
                   {VIOLATIONS} AS sla_violations, {RATE}
            FROM {{deliveries}} WHERE order_hour IS NOT NULL
            GROUP BY order_hour ORDER BY order_hour""",
            groups=("order_hour",),
        ),
        "sql04_city": PackQuery(
            "City performance",
            ("city",),
            ("total_deliveries", "order_share_pct") + _BREAKDOWN[1:],
            _with_share(
                "city", "city", "order_share_pct", "sla_violations", "total_deliveries DESC, city"
            ),
            groups=("city",),
        ),
        "sql05_traffic": PackQuery(
            "Traffic density impact",
            ("traffic_density",),
            _BREAKDOWN,
            _by("traffic_density", "avg_delivery_time_min DESC, traffic_density"),
            groups=("traffic_density",),
        ),
        "sql06_batching": PackQuery(
            "Batched deliveries impact",
            ("multi_orders_stacked",),
            _BREAKDOWN,
            _by("multiple_deliveries", "multiple_deliveries", "multi_orders_stacked"),
            groups=("multiple_deliveries",),
        ),
        "sql07_vehicle": PackQuery(
            "Vehicle type and condition",
            ("vehicle_type", "vehicle_condition"),
            ("total_deliveries", "avg_delivery_time_min", "sla_violation_rate_pct"),
            f"""
            SELECT vehicle_type, vehicle_condition, count(*) AS total_deliveries,
                   {AVG_TIME}, {RATE}
            FROM {{deliveries}} GROUP BY vehicle_type, vehicle_condition
            ORDER BY vehicle_type, vehicle_condition""",
            groups=("vehicle_type", "vehicle_condition"),
        ),
        "sql08_weather": PackQuery(
            "Weather impact",
            ("weather",),
            _BREAKDOWN,
            _by("weather", "avg_delivery_time_min DESC, weather"),
            groups=("weather",),
        ),
        "sql09_festival": PackQuery(
            "Festival impact",
            ("festival",),
            _BREAKDOWN,
            _by("festival", "avg_delivery_time_min DESC, festival"),
            groups=("festival",),
        ),
        "sql10_riders": PackQuery(
            "High-volume riders",
            ("delivery_person_id",),
            (
                "total_orders_delivered",
                "avg_rider_rating",
                "avg_delivery_time_min",
                "sla_violations",
                "sla_violation_rate_pct",
            ),
            f"""
            SELECT delivery_person_id, count(*) AS total_orders_delivered,
                   {exact_avg_sql('delivery_person_rating', 6)} AS avg_rider_rating,
                   {AVG_TIME}, {VIOLATIONS} AS sla_violations, {RATE}
            FROM {{deliveries}} GROUP BY delivery_person_id
            HAVING count(*) >= :min_orders
            ORDER BY total_orders_delivered DESC, sla_violation_rate_pct,
                     delivery_person_id
            LIMIT :top""",
            {"min_orders": config.rider_min_orders, "top": config.rider_top},
        ),
    }


@dataclass(frozen=True)
class Outcome:
    """What became of one report: its table, or the error it met."""

    title: str
    table: DataFrame | None
    error: str | None = None


def run_query(
    spark: SparkSession, query: PackQuery, deliveries: DataFrame | None = None
) -> DataFrame:
    """One report over a DataFrame, or over the registered table without one."""
    if deliveries is None:
        text = query.sql.replace("{deliveries}", "deliveries")
        return spark.sql(text, args=query.args)
    return spark.sql(query.sql, args=query.args, deliveries=deliveries)


def run_pack(
    spark: SparkSession,
    deliveries: DataFrame | None = None,
    pack: dict[str, PackQuery] | None = None,
    sink: Callable[[str, DataFrame], None] | None = None,
) -> dict[str, Outcome]:
    """Every report; a failing one is recorded and the rest still run.

    ``sink`` receives each table as soon as it is planned, for instance to write
    it, so that errors of the run itself are recorded too.
    """
    outcomes = {}
    for name, query in (pack or query_pack()).items():
        try:
            table = run_query(spark, query, deliveries)
            if sink is not None:
                sink(name, table)
            outcomes[name] = Outcome(query.title, table)
        except PySparkException as error:
            outcomes[name] = Outcome(query.title, None, str(error))
    return outcomes


def pack_rows(
    spark: SparkSession,
    deliveries: DataFrame | None = None,
    pack: dict[str, PackQuery] | None = None,
) -> DataFrame:
    """All reports in one long table: a row per report, key and measure.

    The reports of sums share one scan, each other one has its own. A report that
    can't be planned has one row that holds its error and no value.
    """
    queries = pack or query_pack()
    numbered = {name: (i, query) for i, (name, query) in enumerate(queries.items(), 1)}
    source = spark.table("deliveries") if deliveries is None else deliveries
    summed = {n: q for n, q in numbered.items() if q[1].groups is not None}
    parts, errors = [], []
    try:
        if summed:
            parts.append(_summed_rows(source, summed))
    except PySparkException as error:
        errors += [(*_heading(n, q), str(error)) for n, q in summed.items()]
    for name, (number, query) in numbered.items():
        if name in summed:
            continue
        try:
            table = run_query(spark, query, deliveries)
            parts.append(_long_rows(number, name, query, table))
        except PySparkException as error:
            errors.append((*_heading(name, (number, query)), str(error)))
    if errors:
        failed = spark.createDataFrame(
            errors, "query_no int, query_name string, title string, error string"
        )
        none = F.lit(None)
        parts.append(failed.select(
            "query_no", "query_name", "title", none.cast("string").alias("row_key"),
            none.cast("string").alias("measure"), none.cast("double").alias("value"), "error",
        ))
    return reduce(DataFrame.unionByName, parts)


def stored_pack_rows(
    spark: SparkSession,
    deliveries: DataFrame | None = None,
    pack: dict[str, PackQuery] | None = None,
) -> DataFrame:
    """``pack_rows``, run and stored; a report that fails while it runs has a row with its error.

    All reports run in one job of two scans. Only if that fails, each runs on its own, and
    those that go well have their rows.
    """
    queries = pack or query_pack()
    root = shared.table_path(spark, f"pack-{uuid4().hex}")

    def stored(some: dict[str, PackQuery], name: str) -> DataFrame:
        rows = pack_rows(spark, deliveries, some)
        rows.write.parquet(f"{root}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{root}/{name}")

    try:
        return stored(queries, "all")
    except PySparkException:
        pass
    parts, schema = [], None
    for number, (name, query) in enumerate(queries.items(), 1):
        try:
            part = stored({name: query}, name).withColumn("query_no", F.lit(number))
        except PySparkException as error:
            failed = [(number, name, query.title, None, None, None, str(error))]
            part = spark.createDataFrame(failed, ROWS)
        parts.append(part)
    return reduce(DataFrame.unionByName, parts)


ROWS = "query_no int, query_name string, title string, row_key string, measure string, value double, error string"


def _heading(name: str, numbered: tuple[int, PackQuery]) -> tuple[int, str, str]:
    return numbered[0], name, numbered[1].title


def _summed_rows(
    deliveries: DataFrame, summed: dict[str, tuple[int, PackQuery]]
) -> DataFrame:
    """The reports that need only sums by their groups, from one scan."""
    sets = list(dict.fromkeys(q.groups for _, q in summed.values()))
    columns = list(dict.fromkeys(c for group in sets for c in group))
    figures = {
        "n": F.count(F.lit(1)),
        "minutes": F.sum("delivery_time_min"),
        "late": F.sum("is_sla_violated"),
        "km_n": F.count("delivery_distance_km"),
        "km_sum": scaled_sum(F.col("delivery_distance_km"), 2),
    }
    # by all columns at once first: only sums are multiplied by the grouping sets
    joint = deliveries.groupBy(*columns).agg(*[f.alias(name) for name, f in figures.items()])
    added = [F.sum(name).alias(name) for name in figures]
    sums = joint.groupingSets([list(g) for g in sets], *columns).agg(
        F.grouping_id().cast("int").alias("set_id"), *added
    )
    # all figures, so that it is the same exchange of the joint sums
    total = joint.agg(F.struct(*added)).scalar()["n"]
    ids = {
        group: sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in group)
        for group in sets
    }
    n, late = F.col("n"), F.col("late")
    rate = F.round(late / n * 100, 2)
    share = F.round(n * F.lit(100.0) / F.col("all orders"), 2)
    km = F.when(F.col("km_n") > 0, F.round(F.col("km_sum") / (F.col("km_n") * 100.0), 2))
    measures = {
        "total_deliveries": n, "order_volume": n,
        "avg_delivery_time_min": F.round(F.col("minutes") / n, 2),
        "total_sla_violations": late, "sla_violations": late, "sla_violation_rate_pct": rate,
        "pct_of_total_orders": share, "order_share_pct": share, "avg_distance_km": km,
    }
    period = (
        F.when(F.col("is_peak_hour") == 1, DINNER_LABEL)
        .when(F.col("is_peak_hour") == 0, SQL_NON_PEAK_LABEL)
        .otherwise(SQL_UNKNOWN_HOUR_LABEL)
        if "is_peak_hour" in columns
        else None
    )
    reports = []
    for name, (number, query) in summed.items():
        keys = [period if c == "is_peak_hour" else F.col(c) for c in query.groups]
        shown = F.col("set_id") == ids[query.groups]
        if query.groups == ("order_hour",):
            shown = shown & F.col("order_hour").isNotNull()
        row_key = F.concat_ws("/", *[F.coalesce(k.cast("string"), F.lit("")) for k in keys])
        reports += [
            F.when(shown, F.struct(
                F.lit(number).alias("query_no"),
                F.lit(name).alias("query_name"),
                F.lit(query.title).alias("title"),
                row_key.alias("row_key"),
                F.lit(m).alias("measure"),
                measures[m].cast("double").alias("value"),
                F.lit(None).cast("string").alias("error"),
            ))
            for m in query.measures
        ]
    rows = F.filter(F.array(*reports), lambda r: r.isNotNull())
    return sums.withColumn("all orders", total).select(F.inline(rows))


def _long_rows(number: int, name: str, query: PackQuery, table: DataFrame) -> DataFrame:
    keys = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in query.keys]
    measures = F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value"))
        for m in query.measures
    ])
    rows = table.select(
        F.lit(number).alias("query_no"),
        F.lit(name).alias("query_name"),
        F.lit(query.title).alias("title"),
        F.concat_ws("/", *keys).alias("row_key"),
        F.inline(measures),
    )
    return rows.withColumn("error", F.lit(None).cast("string"))
