"""Profiles of a table and the data-quality audit of the cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courierlens.functions.rounding import percent
from courierlens.functions.text import clean_text, is_missing, number
from courierlens.operators.cleaning import normalise_text
from courierlens.operators.metrics import distance_totals
from courierlens.operators.quantiles import QUARTILES, statistics, with_quartiles
from courierlens.operators.time_counts import (
    TIME,
    mean_time,
    median_time,
    order_count,
    time_counts,
    violations,
)
from courierlens.settings import DEFAULT, SlaConfig


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def _as_rows(row: DataFrame, label: str, value: str) -> DataFrame:
    """One row of named figures turned into a row per figure."""
    pairs = [
        F.struct(F.lit(c).alias(label), _quoted(c).alias(value)) for c in row.columns
    ]
    return row.select(F.inline(F.array(*pairs)))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "column_count", F.lit(len(df.columns))
    )


def schema_rows(df: DataFrame) -> DataFrame:
    """Column names and types in order; reads no data."""
    fields = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema, 1)]
    return df.sparkSession.createDataFrame(
        fields, "position int, column_name string, data_type string"
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, marker text counted as missing."""
    counts = df.agg(*[
        F.count_if(_missing(f)).alias(f.name) for f in df.schema.fields
    ])
    return _as_rows(counts, "column_name", "missing_count")


def _missing(field: T.StructField) -> Column:
    c = _quoted(field.name)
    if isinstance(field.dataType, T.StringType):
        return is_missing(c)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def row_digest(df: DataFrame) -> Column:
    """32 bytes that stand for a whole row, nulls and lengths included."""
    parts = []
    for field in df.schema:
        c = _quoted(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = c + F.lit(0.0)  # the two zeros are equal
        text = c.cast("string")
        parts.append(F.coalesce(F.concat(F.length(text), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in all columns, nulls equal.

    Digests of the rows are counted within each task before the shuffle, so a
    large group of copies reaches the reducer as one digest per task.
    """
    groups = df.groupBy(row_digest(df).alias("digest")).count()
    extra = F.coalesce(F.sum(F.col("count") - 1), F.lit(0))
    return groups.agg(extra.alias("duplicate_rows"))


def head(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """First rows by a key column, so that the answer does not vary."""
    return df.orderBy(key).limit(n)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def numeric_view(raw: DataFrame) -> DataFrame:
    """The raw log's numeric columns, age and rating read as numbers."""
    as_number = {
        name: number(clean_text(F.col(name)))
        for name in ("Delivery_person_Age", "Delivery_person_Ratings")
    }
    numeric = raw.withColumns(as_number)
    return numeric.select(*[_quoted(c) for c in numeric_columns(numeric)])


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per column.

    Not-a-number counts as missing; infinite values count as they are. Three passes
    over the rows, whatever their values (``quantiles``).
    """
    names = columns or numeric_columns(df)
    numeric = df.select(*[
        F.nanvl(_quoted(name).cast("double"), F.lit(None).cast("double")).alias(name)
        for name in names
    ])
    rounded = [
        F.when(F.abs(F.col(c)) < float("inf"), F.round(c, 6)).otherwise(F.col(c)).alias(c)
        for c in ("mean", "std")
    ]
    quartiles = [F.round(label, 6).alias(label) for label in QUARTILES]
    return with_quartiles(numeric, statistics(numeric)).select(
        "column_name", "count", *rounded, "min", *quartiles, "max"
    )


def quality_report(
    raw: DataFrame, clean: DataFrame, config: SlaConfig = DEFAULT
) -> DataFrame:
    """Raw against cleaned rows and the headline figures of the cleaning run.

    The peak share is of orders with a known hour. An invalid clock time has
    neither text nor hour, so missing order times are the rows without an hour.
    """
    counts = time_counts(clean, "is_peak_hour", **distance_totals())
    n, flag = F.col("n"), F.col("is_peak_hour")
    known = F.sum(F.when(flag.isNotNull(), n).otherwise(0))
    peak = F.sum(F.when(flag == 1, n).otherwise(0))
    late = violations(config.threshold)
    raw_rows = raw.agg(F.count(F.lit(1))).scalar()
    valid = F.sum("distance_n")
    mean_km = F.sum("distance_sum") / (valid * 100.0)
    return counts.agg(
        order_count().alias("clean_rows"),
        F.lit(config.threshold).alias("sla_threshold"),
        late.alias("sla_violations"),
        F.round(percent(late, F.sum("n")), 2).alias("sla_violation_rate"),
        F.round(mean_time(), 2).alias("avg_time"),
        F.round(median_time(), 1).alias("median_time"),
        peak.alias("peak_orders"),
        F.round(F.when(known > 0, percent(peak, known)), 2).alias(
            "peak_share_of_known_hours_pct"
        ),
        valid.alias("valid_distances"),
        F.round(F.when(valid > 0, mean_km), 2).alias("avg_distance"),
        (F.sum("n") - known).alias("missing_order_times"),
    ).withColumn("raw_rows", raw_rows)


def observed_figures(config: SlaConfig, copies: str) -> dict[str, Column]:
    """Aggregates over cleaned rows with their number of copies, from which the report follows.

    All are taken where the table is written, behind the shuffle, so a repeated task
    counts once. Minutes are few, so their exact median is cheap.
    """
    minutes, flag = F.col(TIME), F.col("is_peak_hour")
    return {
        "raw_rows": F.sum(copies),
        "clean_rows": F.count(F.lit(1)),
        "minutes": F.sum(minutes),
        "sla_violations": F.count_if(minutes > config.threshold),
        "median_time": F.percentile(minutes, F.lit(0.5)),
        "peak_orders": F.count_if(flag == 1),
        "known_hours": F.count(flag),
        **distance_totals(),
    }


def report_of_figures(spark: SparkSession, figures: dict, config: SlaConfig = DEFAULT) -> DataFrame:
    """``quality_report`` from ``observed_figures``, with ``dropped_rows``."""
    has_rows = figures["clean_rows"] > 0
    value = {k: F.lit(v).cast("double" if k == "median_time" else "long") for k, v in figures.items()}
    rows, late, known, valid = (value[k] for k in ("clean_rows", "sla_violations", "known_hours", "distance_n"))
    none = F.lit(None)
    return spark.range(1).select(
        rows.alias("clean_rows") if has_rows else none.cast("long").alias("clean_rows"),
        F.lit(config.threshold).alias("sla_threshold"),
        late.alias("sla_violations"),
        F.round(percent(late, F.when(rows > 0, rows)), 2).alias("sla_violation_rate"),
        F.round(value["minutes"] / F.when(rows > 0, rows), 2).alias("avg_time"),
        F.round(value["median_time"], 1).alias("median_time"),
        value["peak_orders"].alias("peak_orders"),
        F.round(percent(value["peak_orders"], F.when(known > 0, known)), 2).alias("peak_share_of_known_hours_pct"),
        valid.alias("valid_distances"),
        F.round(value["distance_sum"] / (F.when(valid > 0, valid) * 100.0), 2).alias("avg_distance"),
        (rows - known).alias("missing_order_times"),
        F.coalesce(value["raw_rows"], F.lit(0)).alias("raw_rows"),
        (F.coalesce(value["raw_rows"], F.lit(0)) - rows).alias("dropped_rows"),
    )


def issue_audit(raw: DataFrame) -> DataFrame:
    """How many raw rows each cleaning rule applies to, in one pass."""
    col = F.col
    ordered = col("Time_Orderd")
    zero_gps = (col("Restaurant_latitude") == 0) | (col("Restaurant_longitude") == 0)
    rules = {
        "day_fraction_order_times": number(ordered).isNotNull(),
        "past_midnight_pickup_times": col("Time_Order_picked").startswith("24:"),
        "missing_order_times": is_missing(ordered),
        "zero_restaurant_coordinates": zero_gps,
        "ratings_above_cap":
            number(col("Delivery_person_Ratings")) > DEFAULT.rating_cap,
        "riders_under_18": number(col("Delivery_person_Age")) < 18,
        "missing_city": col("City").isNull(),
        "missing_weather": col("Weather_conditions").isNull(),
        "missing_traffic": col("Road_traffic_density").isNull(),
        "missing_festival": col("Festival").isNull(),
        "missing_multiple_deliveries": col("multiple_deliveries").isNull(),
    }
    counts = normalise_text(raw).agg(
        *[F.count_if(rule).alias(name) for name, rule in rules.items()]
    )
    return _as_rows(counts, "issue", "row_count")
