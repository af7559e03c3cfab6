"""Raw order log to the typed fact table.

Every rule is a column expression, so the whole stage is a chain of
projections around one wide step, the removal of duplicate rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courierlens.functions import features, geo, text, times
from courierlens.schemas import CLEAN_COLUMNS, RAW_SCHEMA
from courierlens.settings import DEFAULT, SlaConfig

RAW_TEXT_COLUMNS = [
    f.name for f in RAW_SCHEMA if isinstance(f.dataType, T.StringType)
]
# Read as numbers or clock times, which match no missing marker anyway.
NUMBER_COLUMNS = {"Delivery_person_Age", "Delivery_person_Ratings"}
FINISH = {"Time_Orderd": times.plain_spaces, "Time_Order_picked": times.plain_spaces}


def strip_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip() for name in df.columns])


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Keep one of each group of rows equal in all columns, nulls included.

    Runs on the raw text, before any trimming: rows that differ only in padding
    both stay. Spark drops copies within each task before the shuffle, so a
    large group of copies does not travel to one reducer.
    """
    return df.dropDuplicates()


def count_copies(df: DataFrame, name: str) -> DataFrame:
    """``drop_duplicate_rows`` with the number of equal rows that each one stands for."""
    return df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias(name))


def normalise_text(raw: DataFrame) -> DataFrame:
    """Trim all text columns and turn missing markers into nulls.

    Two projections: each later rule then reads a finished column instead of
    repeating the trim inside its own expression. Clock times and numbers keep
    their markers, which no number or clock pattern matches.
    """
    present = [name for name in RAW_TEXT_COLUMNS if name in raw.columns]
    trimmed = raw.withColumns({name: text.strip(F.col(name)) for name in present})
    return trimmed.withColumns({
        name: FINISH.get(name, text.null_if_missing)(F.col(name))
        for name in present
        if name not in NUMBER_COLUMNS
    })


def required_int(c: Column, name: str) -> Column:
    """Whole number that must be there: a null or bad value fails the run."""
    problem = F.raise_error(F.lit(f"{name}: value is missing"))
    return F.coalesce(c.cast("int"), problem.cast("int"))


def filled_count(c: Column, fill: int = DEFAULT.multiple_deliveries_fill) -> Column:
    return F.coalesce(c.cast("int"), F.lit(fill))


def capped_rating(rating: Column, cap: float = DEFAULT.rating_cap) -> Column:
    return F.when(rating <= cap, rating)


def order_key(c: Column) -> Column:
    """Order ids are never null: a missing one is kept as the text 'nan'."""
    return F.coalesce(c, F.lit("nan"))


def distance_km(config: SlaConfig = DEFAULT) -> Column:
    return geo.haversine_km(
        F.col("Restaurant_latitude"),
        F.col("Restaurant_longitude"),
        F.col("Delivery_location_latitude"),
        F.col("Delivery_location_longitude"),
        config.earth_radius_km,
    )


def add_clock_parts(normalised: DataFrame) -> DataFrame:
    """Hour and minute of both clock times, each pair in a column of its own."""
    return normalised.withColumns({
        "ordered": times.clock_parts(F.col("Time_Orderd")),
        "picked": times.clock_parts(F.col("Time_Order_picked")),
    })


def parse_columns(with_clock: DataFrame, config: SlaConfig = DEFAULT, *kept: str) -> DataFrame:
    """Parse, coerce and fill: one cleaned column per input; ``kept`` columns stay as they are."""
    col = F.col
    ordered, picked = col("ordered"), col("picked")
    return with_clock.select(
        *kept,
        order_key(col("ID")).alias("order_id"),
        col("Delivery_person_ID").alias("delivery_person_id"),
        text.number(col("Delivery_person_Age")).alias("delivery_person_age"),
        text.number(col("Delivery_person_Ratings")).alias("rating"),
        col("Restaurant_latitude").alias("restaurant_latitude"),
        col("Restaurant_longitude").alias("restaurant_longitude"),
        col("Delivery_location_latitude").alias("delivery_location_latitude"),
        col("Delivery_location_longitude").alias("delivery_location_longitude"),
        distance_km(config).alias("delivery_distance_km"),
        times.parse_date(col("Order_Date")).alias("order_date"),
        times.clock(ordered).alias("time_ordered"),
        times.clock(picked).alias("time_order_picked"),
        times.known_hour(ordered).alias("order_hour"),
        times.minutes_between(ordered, picked).alias("pickup_delay_minutes"),
        text.or_unknown(col("Weather_conditions")).alias("weather"),
        text.or_unknown(col("Road_traffic_density")).alias("traffic_density"),
        required_int(col("Vehicle_condition"), "Vehicle_condition").alias(
            "vehicle_condition"
        ),
        col("Type_of_order").alias("order_type"),
        col("Type_of_vehicle").alias("vehicle_type"),
        filled_count(
            col("multiple_deliveries"), config.multiple_deliveries_fill
        ).alias("multiple_deliveries"),
        text.or_unknown(col("Festival")).alias("festival"),
        text.or_unknown(col("City")).alias("city"),
        required_int(col("`Time_taken (min)`"), "Time_taken (min)").alias(
            "delivery_time_min"
        ),
    )


def derive_columns(parsed: DataFrame, config: SlaConfig = DEFAULT) -> DataFrame:
    """Calendar parts and service-level features of the parsed columns."""
    date, hour = F.col("order_date"), F.col("order_hour")
    minutes = F.col("delivery_time_min")
    return parsed.withColumns({
        "delivery_person_rating": capped_rating(F.col("rating"), config.rating_cap),
        "order_day": F.dayofmonth(date),
        "order_month": F.month(date),
        "order_day_name": times.day_name(date),
        "is_weekend": times.weekend_flag(date),
        "is_sla_violated": features.sla_flag(minutes, config.threshold),
        "is_peak_hour": features.peak_flag(hour, config),
        "peak_period": features.peak_period(hour, config),
    })


def select_clean(df: DataFrame) -> DataFrame:
    return df.select(*CLEAN_COLUMNS)


def clean_orders(raw: DataFrame, config: SlaConfig = DEFAULT, copies: str | None = None) -> DataFrame:
    """The whole pipeline: 20 raw columns in, the 30 fact columns out.

    ``copies`` names one more column: how many equal raw rows the row stands for.
    """
    named = raw.transform(strip_column_names)
    kept = [] if copies is None else [copies]
    single = named.transform(count_copies, copies) if kept else named.transform(drop_duplicate_rows)
    return clean_single(single, config, *kept)


def clean_single(single: DataFrame, config: SlaConfig = DEFAULT, *kept: str) -> DataFrame:
    """The pipeline behind the removal of duplicate rows: projections only."""
    return (
        single.transform(normalise_text)
        .transform(add_clock_parts)
        .transform(parse_columns, config, *kept)
        .transform(derive_columns, config)
        .select(*CLEAN_COLUMNS, *kept)
    )
