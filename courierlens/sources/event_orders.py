"""An order log derived from an event stream table by a fixed rule.

The rule uses only arithmetic on the event id, the user id and the time of the
event, so the log grows with the events, and puts every kind of dirt the
cleaning handles at a known rate. It is a projection: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlens.schemas import RAW_SCHEMA

# The vocabulary of the derived log.
WEATHER = ("Sunny", "Cloudy", "Fog", "Stormy", "Sandstorms", "Windy")
TRAFFIC = ("Low", "Medium", "High", "Jam")
ORDER_TYPES = ("Snack", "Meal", "Drinks", "Buffet")
VEHICLES = ("motorcycle", "scooter", "electric_scooter", "bicycle")


def _item(values: tuple[str, ...], index: str) -> str:
    choices = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({choices}), cast(({index}) + 1 as int))"


def _hhmm(minutes: str) -> str:
    hours = f"cast({minutes} div 60 as string)"
    return (
        f"concat(lpad({hours}, 2, '0'), ':', "
        f"lpad(cast({minutes} % 60 as string), 2, '0'))"
    )


RULES = {
    "ID": "concat(' O', cast(e as string), ' ')",
    "Delivery_person_ID": "concat('R', cast(u as string))",
    "Delivery_person_Age":
        "case when e % 50 = 0 then null when e % 97 = 0 then '15' "
        "else cast(20 + u % 20 as string) end",
    "Delivery_person_Ratings":
        "case when e % 53 = 0 then 'NaN ' when e % 211 = 0 then '6.0' "
        "else concat(cast(3 + e % 2 as string), '.', cast(e % 10 as string)) end",
    "Restaurant_latitude":
        "case when e % 12 = 0 then 0e0 "
        "when e % 101 = 0 then -(12 + (e % 1000) / 100e0) "
        "else 12 + (e % 1000) / 100e0 end",
    "Restaurant_longitude":
        "case when e % 12 = 0 then 0e0 else 72 + (e % 700) / 100e0 end",
    "Delivery_location_latitude":
        "(12 + (e % 1000) / 100e0 + (e % 14) / 100e0) "
        "* case when e % 103 = 0 then -1 else 1 end",
    "Delivery_location_longitude":
        "72 + (e % 700) / 100e0 + (e % 14) / 100e0",
    "Order_Date": "concat(' ', date_format(ts, 'dd-MM-yyyy'))",
    "Time_Orderd":
        "case when e % 26 = 0 then null "
        "when e % 7 = 0 then cast(om / 1440e0 as string) "
        f"else {_hhmm('om')} end",
    "Time_Order_picked":
        f"concat({_hhmm('(om + (e % 3 + 1) * 5)')}, "
        "case when e % 2 = 0 then ':00' else '' end)",
    "Weather_conditions":
        "case when e % 74 = 0 then null when e % 75 = 0 then 'NaN' "
        f"else {_item(WEATHER, 'e % 6')} end",
    "Road_traffic_density":
        "case when e % 76 = 0 then null "
        f"else concat({_item(TRAFFIC, '(e div 6) % 4')}, ' ') end",
    "Vehicle_condition": "cast(e % 4 as int)",
    "Type_of_order": _item(ORDER_TYPES, "e % 4"),
    "Type_of_vehicle": _item(VEHICLES, "(e div 4) % 4"),
    "multiple_deliveries":
        "case when e % 46 = 0 then null else cast((e div 24) % 4 as double) end",
    "Festival":
        "case when e % 200 = 0 then null when e % 49 = 0 then 'Yes' else 'No ' end",
    "City":
        "case when e % 38 = 0 then null when e % 250 = 1 then 'Semi-Urban' "
        "when e % 4 = 1 then 'Urban' else 'Metropolitian' end",
    "Time_taken (min)":
        "cast(10 + (e * 7919) % 25 + ((e div 6) % 4) * 4 "
        "+ case when om >= 1080 and om < 1320 then 8 else 0 end as int)",
}


def orders_from_events(events: DataFrame) -> DataFrame:
    """Raw order log of an events table; every 500th order appears twice."""
    copies = F.expr("explode(sequence(1, if(event_id % 500 = 0, 2, 1)))")
    base = events.select(
        F.col("event_id").alias("e"),
        F.col("user_id").alias("u"),
        "ts",
        F.expr("cast(hour(ts) * 60 + minute(ts) as bigint)").alias("om"),
        copies.alias("copy"),
    )
    return base.select(
        *[F.expr(RULES[field.name]).alias(field.name) for field in RAW_SCHEMA]
    )


def load_orders(spark: SparkSession, data_dir: str) -> DataFrame:
    return orders_from_events(spark.read.parquet(f"{data_dir}/events.parquet"))
