"""One local session and the derived tables the tests share."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

DATA_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("courierlens-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(scratch / "shared"))
        .config("spark.sql.warehouse.dir", str(scratch / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw(spark):
    from courierlens.sources.event_orders import load_orders

    return load_orders(spark, DATA_DIR)


@pytest.fixture(scope="session")
def fact(spark):
    from courierlens.plans.cleaning_run import event_deliveries

    return event_deliveries(spark, DATA_DIR)


@pytest.fixture(scope="session")
def raw_row(spark):
    """Builds raw logs from rows that name only the columns that matter."""
    from courierlens.schemas import RAW_SCHEMA

    plain = {
        "ID": "1", "Delivery_person_ID": "R1", "Delivery_person_Age": "30",
        "Delivery_person_Ratings": "4.5", "Restaurant_latitude": 13.0,
        "Restaurant_longitude": 77.0, "Delivery_location_latitude": 13.1,
        "Delivery_location_longitude": 77.1, "Order_Date": "11-02-2022",
        "Time_Orderd": "21:55", "Time_Order_picked": "22:10",
        "Weather_conditions": "Fog", "Road_traffic_density": "Jam",
        "Vehicle_condition": 2, "Type_of_order": "Snack",
        "Type_of_vehicle": "scooter", "multiple_deliveries": 1.0,
        "Festival": "No", "City": "Urban", "Time_taken (min)": 24,
    }

    def build(*rows: dict):
        data = [tuple({**plain, **row}[f] for f in RAW_SCHEMA.names) for row in rows]
        return spark.createDataFrame(data, RAW_SCHEMA)

    return build


def final_plan(df) -> str:
    """Physical plan after a run, with what adaptive execution made of it."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="session")
def plan():
    return final_plan
