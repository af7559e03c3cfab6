"""Edge rows of each cleaning rule."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from courierlens.functions import features, geo, text, times
from courierlens.operators import cleaning
from courierlens.schemas import CLEAN_SCHEMA
from courierlens.settings import SlaConfig


def one(spark, make, *values, types="string"):
    """Value of an expression over one row of inputs named a, b, c, d."""
    names = "abcd"[: len(values)]
    schema = ", ".join(f"{n} {types}" for n in names)
    df = spark.createDataFrame([values], schema)
    return df.select(make(*[F.col(n) for n in names]).alias("v")).first()["v"]


def clock(c):
    return times.parse_clock(text.clean_text(c))


@pytest.mark.parametrize(
    ("written", "expected"),
    [
        ("21:55", "21:55"),
        ("24:15:00", "00:15"),
        ("26:10", "02:10"),
        ("0.833333333", "20:00"),
        ("1", "00:00"),
        ("6.9E-4", "00:01"),
        (" 9:5 ", "09:05"),
        ("9 : 5", "09:05"),
        ("10:75", "10:75"),
        ("10:123", "10:123"),
        ("-1:30", "23:30"),
        ("-0.25", "18:00"),
        ("1e400", None),
        ("", None),
        ("   ", None),
        (None, None),
        ("NaN", None),
        ("abc", None),
        ("a:b", None),
        ("9.5:30", None),
        ("10:", None),
        ("inf", None),
        ("1d", None),
    ],
)
def test_clock(spark, written, expected):
    assert one(spark, clock, written) == expected


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(-3, 3), min_size=20, max_size=20))
def test_day_fraction_follows_floor_arithmetic(spark, days):
    def expected(day: float) -> str:
        seconds = int(round(day * 24 * 3600))
        return f"{seconds // 3600 % 24:02d}:{seconds % 3600 // 60:02d}"

    written = [repr(d) for d in days]
    df = spark.createDataFrame([(w,) for w in written], "t string")
    got = [r[0] for r in df.select(times.parse_clock(F.col("t"))).collect()]
    assert got == [expected(d) for d in days]


def clock_by_rule(written: str) -> str | None:
    """The rule for one clock text, in plain Python."""
    stripped = written.strip()
    try:
        seconds = int(round(float(stripped) * 24 * 3600))
    except OverflowError:
        return None
    except ValueError:
        pieces = stripped.split(":")
    else:
        return f"{seconds // 3600 % 24:02d}:{seconds % 3600 // 60:02d}"
    try:
        return f"{int(pieces[0]) % 24:02d}:{int(pieces[1]):02d}"
    except (IndexError, ValueError):
        return None


@settings(max_examples=10, deadline=None)
@given(
    st.lists(
        st.one_of(
            st.text("0123456789:.+-eE \u00a0", max_size=7),
            st.from_regex(r"[ ]?[0-9]{1,2}:[0-9]{1,3}(:[0-9]{2})?[ ]?", fullmatch=True),
        ),
        min_size=40,
        max_size=60,
    )
)
def test_any_clock_text_follows_the_rule(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(clock(F.col("t"))).collect()]
    assert got == [clock_by_rule(t) for t in texts]


@pytest.mark.parametrize(
    ("ordered", "picked", "expected"),
    [
        ("23:55", "00:10", 15),
        ("23:55", "24:10:00", 15),
        ("10:00", "10:00", 0),
        ("10:10", "10:00", 1430),
        (None, "10:00", None),
        ("10:00", "x", None),
    ],
)
def test_pickup_delay(raw_row, ordered, picked, expected):
    raw = raw_row({"Time_Orderd": ordered, "Time_Order_picked": picked})
    assert cleaning.clean_orders(raw).first()["pickup_delay_minutes"] == expected


@pytest.mark.parametrize(
    ("gps", "expected"),
    [
        ((13.0, 77.0, 13.0, 77.0), 0.0),
        ((0.0, 77.0, 13.0, 77.0), None),
        ((13.0, 77.0, -13.1, 77.1), None),
        ((13.0, 77.0, 1.0, 77.1), None),
        ((None, 77.0, 13.0, 77.0), None),
        ((13.0, 77.0, None, 77.0), None),
        *[
            (tuple(bad if i == k else 13.0 for i in range(4)), None)
            for k in range(4)
            for bad in (float("nan"), float("inf"), float("-inf"))
        ],
    ],
)
def test_distance(spark, gps, expected):
    assert one(spark, geo.haversine_km, *gps, types="double") == expected


def test_not_a_number_is_no_position(spark):
    nan = float("nan")
    assert one(spark, geo.gps_valid, 13.0, 77.0, nan, 77.0, types="double") is False
    assert one(spark, geo.gps_valid, 13.0, 77.0, 13.0, nan, types="double") is False


@pytest.mark.parametrize("written", ["1e999", "-1e999", "nan", "inf"])
def test_numbers_beyond_the_doubles_are_missing(spark, written):
    assert one(spark, text.number, written) is None


def test_inverted_restaurant_is_repaired(spark):
    straight = one(spark, geo.haversine_km, 13.0, 77.0, 13.1, 77.1, types="double")
    inverted = one(spark, geo.haversine_km, -13.0, 77.0, 13.1, 77.1, types="double")
    assert straight == inverted > 15


@pytest.mark.parametrize(
    ("column", "written", "name", "expected"),
    [
        ("Delivery_person_Ratings", "5.0", "delivery_person_rating", 5.0),
        ("Delivery_person_Ratings", "5.1", "delivery_person_rating", None),
        ("Delivery_person_Ratings", "x", "delivery_person_rating", None),
        ("Delivery_person_Ratings", "NaN ", "delivery_person_rating", None),
        ("Delivery_person_Ratings", "inf", "delivery_person_rating", None),
        ("Delivery_person_Age", "15", "delivery_person_age", 15.0),
        ("Delivery_person_Age", "old", "delivery_person_age", None),
        ("Road_traffic_density", None, "traffic_density", "Unknown"),
        ("Road_traffic_density", "Jam ", "traffic_density", "Jam"),
        ("Road_traffic_density", " Jam\t", "traffic_density", "Jam"),
        ("Weather_conditions", "NaN ", "weather", "Unknown"),
        ("Weather_conditions", "NaN", "weather", "Unknown"),
        ("Type_of_order", None, "order_type", None),
        ("Type_of_vehicle", " bicycle ", "vehicle_type", "bicycle"),
        ("multiple_deliveries", None, "multiple_deliveries", 1),
        ("multiple_deliveries", 3.0, "multiple_deliveries", 3),
        ("ID", None, "order_id", "nan"),
        ("ID", " O7 ", "order_id", "O7"),
        ("Order_Date", " 1-2-2022", "order_date", dt.date(2022, 2, 1)),
        ("Order_Date", None, "order_date", None),
        ("Order_Date", None, "is_weekend", 0),
        ("Order_Date", "11-02-2022", "is_weekend", 0),
        ("Order_Date", "12-02-2022", "is_weekend", 1),
        ("Order_Date", "12-02-2022", "order_day_name", "Saturday"),
        ("Order_Date", "12-02-2022", "order_month", 2),
        ("Time_taken (min)", 30, "is_sla_violated", 0),
        ("Time_taken (min)", 31, "is_sla_violated", 1),
    ],
)
def test_rule(raw_row, column, written, name, expected):
    assert cleaning.clean_orders(raw_row({column: written})).first()[name] == expected


@pytest.mark.parametrize(
    ("hour", "period", "flag"),
    [
        (17, "Off-Peak", 0),
        (18, "Dinner Peak (18-21)", 1),
        (21, "Dinner Peak (18-21)", 1),
        (22, "Off-Peak", 0),
        (12, "Lunch Peak (12-13)", 0),
        (13, "Lunch Peak (12-13)", 0),
        (14, "Off-Peak", 0),
        (None, "Unknown", None),
    ],
)
def test_peak(spark, hour, period, flag):
    assert one(spark, features.peak_period, hour, types="int") == period
    assert one(spark, features.peak_flag, hour, types="int") == flag


@pytest.mark.parametrize("column", ["Vehicle_condition", "Time_taken (min)"])
def test_missing_required_number_fails_the_run(raw_row, column):
    with pytest.raises(PySparkException, match="value is missing"):
        cleaning.clean_orders(raw_row({column: None})).collect()


def test_bad_date_fails_without_ansi_too(spark, raw_row):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        raw = raw_row({"Order_Date": "2022/02/11"})
        with pytest.raises(Exception, match="unreadable date"):
            cleaning.clean_orders(raw).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_bad_date_fails_unless_lenient(spark, raw_row):
    with pytest.raises(PySparkException):
        cleaning.clean_orders(raw_row({"Order_Date": "2022/02/11"})).collect()
    assert one(spark, lambda c: times.parse_date(c, lenient=True), "2022/02/11") is None


def test_duplicates_are_equal_raw_rows(raw_row):
    same = {"Time_Orderd": None, "City": None}
    raw = raw_row(same, same, {**same, "ID": "1 "})
    clean = cleaning.clean_orders(raw)
    assert clean.count() == 2
    assert [r["order_id"] for r in clean.collect()] == ["1", "1"]


def test_dedup_is_idempotent(raw):
    once = cleaning.drop_duplicate_rows(raw)
    assert once.count() == cleaning.drop_duplicate_rows(once).count() == 1000


def test_every_distinct_raw_row_is_kept(raw):
    assert cleaning.clean_orders(raw).count() == raw.distinct().count()


def test_schema(raw):
    got = cleaning.clean_orders(raw).schema
    assert [(f.name, f.dataType) for f in got] == [
        (f.name, f.dataType) for f in CLEAN_SCHEMA
    ]


def test_config_reaches_every_rule(raw_row):
    config = SlaConfig(
        threshold=20, dinner_hours=(9,), rating_cap=4.0, multiple_deliveries_fill=0
    )
    raw = raw_row({"multiple_deliveries": None, "Time_Orderd": "9:00"})
    row = cleaning.clean_orders(raw, config).first()
    assert row["is_sla_violated"] == 1
    assert row["is_peak_hour"] == 1
    assert row["delivery_person_rating"] is None
    assert row["multiple_deliveries"] == 0


def test_column_names_are_stripped(raw):
    padded = raw.toDF(*[f"  {c}\t" for c in raw.columns])
    assert cleaning.clean_orders(padded).count() == 1000
