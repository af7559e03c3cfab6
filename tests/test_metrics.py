"""Metrics: empty input, invariants, both routes, percentiles."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from courierlens.operators import insights, metrics, quality
from courierlens.operators.time_counts import set_of, time_count_sets, time_counts
from courierlens.plans.query_pack import query_pack, run_query
from courierlens.settings import SlaConfig


def as_dicts(df):
    return [r.asDict() for r in df.collect()]


def test_kpis_of_nothing_are_zero(fact):
    row = metrics.kpis(fact.where("false")).first()
    assert set(row) == {0, 0.0}


def test_shares_sum_to_100(fact):
    for dim in metrics.CATEGORIES.values():
        total = metrics.category(fact, dim).agg(F.sum("order_share_pct")).first()[0]
        assert total == pytest.approx(100)


def test_null_keys_count_in_the_share_only(spark):
    df = spark.createDataFrame(
        [("a", 10), ("a", 20), (None, 40), (None, 50)],
        "kind string, delivery_time_min int",
    )
    rows = as_dicts(metrics.category(df, "kind"))
    assert [r["kind"] for r in rows] == ["a"]
    assert rows[0]["order_share_pct"] == 50.0


def test_hours_and_unknown_make_the_total(fact):
    known = metrics.hourly(fact).agg(F.sum("order_count")).first()[0]
    assert known + fact.where("order_hour is null").count() == fact.count()


def test_violations_fall_as_the_threshold_rises(fact):
    rows = metrics.threshold_sweep(fact, range(10, 60, 5)).collect()
    counts = [r["sla_violations"] for r in rows]
    assert counts == sorted(counts, reverse=True)
    assert counts[-1] == 0


@pytest.mark.parametrize(
    ("pack_name", "dim", "key"),
    [
        ("sql04_city", "city", "city"),
        ("sql05_traffic", "traffic_density", "traffic_density"),
        ("sql06_batching", "multiple_deliveries", "multi_orders_stacked"),
        ("sql08_weather", "weather", "weather"),
        ("sql09_festival", "festival", "festival"),
    ],
)
def test_sql_and_dataframe_routes_agree(spark, fact, pack_name, dim, key):
    by_sql = {
        r[key]: (r["total_deliveries"], r["sla_violations"], r["avg_delivery_time_min"])
        for r in run_query(spark, query_pack()[pack_name], fact).collect()
    }
    by_frame = {
        r[dim]: (r["order_count"], r["sla_violations"], r["avg"])
        for r in metrics.category(fact, dim)
        .withColumn("avg", F.round("avg_delivery_time", 2))
        .collect()
    }
    assert by_sql == by_frame


def test_threshold_moves_the_rider_violations(fact):
    strict = metrics.riders(fact, SlaConfig(threshold=10, rider_min_orders=1))
    loose = metrics.riders(fact, SlaConfig(threshold=60, rider_min_orders=1))
    assert all(r["sla_violations"] == 0 for r in loose.collect())
    assert all(r["sla_violations"] > 0 for r in strict.collect())


def test_one_scan_of_sets_equals_separate_counts(fact):
    dims = ["order_hour", "city", "weather", "is_peak_hour"]
    sets = time_count_sets(fact, dims)
    for dim in dims:
        one = sorted(set_of(sets, dims, dim).fillna(-1).collect())
        other = sorted(time_counts(fact, dim).fillna(-1).collect())
        assert one == other


def test_median_of_a_hot_group(spark):
    """A third of all rows in one group, counted by minute before the shuffle."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .otherwise((F.col("id") % 50).cast("string"))
        .alias("kind"),
        (F.col("id") % 61).cast("int").alias("delivery_time_min"),
    )
    row = metrics.category(df, "kind").where("kind = 'hot'").first()
    assert row["order_count"] == 10_000
    assert row["median_delivery_time"] == 30.0


QUARTILES = ("q1", "median", "q3")


def numpy_quartiles(values):
    import numpy as np

    with np.errstate(invalid="ignore"):
        return [float(v) for v in np.percentile(values, [25, 50, 75])]


def quartiles_of(df, column="x"):
    rows = {r["column_name"]: r for r in quality.describe(df).collect()}
    return [rows[column][q] for q in QUARTILES]


@settings(max_examples=10, deadline=None)
@given(
    st.lists(
        st.one_of(
            st.floats(-1e6, 1e6), st.sampled_from([0.0, 13.5, 1e300, -1e300, 1e-300])
        ),
        min_size=1,
        max_size=40,
    )
)
def test_quartiles_match_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert quartiles_of(df) == pytest.approx(numpy_quartiles(values), rel=1e-12, abs=1e-6)


def test_quartiles_of_many_rows_with_one_value_in_a_third(spark):
    """More rows than a bracket takes whole, over many powers of ten."""
    rng = random.Random(7)
    values = [
        12.5 if i % 3 == 0 else rng.gauss(20, 9) * 10.0 ** rng.randint(-3, 3)
        for i in range(60_000)
    ]
    df = spark.createDataFrame([(v, None) for v in values], "x double, y double")
    rows = {r["column_name"]: r for r in quality.describe(df.repartition(4)).collect()}
    assert [rows["x"][q] for q in QUARTILES] == pytest.approx(numpy_quartiles(values), abs=1e-6)
    assert rows["x"]["count"] == 60_000
    assert [rows["y"][q] for q in QUARTILES] == [None] * 3


def test_quartiles_of_a_bracket_of_many_distinct_values(spark):
    """A bracket is eight rows in ten thousand; here the whole column is one, of a million values."""
    from courierlens.operators import quantiles

    n = 1_000_000
    counted = spark.range(n).select(
        F.lit("x").alias("column_name"), F.lit(0).alias("k"), (F.pmod(F.col("id") * 7919, F.lit(n)) * 0.5).alias("value"),
        F.lit(1).cast("long").alias("n"),
    )
    ranged = quantiles.in_ranges(counted)
    assert ranged.select("part").distinct().count() > 1
    for place, value in ((0.0, 0.0), (n / 2 - 0.25, (n / 2 - 0.25) / 2), (n - 1.0, (n - 1) / 2)):
        ranks = spark.createDataFrame([("x", 0, place)], "column_name string, k int, place double")
        (row,) = quantiles.values_at(ranged, ranks, ["column_name", "k"]).collect()
        assert row["value"] == value
    outside = spark.createDataFrame([("x", 0, float(n))], "column_name string, k int, place double")
    assert quantiles.values_at(ranged, outside, ["column_name", "k"]).collect() == []


def test_whole_double_range(spark):
    values = [-1.7e308, -1.0, 0.0, 1.0, 1.7e308]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert quartiles_of(df) == [-1.0, 0.0, 1.0]


def test_infinite_values_count_and_not_a_number_is_missing(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 4.0, inf)], "x double")
    row = quality.describe(df).first()
    assert (row["count"], row["max"], row["mean"]) == (5, inf, inf)
    assert [row[q] for q in QUARTILES] == [2.0, 3.0, 4.0]
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 4.0, nan)], "x double")
    row = quality.describe(df).first()
    assert (row["count"], row["mean"]) == (4, 2.5)
    assert [row[q] for q in QUARTILES] == [1.75, 2.5, 3.25]
    counts = {r["column_name"]: r["missing_count"] for r in quality.null_counts(df).collect()}
    assert counts == {"x": 1}


def test_schema_rows(fact):
    rows = quality.schema_rows(fact).collect()
    assert len(rows) == 30 and tuple(rows[0]) == (1, "order_id", "string")


def test_describe_of_an_empty_table(fact):
    row = quality.describe(fact.where("false"), ["delivery_time_min"]).first()
    assert row["count"] == 0 and row["median"] is None


@pytest.mark.parametrize(
    ("low", "high", "bins", "width"),
    [(10, 54, 45, 1.0), (10, 54, 10, 5.0), (0, 90, 45, 5.0), (0, 89, 45, 2.0), (0, 900, 45, 50.0),
     (7, 7, 45, 1.0), (0, 4500, 45, 200.0), (9, 54, 45, 2.0), (14, 64, 10, 10.0),
     (-7, 54, 10, 10.0)],
)
def test_histogram_width(spark, low, high, bins, width):
    df = spark.createDataFrame([(low,), (high,)], "delivery_time_min int")
    rows = metrics.histogram(df, max_bins=bins).collect()
    assert {r["bin_width"] for r in rows} == {width}
    assert high // width - low // width + 1 <= bins
    assert sum(r["order_count"] for r in rows) == 2


def test_insight_is_absent_without_one_of_its_sides(fact):
    names = [r["name"] for r in insights.insights(
        fact.where("traffic_density <> 'Jam'")).collect()]
    assert names == ["batching", "dinner", "vehicle", "festival"]


def test_dinner_insight_needs_dinner_hours_only(fact):
    rows = insights.insights(fact.where("is_peak_hour = 1")).collect()
    dinner = [r for r in rows if r["name"] == "dinner"][0]
    assert "compared to nan minutes and nan%" in dinner["evidence"]
    quiet = insights.insights(fact.where("is_peak_hour = 0")).collect()
    assert "dinner" not in [r["name"] for r in quiet]


def test_insights_of_nothing(fact):
    assert insights.insights(fact.where("false")).collect() == []


def test_marks_are_of_the_whole_table(fact):
    import numpy as np

    minutes = [r[0] for r in fact.select("delivery_time_min").collect()]
    row = metrics.time_marks(fact).first()
    assert tuple(row) == (float(np.median(minutes)), float(np.percentile(minutes, 75)))
    assert metrics.time_summary(fact.where("false")).first()["count"] == 0


def test_duplicates_with_nulls(spark):
    df = spark.createDataFrame([(1, None)] * 4 + [(2, "x"), (2, "-"), (2, "")], "a int, b string")
    assert quality.duplicate_count(df).first()[0] == 3
    assert quality.duplicate_count(df.where("false")).first()[0] == 0


def test_quality_report_of_nothing(raw, fact):
    row = quality.quality_report(raw.where("false"), fact.where("false")).first()
    assert row["raw_rows"] == 0
