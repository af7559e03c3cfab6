"""Filter scopes, option lists and the whole report."""

from __future__ import annotations

import pytest

from courierlens.operators import metrics, scope
from courierlens.operators.scope import Scope
from courierlens.plans.report import build_report, report_cube
from courierlens.settings import DINNER_LABEL


def test_an_empty_scope_keeps_all_rows(fact):
    empty = Scope(cities=(), traffic=(), festival=None)
    assert scope.apply_scope(fact, empty).count() == fact.count()


def test_an_explicit_list_drops_nulls(spark):
    df = spark.createDataFrame([("Meal",), (None,)], "order_type string")
    assert scope.apply_scope(df, Scope(order_types=("Meal",))).count() == 1
    assert scope.apply_scope(df, Scope()).count() == 2


def test_scope_is_a_conjunction(fact):
    chosen = Scope(cities=("Urban",), festival="No", period=DINNER_LABEL)
    expected = fact.where(
        "city = 'Urban' and festival = 'No' and peak_period = 'Dinner Peak (18-21)'"
    )
    assert scope.apply_scope(fact, chosen).count() == expected.count() > 0


def test_scope_share_of_nothing(fact):
    row = scope.scope_share(fact.where("false"), Scope(cities=("Urban",))).first()
    assert tuple(row) == (0, 0, 0.0)


def test_domain_order_drops_values_outside(spark):
    df = spark.createDataFrame(
        [("Unknown",), ("Jam",), ("Odd",), ("Low",), (None,)], "traffic_density string"
    )
    rows = scope.in_domain_order(df, "traffic_density").collect()
    assert [r[0] for r in rows] == ["Low", "Jam", "Unknown"]
    assert [r[0] for r in scope.domain_options(df, "traffic_density").collect()] == [
        "Low", "Jam", "Unknown",
    ]


SCOPES = [Scope(), Scope(cities=("Urban",), traffic=("Jam", "Low"))]


@pytest.mark.parametrize("chosen", SCOPES)
@pytest.mark.parametrize("threshold", [30, 25])
def test_report_equals_the_single_metrics(fact, chosen, threshold):
    scoped = scope.apply_scope(fact, chosen)
    with build_report(fact, chosen, threshold) as report:
        got = {
            name: report.tables[name].collect()
            for name in ("kpis", "hourly", "peak", "city", "chart_distribution")
        }
        for table in report.tables.values():
            table.collect()
    assert got["kpis"] == metrics.kpis(scoped, threshold).collect()
    assert got["hourly"] == metrics.hourly(scoped, threshold).collect()
    assert got["peak"] == metrics.peak_compare(scoped, threshold).collect()
    assert got["city"] == metrics.category(scoped, "city", threshold).collect()
    assert got["chart_distribution"] == metrics.histogram(scoped, threshold).collect()
    assert not report.counts.is_cached


@pytest.mark.parametrize("chosen", SCOPES)
def test_report_from_the_cube_is_the_same(fact, chosen, tmp_path):
    path = str(tmp_path / "cube")
    report_cube(fact).write.parquet(path)
    cube = fact.sparkSession.read.parquet(path)
    assert cube.selectExpr("sum(n)").first()[0] == fact.count()
    with build_report(fact, chosen, 28) as direct:
        expected = {name: t.collect() for name, t in direct.tables.items()}
    with build_report(fact, chosen, 28, cube=cube) as from_cube:
        for name, table in from_cube.tables.items():
            assert table.collect() == expected[name], name


def test_report_of_an_empty_scope(fact):
    with build_report(fact, Scope(cities=("Nowhere",))) as report:
        assert report.tables["kpis"].first()["total_orders"] == 0
        assert report.tables["insights"].count() == 0


@pytest.mark.parametrize("chosen", [{"festival": "Maybe"}, {"period": "Dinner"}])
def test_unknown_choices_are_errors(chosen):
    with pytest.raises(ValueError, match="is none of"):
        Scope(**chosen)


@pytest.mark.parametrize("threshold", [19, 46])
def test_threshold_outside_the_control_is_an_error(fact, threshold):
    with pytest.raises(ValueError, match="outside"):
        build_report(fact, threshold=threshold)
