"""Physical plans: no Python, one scan, pushed filters, partial aggregation."""

from __future__ import annotations

import re

import pytest

from courierlens.operators import metrics
from courierlens.operators.scope import Scope, apply_scope
from courierlens.plans.catalogue import all_queries
from courierlens.plans.cleaning_run import event_deliveries
from courierlens.plans.query_pack import PackQuery, pack_rows, query_pack, run_pack
from courierlens.plans.report import build_report
from tests.conftest import DATA_DIR

QUERIES = all_queries()
PYTHON = re.compile("EvalPython|InPandas|InArrow|MapPartitions|ScanExistingRDD")


def scans(plan: str) -> int:
    """Scans of stored files that really run: not those of the initial plans,
    and one for each exchange that is reused."""
    kept, skip_deeper_than = [], None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :|+-*"))
        if skip_deeper_than is not None and depth > skip_deeper_than:
            continue
        skip_deeper_than = None
        if "== Initial Plan ==" in line or "ReusedExchange" in line:
            skip_deeper_than = depth - (1 if "Initial" in line else 0)
            continue
        kept.append(line)
    return sum("FileScan" in line for line in kept)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_no_cross_join(spark, name):
    text = QUERIES[name](spark, DATA_DIR)._jdf.queryExecution().toString()
    assert not PYTHON.search(text)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


@pytest.mark.parametrize(
    "name",
    ["agg_category_city", "agg_peak_compare", "agg_share", "agg_histogram",
     "chart_distribution", "insights", "agg_group_stats", "sql02_peak", "sql04_city"],
)
def test_metric_reads_the_table_once(spark, plan, name):
    text = plan(QUERIES[name](spark, DATA_DIR))
    final = re.findall(r"Exchange hashpartitioning", text)
    assert final, text
    assert scans(text) <= 1, text


def test_describe_reads_the_rows_three_times_whatever_they_are(spark, plan):
    # two passes before the plan is made, one in it; what they stored is read for its sums and its ranks
    text = plan(QUERIES["agg_describe"](spark, DATA_DIR))
    final = text.split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan[^\n]*events", final)) == 1
    assert "collect_list" not in text


def test_query_pack_reads_the_table_twice_and_sorts_nothing(spark, plan):
    text = plan(pack_rows(spark, event_deliveries(spark, DATA_DIR)))
    final = text.split("== Initial Plan ==")[0]
    assert scans(text) <= 2
    assert "Window" not in final and "Sort [" not in final


def test_insights_multiply_counts_not_rows(spark, plan):
    final = plan(QUERIES["insights"](spark, DATA_DIR)).split("== Initial Plan ==")[0]
    expand = final.index("Expand")
    assert "Exchange hashpartitioning" in final[expand:]


def test_scope_is_pushed_into_the_scan(fact, plan):
    chosen = Scope(cities=("Urban", "Semi-Urban"), festival="No")
    text = plan(metrics.kpis(apply_scope(fact, chosen)))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    assert "In(city" in pushed and "EqualTo(festival,No)" in pushed


def test_columns_are_pruned(fact, plan):
    text = plan(metrics.category(fact, "city"))
    assert "ReadSchema: struct<city:string,delivery_time_min:int>" in text


def test_riders_are_combined_before_the_shuffle_and_cut_early(fact, plan):
    text = plan(metrics.riders(fact))
    assert "partial_count" in text
    assert "TakeOrderedAndProject" in text


def test_copies_are_dropped_before_the_shuffle(spark, plan):
    text = plan(QUERIES["clean_dedup"](spark, DATA_DIR))
    final = text.split("== Initial Plan ==")[0]
    assert final.count("HashAggregate") == 2


def test_report_counts_come_from_one_cached_scan(fact, plan):
    with build_report(fact) as report:
        for name in ("kpis", "hourly", "city", "insights", "chart_distribution"):
            assert "InMemoryTableScan" in plan(report.tables[name])


def test_failing_query_is_recorded_and_the_rest_run(spark, fact):
    pack = {
        "broken": PackQuery("Broken", (), (), "SELECT nothing FROM {deliveries}"),
        **query_pack(),
    }
    outcomes = run_pack(spark, fact, pack)
    assert outcomes["broken"].table is None
    assert "nothing" in outcomes["broken"].error
    assert sum(o.table is not None for o in outcomes.values()) == 10
    rows = pack_rows(spark, fact, pack).collect()
    assert {r["query_name"] for r in rows} == set(pack)
    (failed,) = [r for r in rows if r["error"]]
    assert failed["query_name"] == "broken" and "nothing" in failed["error"]


def test_pack_of_failing_queries_has_their_errors(spark, fact):
    pack = {n: PackQuery(n, (), (), f"SELECT {n} FROM {{deliveries}}") for n in ("a1", "b1")}
    assert [r["error"] is None for r in pack_rows(spark, fact, pack).collect()] == [False] * 2
    rows = pack_rows(spark, fact.drop("city")).collect()
    assert len({r["query_name"] for r in rows}) == 10 and any(r["error"] for r in rows)


def test_error_of_the_run_itself_is_recorded(spark, fact):
    pack = {
        "divides": PackQuery(
            "Divides by zero", (), (),
            "SELECT delivery_time_min / (delivery_time_min - delivery_time_min) AS x "
            "FROM {deliveries}",
        ),
        "sql01_kpis": query_pack()["sql01_kpis"],
    }
    outcomes = run_pack(spark, fact, pack, sink=lambda name, table: table.collect())
    assert "DIVIDE_BY_ZERO" in outcomes["divides"].error
    assert outcomes["sql01_kpis"].error is None


def test_pack_over_the_registered_table(spark, fact):
    fact.createOrReplaceTempView("deliveries")
    assert all(o.error is None for o in run_pack(spark).values())
