"""Versions, clustered layout, the daily cube, observed figures and reports that fail."""

from __future__ import annotations

from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from courierlens.operators import quality, scope
from courierlens.plans import cube_store
from courierlens.plans.cleaning_run import cleaning_report, run_cleaning
from courierlens.plans.query_pack import PackQuery, pack_rows, query_pack, stored_pack_rows
from courierlens.plans.report import report_cube
from courierlens.settings import SlaConfig
from courierlens.sources import fact_table, layout, order_log, shared, versions


def rows(df):
    return Counter(map(tuple, df.select(sorted(df.columns)).collect()))


# --- versions


def test_a_failed_write_keeps_the_old_table(spark, fact, tmp_path):
    path = str(tmp_path / "fact")
    fact_table.sink_clean(fact, path)
    old = fact_table.scan_clean(spark, path)
    broken = fact.withColumn("city", F.raise_error(F.lit("no city")).cast("string"))
    with pytest.raises(Exception, match="no city"):
        fact_table.sink_clean(broken, path)
    assert old.count() == fact_table.scan_clean(spark, path).count() == 1000
    assert len(list((tmp_path / "fact").glob("data=*"))) == 1


def test_of_two_writers_the_second_is_told(spark, fact, tmp_path):
    path = str(tmp_path / "fact")
    fact_table.sink_clean(fact, path)
    base = versions.newest(spark, path)
    fact_table.sink_clean(fact.limit(5), path, base=base)
    with pytest.raises(versions.VersionConflict):
        fact_table.sink_clean(fact.limit(7), path, base=base)
    assert fact_table.scan_clean(spark, path).count() == 5
    assert fact_table.sink_clean(fact.limit(7), path).number == 3


def test_readers_of_the_version_before_go_on(spark, fact, tmp_path):
    path = str(tmp_path / "fact")
    for n in (3, 4, 5):
        fact_table.sink_clean(fact.limit(n), path)
        if n == 4:
            before = fact_table.scan_clean(spark, path)
    assert before.count() == 4 and fact_table.scan_clean(spark, path).count() == 5
    assert len(list((tmp_path / "fact").glob("data=*"))) == 2


def test_a_warehouse_on_a_local_disk_is_an_error_on_a_cluster(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn", "spark.sql.warehouse.dir": "file:/tmp/w"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared.shared_root(Session())


# --- layout


def rows_read(df):
    """Rows that the scan took from the row groups it did not skip."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().apply(0)
    return leaf.metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def many(spark, fact):
    """Fifty times the orders, in no order."""
    return fact.crossJoin(spark.range(50).withColumnRenamed("id", "again")).drop("again").orderBy(F.rand(3)).cache()


def test_a_clustered_table_skips_row_groups(spark, many, tmp_path):
    plain, clustered = str(tmp_path / "plain"), str(tmp_path / "clustered")
    group = 64 * 1024
    many.repartition(8).write.option("parquet.block.size", group).parquet(plain)
    chosen = layout.Layout(files=16, row_group_bytes=group)
    fact_table.sink_clean(spark.read.parquet(plain), clustered, layout=chosen)
    wanted = scope.Scope(cities=("Urban",), traffic=("Jam",), weather=("Cloudy", "Stormy"))
    found = scope.apply_scope(fact_table.scan_clean(spark, clustered), wanted)
    before = scope.apply_scope(spark.read.parquet(plain), wanted)
    assert rows(found) == rows(before) and found.count() > 0
    assert rows_read(before.select("order_id")) == 50_000
    assert rows_read(found.select("order_id")) < 20_000
    assert rows(fact_table.scan_clean(spark, clustered)) == rows(many)


def test_lookups_use_bloom_filters(spark, fact, tmp_path):
    import pyarrow.parquet as pq

    path = str(tmp_path / "fact")
    layout.write(fact, path, layout.Layout(files=2))
    file = next(p for p in (tmp_path / "fact").glob("*.parquet"))
    schema, group = pq.ParquetFile(file).schema_arrow, pq.ParquetFile(file).metadata.row_group(0)
    end = {n: group.column(i).dictionary_page_offset or group.column(i).data_page_offset for i, n in enumerate(schema.names)}
    # filters stand behind the row groups' pages
    assert file.stat().st_size > max(end.values()) + 10_000
    assert spark.read.parquet(path).where("order_id = 'O7'").count() == 1


def test_clustered_by_date_folders(spark, fact, tmp_path):
    path = str(tmp_path / "fact")
    fact_table.sink_clean(fact, path, layout=layout.Layout(folders=("order_month",), files=4))
    back = fact_table.scan_clean(spark, path)
    assert back.schema == fact.schema and rows(back) == rows(fact)


@pytest.mark.parametrize("kind", ["string", "date", "double", "int", "timestamp"])
def test_numbers_keep_the_order_of_values(spark, kind):
    values = {
        "string": ["", "A", "Ab", "B", "a", "é", "éa"], "date": ["1969-01-01", "1970-01-02", "2022-05-01"],
        "double": ["-1e300", "-1.5", "0", "2.5"], "int": ["-7", "0", "9"], "timestamp": ["1960-01-01 00:00:00", "2022-01-01 10:00:00"],
    }[kind]
    df = spark.createDataFrame([(v,) for v in values], "t string").select(F.col("t").cast(kind).alias("v"))
    numbers = [r[0] for r in df.select(layout.as_number(F.col("v"), df.schema["v"].dataType)).collect()]
    assert numbers == sorted(numbers) and len(set(numbers)) == len(values)


def test_layout_of_an_empty_table_and_of_nulls(spark, fact, tmp_path):
    layout.write(fact.limit(0), str(tmp_path / "none"), layout.Layout(files=2))
    bare = fact.withColumn("city", F.lit(None).cast("string"))
    layout.write(bare, str(tmp_path / "bare"), layout.Layout(files=2))
    assert spark.read.schema(fact.schema).parquet(str(tmp_path / "bare")).count() == 1000
    with pytest.raises(ValueError, match="62 bits"):
        layout.write(fact, str(tmp_path / "wide"), layout.Layout(bits=12))


# --- the daily cube


def test_the_cube_kept_by_day_equals_a_rebuild(spark, fact, tmp_path):
    path, days = str(tmp_path / "cube"), cube_store.days_of(fact)
    half = len(days) // 2
    cube_store.put_days(spark, path, fact, days[:half])
    cube_store.put_days(spark, path, fact, days[half:])
    assert rows(cube_store.cube(spark, path)) == rows(report_cube(fact))
    part = fact.where(F.col("order_date").between(days[1], days[3]))
    assert rows(cube_store.cube(spark, path, days[1], days[3])) == rows(report_cube(part))


def test_a_day_can_be_replaced_and_removed(spark, fact, tmp_path):
    path, days = str(tmp_path / "cube"), cube_store.days_of(fact)
    cube_store.put_days(spark, path, fact)
    changed = fact.withColumn("delivery_time_min", F.col("delivery_time_min") + 1)
    cube_store.put_days(spark, path, changed, [days[0]])
    cube_store.drop_days(spark, path, [days[1]])
    is_day = lambda d: F.col("order_date") == F.lit(d)
    expected = changed.where(is_day(days[0])).unionByName(fact.where(~is_day(days[0]) & ~is_day(days[1])))
    assert rows(cube_store.cube(spark, path)) == rows(report_cube(expected))
    cube_store.compact(spark, path)
    assert rows(cube_store.cube(spark, path)) == rows(report_cube(expected))
    cube_store.put_days(spark, path, fact.limit(0), [days[0], date(1999, 1, 1)])
    assert rows(cube_store.cube(spark, path)) == rows(report_cube(fact.where(~is_day(days[0]) & ~is_day(days[1]))))


def test_adding_a_day_reads_that_day_only(spark, fact, tmp_path, plan):
    stored = str(tmp_path / "fact")
    fact.write.partitionBy("order_date").parquet(stored)
    deliveries = spark.read.parquet(stored)
    days = cube_store.days_of(fact)
    own = deliveries.where(F.col("order_date").isin([days[2]]))
    assert "PartitionFilters: [isnotnull(order_date" in plan(own) or "PartitionFilters: [(order_date" in plan(own)
    path = str(tmp_path / "cube")
    cube_store.put_days(spark, path, deliveries, [days[2]])
    assert rows(cube_store.cube(spark, path)) == rows(report_cube(fact.where(F.col("order_date") == F.lit(days[2]))))


def test_a_cube_of_nothing(spark, fact, tmp_path):
    path = str(tmp_path / "cube")
    assert cube_store.put_days(spark, path, fact.limit(0)).number == 0
    assert cube_store.cube(spark, path).count() == 0
    assert cube_store.compact(spark, path).number == 0


def test_of_two_cube_writers_one_is_told(spark, fact, tmp_path, monkeypatch):
    path, days = str(tmp_path / "cube"), cube_store.days_of(fact)
    cube_store.put_days(spark, path, fact, days[:1])
    old = versions.newest(spark, path)
    cube_store.put_days(spark, path, fact, days[1:2])
    with monkeypatch.context() as m:
        m.setattr(versions, "newest", lambda *_: old)
        with pytest.raises(versions.VersionConflict):
            cube_store.put_days(spark, path, fact, days[2:3])
    assert set(versions.newest(spark, path).details["days"]) == {d.isoformat() for d in days[:2]}


# --- figures observed while the table is written


@pytest.mark.parametrize("threshold", [30, 20])
def test_the_report_of_a_run_needs_no_scan(spark, raw, tmp_path, threshold):
    raw_path, fact_path = str(tmp_path / "raw"), str(tmp_path / "fact")
    order_log.write_raw(raw, raw_path)
    config = SlaConfig(threshold=threshold)
    fact = run_cleaning(spark, raw_path, fact_path, config)
    found = cleaning_report(spark, fact_path, config)
    expected = quality.quality_report(order_log.scan_raw(spark, raw_path), fact, config)
    assert found.drop("dropped_rows").first().asDict() == expected.first().asDict()
    assert found.first()["dropped_rows"] == raw.count() - fact.count() == 2
    assert "FileScan" not in found._jdf.queryExecution().executedPlan().toString()
    assert cleaning_report(spark, fact_path, SlaConfig(threshold=44)) is None


def test_the_report_of_an_empty_log(spark, raw, tmp_path):
    raw_path, fact_path = str(tmp_path / "raw"), str(tmp_path / "fact")
    order_log.write_raw(raw.limit(0).coalesce(1), raw_path)
    (tmp_path / "raw" / "head.csv").write_text(",".join(raw.columns) + "\n")
    fact = run_cleaning(spark, raw_path, fact_path)
    found = cleaning_report(spark, fact_path).first().asDict()
    expected = quality.quality_report(order_log.scan_raw(spark, raw_path), fact).first().asDict()
    assert found.pop("dropped_rows") in (0, None)
    assert {k: v or 0 for k, v in found.items()} == {k: v or 0 for k, v in expected.items()}


def test_a_run_can_store_the_table_clustered(spark, raw, tmp_path):
    raw_path, fact_path = str(tmp_path / "raw"), str(tmp_path / "fact")
    order_log.write_raw(raw, raw_path)
    plain = rows(run_cleaning(spark, raw_path, fact_path))
    assert rows(run_cleaning(spark, raw_path, fact_path, layout=layout.Layout(files=3))) == plain
    assert cleaning_report(spark, fact_path).first()["clean_rows"] == 1000


# --- reports that fail


def test_a_report_that_fails_while_it_runs_leaves_the_others(spark, fact):
    pack = query_pack()
    sql = "SELECT city AS k, sum(1) / sum(delivery_time_min - delivery_time_min) AS v FROM {deliveries} GROUP BY city"
    pack["broken"] = PackQuery("A report that divides by zero", ("k",), ("v",), sql)
    found = stored_pack_rows(spark, fact, pack).collect()
    (failed,) = [r for r in found if r["error"]]
    assert failed["query_name"] == "broken" and failed["query_no"] == 11 and failed["value"] is None
    kept = Counter(tuple(r) for r in found if not r["error"])
    assert kept == Counter(map(tuple, pack_rows(spark, fact).collect()))


# --- places


def test_places_without_one_task(spark, plan):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), (F.col("id") % 3).alias("g"))
    found = scope.numbered(df.repartition(5), F.desc("g"), "v")
    expected = sorted(map(tuple, df.select("g", "v").collect()), key=lambda r: (-r[0], r[1]))
    assert [(r["g"], r["v"]) for r in found.orderBy("position").collect()] == expected
    assert [r["position"] for r in found.orderBy("position").collect()] == list(range(1, 1001))
    assert "SinglePartition" not in plan(found)
    assert scope.numbered(df.limit(0), "v").collect() == []
