"""CSV in, Parquet out, table names and the build-once guard."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

from courierlens.operators.cleaning import clean_orders
from courierlens.plans.cleaning_run import event_deliveries, event_table_path, run_cleaning
from courierlens.schemas import RAW_SCHEMA
from courierlens.session import build_session
from courierlens.settings import SlaConfig
from courierlens.sources import fact_table, order_log, shared
from tests.conftest import DATA_DIR


def rows(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=str)


def test_csv_round_trip_keeps_padding(spark, raw, tmp_path):
    path = str(tmp_path / "raw")
    order_log.write_raw(raw, path)
    back = order_log.scan_raw(spark, path)
    assert back.count() == raw.count()
    assert back.where("ID like ' O% '").count() == raw.count()
    assert rows(clean_orders(back)) == rows(clean_orders(raw))


def test_scan_matches_columns_by_padded_name(spark, tmp_path):
    names = list(reversed(RAW_SCHEMA.names))
    values = {name: "7" for name in names} | {"City": " Urban ", "Festival": "NA"}
    log = tmp_path / "log.csv"
    log.write_text(
        ",".join(f" {n} " for n in names) + "\n"
        + ",".join(values[n] for n in names) + "\n"
    )
    row = order_log.scan_raw(spark, str(log)).first()
    assert row["City"] == " Urban "
    assert row["Festival"] is None
    assert row["Time_taken (min)"] == 7
    assert row["Restaurant_latitude"] == 7.0


def test_scan_of_a_missing_file_or_column_fails(spark, tmp_path):
    with pytest.raises(AnalysisException):
        order_log.scan_raw(spark, str(tmp_path / "none.csv"))
    (tmp_path / "short.csv").write_text("ID,City\n1,Urban\n")
    with pytest.raises(AnalysisException):
        order_log.scan_raw(spark, str(tmp_path / "short.csv"))


def log_lines(*rows: dict, names=RAW_SCHEMA.names) -> str:
    plain = dict.fromkeys(RAW_SCHEMA.names, "7")
    return "".join(
        ",".join({**plain, **row}[n] for n in names) + "\n" for row in (dict(zip(names, names)), *rows)
    )


def test_line_breaks_inside_quotes_are_read(spark, tmp_path):
    log = tmp_path / "log.csv"
    log.write_text(log_lines({"City": '"Urban\nEast, \"\"x"', "ID": "1"}, {"ID": "2"}))
    rows = order_log.scan_raw(spark, str(log)).select("ID", "City", "Time_taken (min)").collect()
    assert sorted(map(tuple, rows)) == [("1", 'Urban\nEast, "x', 7), ("2", "7", 7)]


@pytest.mark.parametrize("change", [lambda line: line + ",8", lambda line: line.rsplit(",", 1)[0]])
@pytest.mark.parametrize("splittable", [False, True])
def test_lines_of_another_length_fail_the_run(spark, tmp_path, change, splittable):
    lines = log_lines({"ID": "1"}, {"ID": "2"}).splitlines()
    lines[2] = change(lines[2])
    (tmp_path / "log.csv").write_text("\n".join(lines) + "\n")
    log = order_log.scan_raw(spark, str(tmp_path / "log.csv"), splittable=splittable)
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        log.select("ID").collect()


def test_files_of_different_column_order_fail_the_run(spark, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a.csv").write_text(log_lines({"City": "Urban"}))
    (tmp_path / "log" / "b.csv").write_text(
        log_lines({"City": "Urban"}, names=list(reversed(RAW_SCHEMA.names)))
    )
    log = order_log.scan_raw(spark, str(tmp_path / "log"))
    with pytest.raises(Exception, match="header"):
        log.select("City").collect()


def test_sink_replaces_and_makes_folders(spark, fact, tmp_path):
    path = str(tmp_path / "a" / "b" / "fact")
    fact_table.sink_clean(fact, path)
    fact_table.sink_clean(fact.limit(3), path)
    assert fact_table.scan_clean(spark, path).count() == 3


def test_csv_export(spark, fact, tmp_path):
    path = str(tmp_path / "csv")
    fact_table.sink_clean(fact, path, fmt="csv")
    back = fact_table.scan_clean(spark, path, fmt="csv")
    assert back.schema == fact.schema
    assert rows(back) == rows(fact)


def test_registered_table_is_replaced(spark, fact):
    fact_table.register_table(fact.limit(2))
    fact_table.register_table(fact)
    assert spark.sql("SELECT count(*) FROM deliveries").first()[0] == 1000


def test_saved_table(spark, fact, tmp_path):
    saved = fact_table.register_table(
        fact, "saved_deliveries", path=str(tmp_path / "saved")
    )
    assert saved.count() == 1000
    spark.sql("DROP TABLE saved_deliveries")


def builder(fact, calls):
    """Counts its calls; the rows come from the session it is given."""
    files = fact.inputFiles()

    def build(session):
        calls.append(session)
        return fact_table.scan_clean(session, files)

    return build


def test_built_once_unless_refreshed(spark, fact, tmp_path):
    path, calls = str(tmp_path / "fact"), []
    build = builder(fact, calls)

    fact_table.build_if_missing(spark, path, build)
    fact_table.build_if_missing(spark, path, build)
    assert len(calls) == 1
    fact_table.build_if_missing(spark, path, build, refresh=True)
    assert len(calls) == 2


def test_interrupted_build_is_repeated(spark, fact, tmp_path):
    path, calls = str(tmp_path / "fact"), []
    fact_table.sink_clean(fact.limit(3), f"{path}/build-1")  # never noted as complete
    assert fact_table.build_if_missing(spark, path, builder(fact, calls)).count() == 1000
    assert len(calls) == 1


def test_failed_refresh_keeps_the_old_table(spark, fact, tmp_path):
    path = str(tmp_path / "fact")
    old = fact_table.build_if_missing(spark, path, builder(fact, []))

    def broken(session):
        return session.range(5).selectExpr("raise_error('no')")

    with pytest.raises(Exception, match="no"):
        fact_table.build_if_missing(spark, path, broken, refresh=True)
    assert old.count() == 1000
    assert fact_table.build_if_missing(spark, path, broken).count() == 1000


def test_readers_of_an_older_version_go_on(spark, fact, tmp_path):
    path = str(tmp_path / "fact")
    old = fact_table.build_if_missing(spark, path, builder(fact, []))
    few = fact_table.build_if_missing(
        spark, path, lambda s: fact_table.scan_clean(s, fact.inputFiles()).limit(7), refresh=True
    )
    assert (old.count(), few.count()) == (1000, 7)


def test_another_configuration_is_another_table(spark, raw, tmp_path):
    raw_path, fact_path = str(tmp_path / "raw"), str(tmp_path / "fact")
    order_log.write_raw(raw, raw_path)
    late = {}
    for threshold in (30, 10, 30):
        rows = run_cleaning(spark, raw_path, fact_path, SlaConfig(threshold=threshold), refresh=False)
        late.setdefault(threshold, set()).add(rows.where("is_sla_violated = 1").count())
    assert len(late[30]) == 1 and late[10] != late[30]


def test_the_callers_session_stays_as_it_is(spark, raw, tmp_path):
    raw_path, fact_path = str(tmp_path / "raw"), str(tmp_path / "fact")
    order_log.write_raw(raw, raw_path)
    before = {r["key"]: r["value"] for r in spark.sql("SET").collect()}
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        session = build_session(spark, 17)
        assert session.conf.get("spark.sql.shuffle.partitions") == "17"
        assert session.conf.get("spark.sql.ansi.enabled") == "false"
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    run_cleaning(spark, raw_path, fact_path, partitions=3)
    assert {r["key"]: r["value"] for r in spark.sql("SET").collect()} == before


def test_cleaning_run_from_csv(spark, raw, tmp_path):
    raw_path, fact_path = str(tmp_path / "raw"), str(tmp_path / "fact")
    order_log.write_raw(raw, raw_path)
    assert run_cleaning(spark, raw_path, fact_path).count() == 1000
    order_log.write_raw(raw.limit(5).distinct(), raw_path)
    assert run_cleaning(spark, raw_path, fact_path).count() < 1000


def test_shared_folder_comes_from_the_session(spark, fact):
    root = spark.conf.get("spark.checkpoint.dir")
    assert event_table_path(spark, DATA_DIR, "deliveries").startswith(root)
    assert fact.inputFiles()[0].removeprefix("file://").startswith(root)


def test_changed_events_get_a_new_table(spark, tmp_path):
    source = Path(DATA_DIR) / "events.parquet"
    events = spark.read.parquet(str(source))
    target = str(tmp_path / "events.parquet")
    events.write.parquet(target)
    assert event_deliveries(spark, str(tmp_path)).count() == 1000
    events.where("event_id < 10").write.mode("overwrite").parquet(target)
    assert event_deliveries(spark, str(tmp_path), refresh=True).count() == 10


def test_without_a_setting_the_warehouse_holds_the_tables(spark, monkeypatch):
    monkeypatch.setattr(shared, "ROOT_SETTING", "spark.no.such.setting")
    assert shared.shared_root(spark).startswith(spark.conf.get("spark.sql.warehouse.dir"))


def test_queries_leave_one_table_each(spark):
    from courierlens.plans.catalogue import all_queries

    for _ in range(2):
        for name in ("sink_clean", "cache_scope", "scan_raw"):
            all_queries()[name](spark, DATA_DIR).count()
    folder = event_table_path(spark, DATA_DIR, "").removeprefix("file:")
    assert sorted(p.name for p in Path(folder).iterdir()) == ["deliveries", "raw_csv", "sink"]
    spark.catalog.clearCache()


def test_cache_is_released(spark, fact):
    with fact_table.cached(fact.limit(10)) as kept:
        assert kept.is_cached
    assert not kept.is_cached
