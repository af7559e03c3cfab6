"""Logs added to a stored table: no row twice, no column read but the digests."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from courierlens.operators.cleaning import clean_orders
from courierlens.plans import append_run
from courierlens.plans.append_run import DIGEST, append_log, appended
from courierlens.sources import versions

BITS = 1 << 17


def rows(df):
    return Counter(map(tuple, df.select(sorted(df.columns)).collect()))


def part(raw, *rests):
    return raw.where(F.pmod(F.xxhash64("ID"), F.lit(4)).isin(*rests))


def test_appended_logs_equal_one_log(spark, raw, tmp_path):
    path = str(tmp_path / "fact")
    for rests in ((0, 1), (1, 2), (0, 1, 2), (3,)):
        append_log(spark, part(raw, *rests), path, bits=BITS)
    assert rows(appended(spark, path)) == rows(clean_orders(raw))
    kept = [spark.read.parquet(f"{path}/{p}/rows").count() for p in versions.newest(spark, path).details["parts"]]
    assert kept[2] == 0 and sum(kept) == 1000


def test_rows_that_differ_in_padding_are_both_kept(spark, raw_row, tmp_path):
    path = str(tmp_path / "fact")
    append_log(spark, raw_row({"ID": "1"}, {"ID": None}), path, bits=BITS)
    append_log(spark, raw_row({"ID": "1 "}, {"ID": "1"}, {"ID": None}, {"ID": "2"}), path, bits=BITS)
    assert sorted(r["order_id"] for r in appended(spark, path).collect()) == ["1", "1", "2", "nan"]


@pytest.mark.parametrize("bits", [1 << 15, 1 << 18])
def test_the_filter_loses_nothing(spark, bits):
    held = spark.range(3000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias(DIGEST))
    others = spark.range(10_000, 13_000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias(DIGEST))
    first, second = held.limit(1500), held.exceptAll(held.limit(1500))
    filters = append_run.bloom(first, bits).unionByName(append_run.bloom(second, bits))
    assert append_run.perhaps_in(held, filters, bits).count() == 3000
    wrong = append_run.perhaps_in(others, filters, bits).count()
    assert wrong < (600 if bits == 1 << 15 else 20)
    assert append_run.perhaps_in(others, filters.limit(0), bits).count() == 0


def test_a_log_without_known_rows_reads_no_digests(spark, raw, tmp_path):
    path = str(tmp_path / "fact")
    append_log(spark, part(raw, 0), path, bits=1 << 22)
    keyed = part(raw, 1).withColumn(DIGEST, append_run.row_digest(raw))
    assert append_run.stored_digests(spark, keyed, path, versions.newest(spark, path)) is None
    keyed = part(raw, 0, 1).withColumn(DIGEST, append_run.row_digest(raw))
    known = append_run.stored_digests(spark, keyed, path, versions.newest(spark, path))
    text = known._jdf.queryExecution().executedPlan().toString()
    assert "order_id" not in text and f"ReadSchema: struct<{DIGEST}:binary>" in text


def test_a_failed_append_changes_nothing(spark, raw, raw_row, tmp_path):
    path = str(tmp_path / "fact")
    append_log(spark, part(raw, 0), path, bits=BITS)
    before = rows(appended(spark, path))
    with pytest.raises(Exception, match="value is missing"):
        append_log(spark, raw_row({"Vehicle_condition": None}), path, bits=BITS)
    assert rows(appended(spark, path)) == before
    assert append_log(spark, raw.limit(0), path, bits=BITS).number == 2
    assert rows(appended(spark, path)) == before


def test_an_empty_table(spark, raw, tmp_path):
    assert appended(spark, str(tmp_path / "none")).count() == 0
    append_log(spark, raw.limit(0), str(tmp_path / "fact"), bits=BITS)
    assert appended(spark, str(tmp_path / "fact")).count() == 0
