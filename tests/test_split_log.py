"""Logs in parts: the rows and errors of Spark's whole-file reader."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import types as T

from courierlens.operators.cleaning import clean_orders
from courierlens.schemas import RAW_SCHEMA
from courierlens.sources import order_log, split_log

NAMES = ["a", "b c", "d"]
SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in NAMES])


@pytest.fixture
def small_parts(spark):
    """Files of more than 300 bytes are shared; a task reads so many at once."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in kept:
        spark.conf.set(k, "300")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def whole(spark, path):
    return spark.read.option("columnPruning", False).csv(
        path, schema=SCHEMA, header=True, enforceSchema=False, mode="FAILFAST", multiLine=True, escape='"'
    )


def scan(spark, path):
    return split_log.scan(spark, path, SCHEMA, escape='"')


def counted(df):
    return Counter(map(tuple, df.collect()))


def field(rng, breaks, size=12):
    text = "".join(rng.choice('ab é,"x1' + breaks) for _ in range(rng.randrange(size)))
    if any(c in text for c in ',"\n\r') or rng.random() < 0.2:
        return '"' + text.replace('"', '""') + '"'
    return text


def log(rng, n, end="\n", breaks="\n", size=12):
    head = ",".join(NAMES) + end
    return head + "".join(",".join(field(rng, breaks, size) for _ in NAMES) + end for _ in range(n))


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("end, breaks", [("\n", "\n"), ("\r\n", "\n"), ("\r\n", "\r\n"), ("\n", ""), ("\r\n", "")])
def test_rows_are_those_of_the_whole_file(spark, tmp_path, small_parts, seed, end, breaks):
    path = tmp_path / "log.csv"
    path.write_bytes(log(random.Random(seed), 300, end, breaks).encode())
    assert counted(scan(spark, str(path))) == counted(whole(spark, str(path)))


def test_records_larger_than_a_block(spark, tmp_path, small_parts):
    rng = random.Random(7)
    text = log(rng, 40, size=900) + '1,"' + "line\n" * 500 + '",2\n' + log(rng, 20)[len(",".join(NAMES)) + 1 :]
    path = tmp_path / "log.csv"
    path.write_text(text + 'no,end,of\n\n"line\n\n",at,end')
    found = scan(spark, str(path))
    assert counted(found) == counted(whole(spark, str(path)))


def test_a_header_with_line_breaks(spark, tmp_path, small_parts):
    names = ["a\nb", "c" * 400, "d\n" * 300]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    path = tmp_path / "log.csv"
    path.write_text(",".join(f'"{n}"' for n in names) + "\n" + 'x,"y\n",z\n' * 100)
    assert counted(split_log.scan(spark, str(path), schema, escape='"')) == {("x", "y\n", "z"): 100}


@pytest.mark.parametrize("odd", ['5" pipe,2,3', 'x,"y" z,3', 'x,"open,3', ' "x\ny",2,3', "x\ry,2,3"])
def test_odd_quotes_and_breaks_are_read_as_before(spark, tmp_path, small_parts, odd):
    rng = random.Random(1)
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "odd [1]%20.csv").write_text(log(rng, 60) + odd + "\n" + "1,2,3\n" * 60)
    (tmp_path / "log" / "even.csv").write_text(log(rng, 60))
    path = str(tmp_path / "log")
    try:
        expected = counted(whole(spark, path))
    except Exception:
        with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
            scan(spark, path).collect()
    else:
        assert counted(scan(spark, path)) == expected


def test_files_of_every_kind_at_once(spark, tmp_path, small_parts):
    import gzip

    rng = random.Random(3)
    folder = tmp_path / "log"
    folder.mkdir()
    (folder / "small.csv").write_text(log(rng, 3))
    (folder / "plain 1.csv").write_text(log(rng, 300, breaks=""))
    (folder / "broken*2.csv").write_text(log(rng, 300))
    (folder / "zipped.csv.gz").write_bytes(gzip.compress(log(rng, 300).encode()))
    (folder / "head.csv").write_text(log(rng, 0))
    (folder / "empty.csv").write_text("")
    assert counted(scan(spark, str(folder))) == counted(whole(spark, str(folder)))


def test_many_tasks_read_one_file(spark, tmp_path, small_parts):
    path = tmp_path / "log.csv"
    path.write_text(log(random.Random(5), 400))
    found = scan(spark, str(path))
    assert len(found.rdd.glom().map(len).filter(lambda n: n > 0).collect()) > 5


@pytest.mark.parametrize("change", [lambda line: line + ",8", lambda line: line.rsplit(",", 1)[0]])
@pytest.mark.parametrize("breaks", ["", "\n"])
def test_lines_of_another_length_fail(spark, tmp_path, small_parts, change, breaks):
    path = tmp_path / "log.csv"
    path.write_text(log(random.Random(2), 100, breaks=breaks) + change("1,2,3") + "\n" + "4,5,6\n" * 50)
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        scan(spark, str(path)).select("a").collect()


@pytest.mark.parametrize("breaks", ["", "\n"])
def test_another_header_fails(spark, tmp_path, small_parts, breaks):
    folder = tmp_path / "log"
    folder.mkdir()
    text = log(random.Random(2), 100, breaks=breaks)
    (folder / "a.csv").write_text(text)
    (folder / "b.csv").write_text(text.replace("a,b c,d", "b c,a,d", 1))
    with pytest.raises(Exception, match="header"):
        scan(spark, str(folder)).select("a").collect()


def test_a_log_with_breaks_is_cleaned_in_parts(spark, raw, tmp_path):
    from pyspark.sql import functions as F

    path = str(tmp_path / "raw")
    city = F.when(F.col("ID").like("%7%"), F.lit('Urban\nEast, "x"')).otherwise(F.col("City"))
    order_log.write_raw(raw.withColumn("City", city).coalesce(1), path)
    once = order_log.scan_raw(spark, path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
        parts = order_log.scan_raw(spark, path)
        assert parts.schema == RAW_SCHEMA
        assert counted(parts) == counted(once) and parts.where("City LIKE '%East%'").count() > 100
        assert counted(clean_orders(parts)) == counted(clean_orders(once))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
