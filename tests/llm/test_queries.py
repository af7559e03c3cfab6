"""The registered queries against their DuckDB statements, and the pipeline's stages."""

from __future__ import annotations

import hashlib
import heapq

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from courierlens.llm import decontaminate, language_id, queries
from tests.compare import differences, duck
from tests.conftest import DATA_DIR
from tests.llm.samples import ROWS, clashing, docs, empty
from tests.llm.test_operators import brute_finds, plain_pii, plain_print, plain_secrets

QUERIES = queries.queries()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    assert differences(QUERIES[name](spark, DATA_DIR), duck(DATA_DIR), queries.ORACLE_SQL[name]) == []


def test_there_is_a_query_for_each_operator():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]


def table(spark):
    return spark.read.parquet(f"{DATA_DIR}/documents.parquet")


@pytest.mark.parametrize("name, plain", [("op5_pii", plain_pii), ("op6_secret_scan", plain_secrets)])
def test_span_columns_equal_the_patterns(spark, name, plain):
    texts = {r["doc_id"]: r["text"] for r in table(spark).collect()}
    found = QUERIES[name](spark, DATA_DIR).collect()
    assert len(found) == len(texts)
    for r in found:
        spans = plain(texts[r["doc_id"]] or "")
        joined = ",".join(":".join(map(str, s)) for s in spans)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(r["spans"].split(","))


def test_simhash_query_equals_brute_force(spark):
    prints = {r["doc_id"]: plain_print(r["text"]) for r in table(spark).collect()}
    label = {i: i for i in prints}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(prints)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    found = QUERIES["op1_simhash_near_dedup"](spark, DATA_DIR).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in found} == {
        i: (f"{prints[i]:016x}", find(i)) for i in ids
    }


def test_decontamination_query_equals_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark).collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{DATA_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    found = QUERIES["op9_decontamination"](spark, DATA_DIR).collect()
    assert {(r["doc_id"], i) for r in found for i in map(int, r["item_ids"].split(","))} == brute_finds(rows, items)


def test_sharding_query_is_even(spark):
    found = QUERIES["op10_sharding"](spark, DATA_DIR).toPandas()
    load = found.groupby("shard")["size"].sum()
    single = found.groupby("shard")["text_crc32"].nunique() == 1  # a large group alone
    assert len(load) == 40 and load[~single].max() - load.min() < 0.05 * load.mean()
    assert set(found["law"]) == {"bytes"} and found["grown_shard"].isna().all()


def test_sharding_query_equals_plain_differencing(spark):
    groups = (
        table(spark)
        .select(F.unhex(F.sha2("text", 256)).alias("digest"), (F.octet_length("text") + 16).cast("long").alias("size"))
        .groupBy(F.xxhash64("digest").alias("part"))
        .agg(F.sum("size").alias("bytes"))
    )
    heap = [(-n, i, [n] + [0] * 39) for i, (_, n) in enumerate(sorted(map(tuple, groups.collect())))]
    heapq.heapify(heap)
    made = len(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        joined = sorted((x + y for x, y in zip(a, reversed(b))), reverse=True)
        heapq.heappush(heap, (joined[-1] - joined[0], made, joined))
        made += 1
    found = QUERIES["op10_sharding"](spark, DATA_DIR).groupBy("shard").agg(F.sum("size").alias("n")).collect()
    assert sorted((r["n"] for r in found), reverse=True) == heap[0][2]


# --- the pipeline


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows after each stage, over the smallest tables."""
    docs, out = table(spark), {"documents": table(spark)}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, DATA_DIR).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_keep_the_columns_of_documents(stages):
    for name in list(stages)[:-1]:
        assert stages[name].columns == stages["documents"].columns


def test_language_stage_keeps_texts_with_a_language(stages):
    known = {
        r["doc_id"]
        for r in language_id.identify(stages["documents"]).collect()
        if r["lang_pred"] != "und" and r["score"] >= corpus_pipeline.LEAST_SCORE
    }
    assert set(ids(stages["language_id"])) == known


def test_dedup_stage_keeps_the_least_of_each_group(stages):
    rows = {r["doc_id"]: plain_print(r["text"]) for r in stages["language_id"].collect()}
    kept = ids(stages["simhash_near_dedup"])
    order, label = sorted(rows), {i: i for i in rows}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for n, i in enumerate(order):
        for j in order[:n]:
            if (rows[i] ^ rows[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    assert kept == sorted({find(i) for i in order})


def test_decontamination_stage_drops_what_holds_an_item(spark, stages):
    rows = [(r["doc_id"], r["text"]) for r in stages["simhash_near_dedup"].collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{DATA_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    leaks = {doc for doc, _ in brute_finds(rows, items)}
    assert ids(stages["benchmark_decontamination"]) == sorted({doc for doc, _ in rows} - leaks)


def test_last_stages_mix_and_place_every_row(stages):
    mixed, last = stages["source_mixing"], stages["sharding"]
    assert set(ids(mixed)) <= set(ids(stages["benchmark_decontamination"]))
    assert ids(mixed) == ids(last)
    assert {r["shard"] for r in last.collect()} <= set(range(40))


def test_run_equals_the_stages(spark, stages):
    found = corpus_pipeline.run(spark, DATA_DIR)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, stages["sharding"].collect()))


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_bear_awkward_and_empty_tables(spark, name, stage):
    found = stage(spark, clashing(spark), DATA_DIR)
    assert found.count() <= 2 * len(ROWS)
    if name != "sharding":
        assert found.columns == clashing(spark).columns
    assert stage(spark, empty(spark), DATA_DIR).count() == 0


def test_dedup_stage_keeps_one_of_repeated_and_unnamed_rows(spark):
    found = corpus_pipeline.one_of_near_duplicates(spark, docs(spark), DATA_DIR).collect()
    assert sorted(r["doc_id"] for r in found) == [1, 3, 6, 7, 8, 9]
    unnamed = docs(spark, [(None, "same words here again", None, None, None)] * 3)
    assert corpus_pipeline.one_of_near_duplicates(spark, unnamed, DATA_DIR).count() == 1


def test_items_are_words_in_lower_case():
    assert decontaminate.words("The CAT_sat, 2 é!") == ["the", "cat", "sat", "2", "é"]
