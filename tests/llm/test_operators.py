"""Each operator on awkward rows, empty tables and clashing columns, and against brute force."""

from __future__ import annotations

import gzip
import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from courierlens.llm import (
    components,
    decontaminate,
    exact_dedup,
    language_id,
    masked_lm,
    mixing,
    pii,
    secret_scan,
    sharding,
    simhash,
    warc,
)
from courierlens.llm.common import scratch_path
from tests.conftest import DATA_DIR
from tests.llm.samples import ROWS, clashing, docs, empty


def tuples(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- 1 SimHash


def plain_print(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [r[1] for r in ROWS if r[0] != 6] + ["A B c", "É A b c d", "a  b\x0bc\x1cd e"])
def test_fingerprint_is_the_bitwise_majority(text):
    assert simhash.fingerprint(text) & (2**64 - 1) == plain_print(text)


def brute_labels(keys, budget, lead):
    label = list(range(len(keys)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(keys)):
        for j in range(i + 1, len(keys)):
            differing = keys[i] ^ keys[j]
            if differing >> (64 - lead) == 0 and differing.bit_count() <= budget:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(keys))]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.sampled_from([0, 1, 2, 3]), st.integers(2, 150))
def test_trie_join_links_what_brute_force_links(seed, budget, n):
    draw = random.Random(seed)
    centres = [draw.getrandbits(64) for _ in range(3)]
    keys = set()
    for _ in range(n):
        key = draw.choice(centres)
        for _ in range(draw.randint(0, 6)):
            key ^= 1 << draw.randint(0, 63)
        keys.add(key)
    keys = sorted(keys)
    found = simhash.trie_labels(np.array(keys, dtype=np.uint64), budget, 16)
    assert found.tolist() == brute_labels(keys, budget, 16)


def test_near_groups_join_prints_within_three_bits(spark):
    draw = random.Random(5)
    centres = [draw.getrandbits(64) for _ in range(12)]
    prints = set()
    for _ in range(600):
        key = draw.choice(centres)
        for _ in range(draw.randint(0, 5)):
            key ^= 1 << draw.randint(0, 63)
        prints.add(key)
    prints = sorted(prints)
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    found = simhash.near_components(spark.createDataFrame([(s,) for s in signed], "print long"))
    groups = defaultdict(set)
    for row in found.collect():
        groups[row["root"]].add(row["print"] & (2**64 - 1))
    label, expected = list(range(len(prints))), defaultdict(set)

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                label[find(i)] = find(j)
    for i, p in enumerate(prints):
        expected[find(i)].add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7)]
    found = dict(map(tuple, components.components(spark.createDataFrame(path, "u long, v long")).collect()))
    assert found == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}


@pytest.mark.parametrize("batch", [15, 200_000])
def test_components_of_shuffled_chains_and_hubs(spark, monkeypatch, batch):
    monkeypatch.setattr(components, "BATCH", batch)  # few links a task: many rounds
    draw = random.Random(8)
    name = [n - 2000 for n in draw.sample(range(4000), 700)]
    edges = [(i, i + 1) for i in range(299)] + [(300, i) for i in range(301, 500)] + [(i, 699) for i in range(500, 699)]
    links = [draw.sample([name[a], name[b]], 2) for a, b in draw.sample(edges + edges[::9], len(edges + edges[::9]))]
    links += [(name[0], name[0]), (9999, 9999)]
    found = components.components(spark.createDataFrame(links, "u long, v long").repartition(9))
    parts = [name[:300], name[300:500], name[500:]]
    assert tuples(found) == sorted(((n, min(part)) for part in parts for n in part), key=repr)
    rooted = defaultdict(set)
    for node, root in components.rooted(spark.createDataFrame(links, "u long, v long").repartition(9)).collect():
        rooted[root].add(node)
    assert sorted(sorted(nodes | {root}) for root, nodes in rooted.items()) == sorted(map(sorted, parts))


def test_near_groups_take_few_tasks_over_many_partitions(spark):
    draw, rows = random.Random(3), set()
    for _ in range(40):
        key = draw.getrandbits(64)
        for _ in range(30):
            key ^= 1 << draw.randrange(64) | 1 << draw.randrange(64)
            rows.add(key - 2**64 if key >= 2**63 else key)
    prints = spark.createDataFrame(list(enumerate(rows)), "doc_id long, print long")
    settings = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("near-groups", "near groups")
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = simhash.named_groups(prints).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = {s for job in tracker.getJobIdsForGroup("near-groups") for s in tracker.getJobInfo(job).stageIds}
    tasks = sum(info.numCompletedTasks for s in stages if (info := tracker.getStageInfo(s)))
    assert len(found) == len(rows) and len({r["component_id"] for r in found}) == 40
    assert 0 < tasks < 30 * 60


def test_near_groups_on_awkward_rows(spark):
    found = simhash.near_groups(clashing(spark)).collect()
    by_id = defaultdict(list)
    for row in found:
        by_id[row["doc_id"]].append(row)
    assert len(found) == len(ROWS)
    assert {r["component_id"] for i in (1, 2) for r in by_id[i]} == {1}
    assert {r["component_id"] for i in (3, 4, 5) for r in by_id[i]} == {3}
    assert all(r["print"] == 0 for i in (3, 4, 5) for r in by_id[i])
    assert by_id[None][0]["component_id"] == 7
    assert simhash.near_groups(empty(spark)).collect() == []


# --- 2 masked language model


def test_scores_prefer_texts_in_their_order(spark):
    base = spark.read.parquet(f"{DATA_DIR}/documents.parquet").where("lang = 'en'").select("doc_id", "text").toPandas()
    draw = random.Random(3)
    base = base[base.text.str.split().str.len() > 150]
    line = "this one and that one went to the river again and came back home before it was dark "
    rows = [(int(i), f"{line * 30}{t}") for i, t in zip(base.doc_id, base.text, strict=True)]
    mixed = [(i + 10**6, " ".join(draw.sample(t.split(), len(t.split())))) for i, t in rows[:20]]
    trained = spark.createDataFrame(rows, "doc_id long, text string")
    known = masked_lm.vocabulary(trained)
    net = masked_lm.train(trained, known)
    score = masked_lm.scorer(net.flat, known)
    both = spark.createDataFrame(rows[:20] + mixed, "doc_id long, text string").select("doc_id", score("text").alias("s"))
    found = {r[0]: r[1]["log_prob"] / r[1]["n_tokens"] for r in both.collect()}
    assert sum(found[i] > found[i + 10**6] for i, _ in rows[:20]) == 20


def test_probabilities_of_all_words_add_up_to_one():
    net = masked_lm.Network(classes=4, width=3)
    ids = np.array([16, 16, 1, 5, 7, 16, 16])
    total = 0.0
    for word in range(16):
        ids[3] = word
        total += float(np.exp(net.step(ids, np.array([3]))[0]))
    assert total == pytest.approx(1, abs=1e-4)


def test_training_step_follows_the_gradient():
    net = masked_lm.Network(classes=3, width=2)
    net.flat = net.flat.astype(np.float64)
    net.part = net.parts(net.flat, net.shapes, net.sizes)
    ids, at = np.array([9, 9, 1, 5, 7, 2, 9, 9]), np.array([2, 3, 4, 5])
    before, squares = net.flat.copy(), np.full(len(net.flat), 1.0)
    net.step(ids, at, squares, rate=1.0)
    moved = (before - net.flat) * (np.sqrt(squares) + 1e-6)
    for place in range(0, len(before), 3):
        sides = []
        for shift in (1e-5, -1e-5):
            net.flat[:] = before
            net.flat[place] += shift
            sides.append(-net.step(ids, at).mean())
        assert moved[place] == pytest.approx((sides[0] - sides[1]) / 2e-5, abs=1e-6)


def test_a_step_takes_its_large_arrays_from_the_step_before():
    net, draw = masked_lm.Network(), np.random.default_rng(2)
    ids, at = draw.integers(0, net.classes**2, masked_lm.BATCH + 4), np.arange(2, masked_lm.BATCH + 2)
    squares = np.full(len(net.flat), 1e-6, np.float32)
    net.step(ids, at, squares)
    tracemalloc.start()
    net.step(ids, at, squares)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    scores = len(at) * net.classes * net.flat.itemsize
    assert peak < 3 * scores  # above 4 with fresh arrays


def test_steps_of_any_size_leave_nothing_to_the_next():
    draw = np.random.default_rng(5)
    ids = draw.integers(0, 16, 500) ** 2 // 15  # uneven classes
    ids[:2] = ids[-2:] = 16
    one = masked_lm.Network(classes=4, width=3)
    flat, squares = one.flat.copy(), [np.full(len(one.flat), 1e-6, np.float32) for _ in range(2)]
    for size in (300, 7, 496, 1, 120):
        at = 2 + draw.permutation(496)[:size]
        fresh = masked_lm.Network(classes=4, width=3, flat=flat)
        assert np.array_equal(one.step(ids, at), fresh.step(ids, at))
        fresh = masked_lm.Network(classes=4, width=3, flat=flat)
        assert np.array_equal(one.step(ids, at, squares[0]), fresh.step(ids, at, squares[1]))
        assert np.array_equal(one.flat, flat) and np.array_equal(*squares)


def test_scores_on_awkward_rows(spark):
    found = masked_lm.score(clashing(spark)).collect()
    by_id = {r["doc_id"]: r for r in found}
    assert len(found) == len(ROWS)
    assert all(by_id[i]["n_tokens"] == 0 and by_id[i]["mean_log_prob"] is None for i in (3, 4, 5))
    assert by_id[6]["n_tokens"] == 40_001 and by_id[6]["log_prob"] < 0
    assert masked_lm.score(empty(spark)).collect() == []
    assert tuples(masked_lm.score(docs(spark))) == tuples(masked_lm.score(docs(spark)))


@pytest.mark.parametrize("held", [50_000, 900])
def test_words_of_a_shared_number_have_their_own_probabilities(spark, monkeypatch, held):
    monkeypatch.setattr(masked_lm, "HELD", held)
    names = [f"w{i}" for i in range(2000)]
    rows = [(i, w) for i, w in enumerate(names) for _ in range(2 if i % 2 else 1)]
    found = {r["doc_id"]: r["log_prob"] for r in masked_lm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    known = masked_lm.vocabulary(spark.createDataFrame(rows, "doc_id long, text string"))
    shared = defaultdict(list)
    for i, w in enumerate(names):
        if (number := known.ids([w.encode()])[0]) >= known.own:
            shared[number].append(i)
    pairs = [(i, j) for same in shared.values() for i in same for j in same if i % 2 and not j % 2]
    assert len(pairs) > 100
    assert all(found[i] - found[j] == pytest.approx(np.log(2), abs=2e-4) for i, j in pairs)
    assert 0.97 < np.exp(list(found.values())).sum() < 1.001


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(masked_lm, "SHARD_WORDS", 5000)
    base = spark.read.parquet(f"{DATA_DIR}/documents.parquet").where("doc_id < 60")
    found = [tuples(masked_lm.score(base.repartition(n))) for n in (1, 4, 16)]
    assert found[0] == found[1] == found[2]


@pytest.mark.parametrize("block", [10**6, 1000, 4096])
def test_copies_are_averaged_by_their_words(spark, monkeypatch, block):
    monkeypatch.setattr(masked_lm, "BLOCK", block)
    monkeypatch.setattr(masked_lm, "SHARD_WORDS", 5000)
    base = spark.read.parquet(f"{DATA_DIR}/documents.parquet").where("doc_id < 40")
    known = masked_lm.vocabulary(base)
    rows = masked_lm.numbered(base, known).where("octet_length(ids) > 0")
    shards = sum(len(r["ids"]) for r in rows.collect()) // (5000 * known.kind.itemsize)
    dealt = rows.selectExpr("ids", "xxhash64(ids, doc_id) AS hash").selectExpr("*", f"pmod(hash, {shards}) AS shard")
    by_shard = defaultdict(list)
    for r in dealt.orderBy("hash", "ids").collect():
        by_shard[r["shard"]].append(np.frombuffer(r["ids"], known.kind))
    total, words = 0, 0
    for texts in by_shard.values():
        net = masked_lm.Network(known.classes)
        squares = np.full(len(net.flat), 1e-6, np.float32)
        for ids, at, _ in masked_lm._streams(texts, known.size, net.side):
            for i in range(0, len(at), masked_lm.BATCH):
                net.step(ids, at[i : i + masked_lm.BATCH], squares)
        n = sum(map(len, texts))
        total, words = total + net.flat.astype(np.float64) * n, words + n
    assert len(by_shard) > 1
    found = masked_lm.fitted(masked_lm.numbered(base, known), known, rounds=1)
    assert np.abs(found.flat - total / words).max() < 1e-6


def test_rows_to_be_averaged_are_blocks():
    net = masked_lm.Network(classes=4, width=16)
    train = masked_lm._training(net.flat, 4, np.dtype(np.uint16), 0.15)
    ids = pa.array([np.arange(12, dtype=np.uint16).tobytes()] * 3, pa.binary())
    batches = list(train(iter([pa.RecordBatch.from_arrays([pa.array([0, 0, 7]), ids], ["shard", "ids"])])))
    assert [b.num_rows for b in batches] == [math.ceil(len(net.flat) / masked_lm.BLOCK)] * 2
    assert [b["seen"].to_pylist()[0] for b in batches] == [24, 12]


def plain_score(net, known, tokens):
    """Sum of log-probabilities, word by word, from the network's parts."""
    ids, total = [net.classes**2] * net.side + list(known.ids(tokens)) + [net.classes**2] * net.side, 0.0
    p = {k: v.astype(np.float64) for k, v in net.part.items()}
    for i in range(net.side, len(ids) - net.side):
        seen = [ids[i + d] for d in range(-net.side, net.side + 1) if d]
        h = np.tanh(sum(p["seen"][k][w] for k, w in enumerate(seen)) + p["bias"])
        k, m = divmod(ids[i], net.classes)
        group, member = h @ p["group"] + p["group_bias"], h @ p["member"][k] + p["member_bias"][k]
        total += group[k] - np.log(np.exp(group).sum()) + member[m] - np.log(np.exp(member).sum())
    return total


def test_scores_equal_a_plain_computation(spark):
    base = spark.read.parquet(f"{DATA_DIR}/documents.parquet").where("doc_id < 30").select("doc_id", "text")
    counts = masked_lm.counted(base)
    known, rest = masked_lm.known_words(counts)
    net = masked_lm.train(base, known)
    count = {bytes(r["word"]): r["n"] for r in counts.collect()}
    assert count == Counter(w for r in base.collect() for w in masked_lm.words(r["text"]))
    shared = Counter()
    own = set(sorted(count, key=lambda w: (-count[w], w))[: known.own])
    number = {w: int(known.ids([w])[0]) for w in count}
    for w, n in count.items():
        shared[number[w]] += n if w not in own else 0
    found = {r["doc_id"]: r["log_prob"] for r in masked_lm.score(base).collect()}
    # the query deals rows by doc_id, train() by text: train on what the query trains on
    net = masked_lm.fitted(masked_lm.numbered(base, known), known)
    for r in base.collect():
        tokens = masked_lm.words(r["text"])
        parted = sum(np.log(count[w] / shared[number[w]]) for w in tokens if w not in own)
        assert found[r["doc_id"]] == pytest.approx(plain_score(net, known, tokens) + parted, rel=1e-4, abs=1e-2)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aBÉé \t\n\x0b\x0c\r\x1c\x85 x", max_size=12)), max_size=8))
def test_words_in_bulk_are_the_words(texts):
    different, places, sizes = masked_lm.coded(pa.array(texts, pa.string()))
    flat = [different[int(i)].as_py() for i in places]
    ends = np.r_[0, np.cumsum(sizes)]
    assert [flat[a:b] for a, b in zip(ends, ends[1:])] == [masked_lm.words(t) for t in texts]


def test_the_network_grows_with_the_distinct_words(spark, monkeypatch):
    monkeypatch.setattr(masked_lm, "CLASSES", 2)
    sizes = []
    for n in (10, 100, 2000):
        rows = [(i, f"w{i}") for i in range(n)]
        sizes.append(masked_lm.vocabulary(spark.createDataFrame(rows, "doc_id long, text string")).size)
    assert sizes == [4, 16, 49]


# --- 3 exact dedup


def brute_groups(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return [
        (r[0], best[r[1] or ""], len(groups[r[1] or ""]), r[0] == best[r[1] or ""], hashlib.sha256((r[1] or "").encode()).hexdigest())
        for r in rows
    ]


def test_exact_groups_on_awkward_rows(spark):
    assert tuples(exact_dedup.exact_groups(clashing(spark))) == sorted(brute_groups(ROWS), key=repr)
    assert exact_dedup.exact_groups(empty(spark)).collect() == []


def test_texts_of_one_digest_are_told_apart(spark):
    rows = [(i, f"t{i % 7}{'x' * (i % 2)}", None, None, None) for i in range(200)] + [(None, None, None, None, None)]
    found = exact_dedup.exact_groups(docs(spark, rows), digest=lambda text: F.length(text).cast("string"))
    assert tuples(found.drop("digest")) == sorted((r[:4] for r in brute_groups(rows)), key=repr)


def test_copies_of_a_task_are_one_row_before_the_shuffle(spark):
    text = F.concat(F.lit("t"), F.when(F.col("id") < 20_000, F.lit(0)).otherwise(F.col("id")).cast("string"))
    rows = spark.range(0, 20_300, numPartitions=2).select(F.col("id").alias("doc_id"), text.alias("text"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        merged = exact_dedup.salted_groups(rows.withColumn("digest", exact_dedup.sha256(F.col("text"))))
        assert len(merged.collect()) == 302  # a row for each task, and 300 others
        node = merged._jdf.queryExecution().executedPlan()
        while node.nodeName() != "Exchange":
            node = node.children().apply(0)
        assert node.metrics().apply("shuffleRecordsWritten").value() == 302
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


# --- 4 mixing


def test_targets_fill_by_weight_below_the_ceiling(spark):
    sizes = [("a", 100), ("b", 10), ("c", 1000), ("d", 0), ("e", 50), (None, 7)]
    found = {r["source"]: r for r in mixing.targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    weight = dict(zip(["a", "b", "c", "d", "e", None], [5, 2, 1, 5, 2, 1], strict=True))
    left, total, aims = set(weight), 1.5 * sum(n for _, n in sizes), {}
    size = dict(sizes)
    while True:
        level = total / sum(weight[s] for s in left)
        over = {s for s in left if weight[s] * level > 2 * size[s]}
        if not over:
            break
        for s in over:
            aims[s] = 2.0 * size[s]
            total -= aims[s]
        left -= over
    aims |= {s: weight[s] * level for s in left}
    assert {s: r["target"] for s, r in found.items()} == pytest.approx(aims)
    assert sum(aims.values()) == pytest.approx(1.5 * sum(size.values()))


def test_mix_emits_the_planned_copies(spark):
    table = clashing(spark, ROWS * 3)
    planned, names = mixing.plan(table)
    want = sum(r[0] for r in planned.select(names["copies"]).collect())
    mixed = mixing.mix(table)
    assert mixed.columns == table.columns and mixed.count() == want
    assert mixing.mix(empty(spark)).collect() == []
    assert all(0 <= r[0] <= 2 for r in planned.select(names["copies"]).collect())


def test_mix_comes_near_its_targets_and_repeats(spark):
    rows = [(i, "w " * (1 + i % 9), "en", "src" + str(i % 5 if i % 3 else 0), 1) for i in range(4000)]
    planned, names = mixing.plan(docs(spark, rows))
    taken = planned.groupBy("source").agg(
        F.sum(F.col(names["size"]) * F.col(names["copies"])).alias("taken"), F.first(names["target"]).alias("target")
    )
    assert all(abs(r["taken"] - r["target"]) < 0.1 * r["target"] for r in taken.collect())
    again, more = mixing.plan(docs(spark, rows))
    assert tuples(planned.select("doc_id", names["copies"])) == tuples(again.select("doc_id", more["copies"]))


def test_mix_joins_by_shuffle_beyond_the_broadcast_bound(spark, monkeypatch):
    want = tuples(mixing.mix(docs(spark)))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 1)
    assert tuples(mixing.mix(docs(spark))) == want


# --- 5 personal data

PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def plain_pii(text):
    out = []
    for kind, pattern in PII:
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card":
                total = 0
                for i, c in enumerate(reversed(digits)):
                    n = int(c) * (2 if i % 2 else 1)
                    total += n if n < 10 else n - 9
                if not 13 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


ANCHORS = pii.automaton()


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1 2.-+@()9é٣0\n", max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert [s for s in pii.spans(text, ANCHORS) if s[0] in pii.BASE] == plain_pii(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([
    "4929 3483-85146306", "4845168114407329", "1.2.3.4.5.6.7.8", "256.1.1.1", "+1 (017) 555-7713", "a@b@c.com",
    "x@y.com@z.org", ".", " ", "+", "1", "-", "@", "q", "ü", "+49 ", "00000000000000",
]), max_size=8))
def test_base_spans_equal_the_patterns_on_near_misses(parts):
    text = "".join(parts)
    assert [s for s in pii.spans(text, ANCHORS) if s[0] in pii.BASE] == plain_pii(text)


@pytest.mark.parametrize(
    "text, kind, passage",
    [
        ("see https://bob:pw1@host.example/x", "login", "https://bob:pw1@host.example"),
        ("Account no: 12-3456-789 is", "account", "12-3456-789"),
        ("IBAN DE89 3704 0044 0532 0130 00.", "account", "DE89 3704 0044 0532 0130 00"),
    ],
)
def test_cues_add_spans(text, kind, passage):
    (span,) = [s for s in pii.spans(text, ANCHORS) if s[0] == kind]
    assert text[span[1] : span[2]] == passage


@pytest.mark.parametrize("text", ["IBAN DE00 3704 0044 0532 0130 00", "an account of 12 days", "accounts 1234567", "http://host/a@b"])
def test_cues_without_a_number_add_nothing(text):
    assert [s for s in pii.spans(text, ANCHORS) if s[0] in pii.ADDED] == []


@pytest.mark.parametrize(
    "text, passage",
    [
        ("Social Security Number: 123-45-6789", "123-45-6789"),
        ("İ é sOcIaL security no. 123 45 6789 12 items", "123 45 6789"),
        ("IBAN DE89 3704 0044 0532 0130 00 2024 paid", "DE89 3704 0044 0532 0130 00"),
        ("Iban: GB82 WEST 1234 5698 7654 32 on 5 May", "GB82 WEST 1234 5698 7654 32"),
        ("iban gb82west12345698765432 2024", "gb82west12345698765432"),
        ("account 12345678 12 items", "12345678"),
        ("SSN 123-45-6789 12 items", "123-45-6789"),
        ("account 20-00-00 55779911 today", "20-00-00 55779911"),
        ("Account Number 1234 5678 9012 is", "1234 5678 9012"),
        ("account: 1234 5678 9012 3456 2024 12 31", "1234 5678 9012 3456"),
        ("account 12345678 23456789 34567890 45678901 56789012", "12345678 23456789 34567890 45678901"),
        ("account 1234 5678 9012 3456 7890 1234 5678 9012 3456 x", "1234 5678 9012 3456 7890 1234 5678 9012"),
        ("acct 123-45 2024-12-31", "123-45"),
    ],
)
def test_identifiers_end_where_they_end(text, passage):
    (span,) = [s for s in pii.spans(text, ANCHORS) if s[0] == "account"]
    assert text[span[1] : span[2]] == passage


@pytest.mark.parametrize(
    "text",
    ["account " + "12345 " * 170_000, "account " + "1" * 1_000_000, "account 1 " * 100_000, "iban DE89 " * 100_000,
     "1.2.3." * 170_000, "a@b." * 250_000, "+1 " * 330_000, "x://a:b" * 140_000, "1234 " * 200_000, "ssn no 1-" * 110_000],
)
def test_long_lists_take_time_in_proportion(text):
    import time

    began = time.process_time()
    pii.spans(text, ANCHORS)
    assert time.process_time() - began < 10


def test_pii_on_awkward_rows(spark):
    rows = [*ROWS, (20, "mail é a.b@c.de now " + "x " * 50_000 + "1.2.3.4", None, None, None)]
    found = {r["doc_id"]: r["spans"] for r in pii.find(clashing(spark, rows)).collect()}
    assert [tuple(s) for s in found[20]] == [("email", 7, 15), ("ip", 100_020, 100_027)]
    assert found[4] == found[3] == []
    assert pii.find(empty(spark)).collect() == []


# --- 6 secrets


def plain_secrets(text):
    out = []
    fold = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    pattern = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([a-z0-9+/_.=-]+)"
    out += [(m.start(), 0, m.end()) for m in re.finditer(pattern, fold) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(secret_scan.KINDS[k], s, e) for s, k, e in sorted(out)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([
    "password", "PassWD", "toKen", "api_key", "APIKEY", "ſecret", "secret", ": ", "=", "'", '"', "abc", "abcdefgh1",
    "AKIA", "ABCDEFGH12", "AKIAAKIAAKIA1234", "0123456789abcdef", "deadbeef", "ffffffff", " ", "é", "\n", ".",
]), max_size=9))
def test_base_secrets_equal_the_patterns(parts):
    text = "".join(parts)
    zero = np.zeros((secret_scan._START + 1, secret_scan._START))
    assert [s for s in secret_scan.spans(text, zero, 1.0) if s[0] != "markov"] == plain_secrets(text)


@pytest.fixture(scope="module")
def ratio(spark):
    return secret_scan.train(spark.read.parquet(f"{DATA_DIR}/documents.parquet"))


def test_models_tell_random_strings_from_words(ratio, spark):
    fresh = secret_scan.generated(400, seed=99)
    caught = sum(any(k == "markov" or k == "hex" for k, _, _ in secret_scan.spans(f"x {s} y", ratio)) for s in fresh)
    assert caught >= 0.9 * len(fresh)
    texts = [r[0] for r in spark.read.parquet(f"{DATA_DIR}/documents.parquet").select("text").collect()]
    added = sum(k == "markov" for t in texts for k, _, _ in secret_scan.spans(t, ratio))
    assert added == 0


@pytest.mark.parametrize("text", [
    "com/example/project/ServiceFactoryBean", "https-example-com-products-category", "MAX_CONNECTION_POOL_SIZE",
    "/api/customers/account/settings/profile/", "123e4567-e89b-12d3-a456-426614174000", "/usr/local/share/documents/readme",
    "getApplicationContextProvider", "src/main/java/org/example/MainWindow",
])
def test_ordinary_identifiers_are_no_secrets(ratio, text):
    assert secret_scan.spans(f"see {text} now", ratio) == []


def test_models_on_samples_that_they_were_not_trained_on(ratio):
    held = [s for s in secret_scan.ordinary(3000, seed=5) if len(s) >= 16]
    wrong = [s for s in held if secret_scan.spans(s, ratio)]
    assert len(wrong) <= 0.001 * len(held), wrong[:5]
    fresh = [s for s in secret_scan.generated(600, seed=5)]
    assert sum(bool(secret_scan.spans(s, ratio)) for s in fresh) >= 0.99 * len(fresh)


def test_secrets_on_awkward_rows(spark):
    rows = [*ROWS, (20, 'é token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" ' + "y " * 50_000, None, None, None)]
    found = {r["doc_id"]: r["spans"] for r in secret_scan.find(clashing(spark, rows)).collect()}
    assert [tuple(s) for s in found[20]] == [("assign", 2, 51), ("hex", 11, 51)]
    assert found[4] == found[3] == found[6] == []
    assert secret_scan.find(empty(spark)).collect() == []


def test_redaction_replaces_each_span_once(spark):
    text = 'é token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" end'
    found = secret_scan.find(docs(spark, [(1, text, None, None, None), (2, "none", None, None, None)])).join(
        docs(spark, [(1, text, None, None, None), (2, "none", None, None, None)]).select("doc_id", "text"), "doc_id"
    )
    out = {r[0]: r[1] for r in found.select("doc_id", secret_scan.redacted(F.col("spans"), F.col("text"))).collect()}
    assert out == {1: 'é [secret]" end', 2: "none"}


# --- 7 language


def plain_grams(text):
    out = Counter()
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        word = f" {word} "
        for n in (1, 2, 3):
            out.update(word[i : i + n] for i in range(len(word) - n + 1))
    return Counter({g: n for g, n in out.items() if g != " "})


@pytest.mark.parametrize("text", ["Ab abc! a_b 1x", "ÄÖ ö", "", "日本 語", "the the"])
def test_ngrams_equal_a_plain_count(text):
    _, gram, count = language_id.ngrams([text])
    found = Counter()
    for g, n in zip(gram.tolist(), count.tolist(), strict=True):
        found["".join(chr(p) for p in (g >> 42, g >> 21 & 0x1FFFFF, g & 0x1FFFFF) if p)] += n
    assert found == plain_grams(text)


def test_prediction_equals_plain_out_of_place_distance(spark):
    table = spark.read.parquet(f"{DATA_DIR}/documents.parquet")
    rows = table.collect()
    held = lambda r: zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2
    counts = defaultdict(Counter)
    for r in rows:
        if not held(r):
            counts[r["lang"]].update(plain_grams(r["text"]))
    key = lambda x: (-x[1], [ord(c) for c in x[0]] + [0] * (3 - len(x[0])))
    ranks = {lang: {g: i for i, (g, _) in enumerate(sorted(c.items(), key=key)[:300])} for lang, c in counts.items()}
    found = {r["doc_id"]: r for r in language_id.identify(table).collect()}
    right = 0
    for r in rows:
        top = [g for g, _ in sorted(plain_grams(r["text"]).items(), key=key)[:300]]
        away = {lang: sum(abs(p.get(g, 300) - i) for i, g in enumerate(top)) for lang, p in ranks.items()}
        best = min(sorted(away), key=away.get)
        got = found[r["doc_id"]]
        assert (got["lang_pred"], got["held_out"]) == (best, held(r))
        assert got["score"] == pytest.approx(1 - away[best] / (300 * len(top)))
        right += held(r) and best == r["lang"]
    assert right >= 0.97 * sum(map(held, rows))


def test_language_on_awkward_rows(spark):
    found = language_id.identify(clashing(spark)).collect()
    by_id = {r["doc_id"]: r for r in found}
    assert len(found) == len(ROWS)
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (3, 4, 5, 8))
    assert by_id[7]["lang_pred"] == "de" and by_id[1]["lang_pred"] == "en"
    assert language_id.identify(empty(spark)).collect() == []
    nothing = language_id.identify(docs(spark, [(1, "some text", None, None, None)])).collect()
    assert nothing[0]["lang_pred"] == "und"


def test_languages_are_compared_in_turns(spark):
    draw = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for k in range(40):
        own = "".join(draw.sample(letters, 6))
        for i in range(4):
            words = ["".join(draw.choice(own) for _ in range(draw.randrange(2, 7))) for _ in range(40)]
            rows.append((4 * k + i, " ".join(words), f"l{k:02d}", None, None))
    table = docs(spark, rows + ROWS)
    whole = tuples(language_id.identify(table))
    assert tuples(language_id.identify(table, most=7)) == whole
    assert len({r[2] for r in whole}) > 30


def test_many_scripts_in_one_block():
    texts = ["".join(chr(c) for c in range(start, start + 300)) for start in range(0x4E00, 0x9000, 300)] * 3
    parts = list(language_id._in_parts(texts))
    assert sum(len(np.unique(p[0])) for p in parts) == len(texts)


# --- 8 WARC

PAGES = "page_id long, url string, html string"


def test_round_trip_on_awkward_rows(spark):
    big = "<p>" + "ü" * 600 + "</p>"
    rows = [(1, "http://a", big), (5, None, big), (3, "http://c\r\n", big), (4, "u", "small"), (6, "u", "small"),
            (7, "u", None), (8, "u", "x" * 3_000_000), (9, "u", "WARC/1.1\r\nContent-Length: 3\r\n\r\n\x1f\x8b\x08")]
    table = spark.createDataFrame(rows, PAGES).withColumn("digest", F.lit(1)).withColumn("refers_to", F.lit(2))
    found = {r["page_id"]: r for r in warc.round_trip(table).collect()}
    assert len(found) == len(rows)
    for page, _, html in rows:
        data = (html or "").encode()
        assert (found[page]["payload_bytes"], found[page]["payload_digest"]) == (len(data), hashlib.sha1(data).hexdigest())
    assert {p: r["refers_to"] for p, r in found.items() if r["record_type"] == "revisit"} == {1: 5, 3: 5}
    assert warc.round_trip(spark.createDataFrame([], PAGES)).collect() == []


def test_repeated_and_unnamed_pages(spark):
    big = "y" * 2000
    rows = [(2, "u", big), (2, "u", big), (1, "u", big), (None, "u", big), (None, "u", "z")]
    found = warc.round_trip(spark.createDataFrame(rows, PAGES)).collect()
    assert Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in found) == {
        (2, "response", None): 2, (1, "revisit", 2): 1, (None, "revisit", 2): 1, (None, "response", None): 1}


def test_files_are_plain_gzip_members(spark):
    path = scratch_path(spark, "warc-test")
    warc.write(spark.createDataFrame([(i, "u", f"page {i} é") for i in range(5)], PAGES), path)
    files = spark.read.format("binaryFile").load(path).collect()
    data = b"".join(gzip.decompress(bytes(f["content"])) for f in files)
    assert data.count(b"WARC/1.1\r\n") == 5
    assert warc.gaps(warc.read(spark, path)).collect() == []


def salvaged(data):
    found = list(warc.salvage(data))
    return [r["page_id"] for _, _, r, _ in found if r], [(o, n) for o, n, r, _ in found if r is None]


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 2**32), st.booleans())
def test_damage_costs_only_the_damaged_record(seed, packed):
    draw = random.Random(seed)
    records = [warc.record(i, "u", bytes(draw.randbytes(draw.randint(0, 300)))) for i in range(6)]
    parts = [gzip.compress(r, mtime=0) if packed else r for r in records]
    victim = draw.randrange(6)
    hurt = bytearray(parts[victim])
    # a plain record's header has no checksum of its own
    first = 0 if packed else records[victim].index(b"\r\n\r\n")
    hurt[draw.randrange(first, len(hurt))] ^= 1 << draw.randrange(8)
    start = sum(map(len, parts[:victim]))
    data = b"".join([*parts[:victim], bytes(hurt), *parts[victim + 1 :]])
    pages, gaps = salvaged(data)
    assert set(range(6)) - {victim} <= set(pages)
    assert all(start <= o and o + n <= start + len(hurt) for o, n in gaps)
    if victim not in pages:
        assert gaps


def test_cut_and_foreign_bytes_become_gaps():
    records = [warc.record(i, "u", b"p" * 50) for i in range(4)]
    packed = [gzip.compress(r, mtime=0) for r in records]
    data = packed[0] + b"junk\x1f\x8b\x08WARC/1.1 no" + packed[1] + records[2] + packed[3][:-9]
    pages, gaps = salvaged(data)
    assert pages == [0, 1, 2]
    assert gaps == [(len(packed[0]), 18), (len(data) - len(packed[3]) + 9, len(packed[3]) - 9)]
    assert salvaged(b"") == ([], [])


def test_pages_with_control_characters_come_back(spark):
    urls = [f"http://a/{chr(c)}b" for c in range(128)] + ["http://é/\u2028\x85"]
    rows = [(i, url, f"page {i}") for i, url in enumerate(urls)]
    found = {r["page_id"]: r["url"] for r in warc.round_trip(spark.createDataFrame(rows, PAGES)).collect()}
    assert sorted(found) == list(range(len(urls)))
    assert found[1] == "http://a/%01b" and found[9] == "http://a/%09b" and found[65] == urls[65] and found[128] == urls[128]


def test_a_gap_fails_the_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "record", lambda *a: b"WARC/1.1\r\nno header")
    with pytest.raises(Exception, match="an archive can't be read"):
        warc.round_trip(spark.createDataFrame([(1, "u", "x")], PAGES)).collect()


def test_files_are_bounded_in_bytes(spark):
    path = scratch_path(spark, "warc-test")
    draw = random.Random(4)
    pages = [(i, "u", draw.randbytes(draw.choice([10, 2000, 9000])).hex()) for i in range(60)] + [(99, "u", "z" * 50_000)]
    warc.write(spark.createDataFrame(pages, PAGES).coalesce(1), path, file_bytes=20_000)
    files = [gzip.decompress(bytes(f["content"])) for f in spark.read.format("binaryFile").load(path).collect()]
    assert len(files) > 10 and all(len(f) <= 20_000 or f.count(b"WARC-Record-ID") == 1 for f in files)
    assert warc.records(warc.read(spark, path)).count() == len(pages)


@pytest.mark.parametrize(
    "data",
    [b"WARC/1.1\r\n", b"WARC/1.1\r\nA: b\r\n", b"\x1f\x8b\x08", b"WARC/1.1\r\nContent-Length: 9\r\n\r\n", b"WARC/1.0\r\n" + b"A: b\r\n" * 500],
)
def test_salvage_takes_time_in_proportion(data):
    import time

    whole = warc.record(1, "u", b"p")
    data = data * (2_000_000 // len(data)) + b"\r\n\r\n" + whole
    began = time.process_time()
    pages, gaps = salvaged(data)
    assert pages == [1] and sum(n for _, n in gaps) >= 2_000_000 - 100 - len(data) // 100
    assert time.process_time() - began < 10


def made_elsewhere(kind, fields, block):
    head = {"WARC-Type": kind, "WARC-Record-ID": "<urn:uuid:1-2>", "Content-Length": str(len(block)), **fields}
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def test_records_of_other_makers_are_read():
    http = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n"
    info = made_elsewhere("warcinfo", {"Content-Type": "application/warc-fields"}, b"software: x\r\n\r\nmore")
    kind = {"Content-Type": "application/http; msgtype=response"}
    page = made_elsewhere("response", {**kind, "WARC-Payload-Digest": "sha256:" + hashlib.sha256(b"body").hexdigest()}, http + b"body")
    bare = made_elsewhere("response", {**kind, "WARC-Payload-Digest": "blake3:00"}, http + b"body")
    folded = made_elsewhere("metadata", {"WARC-Target-URI": "http://a\r\n /b"}, b"")
    wrong = made_elsewhere("response", {**kind, "WARC-Payload-Digest": "sha1:" + "A" * 32}, http + b"body")
    again = made_elsewhere("revisit", {**kind, "WARC-Payload-Digest": "sha1:" + hashlib.sha1(b"body").hexdigest()}, http)
    member = gzip.compress(info + page + wrong + bare + folded + again, mtime=0)
    found = list(warc.salvage(member + info))
    rows = [r for _, _, r, _ in found if r]
    assert [r["record_type"] for r in rows] == ["warcinfo", "response", "response", "metadata", "revisit", "warcinfo"]
    assert {r["record_id"] for r in rows} == {"<urn:uuid:1-2>"} and {r["page_id"] for r in rows} == {None}
    assert rows[0]["payload"] == b"software: x\r\n\r\nmore" and rows[1]["payload"] == rows[2]["payload"] == b"body"
    assert rows[1]["payload_digest"] == hashlib.sha256(b"body").hexdigest() and rows[3]["url"] == "http://a /b"
    assert rows[4]["payload"] is None and rows[4]["payload_digest"] == hashlib.sha1(b"body").hexdigest()
    (reason,) = [why for _, _, r, why in found if r is None]
    assert reason == f"digest differs, {len(wrong)} bytes from {len(info + page)} of a member"


# --- 9 decontamination


def brute_finds(rows, items):
    out = set()
    for doc, text in rows:
        tokens = decontaminate.words(text)
        for item, passage in items:
            own = decontaminate.words(passage)
            if not own:
                continue
            width = min(5, len(own))
            want = {tuple(own[i : i + width]) for i in range(len(own) - width + 1)}
            have = {tuple(tokens[i : i + width]) for i in range(len(tokens) - width + 1)}
            if 5 * len(want & have) >= 4 * len(want):
                out.add((doc, item))
    return out


def test_finds_equal_brute_force(spark):
    draw = random.Random(11)
    vocab = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(draw.choices(vocab, k=draw.randint(1, 60)))) for i in range(80)]
    rows = []
    for doc in range(120):
        words = draw.choices(vocab, k=draw.randint(0, 400))
        item = items[draw.randrange(80)][1].split()
        for _ in range(draw.randint(0, 5)):
            item[draw.randrange(len(item))] = draw.choice(["other", item[0]])
        cut = draw.randint(0, len(words))
        rows.append((doc, " ".join(words[:cut] + item + words[cut:])))
    found = decontaminate.contaminated(
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        item_bytes=5000,
    ).collect()
    got = {(r["doc_id"], i) for r in found for i in r["item_ids"]}
    assert got == brute_finds(rows, items) and len(got) > 30
    assert all(r["containment"] >= 0.8 for r in found)


def test_contamination_on_awkward_rows(spark):
    items = [(1, "looked at the moon for a long time"), (2, "LOOKED at the Moon, for a long time!"), (3, None), (4, ""),
             (None, "der hund lief über die brücke und"), (5, "two")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("found", F.lit(1))
    found = decontaminate.contaminated(clashing(spark), bench).collect()
    assert Counter((r["doc_id"], tuple(r["item_ids"])) for r in found) == {
        (1, (1, 2)): 1, (2, (1, 2)): 2, (7, (None,)): 1, (None, (None,)): 1, (9, (5,)): 1}
    left = decontaminate.clean(clashing(spark), bench)
    assert left.columns == clashing(spark).columns
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 4, 5, 6, 8]
    assert decontaminate.contaminated(empty(spark), bench).collect() == []
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.clean(docs(spark), none).count() == len(ROWS)
    in_turns = decontaminate.clean(clashing(spark), bench, item_bytes=40)
    assert sorted(r["doc_id"] for r in in_turns.collect()) == [3, 4, 5, 6, 8]


def test_items_of_equal_words_are_one_find_in_any_number_of_turns(spark):
    texts = ["looked at the moon for a long time", "LOOKED at the Moon, for a long time!"]
    texts += [t.replace(" ", mark) for t in texts for mark in ("  ", "_", ", ", "; ")]
    items = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (50, "sat on the mat and looked"), (51, "two")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = [tuples(decontaminate.contaminated(docs(spark), bench, item_bytes=n)) for n in (1, 40, 10**6)]
    assert found[0] == found[1] == found[2]
    ids = (*range(len(texts)), None)
    assert Counter((r[0], r[1], tuple(r[2])) for r in found[0]) == {
        (1, 0, ids): 1, (2, 0, ids): 2, (1, 50, (50,)): 1, (2, 50, (50,)): 2, (9, 51, (51,)): 1}


def test_threshold_is_exact():
    items = decontaminate.Items([(1, "a b c d e f g h i j k l m n")], 5, Fraction(4, 5))
    assert items.find("x a b c d e f g h i j k l y")  # 8 of 10 shingles
    assert not items.find("x a b c d e f g h i j k y")


def test_many_short_items_cost_a_text_little():
    import time

    items = [(i, f"w{i % 700} x{i // 700} y{i % 3}"[: 9 + i % 5]) for i in range(300_000)]
    found = decontaminate.Items(items, 5, Fraction(4, 5))
    draw = random.Random(1)
    texts = [" ".join(f"{draw.choice('wxy')}{draw.randrange(700)}" for _ in range(300)) for _ in range(100)]
    began = time.process_time()
    for text in texts:
        found.find(text)
    assert time.process_time() - began < 100 * 0.02
    for i in (0, 5, 200_000):
        assert i in {k for k, _, _ in found.find(f"a b {found.texts[i]} c d e f")}


# --- 10 sharding


def plain_kk(sizes, k):
    """Differencing with lists, as the definition has it."""
    parts = [[(s, [i])] + [(0, [])] * (k - 1) for i, s in enumerate(sizes)]
    while len(parts) > 1:
        parts.sort(key=lambda p: p[-1][0] - p[0][0])
        a, b, *rest = parts
        joined = [(x[0] + y[0], x[1] + y[1]) for x, y in zip(a, b[::-1], strict=True)]
        parts = [sorted(joined, key=lambda x: -x[0]), *rest]
    return sorted(x[0] for x in parts[0])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 10**6), min_size=1, max_size=40, unique=True), st.integers(2, 7))
def test_differencing_balances_and_keeps_groups(sizes, k):
    loads = np.zeros((len(sizes), k), dtype=np.int64)
    loads[:, 0] = sizes
    shard, total = sharding.difference(loads)
    own = Counter()
    for size, place in zip(sizes, shard[:, 0].tolist(), strict=True):
        own[place] += size
    assert [own[i] for i in range(k)] == total.tolist()
    assert sum(total) == sum(sizes)
    if len({*sizes}) == len(sizes) and k == 2:
        assert total[0] - total[1] == plain_kk(sizes, 2)[1] - plain_kk(sizes, 2)[0]


def shard_facts(rows, found):
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in found) == sorted((r[0] is None, r[0] or 0) for r in rows)
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_on_awkward_rows(spark):
    found = sharding.assign(clashing(spark), shards=4).collect()
    shard_facts(ROWS, found)
    text = {r[0]: r[1] or "" for r in ROWS}
    by_text = defaultdict(set)
    for r in found:
        if r["doc_id"] is not None:
            by_text[text[r["doc_id"]]].add(r["shard"])
            assert r["size"] == len(text[r["doc_id"]].encode()) + 16
            assert r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode())
    assert all(len(s) == 1 for s in by_text.values())
    assert sharding.assign(empty(spark)).collect() == []


def test_sharding_by_levels_stays_even(spark):
    draw = random.Random(2)
    rows = [(i, "x" * draw.randint(1, 400) + str(i), None, None, None) for i in range(1500)]
    found = sharding.assign(docs(spark, rows), shards=5, bucket=60, run=50)
    load = [r[0] for r in found.groupBy("shard").agg(F.sum("size")).collect()]
    assert len(load) == 5 and max(load) - min(load) <= 16
    shard_facts(rows, found.collect())
