"""Packing, conversation repair and spelling variants: awkward rows and brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from courierlens.llm import conversation_repair as repair
from courierlens.llm import packing, queries, spelling
from tests.compare import duck
from tests.conftest import DATA_DIR
from tests.llm.samples import ROWS, clashing, docs, empty


def tuples(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- 11 packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
MODEL = Path(PATH).read_text()


@pytest.fixture(scope="module")
def encode():
    return packing.encoder(MODEL)


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=60))
def test_ids_are_those_of_the_tokenizer(encode, plain, text):
    assert encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(
    "text", ["a<|endoftext|>b", " " * 300_000 + "x", "\n" * 300_000, "don't  stop\r\n\t x " * 9, "a" * 3000]
)
def test_ids_of_awkward_texts(encode, plain, text):
    assert encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_long_texts_are_cut_between_tokens(plain, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK", 50)
    rng = random.Random(3)
    for _ in range(50):
        text = "".join(rng.choice("ab'é1 \n\t.") for _ in range(400))
        assert packing.encoder(MODEL)(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_other_tokenizer_files_are_read_as_they_are():
    path = public_tokenizers.path("word_bpe_49k.json")
    expected = Tokenizer.from_file(path).encode("The cat, THE dog", add_special_tokens=False).ids
    assert packing.encoder(Path(path).read_text())("The cat, THE dog").tolist() == expected


@pytest.mark.parametrize("length, found", [
    (1, [(0, 1)]), (8, [(0, 8)]), (9, [(0, 1), (1, 8)]), (16, [(0, 8), (8, 8)]), (21, [(0, 5), (5, 8), (13, 8)]),
])
def test_only_the_first_piece_may_be_short(length, found):
    assert packing.cuts(length, 8) == found


def check_packed(rows, texts, plain, tokens):
    """Every row of texts is there with all its ids, in gapless sequences."""
    by_doc, by_sequence = Counter(), {}
    for r in rows:
        by_doc[r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]] += 1
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    expected = Counter()
    for doc_id, text in texts:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for piece, (start, n) in enumerate(packing.cuts(len(ids), tokens)):
            expected[doc_id, piece, start, n, zlib.crc32(ids[start : start + n].tobytes())] += 1
    assert by_doc == expected
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= tokens
    return len(by_sequence)


def test_packing_query_holds_all_documents_in_few_sequences(spark, plain):
    texts = [tuple(r) for r in spark.read.parquet(f"{DATA_DIR}/documents.parquet").select("doc_id", "text").collect()]
    rows = queries.op11_best_fit_packing(spark, DATA_DIR).collect()
    used = check_packed(rows, texts, plain, 2048)
    assert used <= sum(r["length"] for r in rows) // 2048 + 2


def test_packing_bears_awkward_rows(spark, plain):
    for table in (docs(spark), clashing(spark)):
        rows = packing.pack_documents(table, MODEL).collect()
        check_packed(rows, [r[:2] for r in ROWS], plain, 2048)
    assert packing.pack_documents(empty(spark), MODEL).count() == 0


def test_pieces_can_carry_their_ids(spark, plain):
    found = packing.pieces(docs(spark, ROWS[:2]), MODEL, tokens=4, keep_ids=True).orderBy("doc_id", "piece").collect()
    ids = [*plain.encode(ROWS[0][1], add_special_tokens=False).ids, 0]
    assert sum((r["ids"] for r in found if r["doc_id"] == 1), []) == ids


def one_by_one(lengths, limits):
    """Vector best-fit over single pieces: the fill of each sequence."""
    most, weights = limits.capacity(), np.array(limits.weights)
    bins = []
    for length in sorted(lengths, reverse=True):
        need = np.array([length, 1, length * length])
        fits = [(i, left) for i, (left, _) in enumerate(bins) if (left >= need).all()]
        if limits.rule == "norm":
            scored = [((weights * ((left - need) / most) ** 2).sum(), i) for i, left in fits]
        else:
            scored = [((weights * (left / most) * (need / most)).sum(), i) for i, left in fits]
        if scored:
            bins[min(scored)[1]][0] -= need
            bins[min(scored)[1]][1].append(length)
        else:
            bins.append([most - need, [length]])
    return Counter(tuple(b) for _, b in bins)


@settings(max_examples=60, deadline=None)
@given(
    lengths=st.lists(st.integers(1, 32), max_size=60),
    rule=st.sampled_from(["norm", "dot"]),
    documents=st.sampled_from([None, 2, 5]),
    attention=st.sampled_from([None, 1100]),
)
def test_the_plan_is_that_of_single_pieces(lengths, rule, documents, attention):
    limits = packing.Limits(32, documents, attention, (1.0, 0.3, 0.2), rule)
    runs, made = packing.plan(Counter(lengths), limits)
    bins = [[] for _ in range(made)]
    for r in runs:
        for i in range(r.count):
            bins[r.sequence + i // r.each].append((r.offset + i % r.each * r.length, r.length))
    seen = Counter()
    for placed in bins:
        placed.sort()
        assert [o for o, _ in placed] == [sum(n for _, n in placed[:i]) for i in range(len(placed))]
        assert len(placed) <= (documents or 32) and sum(n * n for _, n in placed) <= (attention or 1024)
        seen[tuple(n for _, n in placed)] += 1
    assert seen == one_by_one(lengths, limits)


def test_every_capacity_holds_in_spark(spark):
    rows = [(i, 0, 0, 1 + i % 30, i) for i in range(500)]
    parts = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    found = packing.pack(parts, packing.choices(64, documents=3, attention=900)).toPandas()
    sizes = found.assign(cost=found["length"] ** 2).groupby("sequence_id").agg(
        n=("length", "size"), tokens=("length", "sum"), cost=("cost", "sum"))
    assert len(found) == 500 and sizes["n"].max() <= 3 and sizes["tokens"].max() <= 64 and sizes["cost"].max() <= 900
    with pytest.raises(ValueError, match="beyond the capacity"):
        packing.pack(parts, packing.choices(64, attention=100))


def test_a_length_is_numbered_in_ranges(spark):
    rows = [(i, 0, 0, 7, i) for i in range(1000)] + [(0, 0, 0, 5, 1)] * 3
    parts = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    found = packing.numbered(parts, {7: 1000, 5: 3}, ranges=10, least=1)
    numbers = {n: sorted(r["number"] for r in found.where(F.col("length") == n).collect()) for n in (7, 5)}
    assert numbers == {7: list(range(1000)), 5: [0, 1, 2]}


def test_the_plan_does_not_grow_with_the_pieces():
    few = {n: 1 + n % 7 for n in range(1, 2049)}
    many = {n: c * 10**9 + n % 5 for n, c in few.items()}
    runs, made = packing.plan(many, packing.Limits())
    assert len(runs) < 20_000
    assert made <= 1.01 * sum(n * c for n, c in many.items()) / 2048


# --- 12 conversation repair

CHAT = "conv_id long, turn long, role string, text string"


def cheapest(symbols):
    """Least (cost, audit) over all edits of up to three rows with up to two insertions between."""
    gaps = ["", "u", "a", "ua", "au"]
    per_row = []
    for s in symbols:
        extra = 5 if s.isupper() else 0
        ways = [(2, "D", "")]
        if s != "d":
            ways += [(extra, "K", s.lower()), (1 + extra, "R", "u"), (1 + extra, "R", "a")]
        per_row.append(ways)
    best = None
    for ways in itertools.product(*per_row):
        for added in itertools.product(gaps, repeat=len(symbols) + 1):
            made = added[0] + "".join(w[2] + g for w, g in zip(ways, added[1:]))
            if re.fullmatch("(s?(ua)+)?", made):
                audit = "I" * len(added[0]) + "".join(w[1] + "I" * len(g) for w, g in zip(ways, added[1:]))
                cost = sum(w[0] for w in ways) + 5 * sum(map(len, added))
                best = min(best or (cost, audit), (cost, audit))
    return best


@pytest.mark.parametrize("n", [1, 2, 3])
def test_the_chart_finds_the_cheapest_repair(n):
    rng = random.Random(n)
    strings = list(itertools.product("suaxSUAd", repeat=n))
    for s in strings if n < 3 else rng.sample(strings, 25):
        assert repair.cheapest(repair.Parser().parse(iter("".join(s)))) == cheapest("".join(s))


@settings(max_examples=60, deadline=None)
@given(symbols=st.text("suaxSUAXd", min_size=1, max_size=30))
def test_spans_can_be_split_anywhere(symbols):
    found = repair.cheapest(repair.Parser(width=40).parse(iter(symbols)))
    for width in (1, 3, 8):
        assert repair.cheapest(repair.Parser(width).parse(iter(symbols))) == found
    halves = [repair.Parser().parse(iter(part)) for part in (symbols[:7], symbols[7:]) if part]
    assert repair.cheapest(repair.joined(iter(halves))) == found


CHATS = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hello there?"), (1, 2, "assistant", "Hello."),
    (1, 2, "assistant", "Hello."), (1, 3, "user", "cut off"), (1, 7, "assistant", "Bye!"),
    (2, 0, "assistant", "Hi."), (2, 1, "assistant", "So."),
    (3, None, "user", " "), (3, None, None, None),
    (4, 0, "", "No role."), (4, 1, "Tool", "x."),
    (None, 0, "user", "Who?"), (None, 1, "assistant", "Me."),
]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_reports_on_awkward_conversations(spark):
    found = {r["conv_id"]: r for r in repair.report(spark.createDataFrame(CHATS, CHAT)).collect()}
    one = found[1]
    assert (one["gaps"], one["duplicate"], one["truncated"], one["illegal"]) == (3, 1, 1, 1)
    # the copy and the cut turn go; of the two answers left, the least audit deletes the first
    assert (one["cost"], one["audit"]) == (6, "KKDDDK")
    assert one["repaired_sha256"] == sha("system:Be kind.\nuser:Hello there?\nassistant:Bye!")
    assert (found[2]["cost"], found[2]["audit"]) == (1, "RK")
    assert found[2]["repaired_sha256"] == sha("user:Hi.\nassistant:So.")
    assert (found[3]["gaps"], found[3]["blank"], found[3]["audit"]) == (0, 2, "DD")
    assert found[3]["repaired_sha256"] == sha("")
    assert (found[4]["cost"], found[4]["audit"], found[4]["illegal"]) == (2, "RR", 1)
    assert (found[None]["cost"], found[None]["audit"]) == (0, "KK")


def test_repaired_turns_are_the_audit_carried_out(spark):
    rows = [(9, 0, "system", "S."), (9, 1, "assistant", "A?"), (9, 2, "assistant", "B."), (9, 3, "user", "C.")]
    table = spark.createDataFrame(rows + CHATS, CHAT).withColumns({c: F.lit("x") for c in ("conv", "place", "kind", "audit")})
    found = sorted(tuple(r) for r in repair.repair(table).collect() if r["conv_id"] == 9)
    report = next(r for r in repair.report(table).collect() if r["conv_id"] == 9)
    assert report["audit"] == "KRKD" and report["cost"] == 3
    assert found == [(9, 1, "system", "S."), (9, 2, "user", "A?"), (9, 3, "assistant", "B.")]
    assert report["repaired_sha256"] == sha("\n".join(f"{r[2]}:{r[3]}" for r in found))


def test_a_long_conversation_is_parsed_in_blocks(spark):
    rng = random.Random(5)
    rows = [(1, i, rng.choice(["user", "assistant", "tool"]), f"t{i}" + rng.choice([".", ""])) for i in range(700)]
    taken = repair.turns(spark.createDataFrame(rows + CHATS, CHAT), "conv_id", "turn", "role", "text")
    whole, parts = (tuples(repair.audits(taken, block=b).select("conv", "cost", "audit")) for b in (10_000, 16))
    assert whole == parts


def test_no_conversations(spark):
    none = spark.createDataFrame([], CHAT)
    assert repair.report(none).count() == 0 and repair.repair(none).count() == 0
    assert repair.damaged(none).count() == 0


def test_damage_follows_the_hash(spark):
    rows = [(i, t, "assistant", "a.b") for i in range(40) for t in (0, None)] + [(None, None, None, None)]
    found = Counter(tuple(r) for r in repair.damaged(spark.createDataFrame(rows, CHAT)).collect())
    expected = Counter()
    for conv, turn, role, text in rows:
        role, text = role or " ", text or " "
        by = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if by:
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(by, text)
            expected[conv, turn, "user" if by == 4 else role, text] += 2 if by == 3 else 1
    assert found == expected


def test_every_conversation_is_reported(spark, tmp_path):
    # 28 values of turn whose rows the damage drops
    dropped = [t for t in range(600) if zlib.crc32(f"5:{t}".encode()) % 20 == 0]
    spark.createDataFrame([(5, t, "user", "Hi.") for t in dropped], CHAT).write.parquet(str(tmp_path / "conversations.parquet"))
    found = queries.op12_conversation_repair(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in found] == [(5, 0, 0, 0, 0, 0, 0, "", sha(""))]


# --- 13 spelling variants


def plain_near(words):
    def one_edit(a, b):
        if len(a) > len(b):
            a, b = b, a
        same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        return len(b) - len(a) <= 1 and a != b and a[same + (len(a) == len(b)) :] == b[same + 1 :]

    return {(a, b) for a in words for b in words if one_edit(a, b)}


@settings(max_examples=150, deadline=None)
@given(words=st.sets(st.text("abé", max_size=6), max_size=40))
def test_the_machine_accepts_the_pairs_one_edit_apart(words):
    machine = spelling.Machine(iter(sorted(words)))
    found = machine.accepted()
    assert {p for a, b in found for p in ((a, b), (b, a))} == plain_near(words)


def test_equal_rests_are_one_state():
    ends = [a + b + "ing" for a in "abcd" for b in "xyz"]
    assert len(spelling.Machine(iter(sorted(ends))).arcs) == 6


def vocabulary_table(spark, words):
    return spark.createDataFrame(sorted(words.items()), "word string, n long")


@pytest.mark.parametrize("part, long", [(50_000, 200), (3, 200), (1, 1)])
def test_near_words_equal_brute_force(spark, part, long):
    rng = random.Random(part)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(1, 8))): rng.randrange(1, 50) for _ in range(300)}
    words |= {"a" * 90 + c + "b" * 90: 7 for c in ("", "x", "y", "xy")}
    found = spelling.near_words(vocabulary_table(spark, words), part=part, long=long)
    assert tuples(found) == sorted(((a, b, words[b]) for a, b in plain_near(words)), key=repr)


def plain_forms(words, ratio=5):
    near, out = plain_near(words), {}
    for word, n in words.items():
        others = [b for a, b in near if a == word]
        best = min(others, key=lambda w: (-words[w], w), default=None)
        form = best if best is not None and words[best] >= ratio * n else None
        out[word] = (form, n, len(others), words.get(form))
    roots = {}
    for word in out:
        root = word
        while out[root][0] is not None:
            root = out[root][0]
        roots[word] = root
    return sorted(((w, f, roots[w], n, k, m) for w, (f, n, k, m) in out.items()), key=repr)


def test_forms_and_roots_equal_brute_force(spark):
    rng = random.Random(8)
    words = {"".join(rng.choice("ab") for _ in range(rng.randrange(2, 8))): 5 ** rng.randrange(0, 9) for _ in range(200)}
    words |= {"colour": 3125, "color": 625, "colr": 125, "clr": 25, "cl": 5, "c": 1}
    assert tuples(spelling.forms(vocabulary_table(spark, words))) == plain_forms(words)


def test_a_third_of_the_words_may_share_a_form(spark):
    words = {"common" + c: 1 for c in map(chr, range(0xE0, 0xF0))} | {"common": 100, "others": 1}
    found = {r["word"]: r for r in spelling.forms(vocabulary_table(spark, words)).collect()}
    assert found["common"]["n_near"] == 16 and all(r["root"] == "common" for w, r in found.items() if w[:6] == "common")


def plain_vocabulary(rows, each=199):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc_id}:{run}".encode()) if doc_id is not None else 1
            if h % each == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 6:
                count[run] += 1
    return {w: n for w, n in count.items() if n >= 5}


def test_the_vocabulary_counts_whole_texts(spark):
    words = "Großes ÉCOLE colour colours x×y÷z wonder1ful straße Straßen " * 30
    rows = [(i, words, None, None, None) for i in range(20)] + [(None, words, "en", None, 1), (1, None, None, None, 0), (2, "", "", "", 0)]
    for each in (199, 7):
        found = spelling.vocabulary(clashing(spark, rows), each=each)
        assert dict(tuples(found)) == plain_vocabulary([r[:2] for r in rows], each)
    assert spelling.vocabulary(empty(spark)).count() == 0
    assert spelling.forms(spelling.vocabulary(empty(spark))).count() == 0


def test_long_runs_that_repeat(spark):
    run = "".join(random.Random(2).choice("abcdefgh") for _ in range(30_000))
    rows = [(i, run, None, None, None) for i in range(30)] + [(50 + i, run[1:], None, None, None) for i in range(5)]
    found = {r["word"]: r for r in spelling.forms(spelling.vocabulary(docs(spark, rows))).collect()}
    assert found[run]["n_near"] == 1 and found[run[1:]]["root"] == run


def test_spelling_query_on_rows_of_the_table(spark):
    rows = duck(DATA_DIR).sql("SELECT doc_id, text FROM documents").fetchall()
    found = queries.op13_spelling_variants(spark, DATA_DIR).collect()
    assert {r["word"]: r["n"] for r in found} == plain_vocabulary(rows)
