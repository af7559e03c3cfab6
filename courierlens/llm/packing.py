"""Best-fit packing of token sequences under several capacities at once (vector best-fit).

A piece of l tokens takes (l, 1, l * l) of a sequence's tokens, documents and attention
cost. Pieces are placed by decreasing length: of the open sequences that can take the
piece under every capacity, the one that is left with the least weighted residual norm,
or the one with the least weighted dot-product of the piece and the residual.

Pieces of one length are alike, so all is decided by the number of pieces of each
length, a table of at most as many rows as a sequence has tokens, however large the
corpus. After a piece the chosen sequence is still the best for the next one of that
length, so sequences of one kind are filled by the thousand in one step. The plan says
for ranges of pieces of one length where they go; a piece finds its place by its length
and its number among the pieces of that length.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courierlens.llm.common import written

TOKENS = 2048
#: Characters that are tokenized at once; a longer text is cut before a space or line break.
CHUNK = 1_000_000
#: Ranges of pieces that are numbered on their own, at most, besides one a length.
RANGES = 20_000
#: Pieces of a range at least.
RANGE = 100

#: Fixed values of byte-level vocabularies: how a text is cut before merging.
_CUTS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# --- tokens


def _byte_letters() -> dict[str, int]:
    """The letters of a byte-level vocabulary and their bytes.

    Printable bytes stand for themselves, the others for characters from 256 on.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = sorted(set(range(256)) - set(printable))
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def _ranked(model: dict) -> dict[bytes, int] | None:
    """Bytes to id, if the file is a byte-level vocabulary whose ids are in order of merging."""
    part, cut, added = model["model"], model.get("pre_tokenizer") or {}, model.get("added_tokens", [])
    plain = (
        part.get("type") == "BPE"
        and not model.get("normalizer")
        and cut.get("type") == "ByteLevel"
        and cut.get("use_regex", True)
        and not cut.get("add_prefix_space")
        and not any(part.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
    )
    if not plain:
        return None
    pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in part["merges"]]
    if any(part["vocab"].get(a + b) != 256 + i for i, (a, b) in enumerate(pairs)):
        return None
    special, byte = {t["content"] for t in added}, _byte_letters()
    return {bytes(byte[c] for c in token): i for token, i in part["vocab"].items() if token not in special}


def encoder(model_json: str) -> Callable[[str], np.ndarray]:
    """Text to the ids that the tokenizer file gives without added special tokens.

    A byte-level vocabulary is read into the faster of two libraries, which gives the
    same ids; texts that it refuses and other files go to ``tokenizers``.
    """
    import tiktoken
    from tokenizers import Tokenizer

    model = json.loads(model_json)
    slow, ranks = Tokenizer.from_str(model_json), _ranked(model)
    if ranks is not None:
        special = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        fast = tiktoken.Encoding("pack", pat_str=_CUTS, mergeable_ranks=ranks, special_tokens=special)

    def ids(text: str) -> list[int]:
        if ranks is not None:
            try:
                return fast.encode(text, allowed_special="all", disallowed_special=())
            except ValueError:  # a run of white space that is too long for its pattern
                pass
        return slow.encode(text, add_special_tokens=False).ids

    # no cut of a byte-level vocabulary spans a character and white space after it
    edge = regex.compile(r"(?<=\S)[ \n]")

    def encode(text: str) -> np.ndarray:
        parts, at = [], 0
        while ranks is not None and len(text) - at > CHUNK and (found := edge.search(text, at + CHUNK)):
            parts.append(np.array(ids(text[at : found.start()]), dtype="<u4"))
            at = found.start()
        parts.append(np.array(ids(text[at:]), dtype="<u4"))
        return np.concatenate(parts)

    return encode


def cuts(length: int, tokens: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document: all but the first are full."""
    first = (length - 1) % tokens + 1
    return [(0, first), *((at, tokens) for at in range(first, length, tokens))]


def pieces(
    docs: DataFrame,
    model_json: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokens: int = TOKENS,
    end_id: int = 0,
    keep_ids: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) for each piece of each row of docs.

    A document is the ids of its whole text and ``end_id``; null counts as empty, so each
    row has a piece. Only documents of more than ``tokens`` ids are cut. Repeated rows
    are documents of their own. An empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    name = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(model_json)
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("row", "piece", "start", "length", "ids_crc32", "ids")}
            for row, text in enumerate(batch.column("text")):
                ids = np.append(encode(text.as_py()), np.array([end_id], dtype="<u4"))
                for piece, (start, length) in enumerate(cuts(len(ids), tokens)):
                    part = ids[start : start + length]
                    kept = part.astype("i4") if keep_ids else None
                    for c, v in zip(out, (row, piece, start, length, zlib.crc32(part.tobytes()), kept)):
                        out[c].append(v)
            columns = {
                "doc_id": batch.column("doc_id").take(pa.array(out["row"], pa.int64())),
                "piece": pa.array(out["piece"], pa.int32()),
                **{c: pa.array(out[c], pa.int64()) for c in ("start", "length", "ids_crc32")},
            }
            if keep_ids:
                columns["ids"] = pa.array(out["ids"], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    kind = f"doc_id {name}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return rows.mapInArrow(cut, kind)


# --- the plan


@dataclass(frozen=True)
class Limits:
    """What a sequence holds at most, and how much each capacity weighs in the choice."""

    tokens: int = TOKENS
    documents: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0)
    rule: str = "norm"

    def capacity(self) -> np.ndarray:
        most = (self.tokens, self.documents or self.tokens, self.attention or self.tokens**2)
        return np.array(most, dtype=np.int64)


@dataclass(frozen=True)
class Run:
    """Pieces ``first`` to ``first + count`` of a length: ``each`` to a sequence from ``sequence`` on."""

    length: int
    first: int
    count: int
    sequence: int
    each: int
    offset: int


def plan(counts: dict[int, int], limits: Limits) -> tuple[list[Run], int]:
    """Where the pieces of each length go, and the number of sequences.

    Every step empties a length or a range of alike sequences; a length leaves three
    ranges more at most. So the steps depend on the lengths, not on the number of
    pieces.
    """
    if limits.rule not in ("norm", "dot"):
        raise ValueError(f"no rule {limits.rule!r}")
    most = limits.capacity()
    weights = np.array(limits.weights, dtype=float)
    runs: list[Run] = []
    residual = np.zeros((1024, 3), dtype=np.int64)  # of the sequences of each range
    base, held = np.zeros(1024, dtype=np.int64), np.zeros(1024, dtype=np.int64)
    free, top, made = list(range(1023, -1, -1)), 0, 0

    def put(first: int, n: int, left: np.ndarray) -> None:
        nonlocal residual, base, held, top
        if not free:
            size = len(held)
            residual = np.concatenate([residual, np.zeros_like(residual)])
            base, held = np.concatenate([base, np.zeros_like(base)]), np.concatenate([held, np.zeros_like(held)])
            free.extend(range(2 * size - 1, size - 1, -1))
        at = free.pop()
        residual[at], base[at], held[at], top = left, first, n, max(top, at + 1)

    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        need = np.array([length, 1, length * length], dtype=np.int64)
        if (need > most).any():
            raise ValueError(f"a piece of {length} tokens is beyond the capacity of a sequence")
        left, placed = counts[length], 0
        while left:
            fits = (held[:top] > 0) & (residual[:top] >= need).all(axis=1)
            found = np.flatnonzero(fits)
            if len(found):
                rest = residual[found]
                if limits.rule == "norm":
                    score = (weights * ((rest - need) / most) ** 2).sum(axis=1)
                else:
                    score = (weights * (rest / most) * (need / most)).sum(axis=1)
                at = int(found[np.lexsort((base[found], score))[0]])
                room, start, n = residual[at].copy(), int(base[at]), int(held[at])
                held[at] = 0
                free.append(at)
            else:
                room, start, n = most.copy(), made, -1
            each = int((room // need).min())
            full = left // each if n < 0 else min(n, left // each)
            offset = int(most[0] - room[0])
            if full:
                runs.append(Run(length, placed, full * each, start, each, offset))
                put(start, full, room - need * each)
                placed, left = placed + full * each, left - full * each
            partly = 0
            if 0 < left < each and (n < 0 or full < n):
                partly = 1
                runs.append(Run(length, placed, left, start + full, left, offset))
                put(start + full, 1, room - need * left)
                placed, left = placed + left, 0
            if n < 0:
                made += full + partly
            elif n > full + partly:
                put(start + full + partly, n - full - partly, room)
    return runs, made


def best_plan(counts: dict[int, int], choices: list[Limits]) -> tuple[list[Run], int]:
    """The plan of fewest sequences among some ways to choose; of equals the first."""
    return min((plan(counts, c) for c in choices), key=lambda found: found[1])


def choices(tokens: int = TOKENS, documents: int | None = None, attention: int | None = None) -> list[Limits]:
    """Both rules, with tokens alone, all capacities alike and tokens above the others."""
    weights = ((1.0, 0.0, 0.0), (1.0, 0.1, 0.1), (1.0, 1.0, 1.0))
    return [Limits(tokens, documents, attention, w, rule) for rule in ("norm", "dot") for w in weights]


# --- packing


def numbered(parts: DataFrame, counts: dict[int, int], ranges: int = RANGES, least: int = RANGE) -> DataFrame:
    """The pieces with their ``number`` from 0 among the pieces of their length.

    The pieces of a length are dealt by hash to ranges of one size, which are numbered on
    their own; at most ``ranges`` ranges and one a length, so where each begins is a small table.
    """
    spark = parts.sparkSession
    size = max(least, -(-sum(counts.values()) // ranges))
    spread = spark.createDataFrame([(n, -(-c // size)) for n, c in counts.items()], "length long, spread long")
    dealt = parts.join(F.broadcast(spread), "length").withColumn(
        "range", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("spread"))
    )
    before = Window.partitionBy("length").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("length", "range").agg(F.count(F.lit(1)).alias("held")).select(
        "length", "range", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("begin")
    )
    within = Window.partitionBy("length", "range").orderBy("doc_id", "piece", "start", "ids_crc32")
    return (
        dealt.withColumn("place", F.row_number().over(within) - 1)
        .join(F.broadcast(starts), ["length", "range"])
        .withColumn("number", F.col("begin") + F.col("place"))
        .drop("spread", "range", "begin", "place")
    )


def pack(parts: DataFrame, ways: list[Limits] | None = None) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``, their place in it without gaps.

    ``parts`` has the columns of ``pieces`` and is read several times. No sequence
    exceeds a capacity of ``ways``, which differ in rule and weights only; the one that
    takes the fewest sequences is carried out. Sequences are numbered from 0. A length
    above a capacity raises an error. Repeated rows and null ids get places of their
    own; an empty table gives no rows.
    """
    spark = parts.sparkSession
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs, _ = best_plan(counts, ways or choices())
    kind = "length long, first long, count long, sequence long, each long, offset long"
    table = spark.createDataFrame([tuple(vars(r).values()) for r in runs], kind)
    table = table.withColumnsRenamed({"length": "length_", "offset": "offset_"})
    found = numbered(parts, counts)
    at = F.col("number") - F.col("first")
    placed = found.join(
        F.broadcast(table) if len(runs) <= 100_000 else table,
        (F.col("length") == F.col("length_")) & (at >= 0) & (at < F.col("count")),
    )
    return placed.select(
        *parts.columns,
        (F.col("sequence") + F.floor(at / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("offset_") + F.pmod(at, F.col("each")) * F.col("length")).alias("offset"),
    )


def pack_documents(docs: DataFrame, model_json: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents cut into pieces and packed into sequences of ``TOKENS``, by ``pieces`` and ``pack``."""
    return pack(written(pieces(docs, model_json, id_col, text_col), "pack-pieces"))
