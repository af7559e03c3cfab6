"""Secrets: fixed patterns, and character Markov models for what these don't know.

Two first-order Markov models, of random strings and of ordinary identifiers, are
trained from labelled samples: strings of a seeded generator and secrets that the fixed
patterns find on one side, tokens outside of such finds and identifiers made of ordinary words
on the other. Both sides are tokens of the characters that are scored. A long token is a
secret if its log-likelihood ratio is above the threshold.
"""

from __future__ import annotations

import random
import re
import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order of results; markov is what the models add.
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "markov")
SPANS = "array<struct<kind: string, start: int, end: int>>"
#: About so many documents are the labelled sample; they are chosen by a hash of their id.
SAMPLE = 2000
#: Random strings and ordinary identifiers of the generators.
RANDOM = 5000
ORDINARY = 5000
#: The least log-likelihood ratio: identifiers are a million times as many.
THRESHOLD = 14.0

_CHARS = string.ascii_letters + string.digits + "+/_=-"
_START = len(_CHARS)
_ASSIGN = re.compile(
    r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_PIECE = re.compile(r"[A-Za-z0-9+/_=-]+")
#: Numbers of a fixed form that names things: no secret, however random.
_NAMED = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
#: Words of ordinary identifiers, paths and addresses.
WORDS = (
    "account action address admin agent amount answer archive array article asset author backup block book "
    "browser buffer build button cache calendar category channel child class client cloud cluster code "
    "collection column command comment company component config connection container content context controller "
    "cookie count country course customer data database date debug default delete detail device directory docker "
    "download email engine entry error event example export factory feature field file filter folder format "
    "forum framework function group handler header history home host image import index info input instance "
    "interface item job json key label language layout link list local location login manager map message "
    "metadata method model module name network node object option order page parent password path payment "
    "pipeline platform player plugin policy post price process product profile project property public query "
    "queue readme record redirect region register report request resource response result role route rule sample "
    "schema script search section security server service session setting share size source spring status "
    "storage store stream string summary support system table target task team template test text theme thread "
    "token topic type update upload usage user util value version video view web widget window worker"
).split()
_HINTS = ("passw", "secret", "token", "api")


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """``(start, kind, end, start of the secret)`` of the fixed patterns, by start, then kind."""
    found = []
    low = text.lower()
    if any(hint in low for hint in _HINTS):
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= 8:
                found.append((m.start(), 0, m.end(), m.start(2)))
    for token in _TOKEN.finditer(text):  # the other two lie within such a token
        for kind, pattern, least in ((1, _ACCESS, 16), (2, _HEX, 32)):
            for m in pattern.finditer(text, token.start(), token.end()):
                if m.end() - m.start() >= least:
                    found.append((m.start(), kind, m.end(), m.start()))
    return sorted(found)


def _table() -> np.ndarray:
    """The number of each character of tokens; other ones begin a token."""
    numbers = np.full(128, _START, np.int64)
    numbers[[ord(c) for c in _CHARS]] = np.arange(len(_CHARS))
    return numbers


_NUMBERS = _table()


def _codes(token: str) -> np.ndarray:
    return np.r_[_START, _NUMBERS[np.frombuffer(token.encode(), np.uint8)]]


def count(tokens: list[str]) -> np.ndarray:
    """How often each character follows each other one; the last row: begins a token."""
    codes = _codes(" ".join(tokens))
    pairs = (codes[:-1] * _START + codes[1:])[codes[1:] != _START]
    return np.bincount(pairs, minlength=(_START + 1) * _START)


def generated(n: int = RANDOM, seed: int = 7) -> list[str]:
    """Random strings of the usual alphabets and lengths."""
    draw = random.Random(seed)
    kinds = (
        string.hexdigits[:16], string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/",
        string.ascii_letters + string.digits + "-_", string.ascii_uppercase + string.digits,
        string.ascii_lowercase + string.digits,
    )
    return ["".join(draw.choices(kinds[i % len(kinds)], k=draw.randint(16, 64))) for i in range(n)]


def ordinary(n: int = ORDINARY, seed: int = 11) -> list[str]:
    """Identifiers, paths, slugs and constants made of ordinary words and small numbers."""
    draw = random.Random(seed)
    styles = (
        lambda w: "/".join(w), lambda w: "/" + "/".join(w) + "/", lambda w: "-".join(w), lambda w: "_".join(w),
        lambda w: "_".join(w).upper(), lambda w: "".join(x.capitalize() for x in w),
        lambda w: w[0] + "".join(x.capitalize() for x in w[1:]), lambda w: "/".join([*w[:-1], "".join(x.capitalize() for x in w[-2:])]),
        lambda w: "-".join([*w, str(draw.randrange(2030))]), lambda w: "=".join(w[:2]), lambda w: "".join(w),
    )
    return [styles[i % len(styles)](draw.choices(WORDS, k=draw.randint(2, 6))) for i in range(n)]


def _samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to (label, pair, n): counts of a task's labelled tokens; label 1: secret."""
    totals = np.zeros((2, (_START + 1) * _START), np.int64)
    for batch in batches:
        for text in batch.column("text").to_pylist():
            secrets, rest, at = [], [], 0
            for start, _, end, secret in base_spans(text):
                if start >= at:
                    rest.append(text[at:start])
                    secrets += _PIECE.findall(text, secret, end)
                    at = end
            rest.append(text[at:])
            totals[1] += count(secrets)
            totals[0] += count([w for part in rest for w in _PIECE.findall(part) if len(w) >= 3])
    for label in (0, 1):
        pair = np.flatnonzero(totals[label])
        if len(pair):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(pair), label, np.int32)), pa.array(pair), pa.array(totals[label][pair])],
                ["label", "pair", "n"],
            )


def chances(counts: np.ndarray) -> np.ndarray:
    """The probability of each character after each other one, smoothed by a half."""
    rows = counts.reshape(_START + 1, _START) + 0.5
    return rows / rows.sum(axis=1, keepdims=True)


def ratios(random_counts: np.ndarray, plain_counts: np.ndarray, ordinary_counts: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of each pair of characters, random over plain.

    Plain is half the tokens of texts and half ordinary identifiers, however many there
    are of either.
    """
    return np.log(chances(random_counts)) - np.log((chances(plain_counts) + chances(ordinary_counts)) / 2)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> np.ndarray:
    """Ratios from the labelled sample and the generated strings; no text reaches the driver."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    n = max(1, texts.count())
    chosen = texts.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(n)) < sample).select("text")
    counts = [np.zeros((_START + 1) * _START, np.int64), count(generated())]
    sums = chosen.mapInArrow(_samples, "label int, pair long, n long").groupBy("label", "pair").agg(F.sum("n"))
    for label, pair, total in sums.collect():  # at most two tables of pairs of characters
        counts[label][pair] += total
    return ratios(counts[1], counts[0], count(ordinary()))


def spans(text: str | None, ratio: np.ndarray, threshold: float = THRESHOLD) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` by start, then kind; code points, end exclusive.

    Tokens of 16 and more characters that no fixed pattern touches are held against
    the models, but for those in the form of a UUID. Null and empty texts have no spans.
    """
    if not text:
        return []
    base = base_spans(text)
    found = [(s, k, e) for s, k, e, _ in base]
    for m in _TOKEN.finditer(text):
        if not any(s < m.end() and m.start() < e for s, _, e, _ in base):
            if _NAMED.fullmatch(m[0]):
                continue
            codes = _codes(m[0])
            if ratio[codes[:-1], codes[1:]].sum() >= threshold:
                found.append((m.start(), len(BASE), m.end()))
    return [(KINDS[k], s, e) for s, k, e in sorted(found)]


def finder(ratio: np.ndarray, threshold: float = THRESHOLD):
    @F.pandas_udf(SPANS)
    def secrets(texts: pd.Series) -> pd.Series:
        return pd.Series(
            [[{"kind": k, "start": s, "end": e} for k, s, e in spans(t, ratio, threshold)] for t in texts],
            dtype=object,
        )

    return secrets


def find(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, sample: int = SAMPLE
) -> DataFrame:
    """``doc_id, spans`` for each row of docs: the secrets of its whole text.

    Null and empty texts have no spans. Repeated rows and null ids stay, an empty table
    gives no rows, other columns are not read.
    """
    ratio = train(docs, id_col, text_col, sample)
    return docs.select(F.col(id_col).alias("doc_id"), finder(ratio, threshold)(F.col(text_col)).alias("spans"))


def redacted(found: Column, text: Column) -> Column:
    """The text with each span's characters replaced by one mark."""
    return F.aggregate(
        found,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda acc, s: F.when(s["end"] <= acc["at"], acc).otherwise(
            F.struct(
                F.concat(
                    acc["out"],
                    F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0))),
                    F.lit("[secret]"),
                ).alias("out"),
                s["end"].alias("at"),
            )
        ),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))),
    )
