"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass: at-signs, scheme marks, plus
signs, digit pairs that dots, blanks or nothing part, and words that announce an
identifier. From each anchor a parser of its own kind expands to the boundaries and
validates what it finds.
"""

from __future__ import annotations

import re
import string

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order of results: those of fixed patterns, then those that cues add.
BASE = ("email", "ip", "card", "phone")
ADDED = ("login", "account")
KINDS = BASE + ADDED
SPANS = "array<struct<kind: string, start: int, end: int>>"

_DIGITS = frozenset(string.digits)
_LABEL = frozenset(string.ascii_letters + string.digits + "-")
_LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
_PHONE = frozenset(string.digits + " ().-")
_ID = frozenset(string.ascii_letters + string.digits)
_USER = frozenset(string.ascii_letters + string.digits + "-._~!$&'()*+,;=:%")
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
#: Words that announce an account or identity number, in any case of letters.
CUES = ("iban", "account", "acct", "ssn", "passport", "social security")
#: Words and signs that may stand between a cue and the number.
_FILL = ("number", "no", "nr", "num", "id")
#: Cues whose number has nine digits.
_NINE = ("ssn", "social security")
#: Characters of an identifier at most.
_MOST = 34
_DATE = re.compile("(?:19|20)[0-9]{2}[ -](?:0[1-9]|1[0-2])[ -](?:0[1-9]|[12][0-9]|3[01])(?![A-Za-z0-9])")
#: Characters of an international account number by country.
IBAN_SIZES = {
    **dict.fromkeys(("NO",), 15),
    **dict.fromkeys(("BE",), 16),
    **dict.fromkeys(("DK", "FI", "FK", "FO", "GL", "NL", "SD"), 18),
    **dict.fromkeys(("MK", "SI"), 19),
    **dict.fromkeys(("AT", "BA", "EE", "KZ", "LT", "LU", "MN", "XK"), 20),
    **dict.fromkeys(("CH", "HR", "LI", "LV"), 21),
    **dict.fromkeys(("BG", "BH", "CR", "DE", "GB", "GE", "IE", "ME", "RS", "VA"), 22),
    **dict.fromkeys(("AE", "GI", "IL", "IQ", "OM", "SO", "TL"), 23),
    **dict.fromkeys(("AD", "CZ", "ES", "MD", "PK", "RO", "SA", "SE", "SK", "TN", "VG"), 24),
    **dict.fromkeys(("LY", "PT", "ST"), 25),
    **dict.fromkeys(("IS", "TR"), 26),
    **dict.fromkeys(("BI", "DJ", "FR", "GR", "IT", "MC", "MR", "SM"), 27),
    **dict.fromkeys(("AL", "AZ", "BY", "CY", "DO", "GT", "HN", "HU", "LB", "NI", "PL", "SV"), 28),
    **dict.fromkeys(("BR", "EG", "PS", "QA", "UA"), 29),
    **dict.fromkeys(("JO", "KW", "MU", "YE"), 30),
    **dict.fromkeys(("MT", "SC"), 31),
    **dict.fromkeys(("LC",), 32),
    **dict.fromkeys(("RU",), 33),
}


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    found.add_word("@", ("email", 1))
    found.add_word("://", ("login", 3))
    for a in string.digits:
        found.add_word("+" + a, ("phone", 2))
        for b in string.digits:
            found.add_word(f"{a}.{b}", ("ip", 3))
            for mark in ("", " ", "-"):
                found.add_word(a + mark + b, ("card", 2 + len(mark)))
    for cue in CUES:
        found.add_word(cue, ("account", len(cue)))
    found.make_automaton()
    return found


def _run(text: str, at: int, chars: frozenset) -> int:
    """Where the run of chars that begins at a place ends."""
    while at < len(text) and text[at] in chars:
        at += 1
    return at


def _back(text: str, at: int, chars: frozenset, least: int) -> int:
    """Where the run of chars that ends at a place begins, no sooner than ``least``."""
    while at > least and text[at - 1] in chars:
        at -= 1
    return at


def email(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    """Around the at-sign at a place; free: where the kind's last match ended."""
    start, end = _back(text, at, _LOCAL, free), _run(text, at + 1, _LABEL)
    if start == at or end == at + 1:
        return None
    host = end
    while text[end : end + 1] == "." and (more := _run(text, end + 1, _LABEL)) > end + 1:
        end = more
    return (start, end, True) if end > host else None


def ip(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    """Four numbers with dots between, around a digit, a dot and a digit."""
    if at < free:
        return None
    start = end = _back(text, at, _DIGITS, free)
    parts = []
    while len(parts) < 4:
        begin = end + bool(parts)
        if parts and text[end : end + 1] != "." or (end := _run(text, begin, _DIGITS)) == begin:
            return None
        parts.append(text[begin:end].lstrip("0"))
    return start, end, all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def card(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    """Digits with at most one blank or hyphen between, from the first on."""
    if at < free:
        return None
    end = at + 1
    while (step := 1 + (text[end : end + 1] in (" ", "-"))) and text[end + step - 1 : end + step] in _DIGITS:
        end += step
    digits = [c for c in text[at:end] if c in _DIGITS]
    return at, end, 13 <= len(digits) <= 19 and luhn("".join(digits))


def phone(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    """A plus sign and a digit, then digits with brackets, dots, blanks and hyphens."""
    end = _run(text, at + 2, _PHONE)
    while end > at + 3 and text[end - 1] not in _DIGITS:
        end -= 1
    if end <= at + 3 or text[end - 1] not in _DIGITS:
        return None
    return at, end, 9 <= sum(c in _DIGITS for c in text[at:end]) <= 15


def login(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    """A user's name and password in an address: scheme://name:password@host."""
    scheme = _back(text, at, _LABEL | {"+", "."}, free)
    user = _run(text, at + 3, _USER)
    host = _run(text, user + 1, _LABEL | {"."})
    if scheme == at or text[user : user + 1] != "@" or ":" not in text[at + 3 : user] or host == user + 1:
        return None
    return scheme, host, True


def mod97(number: str) -> bool:
    """The check of international account numbers."""
    moved = number[4:] + number[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def iban(text: str, start: int) -> tuple[int, int, bool] | None:
    """The international account number at a place, with at most one blank or hyphen between its words.

    It ends where a word does and the check holds: at the length of its country, else as
    late as possible. Words without digits belong to it up to that length.
    """
    size, ends = IBAN_SIZES.get(text[start : start + 2].upper(), 0), {}
    end, found = start, ""
    while (word := _run(text, end, _ID)) > end:
        if len(found) >= size and not any(c in _DIGITS for c in text[end:word]):
            break
        found += text[end:word]
        end = word
        if not found[:2].isalpha() or len(found) > 34:
            break
        if sum(c in _DIGITS for c in found) >= 5 and mod97(found):
            ends[len(found)] = end
        if text[end : end + 1] not in (" ", "-"):
            break
        end += 1
    return (start, ends[size] if size in ends else ends[max(ends)], True) if ends else None


def account(text: str, at: int, free: int, cue: str) -> tuple[int, int, bool] | None:
    """The identifier after a cue, which is a whole word; a few words and signs may stand between."""
    end = at + len(cue)
    if at < free or text[at - 1 : at].isalnum() or text[end : end + 1].isalnum():
        return None
    for _ in range(3):
        while text[end : end + 1] in (" ", ":", "#", ".", "=") and end < len(text):
            end += 1
        word = _run(text, end, _ID)
        if text[end:word].lower() not in _FILL:
            break
        end = word
    named = cue.lower()
    if named == "iban":
        return iban(text, end)
    return _number(text, end, 9 if named in _NINE else None)


def _number(text: str, start: int, nine: int | None) -> tuple[int, int, bool] | None:
    """The groups of letters and digits at a place that make one identifier.

    It has 5 to 34 characters, five digits at least, and ends with the last group up to
    which that holds. A group after a blank belongs to it while the groups before have
    fewer than five digits, if it has five itself, or if all are groups of four
    characters at most with blanks only; a date after five digits doesn't. Identity
    numbers end at their ninth digit.
    """
    end, size, digits, last, short, hyphen = start, 0, 0, None, True, False
    while (word := _run(text, end, _ID)) > end and size + word - end <= _MOST:
        more = sum(c in _DIGITS for c in text[end:word])
        if not more:
            break
        fits = short and word - end <= 4
        if size and digits >= 5 and text[end - 1] == " ":
            if more < 5 and (hyphen or not fits) or _DATE.match(text, end):
                break
        hyphen |= size > 0 and text[end - 1] == "-"
        size, digits, short, end = size + word - end, digits + more, fits, word
        if size >= 5 and digits >= 5:
            last = end
        if digits == nine or text[end : end + 1] not in (" ", "-"):
            break
        end += 1
    return (start, last, True) if last else None


_PARSERS = {"email": email, "ip": ip, "card": card, "phone": phone, "login": login}


def spans(text: str | None, anchors: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` by kind, then start; code points, end exclusive.

    Spans of one kind don't overlap: a candidate that fails its check is passed over
    as a whole. Null and empty texts have none. The time is in proportion to the text,
    however long its numbers, words or lists of them are.
    """
    free, found = dict.fromkeys(KINDS, 0), {k: [] for k in KINDS}
    text = text or ""
    low = text.lower()
    if len(low) != len(text):  # places must stay: some letters have two in lower case
        low = text.translate(_LOWER)
    for last, (kind, size) in anchors.iter(low):
        at = last + 1 - size
        if kind == "account":
            span = account(text, at, free[kind], text[at : last + 1])
        else:
            span = _PARSERS[kind](text, at, free[kind])
        if span:
            start, free[kind], good = span
            if good:
                found[kind].append((kind, start, free[kind]))
    return [x for kind in KINDS for x in found[kind]]


def finder():
    @F.pandas_udf(SPANS)
    def personal(texts: pd.Series) -> pd.Series:
        anchors = automaton()
        return pd.Series(
            [[{"kind": k, "start": s, "end": e} for k, s, e in spans(t, anchors)] for t in texts], dtype=object
        )

    return personal


def joined(found: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    each = F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(each, ",")


def of_kinds(found: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(found, lambda s: s["kind"].isin(*kinds))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` for each row of docs: the personal data of its whole text.

    Null and empty texts have no spans. Repeated rows and null ids stay, an empty table
    gives no rows, other columns are not read.
    """
    return docs.select(F.col(id_col).alias("doc_id"), finder()(F.col(text_col)).alias("spans"))


def texts(found: Column, text: Column) -> Column:
    """The passages that spans point to."""
    return F.transform(found, lambda s: F.substring(text, s["start"] + 1, s["end"] - s["start"]))
