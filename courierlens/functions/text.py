"""Text clean-up: white space, missing markers and numbers held as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from courierlens.settings import MISSING_MARKERS, UNKNOWN, WHITESPACE

ASCII_WHITESPACE = "".join(c for c in WHITESPACE if c.isascii())

# Characters of a decimal number. The cast itself checks their order; this keeps
# out what only Spark takes for a number: '1d', 'inf', 'nan', '0x1p3'.
NUMBER_CHARACTERS = r"^[\s0-9eE.+-]+$"


def is_one_byte(text: Column) -> Column:
    """True where every character takes one byte; null for null."""
    return F.octet_length(text) == F.char_length(text)


def strip(c: Column) -> Column:
    """Trim every kind of white space; plain ``trim`` takes only spaces.

    Text without a multi-byte character, nearly all of it, is trimmed with the
    short ASCII set: testing a character costs time in the length of the set.
    """
    text = c.cast("string")
    plain = F.btrim(text, F.lit(ASCII_WHITESPACE))
    return F.when(is_one_byte(text), plain).otherwise(
        F.btrim(text, F.lit(WHITESPACE))
    )


def is_missing(c: Column) -> Column:
    """True for null and for text a CSV reader would have read as missing."""
    return c.isNull() | c.cast("string").isin(*MISSING_MARKERS)


def null_if_missing(c: Column) -> Column:
    return F.when(~c.isin(*MISSING_MARKERS), c)


def clean_text(c: Column) -> Column:
    """Trimmed text, null where nothing but a missing marker is left."""
    return null_if_missing(strip(c))


def or_unknown(text: Column) -> Column:
    return F.coalesce(text, F.lit(UNKNOWN))


def number(text: Column) -> Column:
    """Double from text; what is unparseable or beyond the doubles becomes null."""
    value = text.try_cast("double")
    return F.when(text.rlike(NUMBER_CHARACTERS) & (F.abs(value) < float("inf")), value)
