"""Small tables with the awkward rows that every operator has to bear."""

from __future__ import annotations

LONG = "word " * 40_000 + "end"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Nulls in every column, empty and blank texts, a very long one, copies and repeated rows.
ROWS = [
    (1, "the cat sat on the mat and looked at the moon for a long time", "en", "b", 1),
    (2, "the cat sat on the mat and looked at the moon for a long time", "en", "a", 1),
    (2, "the cat sat on the mat and looked at the moon for a long time", "en", "a", 1),
    (3, "", "en", "a", 0),
    (4, None, None, None, None),
    (5, " \t\n", "de", "a", 3),
    (6, LONG, "en", "c", 1),
    (7, "der Hund lief über die Brücke und bellte die ganze Nacht", "de", None, 1),
    (None, "der Hund lief über die Brücke und bellte die ganze Nacht", "de", "a", 1),
    (8, "12345 67890 !!", None, "c", 1),
    (9, "only two", "en", "d", 1),
]

#: Names that operators use inside, as columns of the input.
CLASH = [
    "size", "source_size", "target", "copies", "rate", "from", "digest", "salt", "part", "print", "root",
    "component_id", "keep_id", "kept", "found", "number", "copy", "shard", "slot", "run", "Part", "a.b",
]


def docs(spark, rows=None):
    return spark.createDataFrame(ROWS if rows is None else rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def clashing(spark, rows=None):
    from pyspark.sql import functions as F

    taken, found = set(), docs(spark, rows)
    for name in CLASH:
        if name.lower() not in taken:
            found = found.withColumn(name, F.lit("x"))
            taken.add(name.lower())
    return found
