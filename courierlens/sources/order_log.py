"""Reading and writing the raw order log as headered CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courierlens.functions import text
from courierlens.operators.cleaning import strip_column_names
from courierlens.schemas import RAW_SCHEMA
from courierlens.sources import split_log


def scan_raw(spark: SparkSession, path: str, *, splittable: bool = False) -> DataFrame:
    """Order log with the declared types, columns matched by header name.

    Everything is read as text, so no inference pass runs over the data. A quoted
    field may hold line breaks; files larger than a split are shared between tasks
    all the same (``split_log``). ``splittable`` reads logs known to have no such breaks
    without looking for them. A line with too many or too few fields fails the run,
    and so does a file whose header differs from the first one's: no value ends up in
    another column. For that the reader always parses whole lines. A missing path or
    column raises ``AnalysisException``.
    """
    header = spark.read.csv(path, header=True, inferSchema=False, escape='"').columns
    texts = T.StructType([T.StructField(name, T.StringType()) for name in header])
    if splittable:
        log = spark.read.option("columnPruning", False).csv(
            path, schema=texts, header=True, enforceSchema=False, mode="FAILFAST", escape='"'
        )
    else:
        log = split_log.scan(spark, path, texts, escape='"')
    named = strip_column_names(log)
    return named.select(*[_typed(field) for field in RAW_SCHEMA])


def _typed(field: T.StructField):
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return text.null_if_missing(c).alias(field.name)
    return text.number(c).cast(field.dataType).alias(field.name)


def write_raw(df: DataFrame, path: str) -> None:
    """CSV with padding kept; Spark's writer would strip it by default."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
