"""What the operators share: the scratch folder, fresh column names, skew-safe joins."""

from __future__ import annotations

from collections.abc import Iterable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlens.sources.shared import shared_root

#: Parts that the rows of one key are dealt to before they meet.
SALTS = 64


def scratch_root(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is what ``spark.checkpoint.dir`` names; where that is unset, a folder in the
    session's warehouse, which must not be one machine's own on a cluster.
    """
    return shared_root(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written to the shared folder and read back: cuts the lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(columns: Iterable[str], name: str) -> str:
    """A column name that none of the columns has, in any case of letters."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def salt(column: str, salts: int = SALTS) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(salts)).cast("int")


def attach(
    rows: DataFrame, labels: DataFrame, key: str, spread: str, salts: int = SALTS, how: str = "inner"
) -> DataFrame:
    """Join labels (one row for each key) to rows, though one key may hold a third of the rows.

    Rows are dealt by key and a salt of the column ``spread``. Each pair of key and
    salt that occurs gets its label first, at most ``salts`` rows for a key; the
    rows then meet only the label of their own pair. Null keys don't match. ``how`` may be
    left: rows of keys without a label stay, those of null keys go.
    """
    part = fresh([*rows.columns, *labels.columns], "part")
    dealt = rows.withColumn(part, salt(spread, salts))
    pairs = dealt.select(key, part).distinct().join(labels, key, how)
    return dealt.join(pairs, [key, part]).drop(part)
