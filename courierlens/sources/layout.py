"""Clustering of a stored table on several filter columns at once.

Rows are sorted along a space-filling curve: each column's values are cut into ranges of
about equal numbers of rows, and the bits of the ranges' numbers are interleaved. Rows
that agree in the high bits of all columns then stand together, so a row group covers a
narrow range of each, and a filter on any of them skips most row groups by their
statistics. Columns looked up by single values get Parquet Bloom filters.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of a column's range number: 16 ranges.
BITS = 4
ACCURACY = 10_000


@dataclass(frozen=True)
class Layout:
    """Columns to cluster by, to keep in folders of their own, and to look up by value."""

    by: tuple[str, ...] = ("city", "traffic_density", "weather", "vehicle_type", "festival", "peak_period", "order_type")
    folders: tuple[str, ...] = ()
    lookups: tuple[str, ...] = ("order_id", "delivery_person_id")
    bits: int = BITS
    files: int | None = None
    row_group_bytes: int | None = None


def as_number(column: Column, kind: T.DataType) -> Column:
    """A number in the order of the values; of texts their first seven bytes count."""
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(column.cast("binary"), 1, 7)), 14, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    return column.cast("double")


def splitters(df: DataFrame, columns: tuple[str, ...], bits: int = BITS) -> dict[str, list[float]]:
    """Ends of ranges of about equal numbers of rows for each column, from one pass.

    At most two to the power of ``bits``, less one, for each column; a value of many rows
    takes several ranges' share but is one end.
    """
    points = F.array(*[F.lit(i / 2**bits) for i in range(1, 2**bits)])
    row = df.agg(*[
        F.percentile_approx(as_number(F.col(c), df.schema[c].dataType), points, F.lit(ACCURACY)).alias(f"c{i}")
        for i, c in enumerate(columns)
    ]).first()
    return {c: sorted(set(ends or [])) for c, ends in zip(columns, row)}


def curve_key(df: DataFrame, ends: dict[str, list[float]], bits: int = BITS) -> Column:
    """The place of a row on the curve; nulls are in the first range of their column."""
    places = []
    for name, marks in ends.items():
        value = as_number(F.col(name), df.schema[name].dataType)
        above = [F.when(value >= mark, 1).otherwise(0) for mark in marks]
        places.append(sum(above, F.lit(0)).cast("long"))
    key = F.lit(0).cast("long")
    for bit in range(bits):
        for i, place in enumerate(places):
            one = F.shiftright(place, bit).bitwiseAND(F.lit(1))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(places) + len(places) - 1 - i))
    return key


def write(df: DataFrame, path: str, layout: Layout = Layout()) -> None:
    """Parquet files clustered by the layout; the rows and columns are those of df.

    ``df`` should be a stored table: it is read for the ends, for the sort's sample and
    for the sort. ``files`` is the number of files, by default that of shuffle partitions.
    """
    if len(layout.by) * layout.bits > 62:
        raise ValueError("too many columns for a key of 62 bits")
    key = "curve"
    while key in df.columns:
        key += "_"
    keyed = df.withColumn(key, curve_key(df, splitters(df, layout.by, layout.bits), layout.bits))
    order = [*layout.folders, key]
    files = layout.files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keyed.repartitionByRange(files, *order).sortWithinPartitions(*order).drop(key)
    writer = dealt.write
    for name in layout.lookups:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    if layout.row_group_bytes:
        writer = writer.option("parquet.block.size", layout.row_group_bytes)
    if layout.folders:
        writer = writer.partitionBy(*layout.folders)
    writer.parquet(path)
