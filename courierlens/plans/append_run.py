"""Adding logs to a stored fact table without the rows that are in it already.

Duplicate rows are known by a digest of all raw columns. Each part of the table keeps the
digests of its rows in a column of their own, and a Bloom filter of them as bitmaps. Of
a new log, digests that the filters don't have are new; only the others are looked up
among the stored digests, which are not read if there are none. No other column of
the stored rows ever is.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlens.operators.cleaning import clean_single, drop_duplicate_rows, strip_column_names
from courierlens.operators.quality import row_digest
from courierlens.schemas import CLEAN_SCHEMA
from courierlens.settings import DEFAULT, SlaConfig
from courierlens.sources import shared, versions

DIGEST = "row_digest"
#: Bits of a table's Bloom filters; a part's bitmaps take an eighth of that in bytes at most.
BLOOM_BITS = 1 << 30
#: Bits that are set for a digest.
PROBES = 4


def _places(bits: int) -> Column:
    """The places of a digest's bits, from 1 on."""
    return F.array(*[F.pmod(F.xxhash64(DIGEST, F.lit(i)), F.lit(bits)) + 1 for i in range(PROBES)])


def _bits_of(digests: DataFrame, bits: int) -> DataFrame:
    at = digests.select(DIGEST, F.explode(_places(bits)).alias("at"))
    return at.select(
        DIGEST, F.bitmap_bucket_number("at").alias("bucket"), F.bitmap_bit_position("at").alias("bit")
    )


def bloom(digests: DataFrame, bits: int = BLOOM_BITS) -> DataFrame:
    """``bucket, bitmap``: a Bloom filter of the digests in bitmaps of 4 KB."""
    return _bits_of(digests, bits).groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def perhaps_in(digests: DataFrame, filters: DataFrame, bits: int = BLOOM_BITS) -> DataFrame:
    """The distinct digests that all have their bits set in the filters; the others are in none."""
    joint = filters.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    byte = F.conv(F.hex(F.substring("bitmap", (F.floor(F.col("bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10)
    is_set = F.expr("shiftright(byte, cast(bit % 8 as int)) & 1")
    probed = _bits_of(digests, bits).join(joint, "bucket", "left").withColumn("byte", byte.cast("int"))
    found = probed.groupBy(DIGEST).agg(F.min(F.coalesce(is_set, F.lit(0))).alias("all_set"))
    return found.where("all_set = 1").select(DIGEST)


def stored_digests(spark: SparkSession, raw: DataFrame, path: str, version: versions.Version) -> DataFrame | None:
    """The digests of the raw rows that a version of the table holds; None if it holds none of them."""
    parts = version.details.get("parts", [])
    if not parts:
        return None
    filters = spark.read.parquet(*[f"{path}/{p}/bloom" for p in parts])
    digests = raw.select(DIGEST).distinct()
    maybe_path = shared.table_path(spark, f"maybe-{uuid4().hex}")
    perhaps_in(digests, filters, version.details["bits"]).write.parquet(maybe_path)
    maybe = spark.read.schema(f"{DIGEST} binary").parquet(maybe_path)
    if maybe.isEmpty():
        return None
    index = spark.read.schema(f"{DIGEST} binary").parquet(*[f"{path}/{p}/rows" for p in parts])
    return maybe.join(index, DIGEST, "left_semi")


def append_log(
    spark: SparkSession,
    raw: DataFrame,
    path: str,
    config: SlaConfig = DEFAULT,
    *,
    bits: int = BLOOM_BITS,
) -> versions.Version:
    """Clean the rows of a raw log that the table does not hold yet and add them as a part.

    The table is then what cleaning all logs together gives, as rows that are equal in
    all raw columns count once. Readers of the version before go on, a failed run changes
    nothing, and of two writers the second gets ``VersionConflict``: its rows were not
    compared with the first one's. All parts must be made with one configuration. ``bits``
    holds for a new table.
    """
    base = versions.newest(spark, path)
    bits = base.details.get("bits", bits)
    named = strip_column_names(raw)
    single = drop_duplicate_rows(named)
    keyed = single.withColumn(DIGEST, row_digest(single))
    known = stored_digests(spark, keyed, path, base)
    fresh = keyed if known is None else keyed.join(known, DIGEST, "left_anti")

    def write(folder: str) -> dict:
        cleaned = clean_single(fresh, config, DIGEST)
        # the digest is a column of the part's files; an index reads that one only
        cleaned.write.parquet(f"{folder}/rows")
        digests = spark.read.schema(f"{DIGEST} binary").parquet(f"{folder}/rows")
        bloom(digests, bits).write.parquet(f"{folder}/bloom")
        return {"parts": [*base.details.get("parts", []), folder.rsplit("/", 1)[1]], "bits": bits}

    return versions.replace(spark, path, write, base)


def appended(spark: SparkSession, path: str) -> DataFrame:
    """The fact table of all parts of the newest version."""
    parts = versions.newest(spark, path).details.get("parts", [])
    if not parts:
        return spark.createDataFrame([], CLEAN_SCHEMA)
    return spark.read.schema(CLEAN_SCHEMA).parquet(*[f"{path}/{p}/rows" for p in parts])
