"""A session of its own for building tables, so the caller's stays as it is."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Whole-stage code of the wide cleaning projections is one method of many
# thousand bytes. HotSpot compiles such a method late, and above 8000 bytes
# never; Spark's own limit is 65535. Below this one, Spark falls back to several
# small methods there, which run faster, and keeps whole-stage code for everything
# narrower. Results do not depend on it.
METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "4000")


def build_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A new session with the caller's settings and those of a build.

    ``partitions`` is the number of shuffle partitions; the wide step of cleaning
    moves whole rows, so choose it for about 200 MB of rows each (500,000 at
    100 TB). Without it the caller's number holds. Adaptive execution merges
    partitions that turn out small.
    """
    session = spark.newSession()
    chosen = {row["key"]: row["value"] for row in spark.sql("SET").collect()}
    for key, value in chosen.items():
        if spark.conf.isModifiable(key):
            session.conf.set(key, value)
    if METHOD_LIMIT[0] not in chosen:
        session.conf.set(*METHOD_LIMIT)
    if partitions is not None:
        session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return session
