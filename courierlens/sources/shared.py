"""Where derived tables live, and which version of a source they come from."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

ROOT_SETTING = "spark.checkpoint.dir"

Version = tuple[int, int, int]
_versions: dict[tuple[str, str], Version] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder that the driver and every executor reach.

    What ``spark.checkpoint.dir`` names; where that is unset, a folder in the
    warehouse. Never a folder of one machine's own: on a cluster a warehouse on a
    local disk is an error.
    """
    named = spark.conf.get(ROOT_SETTING, "")
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    local = spark.conf.get("spark.master", "local").split("[")[0] == "local"
    if not local and (warehouse.startswith("file:") or "://" not in warehouse):
        raise RuntimeError(f"set {ROOT_SETTING} to a folder that all executors share; {warehouse} is one machine's own")
    return f"{warehouse}/_scratch"


def table_path(spark: SparkSession, *parts: str) -> str:
    """Path of a derived table, kept apart per application."""
    app = spark.sparkContext.applicationId
    return "/".join((shared_root(spark), "courierlens", app, *parts))


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def is_complete(spark: SparkSession, path: str) -> bool:
    """True once the write that filled ``path`` has committed."""
    return exists(spark, f"{path}/_SUCCESS")


def stored_version(spark: SparkSession, path: str, *, refresh: bool = False) -> Version:
    """Number of files under ``path``, their bytes and the newest one's time.

    Listed by Spark once per application and path, then remembered; ``refresh``
    lists again. A rewrite of equal size shows in the time of its files.
    """
    key = (spark.sparkContext.applicationId, path)
    if refresh or key not in _versions:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        row = files.agg(
            F.count("path"),
            F.coalesce(F.sum("length"), F.lit(0)),
            F.coalesce(F.max(F.unix_micros("modificationTime")), F.lit(0)),
        ).first()
        _versions[key] = tuple(row)
    return _versions[key]
