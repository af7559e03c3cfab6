"""The cleaned fact table: Parquet store, SQL name, build-once guard, cache."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import asdict
from hashlib import sha256
from uuid import uuid4

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from courierlens.schemas import CLEAN_SCHEMA
from courierlens.session import build_session
from courierlens.settings import DEFAULT, SlaConfig
from courierlens.sources import shared, versions
from courierlens.sources.layout import Layout
from courierlens.sources.layout import write as write_clustered

TABLE_NAME = "deliveries"
VERSIONS = "time long, folder string, made_with string, figures string"


def scan_clean(spark: SparkSession, path: str | list[str], fmt: str = "parquet") -> DataFrame:
    """The stored fact table, with its declared schema rather than a guess.

    Of a table with versions the newest; of another folder all files.
    """
    version = versions.newest(spark, path) if isinstance(path, str) else versions.Version(0)
    folder = f"{path}/{version.folder}" if version.number else path
    reader = spark.read.schema(CLEAN_SCHEMA)
    return reader.options(**_options(fmt)).format(fmt).load(folder).select(*CLEAN_SCHEMA.names)


def sink_clean(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    *,
    base: versions.Version | None = None,
    layout: Layout | None = None,
) -> versions.Version:
    """Write the fact table as a new version that replaces the one there.

    Readers of the version before go on, a failed write changes nothing, and a writer
    gets ``VersionConflict`` if another one has committed since ``base`` (by default
    since this call). The newest two versions are kept. With a ``layout`` the rows are
    stored clustered (Parquet only).
    """
    spark = df.sparkSession
    version = versions.replace(spark, path, lambda folder: write_table(df, folder, fmt, layout), base)
    versions.clear(spark, path)
    return version


def write_table(df: DataFrame, folder: str, fmt: str = "parquet", layout: Layout | None = None) -> None:
    """Plain files in a new folder."""
    if layout is None:
        df.write.options(**_options(fmt)).format(fmt).save(folder)
    elif fmt == "parquet":
        write_clustered(df, folder, layout)
    else:
        raise ValueError("only Parquet files can be clustered")


def _options(fmt: str) -> dict[str, bool]:
    return {"header": True} if fmt == "csv" else {}


def register_table(
    df: DataFrame, name: str = TABLE_NAME, *, path: str | None = None
) -> DataFrame:
    """Publish the fact rows under a SQL name, replacing an older table.

    Without a path the name is a view; with one it is a saved table there.
    """
    if path is None:
        df.createOrReplaceTempView(name)
    else:
        df.write.mode("overwrite").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def _made_with(config: SlaConfig) -> str:
    """Short name of the configuration and the schema a table is built with."""
    text = json.dumps([asdict(config), CLEAN_SCHEMA.jsonValue()], sort_keys=True)
    return sha256(text.encode()).hexdigest()[:16]


def current_folder(
    spark: SparkSession, path: str, config: SlaConfig = DEFAULT
) -> str | None:
    """Folder of the newest table built with this configuration and schema."""
    newest = _newest(spark, path, config)
    return newest and f"{path}/{newest['folder']}"


def _newest(spark: SparkSession, path: str, config: SlaConfig) -> Row | None:
    noted = f"{path}/versions"
    if not shared.exists(spark, noted):
        return None
    fitting = spark.read.schema(VERSIONS).parquet(noted).where(F.col("made_with") == _made_with(config))
    return fitting.orderBy(F.desc("time")).first()


def build_if_missing(
    spark: SparkSession,
    path: str,
    build: Callable[[SparkSession], DataFrame],
    config: SlaConfig = DEFAULT,
    *,
    refresh: bool = False,
    partitions: int | None = None,
    observed: dict[str, Column] | None = None,
) -> DataFrame:
    """The table stored under ``path``, built unless one of this configuration is there.

    ``build`` gets a session of its own (``build_session``). Each build goes to a
    new folder and is noted in the list of versions once it is complete: readers of
    an older version go on, and a failed build changes nothing. Older folders stay
    until their owner removes them. ``observed`` are aggregates over the rows that
    ``build`` gives, which may have columns beside the table's; they are computed as the
    rows are written and noted with the version (``build_figures``).
    """
    folder = None if refresh else current_folder(spark, path, config)
    if folder is None:
        name = f"build-{uuid4().hex}"
        folder = f"{path}/{name}"
        figures = Observation(name)
        built = build(build_session(spark, partitions))
        if observed:
            built = built.observe(figures, *[c.alias(k) for k, c in observed.items()])
        write_table(built.select(*CLEAN_SCHEMA.names), folder)
        found = json.dumps(figures.get, default=str) if observed else None
        _note(spark, path, name, config, found)
    return scan_clean(spark, folder)


def _note(spark: SparkSession, path: str, folder: str, config: SlaConfig, figures: str | None) -> None:
    note = spark.createDataFrame([(time.time_ns(), folder, _made_with(config), figures)], VERSIONS)
    note.coalesce(1).write.mode("append").parquet(f"{path}/versions")


def build_figures(spark: SparkSession, path: str, config: SlaConfig = DEFAULT) -> dict | None:
    """What was observed while the newest table of this configuration was built."""
    row = _newest(spark, path, config)
    return json.loads(row["figures"]) if row and row["figures"] else None


def recluster(
    spark: SparkSession, path: str, layout: Layout = Layout(), config: SlaConfig = DEFAULT
) -> DataFrame:
    """Store the newest table of this configuration once more, clustered; it becomes the newest."""
    row = _newest(spark, path, config)
    if row is None:
        raise ValueError(f"no table of this configuration in {path}")
    name = f"build-{uuid4().hex}"
    write_clustered(scan_clean(spark, f"{path}/{row['folder']}"), f"{path}/{name}", layout)
    _note(spark, path, name, config, row["figures"])
    return scan_clean(spark, f"{path}/{name}")


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Keep ``df`` for the queries of one block and release it afterwards."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()
