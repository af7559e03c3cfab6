"""Versions of a stored table: a folder of data each, committed by compare-and-set.

A table's folder holds ``_versions/<number>.json``, one small file for each version, which
names the folder with its data. A writer notes the newest number, writes data into a
folder of its own and then creates the next number's file by a rename that fails where
the name is taken. So readers see a whole version or the one before, a failed write
changes nothing, and of two writers that began at the same version one is told.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any
from uuid import uuid4

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

FOLDER = "_versions"


class VersionConflict(RuntimeError):
    """Another writer has committed a version since this one began."""


@dataclass(frozen=True)
class Version:
    """A committed version; number 0 stands for none yet."""

    number: int
    folder: str | None = None
    details: dict[str, Any] = field(default_factory=dict)


def _path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """A Hadoop path and its file system."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str) -> list[int]:
    at, files = _path(spark, f"{path}/{FOLDER}")
    if not files.exists(at):
        return []
    names = [status.getPath().getName() for status in files.listStatus(at)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def read(spark: SparkSession, path: str, number: int) -> Version:
    at, files = _path(spark, f"{path}/{FOLDER}/{number:012d}.json")
    stream = files.open(at)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Version(number, **json.loads(text))


def newest(spark: SparkSession, path: str) -> Version:
    numbers = _numbers(spark, path)
    return read(spark, path, numbers[-1]) if numbers else Version(0)


def commit(spark: SparkSession, path: str, base: Version, folder: str, details: dict[str, Any] | None = None) -> Version:
    """Make a folder the version after ``base``; ``VersionConflict`` if there is one already."""
    made = Version(base.number + 1, folder, details or {})
    context = spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _path(spark, path)[1].getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    draft, files = _path(spark, f"{path}/{FOLDER}/.draft-{uuid4().hex}")
    stream = files.create(draft, False)
    stream.write(bytearray(json.dumps({"folder": made.folder, "details": made.details}).encode()))
    stream.close()
    final = _path(spark, f"{path}/{FOLDER}/{made.number:012d}.json")[0]
    options = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(context.makeQualified(draft), context.makeQualified(final), options)
    except Py4JJavaError as error:
        files.delete(draft, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            raise VersionConflict(f"{path} has had version {made.number} since version {base.number} was read") from None
        raise
    return made


def replace(
    spark: SparkSession, path: str, write: Callable[[str], dict[str, Any] | None], base: Version | None = None
) -> Version:
    """Write a new version: ``write`` fills the folder it is given and may return details.

    Without ``base`` the newest version at the beginning is replaced. What a failed write
    or a writer that came second leaves is removed.
    """
    base = newest(spark, path) if base is None else base
    folder = f"data={uuid4().hex}"
    try:
        return commit(spark, path, base, folder, write(f"{path}/{folder}"))
    except BaseException:
        remove(spark, f"{path}/{folder}")
        raise


def remove(spark: SparkSession, path: str) -> None:
    at, files = _path(spark, path)
    files.delete(at, True)


def clear(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove all versions but the newest ``keep``; their readers must have ended."""
    for number in _numbers(spark, path)[:-keep]:
        old = read(spark, path, number)
        remove(spark, f"{path}/{old.folder}")
        remove(spark, f"{path}/{FOLDER}/{number:012d}.json")
