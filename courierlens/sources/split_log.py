"""Large CSV files with quoted line breaks, shared between tasks.

A line break ends a record unless it stands in a quoted field. Whether it does
depends on all quotes before it, so a task that begins in the middle of a file
can't know by itself. Here it is told:

1. A pass over all lines counts quotes by block (the byte range that a task reads). A
   file without quoted line breaks goes to Spark's own reader in parts.
2. For the others, a second pass notes for each block whether its quotes change the
   state and whether they are well-formed, for either state before it. The states at the
   blocks' beginnings are running sums over a small table, a row for each block.
3. In the last pass each task starts from its block's state and joins lines to records.
   What belongs to a record that began in an earlier block is passed on and put
   together, at most two pieces a block.

Files whose quotes are not well-formed, and files of one block, are read whole by Spark's
reader: it alone says what their fields are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Suffixes of files that Spark reads from the beginning only.
COMPRESSED = (".gz", ".bz2", ".deflate", ".lz4", ".snappy", ".zst")

# A field of a record, one that is still open, and lines that begin outside and inside one.
_FIELD = r'(?:[^",]*|"[^"]*(?:""[^"]*)*")'
_OPENED = r'"[^"]*(?:""[^"]*)*'
_OUTSIDE = rf"^(?:{_FIELD},)*(?:{_FIELD}\r?|{_OPENED})$"
_INSIDE = rf'^[^"]*(?:""[^"]*)*(?:"(?:,{_FIELD})*(?:\r?|,{_OPENED}))?$'
# the same for a whole record, without going back
_ONLY = r'(?:[^",]*+|"[^"]*+(?:""[^"]*+)*+")'
_RECORD = rf"^(?:{_ONLY},)*+{_ONLY}\r?\z"


@dataclass(frozen=True)
class File:
    """A file: its path, bytes, and how the metadata of its lines spell the path."""

    path: str
    size: int
    url: str

    @property
    def literal(self) -> str:
        """The path for a reader that takes patterns."""
        return re.sub(r"([\[\]{}*?\\])", r"\\\1", self.path)


def listed(spark: SparkSession, path: str) -> list[File]:
    """The files that a CSV reader would read; no content is read."""
    files = spark.read.format("binaryFile").load(path)
    return [File(*row) for row in files.select("path", "length", "_metadata.file_path").collect()]


def _lines(spark: SparkSession, files: list[File]) -> DataFrame:
    """``file, block, url, value``: the lines, a number for their file and the start of their block.

    Lines of a block stand in one partition, in order.
    """
    return spark.read.text([f.literal for f in files], lineSep="\n").select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_path").alias("url"),
        "value",
    )


def plain_files(lines: DataFrame) -> set[str]:
    """The first pass: urls of the files whose every line is a whole record, all lines ending alike."""
    line, feed = F.col("value"), F.lit("\r")
    odd = line.contains('"') & ~line.rlike(_RECORD) | (line != "") & (F.trim(line) == "")
    found = lines.groupBy("url").agg(
        F.max(odd).alias("odd"),
        F.max(line.contains(feed)).alias("feeds"),
        F.max(F.instr(line, "\r") != F.length(line)).alias("others"),
    )
    return {r["url"] for r in found.where("NOT odd AND (NOT feeds OR NOT others)").collect()}


# --- the second pass


def _segments(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], pa.Array]]:
    """The lines of a batch by file and block."""
    file, block = (batch.column(c).to_numpy() for c in ("file", "block"))
    ends = np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1
    for lo, hi in zip([0, *ends], [*ends, len(file)]):
        if hi > lo:
            yield (int(file[lo]), int(block[lo])), batch.column("value").slice(lo, hi - lo)


def _quotes(lines: pa.Array) -> np.ndarray:
    return pc.count_substring(lines, '"').to_numpy(zero_copy_only=False).astype(np.int64)


def _wrong(lines: pa.Array, before: np.ndarray, counts: np.ndarray) -> bool:
    """Whether a line with quotes is not well-formed, given the state before each line."""
    for state, pattern in ((0, _OUTSIDE), (1, _INSIDE)):
        some = lines.filter(pa.array((counts > 0) & (before == state)))
        if len(some) and not pc.all(pc.match_substring_regex(some, pattern)).as_py():
            return True
    return False


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each run of lines of a block: its quotes, and what is wrong or ends for either state."""
    for batch in batches:
        out = []
        for (file, block), lines in _segments(batch):
            counts = _quotes(lines)
            after = np.cumsum(counts) % 2
            before = np.r_[0, after[:-1]]
            out.append({
                "file": file, "block": block, "odd": int(after[-1]),
                "wrong": [_wrong(lines, (before + s) % 2, counts) for s in (0, 1)],
                "ends": [bool(((after + s) % 2 == 0).any()) for s in (0, 1)],
                "feeds": lines[0].as_py().endswith("\r"),
                "returns": pc.any(pc.match_substring(lines, "\r")).as_py(),
            })
        if out:
            yield pa.RecordBatch.from_pylist(out, _MEASURED)


_MEASURED = pa.schema([
    ("file", pa.int64()), ("block", pa.int64()), ("odd", pa.int32()), ("wrong", pa.list_(pa.bool_())),
    ("ends", pa.list_(pa.bool_())), ("feeds", pa.bool_()), ("returns", pa.bool_()),
])
_MEASURES = (
    "file long, block long, odd int, wrong array<boolean>, ends array<boolean>, feeds boolean, returns boolean"
)


def blocks(lines: DataFrame) -> DataFrame:
    """A row for each block: ``file, block, state, origin, wrong, feeds``.

    ``state`` is 1 if the block begins in a quoted field; then ``origin`` is the block
    that holds the beginning of its record. ``feeds`` says that the file's first line ends
    with a carriage return, too, and ``wrong`` that its quotes are not well-formed or
    that there are carriage returns though the first line has none.
    """
    # lines of a block are in order within their task, where ids grow
    runs = lines.select("file", "block", "value").mapInArrow(_measure, _MEASURES)
    runs = runs.withColumn("run", F.monotonically_increasing_id())
    earlier = Window.partitionBy("file").orderBy("block", "run").rowsBetween(Window.unboundedPreceding, -1)
    told = runs.withColumn("state", (F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2).cast("int"))
    whole = told.groupBy("file", "block").agg(
        F.min_by("state", "run").alias("state"),
        F.min_by("feeds", "run").alias("feeds"),
        F.max("returns").alias("returns"),
        F.max(F.get("wrong", F.col("state"))).alias("wrong"),
        F.max(F.get("ends", F.col("state"))).alias("ends"),
        F.sum("odd").alias("odd"),
    )
    file, ordered = Window.partitionBy("file"), Window.partitionBy("file").orderBy("block")
    # a block holds the beginning of what is open at its end unless it is inside one record as a whole
    begins = F.when((F.col("state") == 0) | F.col("ends"), F.col("block"))
    feeds = F.first("feeds").over(ordered)
    wrong = F.max("wrong").over(file) | (F.sum("odd").over(file) % 2 == 1) | F.max("returns").over(file) & ~feeds
    return whole.select(
        "file",
        "block",
        "state",
        F.last(begins, ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, -1)).alias("origin"),
        wrong.alias("wrong"),
        feeds.alias("feeds"),
    )


# --- the third pass


def _assembling(origins: dict[tuple[int, int], int], feeds: set[int]):
    """Arrow function of lines in order: records, and the pieces of those that cross blocks."""
    schema = pa.schema(
        [("file", pa.int64()), ("origin", pa.int64()), ("block", pa.int64()), ("first", pa.bool_()), ("text", pa.string())]
    )

    def rows(file: int, origin: int | None, block: int, first: list[bool], texts) -> pa.RecordBatch:
        n = len(texts)
        same = lambda value: pa.array([value] * n, pa.int64())
        return pa.RecordBatch.from_arrays(
            [same(file), same(origin), same(block), pa.array(first, pa.bool_()), pa.array(texts, pa.string())],
            schema=schema,
        )

    def cut(lines: pa.Array, file: int) -> pa.Array:
        # where lines end with both marks, Spark's reader takes them for one in quotes, too
        return pc.replace_substring_regex(lines, "\r$", "") if file in feeds else lines

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, held, begun, fresh = None, 0, [], True, True

        def left() -> Iterator[pa.RecordBatch]:
            """What the block leaves open: a record of its own, or more of an earlier one's."""
            if key is not None and held:
                file, block = key
                own = block if begun else origins[key]
                yield rows(file, own, block, [fresh and own == 0], ["\n".join(held)])

        for batch in batches:
            for (file, block), lines in _segments(batch):
                if (file, block) != key:
                    yield from left()
                    key, held = (file, block), []
                    state = int(key in origins)
                    begun, fresh = state == 0, block == 0
                lines = cut(lines, file)
                after = (state + np.cumsum(_quotes(lines))) % 2
                state = int(after[-1])
                ends = np.flatnonzero(after == 0)
                if not len(ends):
                    held.extend(lines.to_pylist())
                    continue
                parts = pa.ListArray.from_arrays(
                    pa.array(np.r_[0, ends + 1], pa.int32()), lines.slice(0, int(ends[-1]) + 1)
                )
                records = pc.binary_join(parts, "\n")
                head = ["\n".join([*held, *lines.slice(0, int(ends[0]) + 1).to_pylist()])]
                if not begun:
                    yield rows(file, origins[key], block, [False], head)
                else:
                    yield rows(file, None, block, [fresh], head)
                if len(records) > 1:
                    yield rows(file, None, block, [False] * (len(records) - 1), records[1:])
                begun, fresh = True, False
                held = lines.slice(int(ends[-1]) + 1).to_pylist()
        yield from left()

    return assemble


_PIECES = "file long, origin long, block long, first boolean, text string"


def records(lines: DataFrame, origins: dict[tuple[int, int], int], feeds: set[int]) -> DataFrame:
    """``first, text`` of each record of the lines; ``first`` marks the first one of its file.

    ``origins`` has the blocks that begin in a quoted field with the block in which their
    record begins, ``feeds`` the files with carriage returns.
    """
    pieces = lines.select("file", "block", "value").mapInArrow(_assembling(origins, feeds), _PIECES)
    whole = pieces.where("origin IS NULL").select("first", "text")
    if not origins:
        return whole
    held = F.array_sort(F.collect_list(F.struct("block", "text")))
    parted = pieces.where("origin IS NOT NULL").groupBy("file", "origin").agg(
        F.max("first").alias("first"), F.array_join(held["text"], "\n").alias("text")
    )
    return whole.unionByName(parted.select("first", "text"))


def _parsed(found: DataFrame, schema: T.StructType, options: dict) -> DataFrame:
    """Columns of records; first records must name them in the order of the schema."""
    how = {k: str(v) for k, v in options.items()}
    how |= {"mode": "FAILFAST", "columnPruning": "false", "multiLine": "true", "lineSep": "\n"}
    quoted = ["`" + name.replace("`", "``") + "`" for name in schema.names]
    row = F.from_csv("text", ", ".join(f"{name} string" for name in quoted), how)
    named = F.array(*[F.lower(F.col(f"row.{name}")) for name in quoted])
    wanted = F.array(*[F.lit(name.lower()) for name in schema.names])
    message = F.concat(F.lit("a file has another header: "), F.col("text"))
    kept = F.when(~F.col("first"), True).when(named == wanted, False).otherwise(F.raise_error(message).cast("boolean"))
    return found.where("text <> ''").withColumn("row", row).where(kept).select("row.*")


def scan(spark: SparkSession, path: str, schema: T.StructType, part_bytes: int | None = None, **options) -> DataFrame:
    """The rows of headered CSV files as text columns, large files shared between tasks.

    The rows are those of Spark's reader with ``multiLine``, and so are the errors:
    a line with too many or too few fields or a file with other column names fails the
    run. ``part_bytes`` is the size above which a file is shared, by default that of a
    split. A shared file is read twice, one with quoted line breaks four times (the last pass
    once for whole records and once for pieces). All
    passes but the last run when this is called; the driver gets a row for each file,
    and one for each block that begins in a quoted field.
    """
    files = listed(spark, path)
    most = part_bytes or spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes")
    )
    large = [f for f in files if f.size > most and not f.path.endswith(COMPRESSED)]

    def read(paths: list[str], multi: bool) -> DataFrame:
        return spark.read.option("columnPruning", False).csv(
            paths, schema=schema, header=True, enforceSchema=False, mode="FAILFAST", multiLine=multi, **options
        )

    if not large:
        return read([path], multi=True)
    found, whole = [], [f for f in files if f not in set(large)]
    alike = plain_files(_lines(spark, large))
    if plain := [f.literal for f in large if f.url in alike]:
        found.append(read(plain, multi=False))
    if others := [f for f in large if f.url not in alike]:
        lines = _lines(spark, others)
        known = blocks(lines).where("state = 1 OR wrong OR feeds").collect()
        wrong = {r["file"] for r in known if r["wrong"]}
        ids = {r["url"]: r["file"] for r in lines.select("url", "file").distinct().collect()} if wrong else {}
        whole += [f for f in others if ids.get(f.url) in wrong and wrong]
        if parted := [f for f in others if not wrong or ids.get(f.url) not in wrong]:
            origins = {(r["file"], r["block"]): r["origin"] for r in known if r["state"] and not r["wrong"]}
            feeds = {r["file"] for r in known if r["feeds"]}
            found.append(_parsed(records(_lines(spark, parted), origins, feeds), schema, options))
    if whole:
        found.append(read([f.literal for f in whole], multi=True))
    return reduce(DataFrame.unionByName, found)
