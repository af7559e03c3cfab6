"""WARC archives: writing with revisit records, and a reader that salvages damaged ones.

Each record is a gzip member of its own. Spark's text writer stores them: the line
separator is an empty member, so a file is a valid sequence of members, written and
committed like any other output, to any store that Spark writes to. The reader checks
each member and record (CRC, length, digests); after a failed check it searches for the
next member or version line that is valid, goes on there, and reports the bytes between
as a gap. In a member whose own check holds it searches for the next version line only, so a
bad record costs no other one. Archives of other makers are read as well: records without
an HTTP block or digests, ids of any form, digests in any common notation.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlens.llm.common import attach, same, scratch_path, written

#: Payloads of fewer bytes are always stored.
REVISIT_BYTES = 1000
#: Bytes of records, before compression, from which on a file gets no more; a reader's task holds one file.
FILE_BYTES = 64 << 20
#: Bytes of a name in a gzip header and of a record's header at most.
NAME_BYTES = 4 << 10
HEADER_BYTES = 64 << 10
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
_MAGIC = b"\x1f\x8b\x08"
_VERSION = b"WARC/1."
_VERSION_LINE = re.compile(rb"WARC/1\.[0-9]\r\n")
_FIELD = re.compile(rb"([!#-'*+.0-9A-Z^-z|~-]+):([^\x00-\x08\x0a-\x1f]*)")
_PAGE = re.compile("<urn:x-page:(-?[0-9]{1,19})>")
_END = b"\r\n\r\n"
_LENGTH = re.compile(rb"(?i)\r\ncontent-length:[ \t]*([0-9]{1,18})[ \t]*\r\n")
_FEED = 65_536


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data, usedforsecurity=False).digest()).decode()


def _name(page: int | None) -> str:
    return f"<urn:x-page:{'' if page is None else page}>"


def _page(name: str | None) -> int | None:
    """The number in a record id of this module; None for other ids."""
    found = _PAGE.fullmatch(name or "")
    return int(found[1]) if found else None


def _digest_of(data: bytes, stated: str) -> str | None:
    """The hex digest of the data if it is the stated one, None if the notation is unknown.

    ``algorithm:value``, the value in base 32 or hex.
    """
    name, _, value = stated.partition(":")
    if (name := name.strip().lower().replace("-", "")) not in ("md5", "sha1", "sha256", "sha512"):
        return None
    digest = hashlib.new(name, data, usedforsecurity=False)
    known = {digest.hexdigest(), base64.b32encode(digest.digest()).decode().rstrip("=").lower()}
    if value.strip().rstrip("=").lower() not in known:
        raise Damaged("digest differs")
    return digest.hexdigest()


def _hex(stated: str) -> str | None:
    """A stated digest in hex, if it is one."""
    value = stated.partition(":")[2].strip()
    if re.fullmatch("(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{64}|[0-9a-fA-F]{128})", value):
        return value.lower()
    try:
        return base64.b32decode(value.rstrip("=") + "=" * (-len(value.rstrip("=")) % 8), casefold=True).hex()
    except ValueError:
        return None


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None = None) -> bytes:
    """A response record of the payload, or a revisit record if refers_to is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _name(page)),
        ("WARC-Target-URI", "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in url or "")),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", _sha1(payload)),
        ("WARC-Block-Digest", _sha1(block)),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if refers_to is not None:
        head += [("WARC-Refers-To", _name(refers_to)), ("WARC-Profile", PROFILE)]
    head.append(("Content-Length", str(len(block))))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + _END


class Damaged(Exception):
    """What is at this place is no whole, valid record."""


def _check_member_header(data: bytes, at: int) -> None:
    """Refuses what no gzip writer makes, so that a search does not read on to a distant end."""
    flags, pos = data[at + 3 : at + 4], at + 10
    if not flags or flags[0] & 0xE0:
        raise Damaged("member has no header")
    if flags[0] & 4:
        pos += 2 + int.from_bytes(data[pos : pos + 2], "little")
    for mark in (8, 16):  # a name and a comment, each up to a zero byte
        if flags[0] & mark:
            pos = data.find(b"\0", pos, pos + NAME_BYTES) + 1
            if not pos:
                raise Damaged("member has no header")


def _member(data: bytes, at: int) -> tuple[bytes, int]:
    """The content of the gzip member at a place, and where it ends."""
    _check_member_header(data, at)
    unpack, parts, pos = zlib.decompressobj(31), [], at
    while not unpack.eof:
        if pos >= len(data):
            raise Damaged("member is cut off")
        try:
            parts.append(unpack.decompress(data[pos : pos + _FEED]))
        except zlib.error as error:
            raise Damaged(f"member: {error}") from error
        pos += _FEED
    return b"".join(parts), min(pos, len(data)) - len(unpack.unused_data)


def _record(data: bytes, at: int) -> tuple[dict, int]:
    """The checked record whose version line is at a place, and where it ends.

    Lines of the header are read one by one, so what is no header costs no more than
    its first bad line.
    """
    if not (version := _VERSION_LINE.match(data, at)):
        raise Damaged("no version line")
    head, last, start = {}, "", version.end()
    while True:
        stop = data.find(b"\r\n", start, at + HEADER_BYTES)
        if stop < 0:
            raise Damaged("header is cut off or too long")
        if stop == start:
            break
        line = data[start:stop]
        if last and line[:1] in (b" ", b"\t"):  # a value goes on
            head[last] += " " + line.strip(b" \t").decode("utf-8", "replace")
        elif field := _FIELD.fullmatch(line):
            last = field[1].decode().lower()
            head[last] = field[2].strip(b" \t").decode("utf-8", "replace")
        else:
            raise Damaged("header holds other bytes")
        start = stop + 2
    body, length = start + 2, head.get("content-length", "")
    if not (length.isascii() and length.isdigit() and len(length) < 16):
        raise Damaged("no content length")
    end = body + int(length)
    if data[end : end + 4] != _END:
        raise Damaged("block does not end where it should")
    block = data[body:end]
    if stated := head.get("warc-block-digest"):
        _digest_of(block, stated)
    return {"head": head, "block": block}, end + 4


def _row(found: dict) -> dict:
    """A record's result columns; checks the payload's digest.

    The payload of an HTTP record is what follows its header, that of another record
    its block. A revisit has none; its size is the content length of its HTTP header.
    """
    head, block = found["head"], found["block"]
    stated, kind = head.get("warc-payload-digest", ""), head.get("warc-type")
    http, mark, payload = block.partition(_END)
    if not (mark and "application/http" in head.get("content-type", "").lower()):
        payload = block
    if kind == "revisit":
        line = _LENGTH.search(http + b"\r\n")
        size, digest, payload = int(line[1]) if line else None, _hex(stated), None
    else:
        size = len(payload)
        digest = _digest_of(payload, stated) if stated else None
        digest = digest or hashlib.sha1(payload, usedforsecurity=False).hexdigest()
    return {
        "record_id": head.get("warc-record-id"),
        "page_id": _page(head.get("warc-record-id")),
        "url": head.get("warc-target-uri"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": _page(head.get("warc-refers-to")) if kind == "revisit" else None,
        "payload": payload,
    }


class _Places:
    """The next place that may begin a member or a record; each mark is looked for once."""

    def __init__(self, data: bytes, marks: tuple[bytes, ...]):
        self.data, self.found = data, dict.fromkeys(marks, -1)

    def after(self, at: int) -> int:
        for mark, place in self.found.items():
            if place < at:
                next_one = self.data.find(mark, at)
                self.found[mark] = next_one if next_one >= 0 else len(self.data)
        return min(self.found.values())


def _records(content: bytes) -> Iterator[tuple[int, int, dict | None, str | None]]:
    """Records and gaps of a member's content, by their places in it."""
    places, pos, gap, reason = _Places(content, (_VERSION,)), 0, None, ""
    while pos < len(content):
        if content[pos : pos + 1] in (b"\r", b"\n") and gap is None:
            pos += 1
            continue
        try:
            found, end = _record(content, pos)
            row = _row(found)
        except Damaged as error:
            if gap is None:
                gap, reason = pos, str(error)
            pos = places.after(pos + 1)
            continue
        if gap is not None:
            yield gap, pos - gap, None, reason
            gap = None
        yield pos, end - pos, row, None
        pos = end
    if gap is not None:
        yield gap, len(content) - gap, None, reason


def salvage(data: bytes) -> Iterator[tuple[int, int, dict | None, str | None]]:
    """``(offset, length, record, None)`` of each valid record and ``(offset, length, None, reason)`` of each gap.

    Records and gaps, with the blank lines and empty members between, make up the
    whole file. What stands in one member has the member's place; a gap within a member
    says so in its reason. A member in which no record is found is a gap.
    """
    places, pos, gap, reason = _Places(data, (_MAGIC, _VERSION)), 0, None, ""
    while pos < len(data):
        try:
            if data.startswith(_MAGIC, pos):
                content, end = _member(data, pos)
                rows = list(_records(content))
                if rows and not any(row for _, _, row, _ in rows):
                    raise Damaged(rows[0][3])
            elif data[pos : pos + 1] in (b"\r", b"\n") and gap is None:
                pos += 1
                continue
            else:
                found, end = _record(data, pos)
                rows = [(0, end - pos, _row(found), None)]
        except Damaged as error:
            if gap is None:
                gap, reason = pos, str(error)
            pos = places.after(pos + 1)
            continue
        if gap is not None:
            yield gap, pos - gap, None, reason
            gap = None
        for at, size, row, why in rows:
            yield pos, end - pos, row, why and f"{why}, {size} bytes from {at} of a member"
        pos = end
    if gap is not None:
        yield gap, len(data) - gap, None, reason


_KIND = {
    "path": pa.string(), "offset": pa.int64(), "length": pa.int64(), "gap": pa.string(),
    "record_id": pa.string(), "page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(),
    "refers_to": pa.int64(), "payload": pa.binary(),
}
_SQL = {pa.string(): "string", pa.int64(): "long", pa.binary(): "binary"}
#: Records handed on at once.
_ROWS = 500


def _reading(columns: list[str]):
    schema = pa.schema([(c, _KIND[c]) for c in columns])

    def read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                path, data = batch.column("path")[i].as_py(), batch.column("content")[i].as_py()
                rows = []
                for offset, length, row, gap in salvage(data):
                    rows.append({"path": path, "offset": offset, "length": length, "gap": gap} | (row or {}))
                    if len(rows) == _ROWS:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return read_files


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """All records and gaps of the archives in a folder, one a row.

    Of a gap, ``gap`` is the reason and only path, offset and length are set besides.
    ``records`` and ``gaps`` tell them apart. Plain records and gzip members may
    alternate in a file. ``payload=False`` leaves the column payload out.
    """
    columns = [c for c in _KIND if payload or c != "payload"]
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_reading(columns), ", ".join(f"{c} {_SQL[_KIND[c]]}" for c in columns))


def records(found: DataFrame) -> DataFrame:
    return found.where("gap IS NULL").drop("gap", "path", "offset", "length")


def gaps(found: DataFrame) -> DataFrame:
    """The log of quarantined bytes: path, offset, length, gap (the reason)."""
    return found.where("gap IS NOT NULL").select("path", "offset", "length", "gap")


def _members(file_bytes: int):
    """Arrow function of pages: each record's gzip member, and the number of the file in its task."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = held = 0
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS).to_pydict()
                out, files = [], []
                for page, url, html, refers in zip(
                    part["page_id"], part["url"], part["html"], part["refers_to"], strict=True
                ):
                    whole = record(page, url, html.encode(), refers)
                    if held and held + len(whole) > file_bytes:
                        file, held = file + 1, 0
                    held += len(whole)
                    out.append(gzip.compress(whole, 5, mtime=0))
                    files.append(file)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(files, pa.int32())], ["member", "file"])

    return members


def revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """``page_id, digest, refers_to`` of the pages (page_id, html) that repeat a payload of a larger id."""
    rows = written(
        pages.where(F.octet_length("html") >= least).select(
            "page_id", F.unhex(F.sha2("html", 256)).alias("digest")
        ),
        "warc-digests",
    )
    best = rows.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    return (
        attach(rows, best.where("n > 1").drop("n"), "digest", "page_id")
        .where(~same(F.col("page_id"), F.col("refers_to")))
        .select("page_id", "digest", "refers_to")
        .distinct()
    )


def write(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least: int = REVISIT_BYTES,
    file_bytes: int = FILE_BYTES,
) -> None:
    """Write a record for each row of pages to archives in the folder ``path``.

    A null html is an empty payload, a null url an empty one. Of equal payloads of at
    least ``least`` bytes the row of the largest id is a response, and so is each
    repeated row of that id; the others are revisits of it. Payloads of null ids are
    revisits where another row has an id. Control characters of urls are percent-encoded.
    A file ends before the record that would bring it above ``file_bytes``, so only a
    record that is larger itself makes a larger file. An empty table gives no record.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    )
    again = written(revisits(rows, least), "warc-revisits")
    marked = rows.withColumn("digest", F.unhex(F.sha2("html", 256))).alias("p")
    joined = marked.join(
        again.alias("r"),
        same(F.col("p.page_id"), F.col("r.page_id")) & same(F.col("p.digest"), F.col("r.digest")),
        "left",
    ).select("p.page_id", "p.url", "p.html", "r.refers_to")
    members = joined.mapInArrow(_members(file_bytes), "member binary, file int")
    stored = members.select(F.col("member").cast("string"), "file")
    stored.write.partitionBy("file").option("encoding", "ISO-8859-1").option(
        "lineSep", EMPTY_MEMBER.decode("latin-1")
    ).text(path)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Records read back from archives that were written to the shared folder; a gap fails the run."""
    path = scratch_path(pages.sparkSession, "warc")
    write(pages, path, **options)
    found = read(pages.sparkSession, path, payload=False)
    lost = F.concat(F.lit("an archive can't be read: "), F.col("path"), F.lit(": "), F.col("gap"))
    return records(found.where(F.when(F.col("gap").isNull(), True).otherwise(F.raise_error(lost).cast("boolean"))))
