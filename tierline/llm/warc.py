"""WARC archives: writing, and reading that survives damage.

``write_archive`` makes one ``response`` record per page, or a ``revisit`` where an
equal payload has a page with a smaller id. Spark's text writer puts the records
into its part files with the WARC record terminator between them, so a task that is
lost or repeated leaves no half file.

``read_archive`` is a salvage reader. It walks an archive record by record and
checks each: the version line, a well-formed header block, the declared length, the
terminator and the payload's SHA-1. After a failed check it searches for the next
version line or gzip member, tries there, and goes on from the first place that
holds a valid record; the bytes passed over are logged as one quarantined gap. Gzip
members are inflated piece by piece and walked by the same rules, whatever their size: only the
record being read is in memory. Of a member that is damaged or cut off, the records complete
before the damage are kept; its bytes up to the next valid member or record are a gap. A
task holds one file as it is stored (at most 2 GB, Spark's limit for a value): archives should stay
well under an executor's memory, as the writer's files do. All files of the folder are read,
whatever their names, but for hidden ones (a leading dot or underscore), as Spark does.

Defined cases: a null payload is an empty one; rows with one id and equal payloads are
all responses; a null id is never referred to unless all ids of its payload are null,
when all are responses; an empty table writes no records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.common import read_table, stored
from tierline.session import scratch_path

VERSION = "WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r?\n")
_MEMBER = b"\x1f\x8b\x08"
_MEMBER_START = re.compile(re.escape(_MEMBER))
_NAME = re.compile(r"[!#$%&'*+\-.^_`|~0-9A-Za-z]+")


# -- writing ---------------------------------------------------------------------------


def base32_sha1(payload: Column) -> Column:
    """The bare upper-case base32 SHA-1 of a binary column: 40 bits at a time through base 32's own digits."""
    digest = F.sha1(payload)
    quarters = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*quarters), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record_id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(">"))


def with_firsts(df: DataFrame, min_bytes: int) -> DataFrame:
    """``df(page_id, url, payload)`` with ``first``: the smallest page_id of its payload where several rows share it.

    Equality is that of length and SHA-256. Only digests that occur more than once come
    out of the aggregate, which combines before it shuffles; Spark broadcasts them if
    small and else splits the rows of a hot digest.
    """
    keyed = df.withColumn("_key", F.sha2("payload", 256)).withColumn("_bytes", F.octet_length("payload"))
    shared = (
        keyed.where(F.col("_bytes") >= min_bytes)
        .groupBy("_key", "_bytes")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("_n"))
        .where("_n > 1")
        .drop("_n")
    )
    shared = stored(shared, "warc-shared")
    return keyed.join(shared, ["_key", "_bytes"], "left").drop("_key", "_bytes")


def records(df: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """One column ``value``: each row's whole record without its terminator."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = with_firsts(
        df.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload.cast("binary").alias("payload")), min_bytes
    )
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    size = F.octet_length("payload")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "")
    head = F.concat(
        F.lit(f"{VERSION}\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", _record_id(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)),
        F.when(url != "", line("WARC-Target-URI", url)).otherwise(F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("payload")))),
        line("X-Payload-Length", size.cast("string")),
        F.when(
            revisit,
            F.concat(line("WARC-Refers-To", _record_id(F.col("first"))), line("WARC-Profile", F.lit(REVISIT_PROFILE))),
        ).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(size.cast("string"))),
        F.lit("\r\n"),
    )
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string"))
    return rows.select(F.concat(head, body).alias("value"))


def write_archive(df: DataFrame, folder: str, **options) -> None:
    """The records of ``df`` as plain WARC files in ``folder``, one per partition."""
    records(df, **options).write.option("lineSep", END).text(folder)


# -- reading ---------------------------------------------------------------------------


@dataclass
class Record:
    """A record that passed every check: where it was, its named fields (lower case), its block."""

    offset: int
    fields: dict[str, str]
    block: memoryview | bytes


@dataclass
class Gap:
    """Bytes that no valid record explains."""

    offset: int
    length: int
    reason: str


@dataclass
class _Failed(Exception):
    reason: str
    fields: dict = field(default_factory=dict)


class _Stored:
    """The bytes of an archive, all in memory."""

    def __init__(self, content: bytes | memoryview):
        self.data, self._raw = memoryview(content), content

    def read(self, at: int, stop: int) -> memoryview:
        """The bytes from ``at`` to ``stop``, fewer at the end."""
        return self.data[at:stop]

    def next_start(self, at: int) -> int:
        """The next place at or after ``at`` that may begin a record or member; the end if none."""
        line = _VERSION_LINE.search(self._raw, at)
        line_at = line.start() if line else len(self.data)
        member = _MEMBER_START.search(self._raw, at, min(len(self.data), line_at))
        return min(line_at, member.start() if member else len(self.data))

    def forget(self, at: int) -> None:
        """Bytes before ``at`` won't be asked for again."""


class _Member:
    """The content of the gzip member at ``at``, inflated as far as it is asked for; zlib verifies its checksum at the end."""

    PIECE = 1 << 16

    def __init__(self, data: memoryview, at: int):
        self._data, self._at, self._inflater = data, at, zlib.decompressobj(31)
        self._kept, self._start, self._input = bytearray(), 0, b""
        self.damage = ""

    def _more(self) -> bool:
        if self._inflater.eof or self.damage:
            return False
        if not self._input:
            self._input = self._data[self._at : self._at + self.PIECE]
            self._at += len(self._input)
            if not self._input:
                self.damage = "gzip member is cut off"
                return False
        try:
            self._kept += self._inflater.decompress(self._input, 16 * self.PIECE)
            self._input = self._inflater.unconsumed_tail
        except zlib.error:
            self.damage = "gzip member is damaged"
            return False
        return True

    def finish(self) -> int:
        """Where the member ends, read to its end."""
        while self._more():
            self.forget(self._start + len(self._kept))
        return self._at - len(self._inflater.unused_data)

    def read(self, at: int, stop: int) -> bytes:
        while self._start + len(self._kept) < stop and self._more():
            pass
        return bytes(self._kept[at - self._start : stop - self._start])

    def next_start(self, at: int) -> int:
        while True:
            if found := _VERSION_LINE.search(self._kept, at - self._start):
                return self._start + found.start()
            end = self._start + len(self._kept)
            at = max(at, end - 11)  # a version line may begin in the last bytes
            self.forget(at)
            if not self._more():
                return max(end, at)

    def forget(self, at: int) -> None:
        del self._kept[: at - self._start]
        self._start = at


def _line_end(source: _Stored | _Member, at: int) -> int:
    """Length of the line at ``at`` without its end. Lines are short; a long one is searched in growing windows."""
    window = 1024
    while (end := (seen := bytes(source.read(at, at + window))).find(b"\n")) < 0:
        if len(seen) < window:
            raise _Failed("header does not end")
        window *= 4
    return end


def _parse(source: _Stored | _Member, at: int) -> tuple[Record, int]:
    """The record at ``at`` and where it ends, or _Failed."""
    if not (m := _VERSION_LINE.match(bytes(source.read(at, at + 12)))):
        raise _Failed("no version line")
    fields: dict[str, str] = {}
    pos = at + m.end()
    while True:
        end = _line_end(source, pos)
        text = bytes(source.read(pos, pos + end)).rstrip(b"\r").decode("utf-8", "replace")
        pos += end + 1
        if not text:
            break
        name, colon, value = text.partition(":")
        if not colon or not _NAME.fullmatch(name):
            raise _Failed("malformed header line")
        fields[name.lower()] = value.strip()
    length = fields.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        raise _Failed("no length")
    stop = pos + int(length)
    if bytes(source.read(stop, stop + 4)) != END.encode():
        raise _Failed("no terminator after the declared length")
    block = source.read(pos, stop)
    digest = fields.get("warc-payload-digest", "")
    if fields.get("warc-type") == "response" and digest.startswith("sha1:"):
        if base64.b32encode(hashlib.sha1(block).digest()).decode() != digest[5:]:
            raise _Failed("payload digest differs")
    return Record(at, fields, block), stop + 4


def _records(source: _Stored | _Member, at: int) -> Iterator[tuple[list[Record | Gap], int]]:
    """What is at ``at``, piece by piece, each with the place to go on from; _Failed if there is no valid record."""
    if not isinstance(source, _Stored) or bytes(source.read(at, at + 3)) != _MEMBER:
        record, end = _parse(source, at)
        yield [record], end
        return
    member, held, some = _Member(source.data, at), [], False
    for x in _walk(member):
        x.offset = at  # places inside a member are told by the member's own place
        held.append(x)  # a gap waits for the record after it
        if isinstance(x, Record):
            yield held, at
            held, some = [], True
    end = member.finish()
    if member.damage:
        raise _Failed(member.damage)
    if held and not some:
        raise _Failed("gzip member holds no record")
    yield held, end


def _walk(source: _Stored | _Member) -> Iterator[Record | Gap]:
    at, gap, reason = 0, None, ""
    while len(source.read(at, at + 1)):
        start = at
        try:
            for found, place in _records(source, start):
                if found and gap is not None:
                    yield Gap(gap, start - gap, reason)
                    gap = None
                yield from found
                at = place
        except _Failed as failed:
            if gap is None:
                gap, reason = start, failed.reason
            at = source.next_start(start + 1)
        if at > start:
            source.forget(at)
    if gap is not None:
        yield Gap(gap, at - gap, reason)


def salvage(content: bytes | memoryview) -> Iterator[Record | Gap]:
    """Every valid record of an archive in order, and the gaps between them."""
    return _walk(_Stored(content))


SCHEMA = (
    "archive string, offset bigint, kind string, record_type string, record_id string, uri string, "
    "payload_digest string, payload_bytes bigint, refers_to string, payload binary, gap_bytes bigint, reason string"
)
BATCH_BYTES = 8 << 20


def _rows(archive: str, content: memoryview) -> Iterator[tuple]:
    for x in salvage(content):
        if isinstance(x, Gap):
            yield archive, x.offset, "gap", None, None, None, None, None, None, None, x.length, x.reason
            continue
        get = x.fields.get
        size = get("x-payload-length", "")
        digest = get("warc-payload-digest", "")
        known = int(size) if size.isascii() and size.isdigit() else None
        revisit = get("warc-type") == "revisit"
        yield (
            archive, x.offset, "record", get("warc-type"), get("warc-record-id"), get("warc-target-uri"),
            digest.removeprefix("sha1:") or None, known if revisit else len(x.block),
            get("warc-refers-to"), None if revisit else bytes(x.block), None, None,
        )


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """One row per valid record (kind ``record``) and per quarantined gap (kind ``gap``)."""
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        types = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        kinds = [types[c.split()[1]] for c in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows, size = [], 0
                for row in _rows(path.rpartition("/")[2], memoryview(content.as_buffer())):
                    rows.append(row)
                    size += len(row[9] or b"") + 200
                    if size >= BATCH_BYTES:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").load(folder)
    return files.select("path", "content").mapInArrow(run, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    write_archive(read_table(spark, sf_dir, "pages"), folder)
    page = lambda name: F.regexp_extract(name, r"<urn:page:(-?\d+)>", 1)
    number = lambda name: F.when(page(name) != "", page(name).cast("bigint"))
    # The archives were just written, so a gap in them is an error and no row may go with it.
    sound = F.when(F.col("kind") == "record", F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("gap in "), "archive")).cast("boolean"))
    return (
        read_archive(spark, folder)
        .where(sound)
        .select(
            number("record_id").alias("page_id"),
            "payload_bytes",
            "payload_digest",
            "record_type",
            number("refers_to").alias("refers_to"),
        )
    )


_QUARTERS = " || ".join(
    f"lpad(to_base(('0x' || substr(h, {1 + 10 * i}, 10))::BIGINT, 32), 8, '0')" for i in range(4)
)
ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
       translate({_QUARTERS}, '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f"""
