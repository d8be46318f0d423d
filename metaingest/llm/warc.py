"""WARC: archives written by Spark, and a reader that salvages damaged ones.

``write_archives`` lays records out as WARC/1.1 files. Records with equal
payloads of ``LEAST_REVISIT`` bytes or more are stored once; the others revisit
the first. ``read_archives`` takes any WARC files, plain or as gzip members. A
record must have a version line, complete headers, a length that the file
holds, its closing line ends and, if given, the right digest. Where one of these
checks fails, the reader goes on at the next version line or gzip member that
starts a valid record, and logs the bytes between as a gap. The same holds within
the decompressed bytes of a gzip member, also of those before the place where a
member breaks or is cut short.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage, stage_counted

LEAST_REVISIT = 100
FILE_BYTES = 16 << 20
#: Digests that repeat are broadcast up to this number, about 60 MB; more are joined by a shuffle.
BROADCAST_DIGESTS = 500_000
_END = "\r\n"
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_GZIP = b"\x1f\x8b\x08"
#: Compressed bytes that are unpacked at once.
_PIECE = 1 << 16
_EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value; line ends can't break it."""
    clean = F.regexp_replace(value.cast("string"), "[\r\n]", " ")
    return F.when(value.isNull(), "").otherwise(F.concat(F.lit(f"{name}: "), clean, F.lit(_END)))


def _uri(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), page_id.cast("string"), F.lit(">"))


def plan_records(pages: DataFrame) -> DataFrame:
    """``pages`` with the digest and length of their payload, ``record_type`` and
    ``refers_to``. A null ``html`` is an empty payload. Of equal payloads that
    are long enough the smallest ``page_id`` is the response; a null id never
    is, unless all are null."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    keyed = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {"payload_digest": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("long")}
    )
    long_enough = F.col("payload_bytes") >= LEAST_REVISIT
    first = keyed.filter(long_enough).groupBy("payload_digest").agg(
        F.min("page_id").alias("response"), F.count(F.lit(1)).alias("times")
    )
    first, seen = stage_counted(first.filter("times > 1").drop("times"), "warc-repeated")
    if seen["rows"] <= BROADCAST_DIGESTS:
        first = F.broadcast(first)
    joined = keyed.join(first, "payload_digest", "left")
    revisits = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    return joined.withColumns(
        {"record_type": F.when(revisits, "revisit").otherwise("response"), "refers_to": F.when(revisits, F.col("response"))}
    ).drop("response")


def average_record(pages: DataFrame) -> int:
    """Bytes of a page's record on average, if none is a revisit."""
    return 600 + int(pages.agg(F.avg(F.octet_length("html"))).first()[0] or 0)


def write_archives(records: DataFrame, path: str, average_bytes: int, file_bytes: int = FILE_BYTES) -> None:
    """Writes planned records as WARC files of about ``file_bytes`` to ``path``.

    Each task writes its own rows; a file ends after as many records as make up
    ``file_bytes`` on average.
    """
    revisit = F.col("record_type") == "revisit"
    block = F.when(revisit, "").otherwise(F.col("payload"))
    head = F.concat(
        F.lit("WARC/1.1" + _END),
        _header("WARC-Type", F.col("record_type")),
        _header("WARC-Record-ID", _uri(F.col("page_id"))),
        F.lit("WARC-Date: 2024-01-01T00:00:00Z" + _END),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Refers-To", _uri(F.col("refers_to"))),
        _header("WARC-Profile", F.when(revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        _header("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.when(revisit, _EMPTY_DIGEST).otherwise(F.col("payload_digest")))),
        _header("Content-Type", F.lit("application/octet-stream")),
        _header("Content-Length", F.octet_length(block)),
    )
    # The writer ends each line with the record's second closing line end.
    lines = records.select(F.concat(head, F.lit(_END), block, F.lit(_END)).alias("value"))
    lines.write.option("lineSep", _END).option("maxRecordsPerFile", max(1, file_bytes // average_bytes)).text(path)


class Gap(NamedTuple):
    """Bytes of the file or, if ``member`` is its place, of the decompressed member."""

    start: int
    end: int
    reason: str
    member: int | None = None


class Damaged(Exception):
    """A record that fails a check."""


def _record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at ``at``."""
    line = _VERSION.match(data, at)
    if not line:
        raise Damaged("no version line")
    close = data.find(b"\r\n\r\n", line.end() - 2)
    if close < 0:
        raise Damaged("headers without an end")
    headers: dict[str, str] = {}
    for row in data[line.end() : close].split(b"\r\n") if close > line.end() else []:
        name, colon, value = row.partition(b":")
        if not colon:
            raise Damaged("a header without a colon")
        headers[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        raise Damaged("no length")
    start, end = close + 4, close + 4 + int(length)
    if end + 4 > len(data):
        raise Damaged("cut short")
    if data[end : end + 4] != b"\r\n\r\n":
        raise Damaged("no closing line ends")
    block = data[start:end]
    digest = headers.get("warc-block-digest")
    if digest and not _digest_fits(digest, block):
        raise Damaged("wrong digest")
    return headers, block, end + 4


def _digest_fits(digest: str, block: bytes) -> bool:
    """Whether the digest is right; one of an unknown kind is not checked."""
    kind, _, value = digest.partition(":")
    if kind.lower() not in ("md5", "sha1", "sha256"):
        return True
    found = hashlib.new(kind.lower(), block)
    return value.lower() in (found.hexdigest(), base64.b32encode(found.digest()).decode().lower())


class Member(NamedTuple):
    """What a gzip member holds up to ``end``, and why no more; it may have
    read on past its true end if it is damaged."""

    inner: bytes
    end: int
    damage: str | None


def _unpack(data: bytes, at: int, until: int) -> Member:
    unpacker, parts, place = zlib.decompressobj(31), [], at
    while place < until and not unpacker.eof:
        piece = memoryview(data)[place : min(place + _PIECE, until)]
        try:
            parts.append(unpacker.decompress(piece))
        except zlib.error:
            return _unpack_damaged(data, at, place)
        place += len(piece)
    return Member(b"".join(parts), place - len(unpacker.unused_data), None if unpacker.eof else "a member cut short")


def _unpack_damaged(data: bytes, at: int, place: int) -> Member:
    """The member at ``at`` up to the byte that is wrong, which is after ``place``."""
    unpacker, parts = zlib.decompressobj(31), []
    if place > at:
        parts.append(unpacker.decompress(memoryview(data)[at:place]))
    while True:
        try:
            parts.append(unpacker.decompress(data[place : place + 1]))
        except zlib.error:
            return Member(b"".join(parts), place, "a damaged member")
        place += 1


def _plain(data: bytes, whole: bool = True) -> Iterator[tuple[int, dict[str, str], bytes] | Gap]:
    """The valid records of decompressed bytes, and gaps. A last gap is left out
    if the bytes are not the ``whole`` member."""
    at = 0
    while at < len(data):
        try:
            headers, block, end = _record(data, at)
        except Damaged as error:
            start, at = at, _next_record(data, at + 1)
            if whole or at < len(data):
                yield Gap(start, at, str(error))
            continue
        yield at, headers, block
        at = end


def _next_record(data: bytes, at: int) -> int:
    while line := _VERSION.search(data, at):
        try:
            _record(data, line.start())
            return line.start()
        except Damaged:
            at = line.start() + 1
    return len(data)


def salvage(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes] | Gap]:
    """The valid records of an archive with their places, and gaps.

    The place of a record in a gzip member is the member's. A member that is
    damaged or cut short is a gap of the file after the records found in it.
    """
    at = 0
    while at < len(data):
        if not data.startswith(_GZIP, at):
            try:
                headers, block, end = _record(data, at)
            except Damaged as error:
                start, at = at, _next_start(data, at + 1)
                yield Gap(start, at, str(error))
            else:
                yield at, headers, block
                at = end
            continue
        start, member = at, _unpack(data, at, len(data))
        at, damage = member.end, member.damage
        if damage:
            at = _next_start(data, start + 1, member)
            if at < member.end:
                member = _unpack(data, start, at)
        for found in _plain(member.inner, damage is None):
            yield found._replace(member=start) if isinstance(found, Gap) else (start, *found[1:])
        if damage:
            yield Gap(start, at, damage)


def _next_start(data: bytes, at: int, damaged: Member | None = None) -> int:
    """The next place where a valid record, or a member with one, starts, or the
    end. Records that the ``damaged`` member before already gave are passed by."""
    while True:
        line, member = _VERSION.search(data, at), data.find(_GZIP, at)
        places = [p for p in (line.start() if line else -1, member) if p >= 0]
        if not places:
            return len(data)
        place = min(places)
        if place == member:
            if any(not isinstance(found, Gap) for found in _plain(_unpack(data, place, len(data)).inner)):
                return place
            at = place + 1
            continue
        try:
            end = _record(data, place)[2]
        except Damaged:
            at = place + 1
            continue
        if not (damaged and place < damaged.end and data[place:end] in damaged.inner):
            return place
        at = end


_READ = "file string, place long, gap_end long, gap_reason string, gap_member long, record_type string, record_id string, refers_to string, uri string, payload_digest string, block_bytes long, block_sha256 string, block binary"


def _read(batches: Iterator[pa.RecordBatch], blocks: bool) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in _READ.split(", ")]
    kinds = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[field.split()[1]] for field in _READ.split(", ")]
    for batch in batches:
        for file, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            rows, held = [], 0
            for found in salvage(content.as_py()):
                if isinstance(found, Gap):
                    rows.append((file, found.start, found.end, found.reason, found.member, *[None] * 8))
                else:
                    place, headers, block = found
                    keys = ("warc-type", "warc-record-id", "warc-refers-to", "warc-target-uri", "warc-payload-digest")
                    seen = len(block), hashlib.sha256(block).hexdigest(), block if blocks else None
                    rows.append((file, place, None, None, None, *map(headers.get, keys), *seen))
                    held += len(block)
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def read_archives(spark: SparkSession, path: str, blocks: bool = True) -> tuple[DataFrame, DataFrame]:
    """Records and gaps of all files below ``path``, each read once and staged.

    Records have ``file``, ``place``, ``record_type``, ``record_id``,
    ``refers_to``, ``uri``, ``payload_digest`` (as stated), ``block_bytes`` and
    ``block_sha256`` (as read) and ``block``, which is null without ``blocks``;
    gaps ``file``, ``start``, ``end``, ``reason`` and ``member``: if not null, start
    and end count the decompressed bytes of the gzip member at this place. A plain
    file without a valid record is one gap.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    found = stage(files.mapInArrow(lambda batches: _read(batches, blocks), _READ), "warc-read")
    gaps = found.filter("gap_end is not null").select("file", F.col("place").alias("start"), F.col("gap_end").alias("end"), F.col("gap_reason").alias("reason"), F.col("gap_member").alias("member"))
    return found.filter("gap_end is null").drop("gap_end", "gap_reason", "gap_member"), gaps


def page_of(uri: Column) -> Column:
    """The id in a record id of ``write_archives``."""
    return F.regexp_extract(uri, "^<urn:page:(.*)>$", 1)


def payload_figures(records: DataFrame) -> DataFrame:
    """``record_id``, ``record_type``, ``refers_to``, and length and digest of the
    full payload, which a revisit takes from the record that it refers to."""
    own = records.select(
        "record_id", "record_type", "refers_to", F.col("block_bytes").alias("payload_bytes"), F.col("block_sha256").alias("payload_digest")
    )
    responses = own.filter("record_type = 'response'").dropDuplicates(["record_id"])
    held = responses.select(F.col("record_id").alias("refers_to"), F.col("payload_bytes").alias("bytes_there"), F.col("payload_digest").alias("digest_there"))
    revisits = own.filter("record_type = 'revisit'").drop("payload_bytes", "payload_digest").join(held, "refers_to", "left")
    revisits = revisits.withColumnsRenamed({"bytes_there": "payload_bytes", "digest_there": "payload_digest"})
    return own.filter("record_type = 'response'").unionByName(revisits)
