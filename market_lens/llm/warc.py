"""WARC archives: one gzip member for each record, a writer and a splittable reader.

Every writing task makes one file in a shared folder and returns its place; files of lost
or repeated attempts are in no manifest. The reader cuts files into byte ranges. A task
scans its range for the gzip magic, decodes the header of each candidate and keeps those
that start a WARC record; a record belongs to the range in which it starts and may end
beyond it. A member's own checksum and its payload digest are verified.

Files are opened with ``pyarrow.fs``, so folders can be local, mounted, HDFS or object stores
that it knows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from market_lens.llm.common import tasks
from market_lens.sources.scratch import materialize, temporary_path

MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPLIT_BYTES = 4 << 20
#: Bytes of archives that a reading task takes.
TASK_BYTES = 64 << 20
LEVEL = 3
_READ = 1 << 18
_LINE_END = re.compile(r"[\r\n\x00]")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def marked_revisits(pages: DataFrame, min_bytes: int = 0, id: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """``page_id, url, payload, first``: ``first`` is the smallest id with the same payload where that is another page.

    Only digests and ids are grouped. Payloads under ``min_bytes`` have no ``first``.
    """
    payload = F.coalesce(F.col(body).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    digest = F.when(F.octet_length("payload") >= min_bytes, F.sha1("payload"))
    rows = rows.withColumn("sha1", digest)
    same = rows.where("sha1 is not null").groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    same = materialize(same.where("n > 1").select("sha1", "first"), "same_payloads")
    first = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.join(same, "sha1", "left").select("page_id", "url", "payload", first.alias("first"))


def _record_id(page: int | None) -> str:
    name = uuid.uuid4() if page is None else uuid.uuid5(uuid.NAMESPACE_OID, str(page))
    return f"<urn:uuid:{name}>"


def _member(fields: list[tuple[str, str]], block: list[bytes], level: int) -> bytes:
    size = sum(map(len, block))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + f"Content-Length: {size}\r\n\r\n"
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    parts = [packer.compress(x) for x in (head.encode(), *block, b"\r\n\r\n")]
    return b"".join([*parts, packer.flush()])


def member_of(page: int | None, url: str | None, payload: bytes, first: int | None, date: str, level: int = LEVEL) -> bytes:
    """A page's response record, or the record of a revisit to page ``first``; the latter holds no payload."""
    target = _LINE_END.sub(lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{page}"
    fields = [("WARC-Type", "response" if first is None else "revisit"), ("WARC-Record-ID", _record_id(page))]
    fields += [("WARC-Date", date), ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}")]
    fields += [("Content-Type", "application/http;msgtype=response")]
    if page is not None:
        fields.append(("X-Page-Id", str(page)))
    if first is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(first)), ("X-Refers-To-Page-Id", str(first))]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return _member(fields, [http] if first is not None else [http, payload], level)


def write(rows: DataFrame, folder: str, level: int = LEVEL) -> DataFrame:
    """Write ``rows`` (of ``marked_revisits``) to ``folder``; the written manifest ``path, bytes, records`` names the files.

    An empty table writes no file. The manifest is stored, so files aren't written again when it is read.
    """
    date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = FileSystem.from_uri(folder)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
        out, size, n = None, 0, 0
        for batch in batches:
            for page, url, payload, first in zip(*(c for c in batch.columns), strict=True):
                if out is None:
                    fs.create_dir(base, recursive=True)
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                    info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(None)), ("WARC-Date", date)]
                    info.append(("Content-Type", "application/warc-fields"))
                    out.write(head := _member(info, [b"format: WARC File Format 1.1\r\n"], level))
                    size += len(head)
                member = member_of(page.as_py(), url.as_py(), payload.as_py(), first.as_py(), date, level)
                out.write(member)
                size += len(member)
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([size]), pa.array([n])], ["path", "bytes", "records"])

    return materialize(rows.mapInArrow(one, "path string, bytes long, records long"), "warc_manifest")


class _Bytes:
    """A window of a file that moves forward."""

    def __init__(self, file, at: int):
        self.file, self.at, self.data, self.ended = file, at, b"", False
        file.seek(at)

    def more(self) -> bool:
        got = b"" if self.ended else self.file.read(_READ)
        self.ended = not got
        self.data += got
        return bool(got)

    def drop(self, n: int) -> None:
        self.data = self.data[n:]
        self.at += n


def _decoded(source: _Bytes, offset: int) -> tuple[bytes, int] | None:
    """The member at ``offset`` of the window and the bytes it takes; None if it isn't a whole WARC record."""
    unpack, out, used, known = zlib.decompressobj(31), [], offset, False
    while not unpack.eof:
        if used >= len(source.data) and not source.more():
            return None
        part = source.data[used : used + _READ]
        used += len(part)
        try:
            out.append(unpack.decompress(part))
        except zlib.error:
            return None
        if not known and sum(map(len, out)) >= 7:
            if not b"".join(out).startswith(b"WARC/1."):
                return None
            known = True
    return (b"".join(out), used - len(unpack.unused_data) - offset) if known else None


def records_of(file, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """``(offset, record)`` of the records that start in the range."""
    source = _Bytes(file, start)
    while source.at < end:
        found = source.data.find(MAGIC)
        if found < 0:
            source.drop(max(0, len(source.data) - len(MAGIC) + 1))
            if not source.more():
                return
            continue
        source.drop(found)
        if source.at >= end:
            return
        if (got := _decoded(source, 0)) is None:
            source.drop(1)
            continue
        yield source.at, got[0]
        source.drop(got[1])


def parsed(record: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Named fields (lower case), the HTTP header and the payload of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    block = rest[: int(fields["content-length"])]
    if not fields.get("content-type", "").startswith("application/http"):
        return fields, b"", block
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, http, payload


_HTTP_LENGTH = re.compile(rb"(?im)^content-length:\s*(\d+)")


def splits(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``path, start, end`` out of ``path, bytes``; ranges are dealt out evenly."""
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("long")))
    return files.select("path", starts.alias("start")).withColumn("end", F.col("start") + split_bytes)


def read(files: DataFrame, split_bytes: int = SPLIT_BYTES, payloads: bool = True) -> DataFrame:
    """All response and revisit records of ``files`` (``path, bytes``): their fields, and payloads if asked for.

    ``page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload, path, offset``. A revisit's
    payload is null, its size and digest are those of the full payload. What isn't a whole record
    is skipped; a payload that doesn't fit its digest raises.
    """

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs, place = FileSystem.from_uri(path)
                rows, held = [], 0
                with fs.open_input_file(place) as file:
                    for offset, record in records_of(file, start, end):
                        fields, http, payload = parsed(record)
                        kind = fields.get("warc-type")
                        if kind not in ("response", "revisit"):
                            continue
                        digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                        size = len(payload)
                        if kind == "revisit":
                            size = int(_HTTP_LENGTH.search(http)[1])
                        elif base32_sha1(payload) != digest:
                            raise ValueError(f"{path} at {offset}: the payload doesn't fit its digest")
                        page, first = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
                        shown = payload if payloads and kind == "response" else None
                        rows.append((page and int(page), fields.get("warc-target-uri"), kind, size, digest, first and int(first), shown, path, offset))
                        held += len(shown or b"")
                        if len(rows) >= 5000 or held > 1 << 24:
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)

    total = files.agg(F.sum("bytes")).first()[0] or 0
    n = max(tasks(files), -(-total // TASK_BYTES))  # a number of its own: rows are tiny, whatever the bytes they stand for
    ranges = splits(files, split_bytes).repartition(n, F.xxhash64("path", "start"))
    return ranges.mapInArrow(one, _KIND)


_KIND = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, "
    "payload binary, path string, offset long"
)
_TYPES = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string(), pa.int64()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split(" ")[0] for x in _KIND.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], names)


def round_trip(pages: DataFrame, min_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Archive ``pages`` and read the archives back: a row for each page, in no order.

    Null html is the empty payload; a null url gets a name made of the id. Rows that share the smallest id and
    the payload are all responses. A row without an id is a revisit if a row with an id has its
    payload. Other columns are ignored. Fewer records than were written raise an error.
    """
    folder = folder or temporary_path(pages.sparkSession, "warc")
    manifest = write(marked_revisits(pages, min_bytes), folder)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    found = materialize(read(manifest, payloads=False).select(columns), "warc_records")
    written, came_back = manifest.agg(F.sum("records")).first()[0] or 0, found.count()
    if written != came_back:
        raise ValueError(f"{written} records were written to {folder}, {came_back} came back")
    return found
