"""WARC archives: a writer with revisit records, and a reader that salvages.

Every task writes one archive of gzip members, one record each, and reports it in
a manifest.  The reader checks each member (gzip CRC, version line, lengths,
digest).  After a failed check it searches for the next member or version line
that holds, goes on from there, and reports the bytes between as a gap.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsift.llm import _files
from jobsift.llm._store import shuffles_dropped
from jobsift.session import scratch_path

#: Payloads below this are stored again each time.
MIN_REVISIT_BYTES = 1000
LEVEL = 3
READ_BYTES = 1 << 20
#: Fixed values of the formats.
MEMBER = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
RECORD_END = b"\r\n\r\n"
DATE = "2000-01-01T00:00:00Z"


def _header(fields: list[tuple[str, object]]) -> bytes:
    lines = [f"{name}: {value}" for name, value in fields if value is not None]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode()


def _clean(url: str | None) -> str | None:
    return None if url is None else "".join(c if c > "\x20" else "%%%02X" % ord(c) for c in url)


def record(
    page: object, url: str | None, payload: bytes, digest: str, refers_to: object, seq: str = ""
) -> bytes:
    """One record.  A revisit has no body but states digest and length of the payload."""
    revisit = refers_to is not None
    body = b"" if revisit else payload
    head = _header(
        [
            ("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", f"<urn:page:{'' if page is None else page}>"),
            ("WARC-Date", DATE),
            ("WARC-Target-URI", _clean(url)),
            ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("WARC-Refers-To", f"<urn:page:{refers_to}>" if revisit else None),
            ("X-Payload-Length", len(payload)),
            ("Content-Type", "text/html; charset=utf-8"),
            ("Content-Length", len(body)),
        ]
    )
    return head + body + RECORD_END


def member(data: bytes, level: int = LEVEL) -> bytes:
    press = zlib.compressobj(level, zlib.DEFLATED, 31)
    return press.compress(data) + press.flush()


def revisits(pages: DataFrame, least: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Add ``digest`` and ``refers_to`` to pages (key, url, html).

    The page with the largest key among equal payloads is the response; a page
    with that same key is one as well.  Copies are counted as narrow rows with
    partial sums; the digests that occur twice are joined back, and a digest of
    very many pages is split by the runtime skew join.
    """
    hashed = pages.withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    large = F.octet_length("html") >= least
    groups = (
        hashed.where(large)
        .groupBy("digest")
        .agg(F.max("key").alias("last"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "last")
    )
    named = hashed.join(groups, "digest", "left")
    other = large & (F.col("key").isNull() | (F.col("key") < F.col("last")))
    return named.select("key", "url", "html", "digest", F.when(other, F.col("last")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write (key, url, html) pages as archives below ``folder``; returns their manifest.

    Null html is an empty payload.  The manifest is a Parquet table beside the archives.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        name, sink, size, count = None, None, 0, 0
        for batch in batches:
            for page, url, html, digest, refers in zip(*batch.columns, strict=True):
                if sink is None:
                    name = _files.attempt_name(folder, part, ".warc.gz")
                    sink = _files.create(name)
                payload = html.as_buffer().to_pybytes()
                data = record(page.as_py(), url.as_py(), payload, digest.as_py(), refers.as_py())
                data = member(data)
                sink.write(data)
                size, count = size + len(data), count + 1
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_pylist([{"path": name, "bytes": size, "records": count}], _MANIFEST)

    rows = revisits(pages.withColumn("html", F.coalesce(pages["html"].cast("string"), F.lit(""))))
    manifest = rows.select("key", "url", "html", "digest", "refers_to")
    with shuffles_dropped(pages.sparkSession):
        manifest.mapInArrow(run, "path string, bytes long, records long").write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.parquet(f"{folder}/manifest")


_MANIFEST = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())])


class Bad(Exception):
    """A check failed."""


def _parsed(data: bytes) -> tuple[dict[str, str], bytes, int]:
    """Header fields, body and length of the record at the start of ``data``."""
    if not data.startswith(VERSION):
        raise Bad("no version line")
    cut = data.find(b"\r\n\r\n")
    if cut < 0:
        raise Bad("no end of header")
    fields = {}
    for line in data[:cut].split(b"\r\n")[1:]:
        name, mark, value = line.partition(b":")
        if not mark:
            raise Bad("broken header line")
        fields[name.strip().decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    try:
        length = int(fields["content-length"])
    except (KeyError, ValueError):
        raise Bad("no length") from None
    end = cut + 4 + length
    if length < 0 or data[end : end + 4] != RECORD_END:
        raise Bad("length and end of record disagree")
    body = data[cut + 4 : end]
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if digest and fields.get("warc-type") == "response" and hashlib.sha1(body).hexdigest() != digest:
        raise Bad("digest differs")
    return fields, body, end + 4


class _Window:
    """Bytes of a file from ``at`` on, read as needed."""

    def __init__(self, source, size: int) -> None:
        self.source, self.size, self.at, self.data = source, size, 0, b""

    def need(self, n: int) -> bytes:
        missing = min(n, self.size - self.at) - len(self.data)
        if missing > 0:
            self.source.seek(self.at + len(self.data))
            self.data += self.source.read(max(missing, min(READ_BYTES, self.size - self.at - len(self.data))))
        return self.data

    def skip(self, n: int) -> None:
        self.data, self.at = self.data[n:], self.at + n


def _member_at(window: _Window, limit: int | None = None) -> tuple[bytes, int]:
    """Content and compressed length of the gzip member at the window's start."""
    inflate, content, used = zlib.decompressobj(31), [], 0
    while not inflate.eof:
        data = window.need(used + READ_BYTES)
        piece = data[used:]
        if not piece:
            raise Bad("member is cut off")
        try:
            content.append(inflate.decompress(piece))
        except zlib.error as error:
            raise Bad(f"member is broken: {error}") from None
        used = len(data) - len(inflate.unused_data)
        if content and not b"".join(content[:1]).startswith(VERSION[: len(content[0])]):
            raise Bad("no version line")
    return b"".join(content), used


def _plain_at(window: _Window) -> tuple[tuple[dict[str, str], bytes], int]:
    n = READ_BYTES
    while True:
        data = window.need(n)
        try:
            fields, body, end = _parsed(data)
            return (fields, body), end
        except Bad:
            if len(data) < min(n, window.size - window.at) or n >= window.size - window.at:
                raise
            # The record may go on behind what was read: ask for as much as its length says.
            cut = data.find(b"\r\n\r\n")
            length = _stated_length(data[:cut]) if data.startswith(VERSION) and cut >= 0 else None
            if cut < 0 and data.startswith(VERSION) and n < 4 * READ_BYTES:
                n *= 2
            elif length is not None and n < cut + 8 + length <= window.size - window.at:
                n = cut + 8 + length
            else:
                raise


def _stated_length(head: bytes) -> int | None:
    for line in head.split(b"\r\n"):
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length" and value.strip().isdigit():
            return int(value)
    return None


def _next_start(window: _Window) -> int:
    """Distance to the next possible member or version line, or to the end of the file."""
    base = 1
    while True:
        data = window.need(base + READ_BYTES)
        found = [x for mark in (MEMBER, VERSION) if (x := data.find(mark, base)) >= 0]
        if found:
            return min(found)
        if window.at + len(data) >= window.size:
            return len(data)
        base = max(base, len(data) - len(VERSION) + 1)
        window_rest = window.size - window.at - len(data)
        if window_rest <= 0:
            return len(data)


def salvage(source, size: int) -> Iterator[tuple[str, int, int, object]]:
    """Go through an archive: ("record", start, end, (fields, body)) or ("gap", start, end, reason).

    Gaps are the bytes that belong to no record that passed its checks.  A search
    tries every member mark and version line in turn, so one broken record costs
    nothing but itself.
    """
    window, gap, reason = _Window(source, size), None, ""
    while window.at < size:
        start = window.at
        try:
            head = window.need(len(VERSION))
            if head.startswith(MEMBER):
                content, used = _member_at(window)
                fields, body, end = _parsed(content)
                if end != len(content):
                    raise Bad("bytes behind the record")
            elif head.startswith(VERSION):
                (fields, body), used = _plain_at(window)
            else:
                raise Bad("neither member nor version line")
        except Bad as error:
            if gap is None:
                gap, reason = start, str(error)
            window.skip(_next_start(window))
            continue
        if gap is not None:
            yield "gap", gap, start, reason
            gap = None
        window.skip(used)
        yield "record", start, window.at, (fields, body)
    if gap is not None:
        yield "gap", gap, size, reason


_READ = pa.schema(
    [
        ("path", pa.string()),
        ("start", pa.int64()),
        ("end", pa.int64()),
        ("gap", pa.string()),
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("url", pa.string()),
        ("refers_to", pa.string()),
        ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload", pa.binary()),
    ]
)
READ_SCHEMA = (
    "path string, start long, end long, gap string, record_id string, record_type string, url string, "
    "refers_to string, payload_digest string, payload_bytes long, payload binary"
)


def _id(value: str | None) -> str | None:
    return value.removeprefix("<urn:page:").removesuffix(">") if value else None


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record and per gap of the archives of a manifest (path, bytes).

    A gap has its reason in ``gap`` and null record columns.  Archives are read as
    streams by as many tasks as there are archives, a bounded buffer each; a task holds one record.  Bytes and
    digest of a response are those of the payload read; a revisit states them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows, held = [], 0
                with _files.read(path) as source:
                    for kind, start, end, found in salvage(source, size):
                        row = {"path": path, "start": start, "end": end}
                        if kind == "gap":
                            rows.append(row | {"gap": found})
                        else:
                            rows.append(row | _row(*found, payloads))
                            held += len(found[1]) if payloads else 200
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, _READ)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _READ)

    tasks = max(1, manifest.count())
    spread = manifest.select("path", "bytes").repartition(tasks)
    return spread.mapInArrow(run, READ_SCHEMA)


def _row(fields: dict[str, str], body: bytes, payloads: bool) -> dict[str, object]:
    response = fields.get("warc-type") == "response"
    stated = fields.get("x-payload-length", "")
    return {
        "record_id": _id(fields.get("warc-record-id")),
        "record_type": fields.get("warc-type"),
        "url": fields.get("warc-target-uri"),
        "refers_to": _id(fields.get("warc-refers-to")),
        "payload_digest": hashlib.sha1(body).hexdigest()
        if response
        else fields.get("warc-payload-digest", "").removeprefix("sha1:"),
        "payload_bytes": len(body) if response or not stated.isdigit() else int(stated),
        "payload": body if payloads else None,
    }


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Archives of (key, url, html) pages in the shared folder, read back without payloads."""
    manifest = write_archives(pages, scratch_path(spark, "warc"))
    return read_archives(manifest, payloads=False)
