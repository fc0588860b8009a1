"""WARC archives: one gzip member per record, and a reader that splits files anywhere.

A reader task has a range of bytes. It looks for the three bytes that begin a gzip member, takes a place
for a member only if what decodes there is a record header, and owns the records whose members begin
inside its range; the last one may end beyond it. From one member's end the next follows without a
search. Ranges are read in blocks, and a record is held alone, so memory does not depend on file sizes."""

from __future__ import annotations

import base64
import gzip
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tankwise.llm import files
from tankwise.llm.common import picked
from tankwise.session import stage

#: Bytes of payload from which a repeated payload is written as a revisit.
REVISIT_FROM = 1_000
#: Compressed bytes that a reader task is given.
SPLIT = 32 << 20
BLOCK = 1 << 20

# The format's names and marks.
GZIP = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
STATUS = b"HTTP/1.1 200 OK\r\n"
_UNSAFE = re.compile(r"[\x00-\x20\x7f-\U0010ffff]")
_DATE = "1970-01-01T00:00:00Z"


def _uri(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def _page(uri: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d*)>", uri)
    if not found:
        raise ValueError(f"not a page's record id: {uri[:100]}")
    return int(found[1]) if found[1] else None


def target(url: str | None) -> str | None:
    """A URL that fits in a header line: other than printable ASCII is percent-encoded as UTF-8."""
    if url is None:
        return None
    return _UNSAFE.sub(lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)


def record(page: int | None, url: str | None, payload: bytes, sha1: bytes, refers_to: int | None) -> bytes:
    """One gzip member: a response, or a revisit of the page ``refers_to``."""
    http = STATUS + f"Content-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    digest = base64.b32encode(sha1).decode()
    lines = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_uri(page)}",
        f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {target(url)}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {_uri(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head = VERSION + "".join(f"{line}\r\n" for line in lines).encode() + b"\r\n"
    return gzip.compress(head + block + b"\r\n\r\n", 6, mtime=0)


def with_decisions(pages: DataFrame, least: int = REVISIT_FROM) -> DataFrame:
    """``page_id, url, html, sha1, refers_to``: what each page is written as.

    Of pages with equal payloads of at least ``least`` bytes the one with the largest id is the response.
    A null payload is empty. Null ids are less than all others; pages that share the response's id are
    responses too, and if a group has no id at all, so is each of them."""
    # The digest has 160 bits; the length goes with it.
    rows = pages.withColumn("html", F.coalesce("html", F.lit(""))).withColumn(
        "sha1", F.unhex(F.sha1(F.col("html").cast("binary")))
    ).withColumn("bytes", F.octet_length("html"))
    large = rows.filter(F.col("bytes") >= least).select("page_id", "sha1", "bytes")
    repeated = large.groupBy("sha1", "bytes").agg(
        F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("copies")
    )
    repeated = repeated.filter(F.col("copies") > 1).select("sha1", "bytes", "refers_to")
    decided = rows.join(repeated, ["sha1", "bytes"], "left")
    first = F.col("page_id").eqNullSafe(F.col("refers_to"))
    return decided.select(
        "page_id", "url", "html", "sha1", F.when(~first, F.col("refers_to")).alias("refers_to")
    )


def write(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = REVISIT_FROM
) -> DataFrame:
    """Write a record per page; returns the list of archives: ``folder, file, bytes, records``.

    A null URL has no target line. Rows given twice are written twice. No rows, no archives. A file has a
    name of its own for each attempt at a task, and only those of the attempts that counted are listed."""
    rows = with_decisions(picked(pages, page_id=page_id, url=url, html=html).withColumn("page_id", F.col("page_id").cast("long")), least)
    folder = files.folder(pages.sparkSession, "warc")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size, records = None, 0, 0
        name = f"{uuid.uuid4().hex}.warc.gz"
        for batch in batches:
            for start in range(0, len(batch), 200):
                for row in batch.slice(start, 200).to_pylist():
                    if out is None:
                        system, where = files.created(folder)
                        out = system.open_output_stream(f"{where}/{name}", compression=None)
                    data = record(row["page_id"], row["url"], row["html"].encode(), row["sha1"], row["refers_to"])
                    out.write(data)
                    size += len(data)
                    records += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"folder": folder, "file": name, "bytes": size, "records": records}])

    return stage(rows.mapInArrow(run, "folder string, file string, bytes long, records long"))


@dataclass
class Record:
    kind: str
    page_id: int | None
    url: str | None
    payload: bytes
    payload_bytes: int
    sha1: bytes
    refers_to: int | None


class _Source:
    """Bytes of a file at any place, read in blocks."""

    def __init__(self, source, size: int) -> None:
        self.source, self.size = source, size
        self.start, self.data = 0, b""

    def at(self, place: int, n: int) -> bytes:
        """Up to ``n`` bytes from ``place`` on."""
        if not (self.start <= place and place + n <= self.start + len(self.data)):
            self.source.seek(place)
            self.start, self.data = place, self.source.read(max(n, BLOCK))
        return self.data[place - self.start : place - self.start + n]


def _is_record(source: _Source, place: int) -> bool:
    """Whether the member at a place decodes to the beginning of a record."""
    inflate = zlib.decompressobj(wbits=31)
    try:
        head = inflate.decompress(source.at(place, 512), len(VERSION) + 32)
    except zlib.error:
        return False
    return re.match(rb"WARC/\d+\.\d+\r\n[!-~]+:", head) is not None


def _member(source: _Source, place: int) -> tuple[bytes, int]:
    """The decoded member at a place, and where it ends."""
    inflate = zlib.decompressobj(wbits=31)
    parts = []
    while not inflate.eof:
        data = source.at(place, 1 << 16)
        if not data:
            raise ValueError("the archive ends within a record")
        parts.append(inflate.decompress(data))
        place += len(data) - len(inflate.unused_data)
    return b"".join(parts), place


def _find(source: _Source, place: int, end: int) -> int | None:
    """The first member of a record that begins in [place, end)."""
    step = BLOCK // 2
    while place < end:
        data = source.at(place, min(step + len(GZIP) - 1, end - place + len(GZIP) - 1))
        at = data.find(GZIP)
        if at < 0:
            place += max(1, min(step, len(data)))
        elif place + at >= end:
            return None
        elif _is_record(source, place + at):
            return place + at
        else:
            place += at + 1
    return None


def _headers(lines: bytes) -> dict[str, str]:
    """Header fields by lower-case name; a line that begins with white space goes on with the last one."""
    found: dict[str, str] = {}
    name = None
    for line in lines.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and name:
            found[name] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            found[name] = value.strip()
    return found


def parse(data: bytes) -> Record:
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _headers(head.partition(b"\r\n")[2])
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(_headers(http.partition(b"\r\n")[2]).get("content-length", len(payload)))
    refers = fields.get("warc-refers-to")
    return Record(
        fields["warc-type"],
        _page(fields["warc-record-id"]),
        fields.get("warc-target-uri"),
        payload,
        length,
        base64.b32decode(fields["warc-payload-digest"].partition(":")[2]),
        None if refers is None else _page(refers),
    )


def records_in(source, size: int, start: int, end: int) -> Iterator[Record]:
    """The records that a range of bytes owns."""
    bytes_of = _Source(source, size)
    place = _find(bytes_of, start, min(end, size))
    while place is not None and place < min(end, size):
        if bytes_of.at(place, len(GZIP)) == GZIP and _is_record(bytes_of, place):
            data, place = _member(bytes_of, place)
            yield parse(data)
        else:  # something between records
            place = _find(bytes_of, place + 1, min(end, size))


def read(archives: DataFrame, split: int = SPLIT) -> DataFrame:
    """One row per record of the archives: ``page_id, url, record_type, payload_bytes, payload_digest``
    (bare lower-case hex SHA-1; for a response worked out from the payload), ``refers_to`` and ``payload``
    (null for a revisit)."""
    ranges = archives.filter("bytes > 0").select(
        "folder", "file", "bytes", F.explode(F.expr(f"sequence(0L, bytes - 1, {split}L)")).alias("start")
    )
    spread = ranges.repartition(int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, where = files.opened(row["folder"])
                with system.open_input_file(f"{where}/{row['file']}") as source:
                    found, held = [], 0
                    for item in records_in(source, row["bytes"], row["start"], row["start"] + split):
                        found.append(item)
                        held += len(item.payload)
                        if held > 4 * BLOCK:
                            yield _rows(found)
                            found, held = [], 0
                    if found:
                        yield _rows(found)

    return spread.mapInArrow(
        run,
        "page_id long, url string, record_type string, payload_bytes long, payload_digest string,"
        " refers_to long, payload binary",
    )


def _rows(found: list[Record]) -> pa.RecordBatch:
    import hashlib

    whole = [r.kind == "response" for r in found]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r.page_id for r in found], pa.int64()),
            pa.array([r.url for r in found], pa.string()),
            pa.array([r.kind for r in found], pa.string()),
            pa.array([len(r.payload) if w else r.payload_bytes for r, w in zip(found, whole)], pa.int64()),
            pa.array([hashlib.sha1(r.payload).hexdigest() if w else r.sha1.hex() for r, w in zip(found, whole)]),
            pa.array([r.refers_to for r in found], pa.int64()),
            pa.array([r.payload if w else None for r, w in zip(found, whole)], pa.binary()),
        ],
        ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"],
    )
