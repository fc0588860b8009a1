import gzip
import hashlib
import io

import pytest

from tankwise.llm import warc
from tests.llm.frames import found

BIG = "<p>é" + "x" * 1_200
ROWS = [
    (1, "http://a.example/ü b\r\nX: y", BIG),
    (2, None, BIG),
    (3, "http://a.example/", BIG),
    (3, "http://a.example/", BIG),  # given twice
    (4, "u", "small"),
    (5, "u", "small"),
    (6, "u", None),
    (7, "u", ""),
    (None, "u", BIG),
    (None, None, "only nulls " * 200),
    (None, None, "only nulls " * 200),
    (8, "u", "line\r\n\r\nline WARC/1.1\r\n" * 3),
    (9, "u", "long " * 400_000),
    (10, "u", "y" * 999),
    (11, "u", "y" * 999),
    (12, "u", "é" * 500),
    (13, "u", "é" * 500),
]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", 1) for r in rows], "page_id long, url string, html string, sha1 string, refers_to string, bytes int")


def expected(rows):
    last = {}
    for i, _, h in rows:
        data = (h or "").encode()
        if i is not None:
            last[data] = max(last.get(data, i), i)
    made = []
    for i, _, h in rows:
        data = (h or "").encode()
        to = last.get(data) if len(data) >= 1_000 else None
        to = None if to == i else to
        made.append((i, len(data), hashlib.sha1(data).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(made, key=repr)


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@pytest.mark.parametrize("split", [50, 700, 1 << 25])
def test_round_trip(spark, split):
    archives = warc.write(pages(spark, ROWS).coalesce(2))
    assert archives.agg({"records": "sum"}).first()[0] == len(ROWS)
    got = warc.read(archives, split)
    assert found(got, *COLUMNS) == expected(ROWS)
    texts = {r["page_id"]: r["payload"] for r in got.filter("record_type = 'response'").collect()}
    assert texts[9] == bytearray(("long " * 400_000).encode())
    urls = {r["page_id"]: r["url"] for r in got.collect()}
    assert urls[1] == "http://a.example/%C3%BC%20b%0D%0AX:%20y" and urls[2] is None


def test_empty_table(spark):
    assert warc.read(warc.write(pages(spark, []))).collect() == []


def test_ranges_share_out_the_records():
    """Also with bytes between the records that look like a member, and records of other writers."""
    parts = [warc.record(k, "u", f"page {k} ".encode() * (k + 1), b"\0" * 20, None) for k in range(40)]
    false = [b"\x1f\x8b\x08 no member", gzip.compress(b"a member, but no record"), b"zz"]
    data = b"".join(p + false[k % 3] for k, p in enumerate(parts))
    for split in (1, 37, 400, 10**6):
        got = [
            r.page_id
            for start in range(0, len(data), split)
            for r in warc.records_in(io.BytesIO(data), len(data), start, start + split)
        ]
        assert got == list(range(40))


def test_archives_are_plain_gzip():
    member = warc.record(5, "http://a/", b"body", b"\1" * 20, 7)
    text = gzip.decompress(member)
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: revisit\r\n") and text.endswith(b"\r\n\r\n\r\n\r\n")
    assert warc.parse(text).refers_to == 7 and warc.parse(text).payload_bytes == 4
