"""WARC archives: exact round trips, revisits, framing errors."""

import gzip
import hashlib
import io

import pytest

from visitlens.llm import warc
from visitlens.session import scratch_path


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload_bytes string")


ROWS = [(1, "http://a/", "x" * 1200, "c"), (2, "http://b/\r\nX: y", "x" * 1200, None), (3, None, "é" * 500, None),
        (4, "u", "é" * 500, None), (5, "u", "s", None), (6, "u", "s", None), (7, "u", None, None), (8, "u", "", None),
        (None, "u", "x" * 1200, None), (9, "u", "\r\n\r\nWARC/1.1\r\n" * 100, None), (2, "u", "x" * 1200, None)]


def test_round_trip(spark):
    marked = warc.with_duplicates(pages(spark, ROWS))
    # one archive per record or one for all
    for size in (1, warc.ARCHIVE_BYTES):
        manifest = warc.write_archives(marked, scratch_path(spark, "t"), size)
        records = warc.read_archives(manifest, rows=2).collect()
        assert sum(r["records"] for r in manifest.collect()) == len(records) == len(ROWS)
        got = sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"])
                      for r in records), key=str)
        heads = {"x" * 1200: 2, "é" * 500: 4, "\r\n\r\nWARC/1.1\r\n" * 100: 9}
        want = []
        for page_id, _, html, _ in ROWS:
            data = (html or "").encode()
            head = heads.get(html)
            again = head is not None and head != page_id
            want.append((page_id, "revisit" if again else "response", head if again else None, len(data),
                         hashlib.sha1(data).hexdigest()))
        assert got == sorted(want, key=str)
        for r in records:
            if r["record_type"] == "response":
                assert hashlib.sha1(r["payload"]).hexdigest() == r["payload_digest"]


def test_empty_table(spark):
    assert warc.archive_round_trip(pages(spark, [])).count() == 0


def test_each_record_is_a_gzip_member_that_others_can_read(spark):
    data = b"".join(warc.page_record(i, "u", "text" * i, hashlib.sha1(b"text" * i).hexdigest(), None)
                    for i in range(1, 4))
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 3
    blocks = [warc.read_record(m)[1] for m in warc.gzip_members(io.BytesIO(data))]
    assert [b.partition(b"\r\n\r\n")[2] for b in blocks] == [b"text" * i for i in range(1, 4)]


def test_large_record_and_small_reads(monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", 7)
    html = "0123456789" * 3_000
    data = warc.page_record(1, "u", html, hashlib.sha1(html.encode()).hexdigest(), None) * 2
    for pieces in warc.gzip_members(io.BytesIO(data)):
        assert warc.parse_page(*warc.read_record(pieces))["payload"] == html.encode()


def test_damage_is_noticed():
    good = warc.make_record([("WARC-Type", "response")], b"HTTP/1.1 200 OK\r\n\r\nbody")
    plain = gzip.decompress(good)
    for bad in (gzip.compress(plain.replace(b"body", b"bodY")), gzip.compress(plain[:-1]), good[:-9],
                gzip.compress(plain.replace(b"WARC/", b"CRAW/")), gzip.compress(b"WARC/1.1\r\nno end")):
        with pytest.raises(ValueError):
            for pieces in warc.gzip_members(io.BytesIO(bad)):
                warc.read_record(pieces)
