"""WARC archives: one gzip member per record, written and read sequentially.

A page becomes a ``response`` record whose block is an HTTP response, or, if another page with the
same payload is the response, a ``revisit`` record with the HTTP headers only. Both state the digest
and length of the full payload. Archives lie in a folder that all executors share and pyarrow
reaches (``file``, ``hdfs``, ``s3``, ``gs``); a manifest, committed by Spark, lists those of the
successful task attempts, so what a lost executor left behind is never read.

Defined results: a null html is an empty payload; a null url has no target header; pages with a null
id keep null and are never the response of others; equal (id, html) rows give equal records; an empty
table gives no archive. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import saved
from visitlens.session import scratch_path

MIN_REVISIT_BYTES = 1_000
ARCHIVE_BYTES = 64 << 20  # an archive is closed once it is larger
READ_BYTES = 256 << 10
DATE = "1970-01-01T00:00:00Z"  # no capture time is known
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, records long, bytes long"
RECORDS = ("path string, record_type string, record_id string, page_id long, url string, "
           "payload_bytes long, payload_digest string, refers_to long, payload binary")


def file_system(uri: str):
    """The pyarrow file system of a URI or plain path, and the path in it."""
    from pyarrow import fs

    if uri.startswith("s3a://"):
        uri = "s3://" + uri[len("s3a://"):]
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def with_duplicates(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
                    min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest (hex SHA-1) and refers_to.

    Only digests and ids meet in the aggregate. Pages join the repeated digests; a digest that many
    pages share is a skewed join key, which Spark splits. Small pages take no part.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
                        payload.alias("html"),
                        F.octet_length(payload).cast("long").alias("payload_bytes"),
                        F.sha1(payload.cast("binary")).alias("payload_digest"))
    large = rows.filter(F.col("payload_bytes") >= min_bytes)
    repeated = (large.groupBy("payload_digest")
                .agg(F.max("page_id").alias("head"), F.count("*").alias("n")).filter("n > 1"))
    marked = large.join(repeated, "payload_digest", "left").withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("head")), F.col("head")))
    small = rows.filter(F.col("payload_bytes") < min_bytes).withColumn("refers_to", F.lit(None).cast("long"))
    columns = ["page_id", "url", "html", "payload_bytes", "payload_digest", "refers_to"]
    return marked.select(columns).unionByName(small.select(columns))


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id, digest: str) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:sha1:{digest}>"


def _clean(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c > " " and c != "\x7f" else "%%%02X" % ord(c) for c in value)


def make_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [*headers, ("WARC-Block-Digest", _sha1(block)), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode()) + packer.compress(block + b"\r\n\r\n") + packer.flush()


def page_record(page_id, url, html: str, digest: str, refers_to) -> bytes:
    payload = html.encode("utf-8", "surrogatepass")
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
             f"Content-Length: {len(payload)}\r\n\r\n").encode()
    revisit = refers_to is not None
    headers = [("WARC-Type", "revisit" if revisit else "response"),
               ("WARC-Record-ID", _record_id(page_id, digest)), ("WARC-Date", DATE)]
    if url is not None:
        headers.append(("WARC-Target-URI", _clean(url)))
    headers += [("Content-Type", "application/http; msgtype=response"),
                ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())]
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to, digest))]
    return make_record(headers, block if revisit else block + payload)


def _info_record() -> bytes:
    return make_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{uuid.uuid4().urn}>"),
                        ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")],
                       b"format: WARC File Format 1.1\r\n")


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the rows of ``with_duplicates`` as archives in ``folder``; the manifest: path, records, bytes.

    A task streams its rows into one archive after the other and holds one record at a time.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = file_system(folder)
        system.create_dir(root, recursive=True)
        out, name, records, size = None, "", 0, 0
        for batch in batches:
            done = []
            for page_id, url, html, digest, refers_to in zip(
                    batch["page_id"], batch["url"], batch["html"], batch["payload_digest"],
                    batch["refers_to"]):
                if out is None:
                    name = f"pages-{uuid.uuid4().hex}.warc.gz"
                    out, records = system.open_output_stream(f"{root}/{name}", compression=None), 0
                    size = out.write(_info_record())
                size += out.write(page_record(
                    None if pd.isna(page_id) else int(page_id), url if isinstance(url, str) else None,
                    html, digest, None if pd.isna(refers_to) else int(refers_to)))
                records += 1
                if size >= archive_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", records, size))
                    out = None
            if done:
                yield pd.DataFrame(done, columns=["path", "records", "bytes"])
        if out is not None:
            out.close()
            yield pd.DataFrame([(f"{folder}/{name}", records, size)], columns=["path", "records", "bytes"])

    ids = pages.select(F.col("page_id").cast("string").alias("page_id"), "url", "html", "payload_digest",
                       F.col("refers_to").cast("string").alias("refers_to"))
    return saved(ids.mapInPandas(write, MANIFEST), "warc-manifest")


def gzip_members(source) -> Iterator[Iterator[bytes]]:
    """The members of a gzip stream, each as an iterator of decompressed pieces to be used up in turn."""
    left = b""

    def member() -> Iterator[bytes]:
        nonlocal left
        unpacker = zlib.decompressobj(31)
        while not unpacker.eof:
            data = left or source.read(READ_BYTES)
            if not data:
                raise ValueError("the archive ends within a record")
            piece = unpacker.decompress(data, READ_BYTES)
            left = unpacker.unconsumed_tail or unpacker.unused_data
            if piece:
                yield piece

    while True:
        left = left or source.read(READ_BYTES)
        if not left:
            return
        yield member()


def _headers(data: bytes) -> dict[str, str]:
    lines = data.decode("utf-8", "surrogatepass").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def read_record(pieces: Iterator[bytes]) -> tuple[dict[str, str], bytes]:
    """Headers and block of one member; the stated length frames the block, its digest is verified."""
    data = b""
    while b"\r\n\r\n" not in data:
        data += next(pieces, None) or _fail("no end of headers")
    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        _fail("not a WARC record")
    headers = _headers(head)
    length = int(headers["content-length"])
    parts, have, digest = [rest], len(rest), hashlib.sha1()
    for piece in pieces:
        parts.append(piece)
        have += len(piece)
    block = b"".join(parts)
    if have != length + 4 or block[length:] != b"\r\n\r\n":
        _fail(f"{have} bytes after the headers, {length} and an end of record stated")
    block = block[:length]
    digest.update(block)
    stated = headers.get("warc-block-digest")
    if stated and stated != "sha1:" + base64.b32encode(digest.digest()).decode():
        _fail("the block does not have the stated digest")
    return headers, block


def _fail(what: str):
    raise ValueError(what)


def _page_number(urn: str | None) -> int | None:
    return int(urn[len("<urn:page:"):-1]) if urn and urn.startswith("<urn:page:") else None


def parse_page(headers: dict[str, str], block: bytes) -> dict:
    """The fields of a response or revisit record; a response's payload is held against its digest."""
    head, _, payload = block.partition(b"\r\n\r\n")
    http, kind = _headers(head), headers["warc-type"]
    digest = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()
    if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest
                               or len(payload) != int(http["content-length"])):
        _fail("the payload does not have the stated digest and length")
    return {"record_type": kind, "record_id": headers["warc-record-id"],
            "page_id": _page_number(headers["warc-record-id"]), "url": headers.get("warc-target-uri"),
            "payload_bytes": int(http["content-length"]), "payload_digest": digest,
            "refers_to": _page_number(headers.get("warc-refers-to")),
            "payload": payload if kind == "response" else None}


def read_archives(manifest: DataFrame, payloads: bool = True, rows: int = 256) -> DataFrame:
    """One row per response or revisit record of the archives in ``path``; see RECORDS.

    A task reads its archives from start to end and holds one record and ``rows`` results. A record
    that fails its length or digest raises an error which names the archive.
    """
    columns = [c.split()[0] for c in RECORDS.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri in batch["path"]:
                system, path = file_system(uri)
                held = []
                with system.open_input_stream(path, compression=None) as source:
                    for pieces in gzip_members(source):
                        try:
                            headers, block = read_record(pieces)
                            if headers["warc-type"] not in ("response", "revisit"):
                                continue
                            row = parse_page(headers, block)
                        except (ValueError, KeyError) as error:
                            raise ValueError(f"{uri}: {error}") from error
                        held.append({**row, "path": uri, "payload": row["payload"] if payloads else None})
                        if len(held) >= rows:
                            yield _frame(held, columns)
                            held = []
                if held:
                    yield _frame(held, columns)

    n = max(1, manifest.count())
    return manifest.select("path").repartitionByRange(min(n, 10_000), "path").mapInPandas(read, RECORDS)


def _frame(rows: list[dict], columns: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=columns)
    return frame.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "int64"})


def archive_round_trip(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write the pages as archives in the shared folder and read them back, without payloads."""
    folder = scratch_path(pages.sparkSession, "warc")
    manifest = write_archives(with_duplicates(pages, min_bytes=min_bytes), folder)
    return read_archives(manifest, payloads=False)
