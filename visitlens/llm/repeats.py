"""Exact repeats of word windows, by fixed-block anchors.

With blocks of ``block_length(window)`` words at every multiple of that length, each window of a document holds a whole block.
So a window that is found twice has a block of the one place standing somewhere, perhaps off the grid, in the other.

1. Documents are written as chunks of about ``CHUNK_WORDS`` words: a dictionary and codes. All later steps read chunks.
2. Index and probes: a chunk sends the keys of its blocks and of all its rolling windows of block length, each once, to the
   buckets of the keys. A bucket finds the keys that are a block in one place and stand in another, and tells the chunks.
3. Extension: the windows around such hits go to buckets by 96-bit hashes and further bits for the bucket, one place
   per chunk and window: the earliest. A bucket tells each chunk which of its places is the first of all.
4. Windows that hit and are not the first are repeats; overlapping ones are one maximal exact repeat, and its words go.

A block that stands in a third of all documents is one key per chunk, and a window found everywhere one place per chunk,
so no bucket holds the places of a frequent passage. Messages are sorted numbers as byte planes of differences. Chunks are
stored in a bucketed table, so that only messages pass a shuffle. A task holds one chunk (or one text, if it is longer)
or one bucket of about ``BUCKET_KEYS`` keys.

Defined results: a null text has no words. A place is (doc_id, start); null ids come last. Rows that share an id are one
document: their windows are earlier and later by start alone, and windows at the same place are both kept, so repeated
rows are judged alike. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import mixed, saved
from visitlens.session import scratch_path

WINDOW = 20
CHUNK_WORDS = 1_000_000
BUCKET_KEYS = 4_000_000
BUCKET_BYTES = 64 << 20  # text bytes to a bucket of the table of chunks
MAX_BUCKETS = 50_000
PIECE_BYTES = 4 << 20
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_STEP = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_LAST = np.iinfo(np.int64).max
CHUNK_SCHEMA = "chunk long, n long, doc_ids array<long>, lengths array<long>, words binary, codes binary"


def block_length(window: int) -> int:
    """The longest block of which every window holds one, whole and on the grid."""
    return (window + 1) // 2


def _planes(values: np.ndarray) -> bytes:
    """Differences of the values, byte plane by byte plane: those of sorted values are mostly zeros."""
    gaps = np.diff(values, prepend=values.dtype.type(0))
    return gaps.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _unplanes(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    gaps = np.frombuffer(data, dtype=np.uint8).reshape(size, -1).T.copy().view(dtype).ravel()
    return np.cumsum(gaps, dtype=dtype)


def _pieces(data: bytes) -> Iterator[bytes]:
    """The text in pieces that end at a blank, so that a long text is not held as words at once."""
    start = 0
    while start < len(data):
        blank = _BLANK.search(data, start + PIECE_BYTES)
        stop = blank.start() if blank else len(data)
        yield data[start:stop]
        start = stop


class _Chunk:
    """Words of several documents: a dictionary, codes, and where each document starts."""

    def __init__(self, row: dict):
        self.chunk = row["chunk"]
        self.ids = row["doc_ids"]
        unpack = zstandard.ZstdDecompressor().decompress
        self.words = unpack(row["words"]).split(b" ")
        self.codes = np.frombuffer(unpack(row["codes"]), np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel()
        lengths = np.array(row["lengths"], dtype=np.int64)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.at = np.arange(len(self.codes)) - np.repeat(self.starts, lengths)  # place within the document
        self.left = np.repeat(self.ends, lengths) - np.arange(len(self.codes))  # words up to its end
        self.doc = np.repeat(np.array([_LAST if i is None else i for i in self.ids], dtype=np.int64), lengths)
        digests = [xxhash.xxh3_128_digest(w) for w in self.words]
        self.hashes = np.frombuffer(b"".join(digests), dtype=np.uint64).reshape(-1, 2)

    def rolled(self, k: int, half: int, starts: np.ndarray) -> np.ndarray:
        """Hash of the k words from each start."""
        ids = self.hashes[:, half][self.codes]
        sums = np.zeros(len(starts), dtype=np.uint64)
        for i in range(k):
            sums = sums * _STEP[half] + ids[starts + i]
        return mixed(sums)

    def keys(self, block: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all rolling windows of block length, and their keys: bucket and 32 bits."""
        starts = np.flatnonzero(self.left >= block)
        hashes = self.rolled(block, 0, starts)
        bucket = (hashes >> np.uint64(32)) % np.uint64(buckets)
        return starts, bucket << np.uint64(32) | hashes & np.uint64(0xFFFFFFFF)

    def windows(self, window: int, buckets: int, hits: np.ndarray) -> dict:
        """The windows around hits, with hashes and buckets, and which places are the earliest of their hash here."""
        block = block_length(window)
        starts, keys = self.keys(block, buckets)
        hit = np.zeros(len(self.codes) + 1, dtype=np.int64)
        hit[starts + 1] = np.isin(keys, hits)
        before = np.cumsum(hit)
        starts = np.flatnonzero(self.left >= window)
        starts = starts[before[starts + window - block + 1] > before[starts]]
        one, two = self.rolled(window, 0, starts), self.rolled(window, 1, starts)
        bucket = (two & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)
        two = (two >> np.uint64(32)).astype(np.uint32)
        doc, at = self.doc[starts], self.at[starts]
        order = np.lexsort((at, doc, two, one, bucket))
        same = np.ones(len(order), dtype=bool)
        for column in (one, two, bucket):
            same[1:] &= column[order][1:] == column[order][:-1]
        same[:1] = False
        group = np.empty(len(order), dtype=np.int64)
        group[order] = np.cumsum(~same) - 1
        first = order[~same]  # by group
        earliest = (doc == doc[first][group]) & (at == at[first][group])
        sent = np.lexsort((starts[first], bucket[first]))  # groups in the order in which they are sent
        return {"starts": starts, "one": one, "two": two, "bucket": bucket, "doc": doc, "at": at, "group": group,
                "first": first, "earliest": earliest, "sent": sent}


def chunks(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = CHUNK_WORDS) -> DataFrame:
    """The documents as chunks: rows of CHUNK_SCHEMA."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first, ordinal = TaskContext.get().partitionId() << 32, 0
        pack = zstandard.ZstdCompressor(level=3).compress
        ids, lengths, codes, known = [], [], [], {}

        def row():
            joined = np.concatenate([np.zeros(0, np.uint32), *codes])
            return pa.RecordBatch.from_pylist([{
                "chunk": first + ordinal, "n": len(joined), "doc_ids": ids, "lengths": lengths, "words": pack(b" ".join(known)),
                "codes": pack(joined.view(np.uint8).reshape(-1, 4).T.tobytes())}], schema=pa.schema([
                    ("chunk", pa.int64()), ("n", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                    ("lengths", pa.list_(pa.int64())), ("words", pa.binary()), ("codes", pa.binary())]))

        for batch in batches:
            for one, value in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids.append(one)
                lengths.append(0)
                for piece in _pieces((value.as_py() or "").encode()):
                    part = np.array([known.setdefault(w, len(known)) for w in piece.split()], dtype=np.uint32)
                    codes.append(part)
                    lengths[-1] += len(part)
                if sum(map(len, codes)) >= words or len(ids) >= words:
                    yield row()
                    ordinal += 1
                    ids, lengths, codes, known = [], [], [], {}
                elif len(codes) > 64:
                    codes = [np.concatenate(codes)]
        if ids:
            yield row()

    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, CHUNK_SCHEMA)


def _stored(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows written once to the shared folder, bucketed by chunk. The name leaves the catalog, the files stay."""
    spark = rows.sparkSession
    path = scratch_path(spark, "chunks")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    rows.write.bucketBy(buckets, "chunk").option("path", path).saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return stored


def _split(bucket: np.ndarray) -> list[tuple[int, slice]]:
    """Buckets and their slices; the rows are sorted by bucket."""
    found, at = np.unique(bucket, return_index=True)
    return [(int(b), slice(i, j)) for b, i, j in zip(found, at, [*at[1:], len(bucket)])]


def _probes(stored: DataFrame, window: int, buckets: int) -> DataFrame:
    """bucket, chunk and four sorted lists of keys: found once or more often in the chunk, off or on the grid."""
    block = block_length(window)
    names = ["once", "once_block", "often", "often_block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = _Chunk(row)
                starts, keys = chunk.keys(block, buckets)
                found, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
                kind = 2 * (counts > 1)
                on_grid = np.zeros(len(found), dtype=bool)
                on_grid[inverse[chunk.at[starts] % block == 0]] = True
                kind = kind + on_grid
                low = (found & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                rows = [{"bucket": b, "chunk": chunk.chunk, **{name: _planes(low[part][kind[part] == k])
                                                               for k, name in enumerate(names)}}
                        for b, part in _split((found >> np.uint64(32)).astype(np.int64))]
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
                    [("bucket", pa.int64()), ("chunk", pa.int64()), *((name, pa.binary()) for name in names)]))

    return stored.mapInArrow(run, f"bucket long, chunk long, {', '.join(f'{n} binary' for n in names)}")


def _hits(probes: DataFrame) -> DataFrame:
    """chunk, bucket and the keys of the chunk that are a block in one place and stand in another."""

    def run(table: pa.Table) -> pa.Table:
        lists = [[_unplanes(v, np.uint32) for v in row] for row in
                 zip(*(table.column(n).to_pylist() for n in ("once", "once_block", "often", "often_block")))]
        keys = np.concatenate([k for row in lists for k in row])
        kinds = np.concatenate([np.full(len(k), at, dtype=np.int8) for row in lists for at, k in enumerate(row)])
        order = np.argsort(keys, kind="stable")
        keys, kinds = keys[order], kinds[order]
        new = np.flatnonzero(np.diff(keys.astype(np.int64), prepend=-1))
        if not len(new):
            return table.select(["chunk", "bucket"]).slice(0, 0).append_column("data", pa.array([], pa.binary()))
        places = np.add.reduceat(1 + (kinds >= 2), new)
        on_grid = np.logical_or.reduceat(kinds % 2 == 1, new)
        hit = keys[new][(places > 1) & on_grid]
        mine = [np.intersect1d(hit, np.concatenate(row)) for row in lists]
        told = pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"),
                         "data": pa.array([_planes(k) for k in mine], pa.binary())})
        return told.filter(pa.array([len(k) > 0 for k in mine], pa.bool_()))

    return probes.groupBy("bucket").applyInArrow(run, "chunk long, bucket long, data binary")


def _keys_of(table: pa.Table) -> np.ndarray:
    keys = [np.uint64(b) << np.uint64(32) | _unplanes(d, np.uint32).astype(np.uint64)
            for b, d in zip(table.column("bucket").to_pylist(), table.column("data").to_pylist())]
    return np.concatenate([np.zeros(0, np.uint64), *keys])


def _extensions(stored: DataFrame, hits: DataFrame, window: int, buckets: int) -> DataFrame:
    """bucket, chunk and for the windows around hits their hashes and earliest places in the chunk."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        for row in left.to_pylist():
            chunk = _Chunk(row)
            w = chunk.windows(window, buckets, _keys_of(right))
            sent = w["first"][w["sent"]]
            for b, part in _split(w["bucket"][sent].astype(np.int64)):
                here = sent[part]
                rows.append({"bucket": b, "chunk": chunk.chunk, "one": w["one"][here].tobytes(), "two": w["two"][here].tobytes(),
                             "doc": _planes(w["doc"][here]), "at": _planes(w["at"][here])})
        return pa.Table.from_pylist(rows, schema=pa.schema(
            [("bucket", pa.int64()), ("chunk", pa.int64()), *((c, pa.binary()) for c in ("one", "two", "doc", "at"))]))

    return stored.groupBy("chunk").cogroup(hits.groupBy("chunk")).applyInArrow(
        run, "bucket long, chunk long, one binary, two binary, doc binary, at binary")


def _owners(extensions: DataFrame) -> DataFrame:
    """chunk, bucket and for each window sent whether its place is the first of all, as bits."""

    def run(table: pa.Table) -> pa.Table:
        def column(name, read):
            return [read(v) for v in table.column(name).to_pylist()]

        ones = column("one", lambda v: np.frombuffer(v, np.uint64))
        sizes = [len(v) for v in ones]
        one, two, doc, at = (np.concatenate(v) for v in (
            ones, column("two", lambda v: np.frombuffer(v, np.uint32)), column("doc", lambda v: _unplanes(v, np.int64)),
            column("at", lambda v: _unplanes(v, np.int64))))
        order = np.lexsort((at, doc, two, one))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
        first = order[new][np.cumsum(new) - 1]
        owns = np.empty(len(order), dtype=bool)
        owns[order] = (doc[order] == doc[first]) & (at[order] == at[first])
        bits = [np.packbits(part).tobytes() for part in np.split(owns, np.cumsum(sizes)[:-1])]
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "data": pa.array(bits, pa.binary())})

    return extensions.groupBy("bucket").applyInArrow(run, "chunk long, bucket long, data binary")


def _cut(stored: DataFrame, told: DataFrame, window: int, buckets: int) -> DataFrame:
    """The documents of each chunk less their repeats. ``told``: hits and owners, by ``kind``."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.string())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        owners = {r["bucket"]: r["data"] for r in right.filter(pa.compute.equal(right.column("kind"), "owners")).to_pylist()}
        hits = _keys_of(right.filter(pa.compute.equal(right.column("kind"), "hits")))
        for row in left.to_pylist():
            chunk = _Chunk(row)
            w = chunk.windows(window, buckets, hits)
            owns = np.zeros(len(w["first"]), dtype=bool)  # by group
            for b, part in _split(w["bucket"][w["first"][w["sent"]]].astype(np.int64)):
                groups = w["sent"][part]
                owns[groups] = np.unpackbits(np.frombuffer(owners[b], np.uint8), count=len(groups)).astype(bool)
            repeated = w["starts"][~(w["earliest"] & owns[w["group"]])]
            change = np.zeros(len(chunk.codes) + 1, dtype=np.int64)
            change[repeated] += 1
            change[repeated + window] -= 1
            gone = np.cumsum(change)[:-1] > 0
            for one, start, end in zip(chunk.ids, chunk.starts.tolist(), chunk.ends.tolist()):
                mask = gone[start:end]
                turns = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
                kept = b" ".join([chunk.words[c] for c in chunk.codes[start:end][~mask].tolist()]).decode()
                rows.append({"doc_id": one, "n_words": end - start, "n_removed": int(mask.sum()),
                             "spans": [{"start": s, "end": e} for s, e in turns.tolist()], "kept": kept})
        return pa.Table.from_pylist(rows, schema=schema)

    return stored.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
        run, "doc_id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept string")


def without_repeats(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
                    chunk_words: int = CHUNK_WORDS, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """doc_id, n_words, n_removed, spans (words from, up to; maximal repeats of earlier places) and kept (the other
    words, joined by one blank), a row per document."""
    size = documents.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    stored = _stored(chunks(documents, doc_id, text, chunk_words), min(MAX_BUCKETS, max(1, -(-size // BUCKET_BYTES))))
    buckets = max(1, -(-(stored.agg(F.sum("n")).first()[0] or 0) // bucket_keys))
    hits = saved(_hits(_probes(stored, window, buckets)), "repeat-hits")
    owners = _owners(_extensions(stored, hits, window, buckets))
    told = hits.withColumn("kind", F.lit("hits")).unionByName(owners.withColumn("kind", F.lit("owners")))
    return _cut(stored, told, window, buckets)
