"""Token ids of documents, packed into rows of a fixed length for training.

Texts are encoded with a public byte-level vocabulary and end with an end-of-text id. A document longer
than a row is cut into pieces, which in turn are the document again. Pieces are dealt by hash into
buckets of about ``BUCKET_BYTES`` (a document counts its text and ``ROW_BYTES``, so texts of a word or
none fill buckets too), and each bucket is packed by itself: longest piece first, each
into the row with the least room that is enough (best fit decreasing). A segment tree over the capacities
0 to L finds that row in about log2(L) steps. A bucket is bounded whatever the data hold; equal documents
are dealt apart by their place in the input.

A packed row has its ids (little-endian uint16, or uint32 for larger vocabularies, filled up with the
padding id), the cumulative lengths of its segments from 0, the position of each id in its segment, and
the document and piece of each segment. ``packed_documents`` returns such rows. ``write_packed`` has the
packing tasks write them as files and returns the manifest, and ``read_packed`` turns a manifest into rows
again. Only files in the manifest count: a task that ran twice leaves unused ones.

Defined results: null and empty texts are one end-of-text id; repeated rows are packed each; null ids stay
null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import saved

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END = 50_256  # free in the vocabulary: end of text, and padding
LENGTH = 2_048
BUCKET_BYTES = 4 << 20
FILE_BYTES = 16 << 20  # of text in the files of one packing task; larger for large corpora, as memory allows
ROW_BYTES = 256  # what a document costs beside its text
ROWS = 256
READ_ROWS = 1_000
FILES_A_TASK = 4  # read by one task
# How the vocabulary splits text before it merges bytes (fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Packed ids of texts. Whole texts go to the library: a cache of stretches in Python costs more than it saves."""

    def __init__(self, vocabulary: str = VOCABULARY):
        import base64

        import tiktoken

        with open(vocabulary, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.dtype = id_type(max(ranks.values()))

    def ids(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), dtype=self.dtype).tobytes()


def id_type(largest: int) -> str:
    return "<u2" if largest < 1 << 16 else "<u4"


def with_ids(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
             end: int = END, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, piece (from 0), n, ids (packed) and row (the document's place), a row per piece."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        size = np.dtype(encoder.dtype).itemsize
        last = np.array([end], dtype=encoder.dtype).tobytes()
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                place, number, pieces, rows_ = [], [], [], []
                for i, value in enumerate(part.column("text").to_pylist()):
                    ids = encoder.ids(value or "") + last
                    for at in range(0, len(ids), length * size):
                        place.append(i)
                        number.append(at // (length * size))
                        pieces.append(ids[at:at + length * size])
                        rows_.append(row)
                    row += 1
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(pa.array(place)), pa.array(number, pa.int32()),
                    pa.array([len(p) // size for p in pieces], pa.int32()), pa.array(pieces, pa.binary()),
                    pa.array(rows_, pa.int64())], ["doc_id", "piece", "n", "ids", "row"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, piece int, n int, ids binary, row long")


class Capacities:
    """Open rows by room left; a segment tree tells the least room of at least n."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(length + 1)]

    def add(self, room: int, row: int) -> None:
        self.open[room].append(row)
        self._change(room, 1)

    def _change(self, room: int, by: int) -> None:
        node = self.leaves + room
        while node:
            self.count[node] += by
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """The room and number of the row with the least room of at least ``least``, which is removed."""
        node = self.leaves + least
        if not self.count[node]:
            # Up until a right sibling has rows, then down to its first.
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._change(room, -1)
        return room, self.open[room].pop()


def best_fit_decreasing(lengths: list[int], length: int) -> list[list[int]]:
    """Rows of piece numbers. ``lengths`` fall; none is above ``length``."""
    rows: list[list[int]] = []
    capacities = Capacities(length)
    for i, n in enumerate(lengths):
        found = capacities.take(n)
        if found is None:
            room, row = length, len(rows)
            rows.append([])
        else:
            room, row = found
        rows[row].append(i)
        if room > n:
            capacities.add(room - n, row)
    return rows


def pack_bucket(table: pa.Table, length: int, end: int, dtype: str) -> pa.Table:
    """number, n_tokens, ids, cu_seqlens, doc_ids and pieces: the packed rows of one bucket of pieces."""
    table = table.sort_by([("n", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("row", "ascending")])
    n, ids = table.column("n").to_pylist(), table.column("ids").to_pylist()
    number = table.column("piece").to_pylist()
    rows = best_fit_decreasing(n, length)
    matrix, bounds, used = [], [], []
    filler = np.full(length, end, dtype=dtype).tobytes()
    width = np.dtype(dtype).itemsize
    for row in rows:
        lengths = [n[i] for i in row]
        total = sum(lengths)
        matrix.append(b"".join([*(ids[i] for i in row), filler[:(length - total) * width]]))
        bounds.append(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
        used.append(total)
    flat = pa.array([i for row in rows for i in row], pa.int64())
    offsets = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32))
    return pa.table({
        "number": pa.array(range(len(rows)), pa.int32()), "n_tokens": pa.array(used, pa.int32()),
        "ids": pa.array(matrix, pa.binary()), "cu_seqlens": pa.array(bounds, pa.list_(pa.int32())),
        "doc_ids": pa.ListArray.from_arrays(offsets, table.column("doc_id").combine_chunks().take(flat)),
        "pieces": pa.array([[number[i] for i in row] for row in rows], pa.list_(pa.int32()))})


def positions_of(resets: np.ndarray, length: int, dtype: str) -> bytes:
    """The position of each id of a row, from the places where positions begin again at 0."""
    runs = np.diff(np.append(resets, length))
    return (np.arange(length) - np.repeat(resets, runs)).astype(dtype).tobytes()


def _resets(bounds: list[int], length: int) -> list[int]:
    """Where positions begin again: at each segment, and at the padding if there is any."""
    return bounds if bounds[-1] < length else bounds[:-1]


def packed_schema(kind: str) -> str:
    return (f"bucket int, number int, n_tokens int, ids binary, cu_seqlens array<int>, positions binary, "
            f"doc_ids array<{kind}>, pieces array<int>")


def _in_buckets(pieces: DataFrame, n_buckets: int) -> DataFrame:
    return pieces.withColumn("bucket", F.pmod(F.xxhash64("row", "piece"), F.lit(n_buckets)).cast("int"))


def pack(pieces: DataFrame, n_buckets: int, length: int = LENGTH, end: int = END, dtype: str = "<u2") -> DataFrame:
    """Packed rows: bucket, number, n_tokens, ids, cu_seqlens, positions, doc_ids, pieces."""
    kind = pieces.schema["doc_id"].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        rows = pack_bucket(table, length, end, dtype)
        places = [positions_of(np.array(_resets(b, length)), length, dtype) for b in rows.column("cu_seqlens").to_pylist()]
        bucket = pa.array([table.column("bucket")[0].as_py()] * rows.num_rows, pa.int32())
        return (rows.append_column("bucket", bucket).append_column("positions", pa.array(places, pa.binary()))
                .select(["bucket", "number", "n_tokens", "ids", "cu_seqlens", "positions", "doc_ids", "pieces"]))

    return _in_buckets(pieces, n_buckets).groupBy("bucket").applyInArrow(run, packed_schema(kind))


def _n_buckets(documents: DataFrame, text: str, bucket_bytes: int) -> int:
    """As many as the bytes of all texts and the number of rows ask for."""
    size = F.coalesce(F.octet_length(F.col(text)).cast("long"), F.lit(0)) + ROW_BYTES
    return max(1, math.ceil((documents.agg(F.sum(size)).first()[0] or 0) / bucket_bytes))


def packed_documents(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                     end: int = END, vocabulary: str = VOCABULARY, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Packed rows of all documents. The number of buckets follows the bytes of all texts and the number of rows."""
    pieces = with_ids(documents, doc_id, text, length, end, vocabulary)
    return pack(pieces, _n_buckets(documents, text, bucket_bytes), length, end)


def write_packed(documents: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                 end: int = END, vocabulary: str = VOCABULARY, file_bytes: int = FILE_BYTES,
                 dtype: str = "<u2") -> DataFrame:
    """Packs all documents into files of a shared folder; returns the manifest: bucket, path, lines, n_tokens.

    The task that packs a bucket writes it under a name of its own, so that nothing else is sent on:
    ``.ids.npy``, a matrix with a line per packed row that can be mapped into memory; ``.cu_seqlens.npy`` and
    ``.resets.npy``, the cumulative lengths and the places where positions begin again, all lines in one list;
    ``.lines.npy``, where each line starts in these two; ``.segments.arrow``, documents and pieces.
    """
    from visitlens.llm.warc import file_system

    def write(table: pa.Table) -> pa.Table:
        rows = pack_bucket(table, length, end, dtype)
        bounds = rows.column("cu_seqlens").to_pylist()
        resets = [_resets(b, length) for b in bounds]
        arrays = {
            "ids": np.frombuffer(b"".join(rows.column("ids").to_pylist()), dtype=dtype).reshape(-1, length),
            "cu_seqlens": np.concatenate([np.array(b, dtype=np.int32) for b in bounds]),
            "resets": np.concatenate([np.array(r, dtype=np.int32) for r in resets]),
            "lines": np.array([np.cumsum([0, *map(len, x)]) for x in (bounds, resets)], dtype=np.int64)}
        system, root = file_system(folder)
        system.create_dir(root, recursive=True)
        name = f"packed-{uuid.uuid4().hex}"
        for kind, array in arrays.items():
            with system.open_output_stream(f"{root}/{name}.{kind}.npy", compression=None) as out:
                np.lib.format.write_array(_Sink(out), array, allow_pickle=False)
        segments = rows.select(["number", "n_tokens", "doc_ids", "pieces"])
        with system.open_output_stream(f"{root}/{name}.segments.arrow", compression=None) as out:
            with pa.ipc.new_file(out, segments.schema) as writer:
                writer.write_table(segments, max_chunksize=READ_ROWS)
        return pa.table({
            "bucket": pa.array([table.column("bucket")[0].as_py()], pa.int32()), "path": [f"{folder}/{name}"],
            "lines": pa.array([rows.num_rows], pa.int64()),
            "n_tokens": pa.array([sum(rows.column("n_tokens").to_pylist())], pa.int64())})

    pieces = with_ids(documents, doc_id, text, length, end, vocabulary)
    dealt = _in_buckets(pieces, _n_buckets(documents, text, file_bytes))
    return saved(dealt.groupBy("bucket").applyInArrow(write, "bucket int, path string, lines long, n_tokens long"),
                 "packed-manifest")


def read_packed(manifest: DataFrame, kind: str = "bigint", length: int = LENGTH, dtype: str = "<u2") -> DataFrame:
    """The packed rows in the files of a manifest, like those of ``packed_documents``; ``kind`` is the ids' type.

    A file is read by one task, ``READ_ROWS`` rows at a time."""
    from visitlens.llm.warc import file_system

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, path in zip(batch.column("bucket").to_pylist(), batch.column("path").to_pylist()):
                system, root = file_system(path)

                def whole(name):
                    with system.open_input_stream(f"{root}.{name}.npy", compression=None) as file:
                        return np.lib.format.read_array(_Source(file), allow_pickle=False)

                bounds, resets, lines = whole("cu_seqlens"), whole("resets"), whole("lines")
                with (system.open_input_stream(f"{root}.ids.npy", compression=None) as ids,
                      system.open_input_file(f"{root}.segments.arrow") as file):
                    source = _Source(ids)
                    np.lib.format.read_magic(source)
                    shape, _, stored = np.lib.format.read_array_header_1_0(source)
                    if shape != (lines.shape[1] - 1, length) or stored != np.dtype(dtype):
                        raise ValueError(f"{path}: the matrix is {shape} of {stored}")
                    segments, at = pa.ipc.open_file(file), 0
                    for k in range(segments.num_record_batches):
                        part = segments.get_batch(k)
                        width = length * stored.itemsize
                        data = source.read(part.num_rows * width)
                        rows = range(at, at + part.num_rows)
                        yield pa.RecordBatch.from_arrays([
                            pa.array([bucket] * part.num_rows, pa.int32()), part.column("number"), part.column("n_tokens"),
                            pa.array([data[i * width:(i + 1) * width] for i in range(part.num_rows)], pa.binary()),
                            pa.array([bounds[lines[0, i]:lines[0, i + 1]] for i in rows], pa.list_(pa.int32())),
                            pa.array([positions_of(resets[lines[1, i]:lines[1, i + 1]], length, dtype) for i in rows],
                                     pa.binary()),
                            part.column("doc_ids"), part.column("pieces")],
                            ["bucket", "number", "n_tokens", "ids", "cu_seqlens", "positions", "doc_ids", "pieces"])
                        at += part.num_rows

    # Lines of a manifest are small and their files are not: a stated number of tasks is not merged by size.
    tasks = max(1, math.ceil(manifest.count() / FILES_A_TASK))
    return manifest.repartition(tasks, "path").mapInArrow(read, packed_schema(kind))


def written_documents(documents: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text",
                      **options) -> DataFrame:
    """All documents packed, written as matrix files into ``folder`` and read back."""
    kind = documents.schema[doc_id].dataType.simpleString()
    manifest = write_packed(documents, folder, doc_id, text, **options)
    return read_packed(manifest, kind, options.get("length", LENGTH), options.get("dtype", "<u2"))


class _Sink:
    """What numpy needs of a file."""

    def __init__(self, out):
        self.out = out

    def write(self, data) -> int:
        return self.out.write(data)


class _Source:
    """What numpy needs of a file to read: as many bytes as asked for while there are any."""

    def __init__(self, file):
        self.file = file

    def read(self, n: int) -> bytes:
        parts = []
        while n > 0:
            part = self.file.read(n)
            if not part:
                break
            parts.append(part)
            n -= len(part)
        return b"".join(parts)
