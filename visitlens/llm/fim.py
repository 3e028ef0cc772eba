"""Fill-in-the-middle forms of documents over seekable compressed frames.

1. ``store`` keeps each text as independent zstandard frames of ``FRAME_UNITS`` code points, with the number of
   code points up to the end of each frame.
2. ``draw`` decides form and cuts from the id alone, in SQL expressions: no two runs differ.
3. ``arrange`` looks the cuts up in the cumulative counts, decompresses the frames that hold a cut and passes
   all others on as they are. Its frames, joined, are one zstandard stream of the output.
4. ``digests`` streams the ordered frames: the digest of the output, and of the text rebuilt from output and
   form alone. ``output_texts`` gives the outputs as strings.

No step moves rows between tasks, and a task holds one text and a few frames. Defined results: a null text is an
empty one; empty texts, and those that hold one of the markers, stay plain; a null id draws as an empty id;
repeated rows give repeated results; an empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import saved

FRAME_UNITS = 65_536
SEED = 1
PLAIN_PERCENT = 10
SPM_PERCENT = 20
# Markers of the parts (fixed values).
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
# Markers in the order of the output, and the place of prefix, middle and suffix among them.
FORMS = {"psm": ((PREFIX, SUFFIX, MIDDLE), (0, 2, 1)), "spm": ((SUFFIX, PREFIX, MIDDLE), (1, 2, 0))}


def store(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", units: int = FRAME_UNITS) -> DataFrame:
    """doc_id, n (code points), marked (holds a marker), frames, ends (code points up to the end of each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            n, marked, frames, ends = [], [], [], []
            for value in batch.column("text"):
                one = value.as_py() or ""
                n.append(len(one))
                marked.append(any(m.decode() in one for m in (PREFIX, SUFFIX, MIDDLE)))
                frames.append([pack(one[i:i + units].encode()) for i in range(0, len(one), units)])
                ends.append([min(i + units, len(one)) for i in range(0, len(one), units)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(marked, pa.bool_()),
                 pa.array(frames, pa.list_(pa.binary())), pa.array(ends, pa.list_(pa.int64()))],
                ["doc_id", "n", "marked", "frames", "ends"])

    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, marked boolean, frames array<binary>, ends array<long>")


def _drawn(k: int) -> Column:
    """The k-th group of eight digits of the id's digest, as a number."""
    key = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(key, 8 * k - 7, 8), 16, 10).cast("long")


def draw(stored: DataFrame) -> DataFrame:
    """``stored`` with form, low and high: the prefix ends at ``low``, the middle at ``high`` code points."""
    cuts = [F.pmod(_drawn(k), F.col("n") + 1) for k in (1, 2)]
    plain = (F.col("n") == 0) | F.col("marked") | (F.pmod(_drawn(3), F.lit(100)) >= 100 - PLAIN_PERCENT)
    form = F.when(plain, "plain").when(F.pmod(_drawn(4), F.lit(100)) < SPM_PERCENT, "spm").otherwise("psm")
    return stored.withColumns({"form": form, "low": F.least(*cuts), "high": F.greatest(*cuts)})


def _arranged(frames: list[bytes], ends: list[int], form: str, low: int, high: int) -> list[bytes]:
    """The frames of the output: whole frames as they are, cut ones and markers compressed anew."""
    if form == "plain":
        return frames
    opened: dict[int, str] = {}
    pack, unpack = zstandard.ZstdCompressor(level=3).compress, zstandard.ZstdDecompressor().decompress
    result: list[bytes] = []
    loose: list[bytes] = []

    def close():
        if loose:
            result.append(pack(b"".join(loose)))
            loose.clear()

    def add(start, stop):
        for i, end in enumerate(ends):
            begin = ends[i - 1] if i else 0
            if start <= begin and end <= stop:
                close()
                result.append(frames[i])
            elif begin < stop and start < end:
                if i not in opened:
                    opened[i] = unpack(frames[i]).decode()
                loose.append(opened[i][max(start - begin, 0):stop - begin].encode())

    parts = {PREFIX: (0, low), MIDDLE: (low, high), SUFFIX: (high, ends[-1])}
    for marker in FORMS[form][0]:
        loose.append(marker)
        add(*parts[marker])
    close()
    return result


def arrange(drawn: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars (null if plain) and the frames of the output, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("frames", "ends", "form", "low", "high")
        for batch in batches:
            frames = [_arranged(*(v.as_py() for v in row)) for row in zip(*(batch.column(c) for c in names))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "n", "form", "low", "high")),
                 pa.array(frames, pa.list_(pa.binary()))], ["doc_id", "n", "form", "low", "high", "frames"])

    rows = drawn.select("doc_id", "n", "form", "low", "high", "frames", "ends").mapInArrow(
        run, "doc_id long, n long, form string, low long, high long, frames array<binary>")
    cut = F.col("form") != "plain"
    return rows.select("doc_id", "n", "form", F.when(cut, F.col("low")).alias("prefix_chars"),
                       F.when(cut, F.col("high") - F.col("low")).alias("middle_chars"), "frames")


def _digests(frames: list[bytes], form: str) -> tuple[str, str]:
    """Digest of the output, and of the text that output and form give back. Frames are opened one at a time."""
    unpack = zstandard.ZstdDecompressor().decompress
    markers, places = FORMS.get(form, ((), ()))
    output, found, sizes, rest = hashlib.sha256(), [], [], b""
    for frame in frames:
        data = unpack(frame)
        output.update(data)
        base, seen, at = sum(sizes) - len(rest), rest + data, 0
        sizes.append(len(data))
        while len(found) < len(markers) and (k := seen.find(markers[len(found)], at)) >= 0:
            found.append(base + k)
            at = k + len(markers[0])
        rest = seen[max(at, len(seen) - 2):]  # a marker may begin in the last two bytes
    if form == "plain":
        return output.hexdigest(), output.hexdigest()
    stops = [*found[1:], sum(sizes)]
    restored = hashlib.sha256()
    for place in places:
        start, stop, begin = found[place] + len(markers[0]), stops[place], 0
        for frame, size in zip(frames, sizes):
            if begin < stop and start < begin + size:
                restored.update(unpack(frame)[max(start - begin, 0):stop - begin])
            begin += size
    return output.hexdigest(), restored.hexdigest()


def digests(arranged: DataFrame) -> DataFrame:
    """``arranged`` with output_sha256 and restored_sha256 in place of the frames."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [_digests(f.as_py(), form.as_py()) for f, form in zip(batch.column("frames"), batch.column("form"))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in batch.schema.names if c != "frames"),
                 *(pa.array([p[k] for p in pairs], pa.string()) for k in (0, 1))],
                [*(c for c in batch.schema.names if c != "frames"), "output_sha256", "restored_sha256"])

    return arranged.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, "
                                    "output_sha256 string, restored_sha256 string")


def output_texts(arranged: DataFrame) -> DataFrame:
    """``arranged`` with the output as a string in place of the frames."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            texts = [b"".join(map(unpack, f.as_py())).decode() for f in batch.column("frames")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in batch.schema.names if c != "frames"), pa.array(texts, pa.string())],
                [*(c for c in batch.schema.names if c != "frames"), "output"])

    return arranged.mapInArrow(
        run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def fill_in_middle(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The arranged frames of every document; the store is written to the shared folder first."""
    return arrange(draw(saved(store(documents, doc_id, text), "frames")))
