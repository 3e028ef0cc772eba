"""Packing: exact encoding, best fit, lossless round trips."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from visitlens.llm import packing
from visitlens.session import scratch_path

ENCODER = packing.Encoder()


def plain(text):
    return ENCODER.encoding.encode_ordinary(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r\x0b\x0c\x1c\x1f\x85\xa0 　'sdtlrev.,!1a2b"),
                                  st.characters(codec="utf-8")), max_size=60))
def test_cached_stretches_encode_as_the_whole_text(text):
    assert np.frombuffer(ENCODER.ids(text), dtype=ENCODER.dtype).tolist() == plain(text)


def brute(lengths, length):
    """Best fit by looking at every row."""
    rows, room = [], []
    for i, n in enumerate(lengths):
        fits = [r for r in range(len(rows)) if room[r] >= n]
        if fits:
            row = min(fits, key=lambda r: room[r])
        else:
            row = len(rows)
            rows.append([])
            room.append(length)
        rows[row].append(i)
        room[row] -= n
    return sorted(length - r for r in room)


@given(st.lists(st.integers(1, 33), max_size=120), st.integers(33, 70))
def test_best_fit_uses_rows_as_a_full_search_does(lengths, length):
    lengths = sorted(lengths, reverse=True)
    rows = packing.best_fit_decreasing(lengths, length)
    assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
    assert sorted(sum(lengths[i] for i in r) for r in rows) == brute(lengths, length)


def unpacked(rows, length):
    pieces = defaultdict(dict)
    for r in rows:
        ids = np.frombuffer(r["ids"], dtype="<u2")
        positions = np.frombuffer(r["positions"], dtype="<u2")
        bounds = r["cu_seqlens"]
        assert len(ids) == len(positions) == length and bounds[0] == 0 and bounds[-1] == r["n_tokens"]
        for doc, piece, a, b in zip(r["doc_ids"], r["pieces"], bounds, bounds[1:]):
            assert positions[a:b].tolist() == list(range(b - a))
            assert piece not in pieces[doc] or doc in (None, 7)
            pieces[doc].setdefault(piece, []).append(ids[a:b].tolist())
        assert (ids[bounds[-1]:] == packing.END).all()
        assert positions[bounds[-1]:].tolist() == list(range(length - bounds[-1]))
    return pieces


@pytest.mark.parametrize("bucket_bytes", [packing.BUCKET_BYTES, 2_000])
def test_round_trip(spark, bucket_bytes):
    random.seed(1)
    texts = {i: " ".join(random.choice(["the", "cat", "Straße", "éàü", "x1", "\n"]) for _ in range(random.randint(0, 90)))
             for i in range(60)} | {100: "long " * 5_000, 101: None, 102: ""}
    df = spark.createDataFrame([(k, v, "p") for k, v in texts.items()] + [(7, texts[7], "p")] * 2 + [(None, "a", "p")],
                               "doc_id long, text string, piece string")
    rows = packing.packed_documents(df, length=64, bucket_bytes=bucket_bytes).collect()
    pieces = unpacked(rows, 64)
    assert len({r["bucket"] for r in rows}) == (1 if bucket_bytes > 2_000 else len({r["bucket"] for r in rows}))
    for doc, text in texts.items():
        found = pieces[doc]
        if doc == 7:
            assert all(len(v) == 3 and v[0] == v[1] == v[2] for v in found.values())
        ids = [i for k in sorted(found) for i in found[k][0]]
        assert ids == plain(text or "") + [packing.END]
        assert ENCODER.encoding.decode(ids[:-1]) == (text or "")
        assert all(len(found[k][0]) == 64 for k in sorted(found)[:-1])
    tokens = sum(r["n_tokens"] for r in rows)
    if bucket_bytes > 2_000:
        assert len(rows) <= math.ceil(tokens / 64 * 1.1)


def test_empty_table(spark):
    assert packing.packed_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_texts_without_bytes_are_dealt_over_buckets(spark):
    n = 200_000
    df = spark.range(n).selectExpr("id doc_id", "cast(null as string) text")
    packed = packing.packed_documents(df)
    rows = packed.select("bucket", "n_tokens").collect()
    by_bucket = defaultdict(int)
    for r in rows:
        by_bucket[r["bucket"]] += r["n_tokens"]
    want = math.ceil(n * packing.ROW_BYTES / packing.BUCKET_BYTES)
    assert sum(by_bucket.values()) == n and len(by_bucket) == want > 1
    assert max(by_bucket.values()) < 1.2 * n / want


def test_matrix_files(spark):
    rows = [(i, "word " * i) for i in range(50)] + [(None, None), (None, ""), (7, "word " * 7), (99, "long " * 900)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    manifest = packing.write_packed(df, scratch_path(spark, "m"), length=32, file_bytes=1_500)
    files = manifest.collect()
    assert len(files) > 1
    by_bucket = defaultdict(list)
    for r in packing.packed_documents(df, length=32, bucket_bytes=1_500).collect():
        by_bucket[r["bucket"]].append(r)
    for m in files:
        want = sorted(by_bucket.pop(m["bucket"]), key=lambda r: r["number"])
        ids = np.load(f"{m['path']}.ids.npy", mmap_mode="r")
        bounds, lines = np.load(f"{m['path']}.cu_seqlens.npy"), np.load(f"{m['path']}.lines.npy")
        assert ids.shape == (m["lines"], 32) and m["n_tokens"] == sum(r["n_tokens"] for r in want)
        for i, row in enumerate(ids):
            assert want[i]["ids"] == row.tobytes() and want[i]["cu_seqlens"] == bounds[lines[0, i]:lines[0, i + 1]].tolist()
    assert not by_bucket


@pytest.mark.parametrize("read_rows", [packing.READ_ROWS, 3])
def test_written_rows_come_back_as_packed(spark, monkeypatch, read_rows):
    monkeypatch.setattr(packing, "READ_ROWS", read_rows)
    rows = [(str(i), "word " * (i % 40), "x") for i in range(120)] + [(None, None, "x"), ("a", "long " * 900, None)]
    df = spark.createDataFrame(rows, "doc_id string, text string, bucket string")
    want = packing.packed_documents(df, length=32, bucket_bytes=4_000)
    got = packing.written_documents(df, scratch_path(spark, "w"), length=32, file_bytes=4_000)
    assert got.dtypes == want.dtypes
    key = lambda r: (r["bucket"], r["number"])
    assert sorted(map(tuple, got.collect()), key=lambda r: r[:2]) == sorted(map(tuple, want.collect()), key=lambda r: r[:2])
    assert len({key(r) for r in want.collect()}) == want.count()


def test_no_documents_no_files(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.written_documents(empty, scratch_path(spark, "none")).count() == 0


def test_positions_begin_again_at_segments_and_padding():
    assert np.frombuffer(packing.positions_of(np.array([0, 3, 4]), 7, "<u2"), "<u2").tolist() == [0, 1, 2, 0, 0, 1, 2]
    assert packing._resets([0, 3, 4], 7) == [0, 3, 4] and packing._resets([0, 3, 7], 7) == [0, 3]


def test_encoder_keeps_nothing_between_texts():
    """Texts of new words cost no more memory than texts of old ones: nothing is kept by word."""
    import tracemalloc

    encoder = packing.Encoder()
    tracemalloc.start()
    for i in range(20_000):
        encoder.ids(f"w{i:x}q {i * i:x}")
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert kept < 100_000
