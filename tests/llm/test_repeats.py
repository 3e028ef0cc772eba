"""Repeats of word windows against a plain version that holds all windows of all documents."""

import random

import numpy as np
import pytest

from tests.llm.helpers import documents, prose
from visitlens.llm import repeats

LAST = 2**63 - 1


def plain_version(rows, window):
    """doc_id, n_words, n_removed, kept of each row."""
    first, split = {}, []
    for doc_id, text in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        split.append((LAST if doc_id is None else doc_id, words))
    for doc_id, words in split:
        for i in range(len(words) - window + 1):
            key = tuple(words[i:i + window])
            first[key] = min(first.get(key, (LAST, LAST)), (doc_id, i))
    result = []
    for (original, _), (doc_id, words) in zip(rows, split):
        gone = set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i:i + window])] < (doc_id, i):
                gone.update(range(i, i + window))
        spans = [i for i in sorted(gone) if i - 1 not in gone], [i + 1 for i in sorted(gone) if i + 1 not in gone]
        result.append((original, len(words), len(gone), tuple(zip(*spans)),
                       " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(result, key=str)


def found(spark, rows, window, parts=3, **options):
    docs = documents(spark, [(i, t, "en", "a") for i, t in rows]).repartition(parts)
    return sorted(((r.doc_id, r.n_words, r.n_removed, tuple((s.start, s.end) for s in r.spans), r.kept)
                   for r in repeats.without_repeats(docs, window=window, **options).collect()), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_few_words_against_plain_version(spark, seed):
    """Texts of three different words are full of repeats, over chunks and buckets of a few words."""
    draw = random.Random(seed)
    rows = [(draw.randrange(30) if seed else i, " ".join(draw.choice("abc") for _ in range(draw.randrange(60))))
            for i in range(40)]
    window = draw.choice([2, 3, 4, 5])
    assert found(spark, rows, window, chunk_words=90, bucket_keys=50) == plain_version(rows, window)


def test_shared_passages(spark):
    passage, other = prose(1, 60), prose(2, 25)
    rows = [(i, f"{prose(100 + i, 80 + i % 13)} {passage if i % 2 else other} {prose(500 + i, 40)}") for i in range(60)]
    rows += [(200 + i, rows[3][1]) for i in range(50)]  # copies
    rows += [(300 + i, rows[5][1].replace(" ", "\n\t", i)) for i in range(20)]  # other blanks
    rows += [(400, " ".join([passage] * 4)), (401, prose(9, 19)), (402, prose(9, 19)), (403, prose(9, 20)), (404, prose(9, 20))]
    got = found(spark, rows, 20, chunk_words=700, bucket_keys=1000)
    assert got == plain_version(rows, 20)
    by_id = {r[0]: r for r in got}
    assert by_id[1][2] == 0 and by_id[3][2] >= 60 and by_id[0][2] == 0 and by_id[2][2] >= 25
    assert by_id[210][4] == "" and by_id[402][2] == 0 and by_id[404][2] == 20


def test_windows_at_document_ends(spark):
    """Windows do not cross from one document of a chunk into the next."""
    a, b = prose(1, 10).split(), prose(2, 10).split()
    rows = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(a + b)), (4, " ".join(b + a)), (5, " ".join(["x"] + a + b))]
    assert found(spark, rows, 20, parts=1) == plain_version(rows, 20)


def test_odd_rows(spark):
    text = prose(4, 50)
    rows = [(None, None), (1, None), (2, ""), (3, " \n"), (None, text), (None, text), (7, text), (7, text), (8, "é" + text),
            (-2, text[3:]), (9, " ".join(prose(5, 30).split())), (10, "\x85".join(prose(6, 30).split()))]
    assert found(spark, rows, 20) == plain_version(rows, 20)
    assert found(spark, rows[:4], 20) == plain_version(rows[:4], 20)
    assert found(spark, [], 20) == []


def test_very_long_text_in_pieces(spark):
    long = " ".join([prose(7, 3000), prose(8, 500), prose(7, 3000)] * 20)
    rows = [(1, long), (2, prose(8, 500)), (3, "x" * 500_000 + " " + prose(7, 40))]
    assert found(spark, rows, 20) == plain_version(rows, 20)


def test_pieces_hold_all_words():
    draw = random.Random(5)
    data = b"".join(draw.choice([b"ab", b" ", b"\n", b"c\t", b"dd\x0b "]) for _ in range(400))
    old, repeats.PIECE_BYTES = repeats.PIECE_BYTES, 7
    try:
        assert [w for p in repeats._pieces(data) for w in p.split()] == data.split()
    finally:
        repeats.PIECE_BYTES = old


def test_byte_planes():
    for dtype in (np.uint32, np.int64):
        values = np.sort(np.random.default_rng(1).integers(0, 2**31, 1000)).astype(dtype)
        values = np.append(values, np.iinfo(dtype).max).astype(dtype)
        assert (repeats._unplanes(repeats._planes(values), dtype) == values).all()
        assert len(repeats._unplanes(repeats._planes(values[:0]), dtype)) == 0


def test_chunks_pass_no_shuffle(spark):
    """Only messages are exchanged: the stored chunks are read bucket by bucket."""
    plan = repeats.without_repeats(documents(spark, [(1, prose(1, 100), "en", "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    exchanged = [line for line in plan.splitlines() if " Exchange " in line]
    assert exchanged and not any("codes" in line for line in exchanged)
