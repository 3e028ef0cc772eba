"""Near-duplicates against all pairs; components against a search."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import documents, prose
from visitlens.llm import neardup as nd
from visitlens.llm.components import components


def sets(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return set()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def brute(rows, percent):
    """n and component by row, from all pairs of rows with an id; equal ids are one document."""
    found = [sets(text) for _, text, *_ in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(found):
        for j in range(i):
            b = found[j]
            if rows[i][0] is None or rows[j][0] is None or not a or not b:
                continue
            both = len(a & b)
            if rows[i][0] == rows[j][0] or 100 * both >= percent * (len(a) + len(b) - both):
                group[root(i)] = root(j)
    least = {}
    for i, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return sorted((str(d), len(s), str(least[root(i)] if d is not None else None))
                  for i, ((d, *_), s) in enumerate(zip(rows, found)))


def edited(text, changes, draw):
    words = text.split()
    for _ in range(changes):
        words[draw.randrange(len(words))] = draw.choice(["uno", "due", "tre"])
    return " ".join(words)


def planted():
    draw, rows = random.Random(7), []
    shared = prose(999, 60)
    for i in range(150):
        base = prose(i, draw.randint(30, 200))
        rows.append((10 * i, base, "en", "s"))
        for k in range(draw.choice([0, 0, 1, 3])):
            rows.append((10 * i + k + 1, edited(base, draw.randint(0, 6), draw), "en", "s"))
    rows += [(5_000 + i, prose(i, 25) + " " + shared, "en", "s") for i in range(60)]  # a passage in common
    chain = prose(77, 120)
    for i in range(25):  # each close to the next only
        chain = edited(chain, 2, draw)
        rows.append((7_000 - i, chain, "en", "s"))
    rows += [(8_000 + i, prose(5, 80).upper(), "en", "s") for i in range(40)]  # copies
    rows += [(9_000, "a b", "en", "s"), (9_001, "A  B\n", "en", "s"), (9_002, "", "en", "s"), (9_003, None, None, None)]
    rows += [(9_000, "a b", "en", "s"), (None, prose(0, 50), "en", "s"), (None, prose(0, 50), "en", "s")]
    return rows


@pytest.mark.parametrize("percent, slice_", [(85, nd.SLICE), (80, 8)])
def test_components_against_all_pairs(spark, monkeypatch, percent, slice_):
    monkeypatch.setattr(nd, "SLICE", slice_)
    rows = planted()
    found = nd.near_duplicates(documents(spark, rows), percent).collect()
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in found)
    assert got == brute(rows, percent)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_a_bucket_is_shared_by_full_minima():
    draw = np.random.default_rng(4)
    found = draw.integers(0, 1 << 32, (2, nd.BANDS * nd.ROWS_PER_BAND), dtype=np.uint32)
    found[1, 12:] = found[0, 12:]
    found[1, :6] = found[0, :6]
    found[1, 5] ^= 0x100  # the low bytes of the first band agree, its minima do not
    keys = nd.band_keys(found)
    assert (keys[0] == keys[1]).argmax() == 2
    table = pa.table({"i": [0, 0], "j": [0, 0], "band": [2, 2], "mine": [0, 0], "rep": [1, 2], "n": [50, 50],
                      "component": [1, 2], "signature": [r.astype(np.uint8).tobytes() for r in found],
                      "bands": pa.array(list(keys), pa.list_(pa.int64()))})
    assert [(x, list(others)) for x, others in nd._open_pairs(table, 85)] == [(0, [1])]
    later = table.set_column(table.schema.get_field_index("band"), "band", pa.array([3, 3]))
    assert not list(nd._open_pairs(later, 85))


def test_an_id_with_two_texts_ties_them(spark):
    rows = [(1, prose(1, 50), "", ""), (2, prose(1, 50), "", ""), (2, prose(2, 50), "", ""), (3, prose(2, 50), "", "")]
    assert {r["component_id"] for r in nd.near_duplicates(documents(spark, rows)).collect()} == {1}


def test_one_of_each_group_stays(spark):
    rows = planted()
    df = documents(spark, rows)
    left = nd.without_near_duplicates(df)
    assert left.columns == df.columns
    ids = [r["doc_id"] for r in left.collect()]
    want = {r["doc_id"] for r in nd.near_duplicates(df).collect() if r["kept"]}
    assert set(ids) == want and ids.count(9_000) == 1 and ids.count(None) == 1


def test_empty_table(spark):
    assert nd.near_duplicates(documents(spark, [])).count() == 0
    assert nd.without_near_duplicates(documents(spark, [])).count() == 0


def test_graph_components(spark):
    draw = random.Random(8)
    edges = [(draw.randint(0, 150), draw.randint(0, 150)) for _ in range(110)] + [(i, i + 1) for i in range(500, 560)]
    edges += [(1_000, 2_000 + i) for i in range(200)] + [(3, 3)]
    neighbours = {}
    for a, b in edges:
        if a != b:
            neighbours.setdefault(a, set()).add(b)
            neighbours.setdefault(b, set()).add(a)
    want = {}
    for node in sorted(neighbours):
        if node not in want:
            stack = [node]
            while stack:
                x = stack.pop()
                if want.setdefault(x, node) == node:
                    stack += [y for y in neighbours[x] if y not in want]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_long_texts_in_one_bucket(spark, monkeypatch):
    """Slices follow the bytes of the sets: texts of 50,000 words, some linked through steps 3 and some through 4."""
    monkeypatch.setattr(nd, "SLICE_BYTES", 2 << 20)
    base = prose(1, 50_000).split()
    rows = [(0, " ".join(base[:47_000] + prose(2, 9_000).split()), "", "")]  # the least id: near to all, linked with none
    for i in range(1, 13):
        kind = i % 3  # two texts of a kind are linked, of two kinds not
        own = prose(10 + kind, 9_000).split()
        words = base[:41_000] + own
        words[i * 500] = "uno"
        rows.append((i, " ".join(words), "", ""))
    found = nd.near_duplicates(documents(spark, rows), 85).collect()
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in found)
    assert got == brute(rows, 85)


def test_slices_by_members_and_bytes(spark):
    few_long = spark.range(100).selectExpr("1L key", "7 step", "5000000L n")
    many_short = spark.range(3 * nd.SLICE).selectExpr("2L key", "7 step", "20L n")
    one = spark.range(1).selectExpr("3L key", "0 step", "1L n")
    got = {r["key"]: r["slices"] for r in nd.slice_counts(few_long.union(many_short).union(one)).collect()}
    assert got == {1: -(-100 * 5_000_000 * 8 // nd.SLICE_BYTES), 2: 3, 3: 1}


def test_members_of_large_buckets_are_dealt_by_salt(spark, monkeypatch):
    monkeypatch.setattr(nd, "SLICE", 4)
    rows = ([(1, 0, i, 50, i % 2) for i in range(40)]  # large, two components
            + [(2, 0, 100 + i, 50, 1) for i in range(40)]  # large, one component
            + [(3, 0, 200, 50, 1), (3, 0, 201, 50, 2), (4, 0, 300, 50, 3), (4, 0, 301, 50, 3)])
    known = spark.createDataFrame(rows, "key long, band int, rep long, n long, component long")
    found = nd._of_several(known)
    got = found.collect()
    assert sorted(r["rep"] for r in got) == [*range(40), 200, 201]
    assert {r["rep"] for r in got if r["large"]} == set(range(40))
    assert len({r["salt"] for r in got if r["large"]}) > 10
    members = found.withColumn("step", found.key.cast("int"))
    slices = nd.slice_counts(members.filter("NOT large"))
    large = nd._salted(nd.slice_counts(members.filter("large")))
    counted = nd._with_slices(members, slices, large).collect()
    assert sorted((r["rep"], r["slices"]) for r in counted) == [*((i, 10) for i in range(40)), (200, 1), (201, 1)]


def test_wide_rows_reach_python_in_small_batches(spark):
    """Texts and full sets go to Python a few hundred rows at a time, whatever the session says; its setting stays."""
    from visitlens.llm.common import saved_in_small_batches

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    rows = spark.range(5_000, numPartitions=1).mapInArrow(sizes, "n long")
    found = [r.n for r in saved_in_small_batches(rows, "sizes", 512).collect()]
    assert sum(found) == 5_000 and max(found) <= 512
    assert spark.conf.get(name) == before
