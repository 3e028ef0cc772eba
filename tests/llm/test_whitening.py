"""Whitening against numpy over all rows in memory."""

import math

import numpy as np
import pytest

from visitlens.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, copies string, n string, x string"


def table(spark, rows):
    """Rows with columns that clash with those of the operator."""
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], "c", "n", "x")
                                  for i, v in rows], SCHEMA)


def expected(rows, weight):
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v) for _, v in good]
    counts = {}
    for v in x:
        counts[v] = counts.get(v, 0) + 1
    fit = np.array([v for v, k in counts.items() for _ in range(k if weight == "copies" else 1)], dtype=np.int64)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:16], vectors[:, ::-1][:, :16]
    rows = {}
    for (i, _), v in zip(good, x):
        d = n * np.array(v) - sums
        rows[i] = (int((d.astype(object) ** 2).sum()), (d / n) @ vectors / np.sqrt(values), values / np.trace(cov), n)
    return rows, cov


@pytest.mark.parametrize("weight", ["distinct", "copies"])
def test_against_numpy(spark, weight):
    draw = np.random.default_rng(1)
    base = draw.normal(size=(300, 20)) * np.linspace(0.5, 40, 20) + 5
    rows = [(i, list(v)) for i, v in enumerate(base)]
    rows += [(1000 + i, list(base[7])) for i in range(400)] + [(2000 + i, list(base[i])) for i in range(30)]
    rows += [(5000, None), (5001, [None] * 20), (5002, [math.nan] * 20), (5003, [math.inf] + [0.0] * 19)]
    found = whitening.whiten(table(spark, rows), weight=weight).collect()
    want, _ = expected(rows, weight)
    assert sorted(r.vec_id for r in found) == sorted(want)
    signs = np.sign([a * b for a, b in zip(found[0].whitened, want[found[0].vec_id][1])])
    for r in found:
        deviation, z, explained, n = want[r.vec_id]
        assert (int(r.deviation), r.n) == (deviation, n)
        assert np.allclose(r.whitened, signs * z, atol=1e-8)
        assert np.allclose(r.explained, explained, rtol=1e-9)
        assert r.identity_error < 1e-9
        assert r.copies == (401 + (7 < 30) if r.vec_id == 7 or 1000 <= r.vec_id < 2000 or r.vec_id == 2007 else
                            2 if r.vec_id < 30 or r.vec_id >= 2000 else 1)


def test_components_as_rows(spark):
    draw = np.random.default_rng(2)
    rows = [(i, list(draw.normal(size=5))) for i in range(50)] + [(None, [0.0] * 5), (3, [0.0] * 5)]
    found = whitening.components_of(whitening.whiten(table(spark, rows)))
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert found.count() == 52 * 5 and {r.component for r in found.collect()} == {1, 2, 3, 4, 5}
    assert found.filter("vec_id IS NULL").count() == 5 and found.filter("vec_id = 3").count() == 10
    shares = [r.explained for r in found.filter("vec_id = 4").orderBy("component").collect()]
    assert shares == sorted(shares, reverse=True) and sum(shares) == pytest.approx(1)


def test_frequent_vector_is_joined_in_slices(spark):
    rows = [(i, [1.0, 2.0]) for i in range(3000)] + [(5000 + i, [float(i % 50), float(i % 7)]) for i in range(500)]
    found = whitening.whiten(table(spark, rows)).select("vec_id", "copies").collect()
    assert sorted(r.vec_id for r in found) == sorted(i for i, _ in rows)
    assert {r.copies for r in found if r.vec_id < 3000} == {3000 + sum(
        (i % 50, i % 7) == (1, 2) for i in range(500))}


def test_directions_without_variance(spark):
    rows = [(i, [float(i), 3.0, float(2 * i)]) for i in range(40)]
    found = whitening.whiten(table(spark, rows)).collect()
    assert len(found) == 40
    assert all(r.whitened[0] is not None and r.whitened[1:] == [None, None] for r in found)
    assert found[0].identity_error < 1e-9
    same = whitening.whiten(table(spark, [(1, [2.0, 2.0]), (2, [2.0, 2.0])])).collect()
    assert [(r.whitened, r.explained, r.identity_error, int(r.deviation)) for r in same] == [
        ([None, None], [None, None], None, 0)] * 2


def test_small_variance_beside_large(spark):
    """Eigenvalues a thousand million times apart keep their digits."""
    draw = np.random.default_rng(3)
    rows = [(i, [float(a * 3000), float(b), float(c)]) for i, (a, b, c) in enumerate(draw.normal(size=(500, 3)))]
    found = whitening.whiten(table(spark, rows)).first()
    _, cov = expected(rows, "distinct")
    assert found.identity_error < 1e-6
    assert np.allclose(found.explained, np.linalg.eigvalsh(cov)[::-1] / np.trace(cov), rtol=1e-6)


def test_tables_without_vectors(spark):
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.components_of(whitening.whiten(table(spark, [(1, None), (2, [math.nan])]))).collect() == []
    with pytest.raises(ValueError, match="widths"):
        whitening.whiten(table(spark, [(1, [1.0]), (2, [1.0, 2.0])]))


def test_deviation_beyond_64_bits_is_exact(spark):
    rows = [(1, [1e9]), (2, [-1e9]), (3, [0.0])]
    found = {r.vec_id: r for r in whitening.whiten(table(spark, rows)).collect()}
    want, _ = expected(rows, "distinct")
    assert {i: int(r.deviation) for i, r in found.items()} == {i: w[0] for i, w in want.items()}
    assert found[1].deviation > 2**63
    listed = whitening.components_of(whitening.whiten(table(spark, rows)))
    assert {r.vec_id: r.deviation for r in listed.collect()}[1] is None
