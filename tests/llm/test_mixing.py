"""Targets against the stated rule; rounding keeps sums, limits and expectations."""

import random

import numpy as np
import pytest

from tests.llm.helpers import documents, prose
from visitlens.llm import mixing as m


def targets(sizes, weights=(5, 2, 1), most=3):
    """Share, stop at the limit, share the excess anew."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in fixed]
        share = {s: (total - sum(fixed.values())) * weight[s] / sum(weight[x] for x in rest) for s in rest}
        above = [s for s in rest if share[s] > most * sizes[s]]
        if not above:
            return {**fixed, **share}
        fixed |= {s: most * sizes[s] for s in above}


def table(spark):
    random.seed(2)
    rows = [(i, prose(i, 1 + int(random.paretovariate(0.8) * 10) % 3_000), "en",
             random.choice(["b", "b", "b", "b", "a", "é", "z", "𝒳", None])) for i in range(700)]
    rows += [(5_000, prose(5_000, 3), "en", "tiny"), (5_001, "", "en", "void"), (5_002, None, "en", "void")]
    rows += [(9_000, prose(9, 40), "en", "b")] * 7 + [(None, prose(10, 20), "en", "a")]
    return documents(spark, rows), rows


@pytest.mark.parametrize("bucket", [m.BUCKET, 16])
def test_mix(spark, bucket):
    df, rows = table(spark)
    decided = m.decide(df, bucket=bucket)
    report = m.mix_report(decided).collect()
    assert len(report) == len(rows)
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = targets(sizes)
    got = {r["source"]: r["target"] for r in decided.collect()}
    assert got == pytest.approx(want)
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    taken = {}
    for r in report:
        assert r["taken"] <= 3 * r["size"] and (r["size"] == 0) <= (r["taken"] == 0)
        assert r["size"] == 0 or r["taken"] % r["size"] == 0
    for r in decided.collect():
        taken[r["source"]] = taken.get(r["source"], 0) + r["copies"] * r["size"]
    largest = max(len((r[1] or "").split()) for r in rows)  # in buckets of a few, a large one may stay open
    for source, target in want.items():
        assert abs(taken[source] - target) <= (0.02 * target + 60 if bucket > 16 else largest), source
    again = m.mix_report(m.decide(df, bucket=bucket)).collect()
    assert sorted(report, key=str) == sorted(again, key=str)


def test_documents_are_repeated_as_decided(spark):
    df, _ = table(spark)
    words = sum(r["taken"] for r in m.mix_report(m.decide(df)).collect())
    mixed = m.mixed_documents(df)
    assert mixed.columns == df.columns
    found = mixed.collect()
    assert sum(len(r["text"].split()) for r in found) == words
    assert abs([r["doc_id"] for r in found].count(9_000) - 7 * targets_of_b(df)) < 2


def targets_of_b(df):
    row = next(r for r in m.decide(df).collect() if r["source"] == "b")
    return row["target"] / row["source_size"]


@pytest.mark.parametrize("slice_", [3, m.SLICE])
def test_equal_rows(spark, monkeypatch, slice_):
    """Equal rows, null ids and empty texts among them: each is one row of the report, and copies are even."""
    monkeypatch.setattr(m, "SLICE", slice_)
    rows = [(None, prose(1, 5), "en", "a")] * 100 + [(7, prose(1, 5), "en", None)] * 41 + [
        (None, None, "en", "a")] * 50 + [(i + 100, prose(i, 9), "en", "b") for i in range(60)]
    df = documents(spark, rows).repartition(7)
    decided = m.decide(df)
    copies = {(r["doc_id"], r["size"]): r["copies"] for r in decided.collect()}
    report = m.mix_report(decided).collect()
    assert len(report) == len(rows)
    for key, n in (((None, 5), 100), ((7, 5), 41), ((None, 0), 50)):
        taken = [r["taken"] // max(1, r["size"]) for r in report if (r["doc_id"], r["size"]) == key]
        assert len(taken) == n and sum(taken) == copies[key] and max(taken) - min(taken) <= 1
    found = [(r["doc_id"], len(r["text"].split())) for r in m.mixed_documents(df).collect()]
    assert {k: found.count(k) for k in copies} == copies


def test_a_large_group_of_equal_rows_is_spread(spark):
    n = 300_000
    df = spark.range(n).selectExpr("cast(null as long) doc_id", "'a b c' text", "'s' source").unionAll(
        spark.createDataFrame([(1, "x y", "t")], "doc_id long, text string, source string"))
    decided = m.decide(df)
    report = m.mix_report(decided)
    # The two targets add up to all words: 1 of 3 is more than three times the second source's.
    assert report.count() == n + 1
    mixed = m.mixed_documents(df)
    assert mixed.count() == sum(r["copies"] for r in decided.collect())
    largest = report.groupBy(m.F.spark_partition_id()).count().agg({"count": "max"}).first()[0]
    assert largest < n


def test_callers_columns_come_through(spark):
    df = spark.createDataFrame([(i, prose(i, 20), "s", 777, i, "dot", 1, 2, 3) for i in range(20)],
                               "doc_id long, text string, source string, _n int, _k int, `a.b` string, _d_1 int, "
                               "_copy int, _size int")
    df = df.unionAll(df.limit(3))
    mixed = m.mixed_documents(df)
    assert mixed.columns == df.columns
    rows = mixed.collect()
    assert rows and all(r["_n"] == 777 and r["_k"] == r["doc_id"] and r["a.b"] == "dot" and
                        (r["_d_1"], r["_copy"], r["_size"]) == (1, 2, 3) for r in rows)


def test_expectations_are_kept():
    p, size = np.full(40, 0.37), np.sort(np.arange(5, 45.0))[::-1]
    draw = np.random.default_rng(1)
    total = np.zeros(40)
    for _ in range(3_000):
        extra, place, fraction = m.settle(p, size, draw.random(40))
        total += extra
        if place >= 0:
            total[place] += fraction
    assert np.abs(total / 3_000 - p).max() < 0.04


def test_transfer_keeps_words_and_settles_one():
    draw = random.Random(3)
    for _ in range(2_000):
        p, q, s, t = draw.random(), draw.random(), draw.randint(1, 50), draw.randint(1, 50)
        a, b = m.transfer(p, s, q, t, draw.random())
        assert a * s + b * t == pytest.approx(p * s + q * t) and (a in (0, 1) or b in (0, 1))
        assert -1e-9 <= a <= 1 + 1e-9 and -1e-9 <= b <= 1 + 1e-9


def test_odd_tables(spark):
    assert m.mix_report(m.decide(documents(spark, []))).count() == 0
    void = documents(spark, [(1, None, None, None), (2, "", "en", "a")])
    assert [r["taken"] for r in m.mix_report(m.decide(void)).collect()] == [0, 0]
    assert m.mixed_documents(void).count() == 0
