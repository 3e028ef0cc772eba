"""Toxicity: held-out accuracy, inputs of the score, odd tables."""

import math
import random
import zlib

import numpy as np
import pytest

from tests.llm.helpers import documents, prose
from visitlens.llm import toxicity as t

BAD = ["blork", "snarp", "grumf", "vexil", "dratz"]


def labelled(spark, n=900):
    draw, rows, labels = random.Random(5), [], []
    for i in range(n):
        toxic = i % 6 == 0
        words = prose(i, draw.randint(20, 150)).split()
        for _ in range(4 * toxic):
            words.insert(draw.randrange(len(words)), draw.choice(BAD))
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, 1, int(toxic)))
    return rows, labels, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    rows, labels, frame = labelled(spark)
    found = t.judge(documents(spark, rows), frame).collect()
    truth = {i: y for i, _, y in labels}
    assert len(found) == len(rows)
    hits = {0: [], 1: []}
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert r["predicted"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1
        if r["held_out"]:
            hits[truth[r["doc_id"]]].append(r["predicted"])
    assert sum(hits[1]) >= 0.9 * len(hits[1]) and sum(hits[0]) <= 0.01 * len(hits[0])


def test_held_out_labels_lang_and_ids_do_not_matter(spark):
    rows, labels, frame = labelled(spark, 300)
    flipped = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, q, y in labels]
    other = spark.createDataFrame(flipped, "doc_id long, quality int, toxic int")
    scores = [{r["doc_id"]: r["score"] for r in t.judge(documents(spark, d), f).collect()}
              for d, f in ((rows, frame), ([(*r[:2], "xx", "yy") for r in rows], other))]
    assert scores[0] == scores[1]


def test_sparsity_and_bound(spark):
    rows, labels, frame = labelled(spark, 300)
    weights = t.learn([(text, y) for (_, text, _, _), (_, _, y) in zip(rows, labels)])
    features = sum(len(np.unique(np.concatenate(t.features(text)))) for _, text, _, _ in rows)
    assert 0 < len(weights.places) < features / 100
    some = t.examples(documents(spark, rows), frame, max_rows=60)
    assert 20 < some.count() < 110


def brute_learn(examples, epochs, l1=t.L1):
    """The update of each coordinate by itself, as the method is published, in plain Python."""
    z, n, bias_z, bias_n = {}, {}, 0.0, 0.0

    def weight(i):
        a = z.get(i, 0.0)
        if abs(a) <= l1:
            return 0.0
        return -(a - math.copysign(l1, a)) / ((t.BETA + math.sqrt(n[i])) / t.ALPHA + t.L2)

    def bias():
        return -bias_z / ((t.BETA + math.sqrt(bias_n)) / t.ALPHA)

    for _ in range(epochs):
        for text, label in examples:
            values = {}
            for places, value in zip(t.features(text), (1.0, t.PAIR_VALUE)):
                values.update((("word" if value == 1 else "pair", int(i)), value) for i in places)
            assert len({i for _, i in values}) == len(values)  # no place is shared here
            total, b = bias(), bias()
            total += sum(v * weight(i) for (_, i), v in values.items())
            error = (1 / (1 + math.exp(-total)) - label) * (t.POSITIVE_WEIGHT if label else 1)
            if abs(error) < 1e-4:
                continue
            for (_, i), v in values.items():
                g = error * v
                before, old = n.get(i, 0.0), weight(i)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / t.ALPHA * old
                n[i] = before + g * g
            bias_z += error - (math.sqrt(bias_n + error * error) - math.sqrt(bias_n)) / t.ALPHA * b
            bias_n += error * error
    return bias(), {i: weight(i) for i in z if weight(i)}


@pytest.mark.parametrize("l1", [t.L1, 0.2])
def test_updates_against_a_plain_loop(monkeypatch, l1):
    monkeypatch.setattr(t, "L1", l1)
    examples = [(prose(i, 12) + (" blork snarp" if i % 3 == 0 else " calm day"), int(i % 3 == 0)) for i in range(20)]
    found, (bias, weights) = t.learn(examples, 6), brute_learn(examples, 6, l1)
    assert found.bias == pytest.approx(bias, rel=1e-3, abs=1e-4)
    assert set(found.places.tolist()) == set(weights)
    assert found.values.tolist() == pytest.approx([weights[i] for i in found.places.tolist()], rel=1e-3, abs=1e-3)
    assert l1 > 1 or len(weights) > 10


def test_more_l1_while_there_are_too_many_weights(monkeypatch):
    monkeypatch.setattr(t, "L1", 0.05)
    examples = [(prose(i, 30) + (" blork" if i % 2 else " calm"), i % 2) for i in range(40)]
    free = t.learn(examples)
    assert len(free.places) > 20
    some = t.learn(examples, max_weights=20)
    assert 0 < len(some.places) <= 20
    flags = some.lookup()
    assert all((some.score(t.features(x), flags) >= 0.5) == y for x, y in examples)


def test_skip_grams_carry_what_words_cannot():
    draw, examples = random.Random(6), []
    for i in range(600):
        words = prose(i, 30).split()
        for word in ("red", "mist"):  # both words in all texts, near each other in the toxic ones only
            words.insert(draw.randrange(10) + 20 * (word == "red"), word)
        if i % 3 == 0:
            words = [w for w in words if w not in ("red", "mist")] + ["red", "x", "mist"]
        examples.append((" ".join(words), int(i % 3 == 0)))
    weights = t.learn(examples[:400], epochs=12)
    flags = weights.lookup()
    right = [(weights.score(t.features(x), flags) >= 0.5) == y for x, y in examples[400:]]
    assert sum(right) >= 0.95 * len(right)


def test_odd_tables(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = documents(spark, [(None, "a", None, None), (1, None, None, None), (1, "", "en", "s"), (2, "y " * 30_000, "", "")])
    assert [r["score"] for r in t.judge(odd, none).collect()] == [0.5] * 4
    labels = spark.createDataFrame([(1, None, 1), (1, 0, 0), (None, 1, 1), (2, 1, None)], "doc_id long, quality int, toxic int")
    assert t.judge(odd, labels).count() == 4
    assert t.judge(documents(spark, []), labels).count() == 0
