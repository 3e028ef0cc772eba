"""Toxicity of texts: logistic regression over hashed word n-grams and skip-grams, learned by FTRL-proximal.

Features are the distinct unigrams, bigrams and skip-grams (two words with one or two between) of a text,
each hashed to one of 2**BITS places. Every place has its own learning rate; L1 leaves most weights at
exactly zero. The rest are broadcast: their number is at most ``MAX_WEIGHTS``; while there are more, the
texts are learned anew with twice the L1.

Learning reads at most about ``MAX_ROWS`` labelled texts, drawn by hash of their id (the bound of one
learning task; a parameter); scoring reads all texts, whole, in one pass without a shuffle. Labels
come only from rows whose crc32 of the id modulo 3 is not 1, so the others measure held-out accuracy.

Defined results: null and empty texts have no features and the score of the bias; a document with several
labels has the largest; null labels and ids are no examples; no examples give the score 0.5 everywhere;
repeated rows keep their rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import mixed, saved
from visitlens.llm.notices import words_of

BITS = 22
GAPS = (1, 2, 3)  # second word this far behind the first: bigrams and two kinds of skip-grams
PAIR_VALUE = 0.3  # a pair counts less than a word, whose value is 1: there are three times as many
POSITIVE_WEIGHT = 2.0  # toxic texts are the rarer
MAX_ROWS = 16_000
MAX_WEIGHTS = 1 << 20
EPOCHS = 8
ALPHA, BETA, L1, L2 = 6.0, 1.0, 5.0, 0.1
THRESHOLD = 0.7
ROWS = 512


@dataclass
class Weights:
    bias: float
    places: np.ndarray  # sorted, int64
    values: np.ndarray  # float32

    def lookup(self) -> np.ndarray:
        """Whether a place has a weight: 2**BITS flags."""
        flags = np.zeros(1 << BITS, dtype=bool)
        flags[self.places] = True
        return flags

    def score(self, found: tuple[np.ndarray, np.ndarray], flags: np.ndarray) -> float:
        total = self.bias
        for places, value in zip(found, (1.0, PAIR_VALUE)):
            hit = np.unique(places[flags[places]])
            total += value * float(self.values[np.searchsorted(self.places, hit)].sum())
        return float(1 / (1 + np.exp(-np.clip(total, -35, 35))))


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places of all words and of all pairs of words, with repetition."""
    words = words_of(text)
    ids = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    pairs = [mixed(ids[:-gap] * np.uint64(0x9E3779B97F4A7C15) + ids[gap:] + np.uint64(gap))
             for gap in GAPS if len(ids) > gap]
    shift = np.uint64(64 - BITS)
    return ((mixed(ids) >> shift).astype(np.int64),
            (np.concatenate(pairs) >> shift).astype(np.int64) if pairs else np.zeros(0, np.int64))


def _example(text: str) -> tuple[np.ndarray, int]:
    """Distinct places, words first, and how many of them are words."""
    words, pairs = (np.unique(places).astype(np.int32) for places in features(text))
    return np.concatenate([words, pairs]), len(words)


def learn(examples: list[tuple[str, int]], epochs: int = EPOCHS, max_weights: int = MAX_WEIGHTS) -> Weights:
    """At most ``max_weights`` weights, with the least of L1, 2 L1, 4 L1 and so on that gives so few."""
    known = [(*_example(text), label) for text, label in examples]
    l1 = L1
    while len((found := _descend(known, epochs, l1)).places) > max_weights:
        l1 *= 2
    return found


def _descend(known: list[tuple[np.ndarray, int, int]], epochs: int, l1: float) -> Weights:
    """FTRL-proximal over the examples in turn; a place's rate falls with the gradients it has seen."""
    z, n = np.zeros(1 << BITS, dtype=np.float32), np.zeros(1 << BITS, dtype=np.float32)
    bias_z = bias_n = 0.0

    def weights(z, n):
        return np.where(np.abs(z) <= l1, 0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    for _ in range(epochs):
        for at, n_words, label in known:
            value = np.full(len(at), PAIR_VALUE, dtype=np.float32)
            value[:n_words] = 1
            w = weights(z[at], n[at])
            bias = -bias_z / ((BETA + np.sqrt(bias_n)) / ALPHA)  # the bias is not regularised
            p = 1 / (1 + np.exp(-np.clip(bias + float(value @ w), -35, 35)))
            error = (p - label) * (POSITIVE_WEIGHT if label else 1)
            if abs(error) < 1e-4:
                continue
            # A place that a word and a pair share gets one of the two updates.
            g = (error * value).astype(np.float32)
            rate = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - rate * w
            n[at] += g * g
            bias_z += error - (np.sqrt(bias_n + error * error) - np.sqrt(bias_n)) / ALPHA * bias
            bias_n += error * error
    w = weights(z, n)
    places = np.flatnonzero(w)
    bias = -bias_z / ((BETA + np.sqrt(bias_n)) / ALPHA)
    return Weights(float(bias), places, w[places].astype(np.float32))


def id_remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def examples(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
             label: str = "toxic", max_rows: int = MAX_ROWS) -> DataFrame:
    """key, text, label of about ``max_rows`` labelled documents at most, chosen by hash of the id."""
    known = (labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("label"))
             .filter("_id IS NOT NULL AND label IS NOT NULL").filter(id_remainder(F.col("_id")) != 1)
             .groupBy("_id").agg(F.max("label").alias("label")))
    known = saved(known.withColumn("key", F.xxhash64("_id", F.lit(3))), "toxic-labels")
    share = min(1.0, max_rows / max(1, known.count()))
    chosen = known.filter(F.pmod("key", F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = documents.select(F.col(doc_id).alias("_id"), F.col(text).alias("text"))
    # At most about max_rows rows of three numbers.
    return rows.join(F.broadcast(chosen), "_id").select("key", F.coalesce("text", F.lit("")).alias("text"), "label")


def train(known: DataFrame, epochs: int = EPOCHS, max_weights: int = MAX_WEIGHTS) -> Weights:
    """Weights from rows (key, text, label), learned in one task in the order of ``key``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        rows = pd.concat(parts).sort_values(["key", "text"], kind="stable") if parts else None
        if rows is None or rows.empty:
            return
        found = learn(list(zip(rows["text"], rows["label"])), epochs, max_weights)
        yield pd.DataFrame({"bias": [found.bias], "places": [found.places.tobytes()],
                            "values": [found.values.tobytes()]})

    rows = known.repartition(1).mapInPandas(run, "bias double, places binary, values binary").collect()
    if not rows:
        return Weights(0.0, np.zeros(0, np.int64), np.zeros(0, np.float32))
    return Weights(rows[0]["bias"], np.frombuffer(rows[0]["places"], np.int64).copy(),
                   np.frombuffer(rows[0]["values"], np.float32).copy())


def score(documents: DataFrame, weights: Weights, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score of every document."""
    held = documents.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = held.value
        flags = weights.lookup()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                scores = [weights.score(features(t or ""), flags) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores, pa.float64())],
                                                 ["doc_id", "score"])

    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def judge(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    weights = train(examples(documents, labels, **options))
    held_out = F.coalesce(id_remainder(F.col("doc_id")) == 1, F.lit(False))
    return score(documents, weights).select(
        "doc_id", held_out.alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
