"""Benchmark decontamination by latent semantic retrieval.

1. Terms are the words of the benchmark's items (a bounded block of them at a time); texts are written
   once as term numbers, 0 for all other words, which no item contains.
2. Document frequencies over all passages (``PASSAGE`` words each) give TF-IDF weights.
3. A randomised SVD of the TF-IDF matrix of all passages: each task adds A'(A G) for its passages and a
   fixed Gaussian matrix G; the sum gives the leading right singular vectors (Nystrom's method on A'A).
4. Texts are searched in overlapping windows about as long as the items. Windows and items are compared
   by the cosine of their latent vectors, each direction scaled by its singular value, so that what most
   texts share (the language, say) weighs no more than the rest. Runs of ``SEED`` words of an item are
   looked up in the texts beside it: a repeated phrase can hide an item from the cosine, but a verbatim run
   that covers enough of an item holds such a seed and always reaches the next step.
5. Around each candidate the longest common subsequence with the item must cover ``MIN_COVER`` of its
   words and, where a column ``answer`` gives one, that with the answer ``MIN_ANSWER`` of its words. Items
   without an answer are judged by their words alone (``answer_cover`` is null), whichever of them are
   there. Subsequences bear changed, added and dropped words.

Frequencies and the SVD are over all texts; sums of fixed size meet in the driver, never texts or windows.
Items are taken in blocks of ``BLOCK_CHARS`` characters, so what tasks hold is bounded.

Defined results: null and empty texts and items match nothing; rows with equal ids, null among them, are
judged together by ``clean_documents`` and each by its own text by ``clean_rows``; repeated rows are found each; empty tables give no rows; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import saved, summed
from visitlens.llm.notices import words_of

PASSAGE = 64
DIRECTIONS, OVERSAMPLE = 64, 16
FLOOR = 0.05  # weight of a term that all passages have
MIN_COSINE = 0.4
MIN_COVER, MIN_ANSWER = 0.6, 0.5
LEAST_WINDOW = 16
SEED = 5
MARK_BITS = 22
_SCALE = np.uint64(0x9E3779B97F4A7C15)
BLOCK_CHARS = 2_000_000
ROWS = 256
PIECE_WORDS = 1 << 15  # words compared at once
PASSAGES = 256  # passages multiplied at once
FOUND = ("item_id long, first_word int, n_words int, cosine double, common int, cover double, answer_cover double")


@dataclass
class Items:
    """A block of items: their words as term numbers from 1, and those of their answers, empty if not given."""

    ids: list[int]
    words: list[np.ndarray]
    answers: list[np.ndarray]
    terms: dict[bytes, int]


def item_block(rows: list) -> Items:
    terms: dict[bytes, int] = {}
    ids, words, answers = [], [], []
    for item_id, text, answer in rows:
        tokens = words_of(text)
        if not tokens:
            continue
        numbers = np.array([terms.setdefault(w, len(terms) + 1) for w in tokens], dtype=np.int64)
        own = words_of(answer) if answer else []
        ids.append(item_id)
        words.append(numbers)
        answers.append(np.array([terms.setdefault(w, len(terms) + 1) for w in own], dtype=np.int64))
    return Items(ids, words, answers, terms)


def as_terms(documents: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """doc_id, digest and the words of each text as numbers (little-endian, packed)."""
    width = "<u2" if len(terms) < 1 << 16 else "<u4"
    held = documents.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = held.value.get
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                packed = []
                for text in part.column("text").to_pylist():
                    words = words_of(text or "")
                    packed.append(np.fromiter(map(number, words, repeat(0)), dtype=width, count=len(words)).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("digest"), pa.array(packed, pa.binary())],
                    ["doc_id", "digest", "terms"])

    return documents.select("doc_id", "digest", "text").mapInArrow(run, "doc_id long, digest string, terms binary")


def _texts(batches: Iterator[pa.RecordBatch], width: str) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Ids with digests and numbers of a few texts at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            yield (list(zip(part.column("doc_id").to_pylist(), part.column("digest").to_pylist()))
                   if "doc_id" in part.schema.names else [],
                   [np.frombuffer(v, dtype=width) for v in part.column("terms").to_pylist()])


def passage_counts(texts: list[np.ndarray], n_terms: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Number of passages, and (passage, term, count) of the terms in them, sorted by passage."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    passages = -(-lengths // PASSAGE)
    flat = np.concatenate(texts).astype(np.int64) if len(texts) else np.zeros(0, np.int64)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    passage = np.repeat(np.cumsum(passages) - passages, lengths) + place // PASSAGE
    known = flat > 0
    keys, counts = np.unique(passage[known] * (n_terms + 1) + flat[known], return_counts=True)
    return int(passages.sum()), keys // (n_terms + 1), keys % (n_terms + 1), counts


def inverse_frequencies(texts: DataFrame, n_terms: int, width: str) -> np.ndarray:
    """FLOOR + log((1 + passages) / (1 + passages with the term)) by term number; 0 for number 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        total = np.zeros(n_terms + 1)
        for _, part in _texts(batches, width):
            n, _, term, _ = passage_counts(part, n_terms)
            total += np.bincount(term, minlength=n_terms + 1)
            total[0] += n
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    total = summed(texts.select("terms").mapInArrow(run, "part binary"))
    if total is None:
        return np.zeros(n_terms + 1)
    result = FLOOR + np.log((1 + total[0]) / (1 + total))
    result[0] = 0
    return result


def latent_directions(texts: DataFrame, weights: np.ndarray, width: str, directions: int = DIRECTIONS,
                      oversample: int = OVERSAMPLE, seed: int = 42) -> np.ndarray:
    """Per term its weighted, scaled coordinates: latent vectors are sums of these rows over words."""
    n_terms = len(weights) - 1
    wide = min(directions + oversample, n_terms)
    probe = np.random.default_rng(seed).standard_normal((n_terms + 1, wide)).astype(np.float32)
    probe[0] = 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n_terms + 1, wide))
        for _, part in _texts(batches, width):
            _, passage, term, count = passage_counts(part, n_terms)
            value = count * weights[term]
            used = value > 0
            passage, term, value = passage[used], term[used], value[used]
            if not len(term):
                continue
            _, starts, number = np.unique(passage, return_index=True, return_inverse=True)
            value = (value / np.sqrt(np.add.reduceat(value ** 2, starts))[number]).astype(np.float32)
            # A few passages at a time as a matrix over their own terms, which stays in the processor's cache.
            for first, begin in zip(range(0, len(starts), PASSAGES), starts[::PASSAGES]):
                mine = slice(begin, starts[first + PASSAGES] if first + PASSAGES < len(starts) else None)
                terms, column = np.unique(term[mine], return_inverse=True)
                weighed = np.zeros((min(PASSAGES, len(starts) - first), len(terms)), dtype=np.float32)
                weighed[number[mine] - first, column] = value[mine]
                total[terms] += weighed.T @ (weighed @ probe[terms])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    total = summed(texts.select("terms").mapInArrow(run, "part binary"))
    if total is None or not total.any():
        return np.zeros((n_terms + 1, 1), dtype=np.float32)
    product = total.reshape(n_terms + 1, wide)
    # Nystrom: A'A is about F F' with F = Y W D**-1/2, where W and D are vectors and values of G'Y that
    # are not lost in rounding.
    core = probe.T.astype(np.float64) @ product
    roots, turn = np.linalg.eigh((core + core.T) / 2)
    sound = roots > 1e-10 * roots[-1]
    vectors, values, _ = np.linalg.svd(product @ turn[:, sound] / np.sqrt(roots[sound]), full_matrices=False)
    keep = min(directions, int((values > 1e-6 * values[0]).sum()))
    return (weights[:, None] * vectors[:, :keep] / values[:keep]).astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


def window_of(n_words: int) -> int:
    """The least power of two that is not shorter than the item."""
    return max(LEAST_WINDOW, 1 << max(0, n_words - 1).bit_length())


def _pieces(texts: list[np.ndarray], words: int, longest: int) -> Iterator[list[tuple[int, int]]]:
    """(text, first word) of pieces with about so many words together. A text's pieces start at multiples of ``words``;
    each is read on by the longest window."""
    group, held = [], 0
    for number, text in enumerate(texts):
        for first in range(0, len(text), words):
            group.append((number, first))
            held += min(words + longest, len(text) - first)
            if held >= words:
                yield group
                group, held = [], 0
    if group:
        yield group


def candidates(texts: list[np.ndarray], coordinates: np.ndarray, scales: dict[int, tuple[np.ndarray, np.ndarray]],
               least: float) -> list[dict[int, list[list]]]:
    """For each text per item number the stretches [first, end, cosine] in which it may lie.

    Pieces of many texts are compared at once: one sum per segment of words, one product per window length.
    """
    found: list[dict[int, list[list]]] = [{} for _ in texts]
    if not scales:
        return found
    unit, longest = min(scales) // 4, max(scales)
    words = max(PIECE_WORDS, longest)
    hits = {window: [] for window in scales}
    for group in _pieces(texts, words, longest):
        parts = [texts[number][first:first + words + longest] for number, first in group]
        segments = np.array([-(-len(p) // unit) for p in parts])
        ends = np.cumsum(segments)
        begins = ends - segments
        # Words of a segment side by side, filled up with 0, whose coordinates are 0.
        padded = np.zeros(ends[-1] * unit, dtype=np.int64)
        lengths = np.array([len(p) for p in parts])
        shift = begins * unit - (np.cumsum(lengths) - lengths)
        padded[np.arange(lengths.sum()) + np.repeat(shift, lengths)] = np.concatenate(parts)
        padded = padded.reshape(-1, unit)
        total = coordinates[padded[:, 0]]
        buffer = np.empty_like(total)
        for k in range(1, unit):
            total += np.take(coordinates, padded[:, k], axis=0, out=buffer, mode="clip")
        sums = np.zeros((ends[-1] + 1, coordinates.shape[1]))
        np.cumsum(total, axis=0, out=sums[1:])
        whole = np.array([-(-len(texts[number]) // unit) for number, _ in group])  # segments of the whole text
        before = np.array([first // unit for _, first in group])
        for window, (numbers, items) in scales.items():
            hop, span = window // 4 // unit, window // unit
            # A text's windows start at multiples of the hop; a piece has those that start in its own words.
            stop = np.minimum(np.maximum(1, whole - span + hop) - before, words // unit)
            count = np.maximum(0, -(-stop // hop))
            piece = np.repeat(np.arange(len(group)), count)
            first = (np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count)) * hop
            last = np.minimum(first + span, segments[piece])
            mine = (sums[begins[piece] + last] - sums[begins[piece] + first]).astype(np.float32)
            norms = np.sqrt(np.einsum("ij,ij->i", mine, mine))
            norms[norms == 0] = 1
            products = mine @ items.T  # the items are unit vectors
            at, item = np.nonzero(products >= least * norms[:, None])
            offset = np.array([f for _, f in group])[piece[at]]
            hits[window].append((np.array([t for t, _ in group])[piece[at]], offset + first[at] * unit,
                                 offset + last[at] * unit, numbers[item], products[at, item] / norms[at]))
    for window, parts in hits.items():
        for part in parts:
            for number, first, last, item, cosine in zip(*(column.tolist() for column in part)):
                begin, end = max(0, first - window // 2), min(len(texts[number]), last + window // 2)
                mine = found[number].setdefault(item, [])
                if mine and begin <= mine[-1][1] and end - mine[-1][0] <= 4 * window:
                    mine[-1][1], mine[-1][2] = max(mine[-1][1], end), max(mine[-1][2], cosine)
                else:
                    mine.append([begin, end, cosine])
    return found


@dataclass
class Seeds:
    """Seeds of one length: sorted hashes, marks of their upper bits, and (item number, first place, last place)."""

    hashes: np.ndarray
    marks: np.ndarray
    places: list[list[tuple[int, int, int]]]


def _runs(words: np.ndarray, length: int) -> np.ndarray:
    """A hash for each run of so many words."""
    n = max(0, len(words) - length + 1)
    sums, wide = np.zeros(n, dtype=np.uint64), words.astype(np.uint64)
    for k in range(length):
        sums += wide[k:k + n]
        sums *= _SCALE
    return sums


def seeds_of(items: list[np.ndarray], min_cover: float) -> dict[int, Seeds]:
    """Seeds by length: shorter ones for items of which a run that covers enough is shorter than ``SEED``."""
    found: dict[int, dict[int, list[tuple[int, int, int]]]] = {}
    for number, words in enumerate(items):
        length = max(1, min(SEED, math.ceil(min_cover * len(words) - 1e-9)))
        own: dict[int, list[int]] = {}
        for place, value in enumerate(_runs(words, length).tolist()):
            own.setdefault(value, []).append(place)
        of_length = found.setdefault(length, {})
        for value, places in own.items():
            of_length.setdefault(value, []).append((number, places[0], places[-1]))
    result = {}
    for length, of_length in found.items():
        hashes = np.array(sorted(of_length), dtype=np.uint64)
        marks = np.zeros(1 << MARK_BITS, dtype=bool)
        marks[hashes >> np.uint64(64 - MARK_BITS)] = True
        result[length] = Seeds(hashes, marks, [of_length[h] for h in hashes.tolist()])
    return result


def seeded(text: np.ndarray, seeds: dict[int, Seeds], items: list[np.ndarray]) -> dict[int, list[list]]:
    """Per item number the stretches [first, end, None] of the text around its seeds."""
    found: dict[int, list[list]] = {}
    for length, known in seeds.items():
        runs = _runs(text, length)
        at = np.flatnonzero(known.marks[runs >> np.uint64(64 - MARK_BITS)])
        which = np.minimum(np.searchsorted(known.hashes, runs[at]), len(known.hashes) - 1)
        same = known.hashes[which] == runs[at]
        for place, seed in zip(at[same].tolist(), which[same].tolist()):
            for item, low, high in known.places[seed]:
                n = len(items[item])
                begin, end = max(0, place - high - n // 2), min(len(text), place - low + n + n // 2)
                mine = found.setdefault(item, [])
                if mine and max(end, mine[-1][1]) - min(begin, mine[-1][0]) <= max(5 * n // 2, end - begin):
                    mine[-1][:2] = min(begin, mine[-1][0]), max(end, mine[-1][1])
                else:
                    mine.append([begin, end, None])
    return found


def common_subsequence(text: list[int], masks: dict[int, int], full: int) -> int:
    """Length of the longest common subsequence; ``masks`` has the places of each term in the item as bits."""
    row = full
    for term in text:
        match = row & masks.get(term, 0)
        row = ((row + match) | (row - match)) & full
    return full.bit_length() - row.bit_count()


def _masks(words: np.ndarray) -> tuple[dict[int, int], int]:
    masks: dict[int, int] = {}
    for place, term in enumerate(words.tolist()):
        masks[term] = masks.get(term, 0) | 1 << place
    return masks, (1 << len(words)) - 1


def search(texts: DataFrame, items: Items, coordinates: np.ndarray, width: str,
           min_cosine: float = MIN_COSINE, min_cover: float = MIN_COVER, min_answer: float = MIN_ANSWER) -> DataFrame:
    """doc_id, digest and FOUND: the best stretch for each text and item that passes all tests."""
    scales: dict[int, list[int]] = {}
    for number, words in enumerate(items.words):
        scales.setdefault(window_of(len(words)), []).append(number)
    vectors = _unit(np.stack([coordinates[w].sum(axis=0) for w in items.words]))
    ready = {w: (np.array(n), vectors[n]) for w, n in scales.items()}
    seeds = seeds_of(items.words, min_cover)
    held = texts.sparkSession.sparkContext.broadcast((items, coordinates, ready, vectors, seeds))
    names = ["doc_id", "digest", *(c.split()[0] for c in FOUND.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, coordinates, ready, vectors, seeds = held.value
        masks = [_masks(w) for w in items.words]
        answers = [_masks(w) for w in items.answers]
        sets = [frozenset(w.tolist()) for w in items.words]
        for ids, part in _texts(batches, width):
            rows = []
            for key, text, near in zip(ids, part, candidates(part, coordinates, ready, min_cosine)):
                for number, stretches in seeded(text, seeds, items.words).items():
                    near.setdefault(number, []).extend(stretches)
                for number, stretches in near.items():
                    n, best = len(items.words[number]), None
                    for begin, end, cosine in stretches:
                        words = text[begin:end].tolist()
                        # No subsequence covers more than the words in common.
                        if len(sets[number].intersection(words)) < min_cover * len(sets[number]) - (n - len(sets[number])):
                            continue
                        common = common_subsequence(words, *masks[number])
                        if common < min_cover * n or best and common <= best[4]:
                            continue
                        own = len(items.answers[number])
                        part_ = common_subsequence(words, *answers[number]) / own if own else None
                        if part_ is None or part_ >= min_answer:
                            if cosine is None:
                                mine = coordinates[text[begin:end]].sum(axis=0, keepdims=True)
                                cosine = float((_unit(mine) @ vectors[number])[0])
                            best = (items.ids[number], begin, end - begin, cosine, common, common / n, part_)
                    if best:
                        rows.append((*key, *best))
            if rows:
                yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=names).astype(
                    {"doc_id": "Int64", "item_id": "Int64", "first_word": "int32", "n_words": "int32",
                     "common": "int32", "answer_cover": "float64"}), preserve_index=False)

    return texts.mapInArrow(run, f"doc_id long, digest string, {FOUND}")


def find_leaks(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
               item_id: str = "item_id", item_text: str = "text", answer: str = "answer",
               block_chars: int = BLOCK_CHARS, **limits) -> DataFrame:
    """doc_id, item_id, where and how well they agree: a row per document row and item found in it."""
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                            F.lit(None).cast("string").alias("digest"))
    return _leaks(rows, benchmark, item_id, item_text, answer, block_chars, **limits).drop("digest")


def _leaks(rows: DataFrame, benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text",
           answer: str = "answer", block_chars: int = BLOCK_CHARS, **limits) -> DataFrame:
    """doc_id, digest and FOUND for rows of doc_id, text and digest."""
    spark = rows.sparkSession
    own = F.col(answer).cast("string") if answer in benchmark.columns else F.lit(None).cast("string")
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"),
                             own.alias("answer")).filter("text IS NOT NULL").distinct()
    chars = items.agg(F.sum(F.length("text") + F.coalesce(F.length("answer"), F.lit(0)))).first()[0] or 0
    blocks = max(1, math.ceil(chars / block_chars))
    result = spark.createDataFrame([], f"doc_id long, digest string, {FOUND}")
    for block in range(blocks):
        mine = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        held = item_block(sorted(mine.collect(), key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"])))
        if not held.ids:
            continue
        width = "<u2" if len(held.terms) < 1 << 16 else "<u4"
        texts = saved(as_terms(rows, held.terms), "leak-terms")
        weights = inverse_frequencies(texts, len(held.terms), width)
        coordinates = latent_directions(texts, weights, width)
        result = result.unionByName(search(texts, held, coordinates, width, **limits))
    return result


def clean_documents(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The documents in which no item was found, with all columns."""
    found = saved(find_leaks(documents, benchmark, doc_id, **options).select(
        F.col("doc_id").alias("_leak")).distinct(), "leaks")
    return documents.join(found, F.col(doc_id).cast("long").eqNullSafe(found["_leak"]), "left_anti")


def clean_rows(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
               **options) -> DataFrame:
    """The rows in whose own text no item was found, with all columns; other rows of the same id do not count."""
    own, digest = F.col(doc_id).cast("long"), F.md5(F.col(text).cast("binary"))
    rows = documents.select(own.alias("doc_id"), F.col(text).alias("text"), digest.alias("digest"))
    found = saved(_leaks(rows, benchmark, **options).select(
        F.col("doc_id").alias("_leak"), F.col("digest").alias("_digest")).distinct(), "leaks")
    return documents.join(found, own.eqNullSafe(found["_leak"]) & (digest == found["_digest"]), "left_anti")
