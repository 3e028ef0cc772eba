"""Quality rules: how a public tokenizer takes a text, with rejection bands per language.

Words are encoded one by one, as they stand after a blank, with a vocabulary that falls back to bytes.
Measured are characters per token, the share of tokens that are single bytes, and the entropy of the
token distribution over the largest that so many tokens can have. Each has a band, which all documents of
a language together define: junk of symbols and capitals breaks into many short tokens, foreign scripts
into bytes, and repetition leaves few distinct tokens. A text fails outside a band of its language.

A language of few documents leans on the band of the text's script, and that on the band of all documents.
The weight of its own is n / (n + ``PRIOR``), so no number of documents is a threshold, and a band that
leans on another is wider by the distance between the two. Scripts are those of most letters.

Texts are read once. Their measures are written; the bands are aggregates of those, of which the driver sees
those of the scripts (a fixed list) only. A worker remembers the tokens of at most ``CACHE_WORDS`` words
and forgets all when full.

Defined results: null and empty texts have no words and fail; null is a language of its own; repeated rows
and null ids keep their rows; where no document passes the base rules there are no bands, and none to
reject; ``clean_documents`` keeps all columns, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import saved

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
CACHE_WORDS = 200_000
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
ROWS = 512  # texts in Python at a time
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"
MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "chars_per_token double, byte_share double, token_entropy double, script string")
# Scripts by the first byte of their letters in UTF-8 (fixed values), ends included.
SCRIPTS = {"latin": ((0x41, 0x5A), (0x61, 0x7A), (0xC3, 0xCA)), "greek": ((0xCD, 0xCF),),
           "cyrillic": ((0xD0, 0xD3),), "hebrew": ((0xD4, 0xD7),), "arabic": ((0xD8, 0xDD),),
           "south asian": ((0xE0, 0xE1),), "east asian": ((0xE3, 0xE9),), "hangul": ((0xEA, 0xED),),
           "other": ((0xF0, 0xF4),)}
NO_SCRIPT = "none"
# Bands by measure: on which sides they end (-1 below, 1 above), and the least standard deviation, since
# half of a language's texts may agree to the last digit (most have no byte tokens at all).
BANDS = {"chars_per_token": ((-1, 1), 0.02), "byte_share": ((1,), 0.02), "token_entropy": ((-1,), 0.02)}
SPREADS = 5.0
PRIOR = 30
ROBUST = 1.4826  # standard deviations in a median distance of normal values
ACCURACY = 10_000


class WordTokens(dict):
    """Token ids by word (bytes), packed as int32, computed when first asked for."""

    def __init__(self, vocabulary: str, limit: int = CACHE_WORDS):
        import sentencepiece

        super().__init__()
        self.model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        self.limit = limit
        n = self.model.get_piece_size()
        self.is_byte = np.array([self.model.is_byte(i) for i in range(n)])

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        ids = np.array(self.model.encode(word.decode("utf-8", "replace")), dtype=np.int32).tobytes()
        if len(word) <= 64:
            self[word] = ids
        return ids


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows that occur more than once. Hashes tell where to look; words decide."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    sums = ids[:n].copy()
    for k in range(1, window):
        sums *= np.uint64(0x9E3779B97F4A7C15)
        sums += ids[k:k + n]
    order = np.argsort(sums, kind="stable")
    ordered = sums[order]
    same = np.zeros(n, dtype=bool)
    equal = ordered[1:] == ordered[:-1]
    if not equal.any():
        return 0
    same[order[1:][equal]] = True
    same[order[:-1][equal]] = True
    places = np.flatnonzero(same).tolist()
    windows = Counter(tuple(words[i:i + window]) for i in places)
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    for i in places:
        if windows[tuple(words[i:i + window])] > 1:
            covered[i] += 1
            covered[i + window] -= 1
    return int((np.cumsum(covered) > 0).sum())


def script_of(data: bytes) -> str:
    """The script of most letters of a UTF-8 text; the first of SCRIPTS if several have as many."""
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    found = {name: int(sum(counts[a:b + 1].sum() for a, b in ranges)) for name, ranges in SCRIPTS.items()}
    best = max(found, key=found.get)
    return best if found[best] else NO_SCRIPT


def measure(text: str, tokens: WordTokens) -> tuple:
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # exactly the blanks above
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    ids = np.frombuffer(b"".join(map(tokens.__getitem__, words)), dtype=np.int32)
    chars = len(text) - sum(text.count(c) for c in BLANKS)
    if len(ids):
        counts = np.bincount(ids, minlength=len(tokens.is_byte))
        bytes_ = int(counts[tokens.is_byte].sum())
        counts = counts[counts > 0]
        entropy = float(np.log2(len(ids)) - (counts * np.log2(counts)).sum() / len(ids))
        most = np.log2(min(len(ids), len(tokens.is_byte)))
        ratios = (chars / len(ids), bytes_ / len(ids), entropy / most if most > 0 else 0.0)
    else:
        ratios = (0.0, 0.0, 0.0)
    return (len(words), chars, sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)),
            repeated_words(words), *ratios, script_of(data))


def with_measures(documents: DataFrame, text: str = "text", drop: tuple = (),
                  vocabulary: str = VOCABULARY) -> DataFrame:
    """The measures beside the columns (but those in ``drop``); columns with their names are replaced."""
    names = [m.split()[0] for m in MEASURES.split(", ")]
    kept = documents.drop(*names)
    fields = [f for f in kept.schema if f.name not in drop]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokens(vocabulary)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                found = [measure(t or "", tokens) for t in part.column(text).to_pylist()]
                columns = [pa.array(c) for c in zip(*found)]
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in fields), *columns],
                                                 [*(f.name for f in fields), *names])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), MEASURES])
    return kept.mapInArrow(run, schema)


def base_failure():
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _median(column) -> Column:
    return F.percentile_approx(column, 0.5, ACCURACY)


def _centres(rows: DataFrame, by: str) -> DataFrame:
    """_n, _typical (words) and the median of each measure."""
    return rows.groupBy(by).agg(F.count("*").alias("_n"), _median("n_words").alias("_typical"),
                                *[_median(m).alias(f"_c_{m}") for m in BANDS])


def _variances(rows: DataFrame, by: str) -> DataFrame:
    """The robust variance of each measure around the centre that stands beside it."""
    squares = [F.pow(F.greatest(_median(F.abs(F.col(m) - F.col(f"_c_{m}"))) * ROBUST, F.lit(least)), 2.0)
               .alias(f"_v_{m}") for m, (_, least) in BANDS.items()]
    kept = [F.first(c).alias(c) for c in ("_n", "_typical", *(f"_c_{m}" for m in BANDS))]
    return rows.groupBy(by).agg(*squares, *kept)


def blend(own: dict, prior: dict, weight) -> dict:
    """Typical length, centres and variances of a mixture of the two, for numbers and for columns.

    A mixture's variance holds the distance of the centres too.
    """
    rest = 1 - weight
    mixed = {"_typical": weight * own["_typical"] + rest * prior["_typical"]}
    for m in BANDS:
        c, v = f"_c_{m}", f"_v_{m}"
        apart = own[c] - prior[c]
        mixed[c] = weight * own[c] + rest * prior[c]
        mixed[v] = weight * own[v] + rest * prior[v] + weight * rest * apart * apart
    return mixed


def _by_group(rows: DataFrame) -> dict[str, dict]:
    """Bands of each script and of "all", not yet blended: a row for each of SCRIPTS at most."""
    groups = rows.withColumn("_group", F.explode(F.array("script", F.lit("all"))))
    centres = {r["_group"]: r.asDict() for r in _centres(groups, "_group").collect()}
    if not centres:
        return {}

    def beside(name):
        return F.create_map(*[F.lit(x) for g, r in centres.items() for x in (g, r[name])])[F.col("_group")]

    names = ("_n", "_typical", *(f"_c_{m}" for m in BANDS))
    found = _variances(groups.select("*", *[beside(n).alias(n) for n in names]), "_group")
    return {r["_group"]: r.asDict() for r in found.collect()}


def learned_bands(measured: DataFrame, lang: str = "lang", prior: float = PRIOR) -> tuple[DataFrame, dict]:
    """Bands over all documents that pass the base rules: a row per language, and by script.

    Languages have their own number of documents, typical length, centres (medians) and variances (squares
    of 1.4826 times the median distance from the centre); ``_lang`` names them. Scripts are blended with
    all documents already; "all" stands for scripts that no document has. The dict is empty if nothing passes.
    """
    rows = measured.filter(~base_failure()).select(F.col(lang).alias("_of"), "script", "n_words", *BANDS)
    groups = _by_group(rows)
    scripts = {g: blend(r, groups["all"], r["_n"] / (r["_n"] + prior)) for g, r in groups.items()}
    centres = _centres(rows.drop("script"), "_of").withColumnRenamed("_of", "_lang")
    languages = _variances(rows.join(centres, F.col("_of").eqNullSafe(F.col("_lang"))), "_lang")
    return languages, scripts


def verdict(measured: DataFrame, bands: tuple[DataFrame, dict], lang: str = "lang",
            spreads: float = SPREADS, prior: float = PRIOR) -> DataFrame:
    """Adds ``base_failed`` and ``kept``: inside all bands of its language.

    A band ends ``spreads`` standard deviations from the centre. A text shorter than is typical by a factor
    f has bands wider by the root of f, since its mean over tokens varies by so much more.
    """
    languages, scripts = bands
    if not scripts:
        return measured.withColumns({"base_failed": base_failure(), "kept": ~base_failure()})
    joined = measured.join(languages, F.col(lang).eqNullSafe(F.col("_lang")), "left")

    def of_script(name):
        by_script = F.create_map(*[F.lit(x) for g, r in scripts.items() for x in (g, float(r[name]))])
        return F.coalesce(by_script[F.col("script")], by_script[F.lit("all")])

    names = ("_typical", *(f"_{kind}_{m}" for m in BANDS for kind in "cv"))
    general = {n: of_script(n) for n in names}
    own = {n: F.coalesce(F.col(n), general[n]) for n in names}
    n = F.coalesce(F.col("_n"), F.lit(0))
    band = blend(own, general, n / (n + F.lit(float(prior))))
    wider = F.sqrt(F.greatest(F.lit(1.0), band["_typical"] / F.greatest(F.col("n_words"), F.lit(1))))
    inside = F.lit(True)
    for m, (sides, _) in BANDS.items():
        width = spreads * wider * F.sqrt(band[f"_v_{m}"])
        for side in sides:
            inside = inside & (side * (F.col(m) - band[f"_c_{m}"]) <= width)
    return joined.withColumns({"base_failed": base_failure(), "kept": ~base_failure() & inside}).drop(
        "_lang", "_n", *names)


def judge(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
          vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, lang, the measures, ``base_failed`` and ``kept`` of every document."""
    rows = documents.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"),
                            F.col(lang).alias("lang"))
    # Ids pass pandas as text, which keeps nulls and large numbers.
    measured = saved(with_measures(rows, drop=("text",), vocabulary=vocabulary), "fertility")
    judged = verdict(measured, learned_bands(measured))
    return judged.withColumn("doc_id", F.col("doc_id").cast(documents.schema[doc_id].dataType))


def clean_documents(documents: DataFrame, text: str = "text", lang: str = "lang",
                    vocabulary: str = VOCABULARY) -> DataFrame:
    """The documents that are kept, with their columns. Texts are measured once and written beside the measures."""
    names = {c: f"_d_{i}" for i, c in enumerate(documents.columns)}
    rows = documents.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    measured = saved(with_measures(rows, names[text], vocabulary=vocabulary), "fertility")
    kept = verdict(measured, learned_bands(measured, names[lang]), names[lang]).filter("kept")
    return kept.select(*[F.col(n).alias(c) for c, n in names.items()])
