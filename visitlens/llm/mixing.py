"""Mixing sources to target weights by pivotal rounding of fractional copy numbers.

A source's target over its size is how often each of its documents is due: a whole number of copies and
a fraction. Fractions are rounded in pairs, a document and the smaller ones of its bucket taken as one:
the words that they are due beyond whole copies move from one to the other, in a direction drawn so that
nobody's expectation changes, until one of the two is due a whole number. The words due in sum stay what
they were, so a source misses its target by less than the one document that stays open, a small one.

Documents are dealt by hash into buckets of about ``BUCKET`` per source (a hot source has more buckets,
not larger ones). The document left open in each bucket meets those of ``FAN_IN`` neighbouring buckets, in
a tree that ends with one per source. Chances come from hashes of ids, so that reruns agree.

Defined results: null and empty texts have size 0 and are never taken; null is a source of its own, the
last; rows with equal (doc_id, source, size) are due the sum of their copies, dealt evenly among them,
and numbered in slices, so that any number of them is spread over tasks; an empty table gives no rows;
``mixed_documents`` keeps all columns, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from visitlens.llm.common import mixed, saved

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
BUCKET = 2_048
FAN_IN = 64
SEED = 42
WORD = r"[^\x20\x09-\x0D]+"
RANGES = 64
SLICE = 4_096  # equal rows numbered at a time
TINY = 1e-9
UNIT = "doc_id string, source string, size long, m long, base long, p double, tie long, bucket long, extra int"


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def ranked(sources: DataFrame) -> DataFrame:
    """Adds ``rank`` from 0, by code point with null last. Ranges are numbered apart, then offset."""
    order = F.col("source").asc_nulls_last()
    ranged = saved(sources.repartitionByRange(RANGES, order)
                   .withColumn("part", F.spark_partition_id()), "mix-ranges")
    before, offset = 0, {}
    for row in sorted(ranged.groupBy("part").count().collect()):  # at most RANGES rows
        offset[row["part"]], before = before, before + row["count"]
    if not offset:
        return ranged.drop("part").withColumn("rank", F.lit(0))
    offsets = F.create_map(*[F.lit(x) for pair in offset.items() for x in pair])
    number = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    return ranged.withColumn("rank", number + offsets[F.col("part")]).drop("part")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """source, source_size, n (documents) and target, from rows (source, size).

    Sources share all words by weight; a target over ``max_copies`` times its source's size stops there
    and the rest is shared anew. Each round is one aggregate; only sums reach the driver.
    """
    sources = ranked(sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("rank") % len(weights) + 1).cast("int"))
    sources = saved(sources.withColumn("weight", weight).drop("rank"), "mix-sources")
    limit = max_copies * F.col("source_size")
    level = None  # words per unit of weight
    while True:
        above = F.lit(False) if level is None else level * F.col("weight") > limit
        row = sources.agg(F.sum("source_size").alias("words"),
                          F.sum(F.when(above, limit).otherwise(0)).alias("stopped"),
                          F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("open")).first()
        new = (row["words"] - row["stopped"]) / row["open"] if row["open"] else 0.0
        if level is not None and (new <= level or not row["open"]):
            break
        level = new
    return sources.select("source", "source_size", "n", F.when(
        F.col("source_size") > 0, F.least(limit.cast("double"), level * F.col("weight")))
        .otherwise(0.0).alias("target"))


def transfer(p: float, size: float, q: float, other: float, chance: float) -> tuple[float, float]:
    """Move due words between two fractions until one is whole; their sum in words stays.

    The direction is drawn so that neither expectation changes.
    """
    to_first = min((1 - p) * size, q * other)
    to_second = min(p * size, (1 - q) * other)
    if chance * (to_first + to_second) < to_second:
        return (1.0, q - to_first / other) if (1 - p) * size <= q * other else (p + to_first / size, 0.0)
    return (0.0, q + to_second / other) if p * size <= (1 - q) * other else (p - to_second / size, 1.0)


def settle(p: np.ndarray, size: np.ndarray, chances: np.ndarray) -> tuple[np.ndarray, int, float]:
    """Round fractions of documents sorted by falling size: whole numbers, and the one left open, if any.

    Each document in turn is paired with all that come after it, taken as one: their fraction is the
    mean by words, and what they gain or lose is spread among them in proportion to what they can take
    or give. So large documents are settled while there is much to settle them with, and the one that
    stays open (its place and fraction; place -1 if none) is a small one.
    """
    extra = np.zeros(len(p), dtype=np.int32)
    words = np.append(np.cumsum(size[::-1])[::-1], 0.0)  # of the documents from a place on
    due = np.append(np.cumsum((p * size)[::-1])[::-1], 0.0)
    scale, shift = 1.0, 0.0  # a fraction is now scale * p + shift
    for i in range(len(p)):
        mine = min(1.0, max(0.0, scale * p[i] + shift))
        rest = words[i + 1]
        if mine < TINY or mine > 1 - TINY:
            extra[i] = mine > 0.5
            continue
        if rest <= 0:
            return extra, i, mine
        theirs = min(1.0, max(0.0, (scale * due[i + 1] + shift * rest) / rest))
        mine, new = transfer(mine, size[i], theirs, rest, chances[i])
        if new <= TINY or new >= 1 - TINY:
            extra[i + 1:] = new > 0.5
            if TINY < mine < 1 - TINY:
                return extra, i, mine
            extra[i] = mine > 0.5
            return extra, -1, 0.0
        extra[i] = mine > 0.5
        if new < theirs:
            factor = new / theirs
            scale, shift = scale * factor, shift * factor
        elif new > theirs:
            factor = (1 - new) / (1 - theirs)
            scale, shift = scale * factor, 1 - factor + shift * factor
    return extra, -1, 0.0


def _settle_bucket(level: int, last: bool):
    def run(bucket: pd.DataFrame) -> pd.DataFrame:
        bucket = bucket.sort_values(["size", "tie"], ascending=[False, True], kind="stable")
        ties = bucket["tie"].to_numpy(np.int64).view(np.uint64) + np.uint64(level + 1)
        chances = (mixed(ties) >> np.uint64(11)).astype(np.float64) / 2**53
        size = bucket["size"].to_numpy(np.float64)
        p = np.where(size > 0, bucket["p"].to_numpy(np.float64), 0.0)
        extra, place, fraction = settle(p, size, chances)
        result = pd.array(extra, dtype="Int32")
        if place >= 0:
            if last:
                result[place] = int(chances[place] < fraction)
            else:
                result[place] = pd.NA
                bucket.iloc[place, bucket.columns.get_loc("p")] = fraction
        return bucket.assign(extra=result)

    return run


def decide(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
           weights=WEIGHTS, max_copies: int = MAX_COPIES, seed: int = SEED, bucket: int = BUCKET) -> DataFrame:
    """doc_id, source, size, m (equal rows), copies (of these rows in all), source_size and target."""
    sizes = saved(documents.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
        n_words(text).alias("size")), "mix-sizes")
    targets = saved(source_targets(sizes, weights, max_copies), "mix-targets")
    units = sizes.groupBy("doc_id", "source", "size").agg(F.count("*").alias("m"))
    t = targets.withColumnRenamed("source", "_source")
    due = F.when(F.col("size") > 0, F.least(
        F.col("target") / F.col("source_size"), F.lit(float(max_copies))) * F.col("m")).otherwise(0.0)
    buckets = F.ceil(F.col("n") / bucket)
    units = units.join(t, F.col("source").eqNullSafe(F.col("_source"))).select(
        F.col("doc_id").cast("string").alias("doc_id"), "source", "size", "m", F.floor(due).alias("base"),
        (due - F.floor(due)).alias("p"), F.xxhash64("doc_id", "source", "size", F.lit(seed)).alias("tie"),
        buckets.alias("buckets"))
    units = units.withColumn("bucket", F.pmod(F.xxhash64("tie", F.lit(1)), F.col("buckets"))).drop("buckets")
    most = targets.agg(F.max(buckets)).first()[0] or 1
    levels = 1 + math.ceil(math.log(most, FAN_IN) - 1e-9)
    decided = []
    for level in range(levels):
        done = saved(units.groupBy("source", "bucket").applyInPandas(
            _settle_bucket(level, level == levels - 1), UNIT), "mix-level")
        decided.append(done.filter("extra IS NOT NULL"))
        units = done.filter("extra IS NULL").drop("extra").withColumn(
            "bucket", F.floor(F.col("bucket") / FAN_IN))
    settled = decided[0]
    for more in decided[1:]:
        settled = settled.unionByName(more)
    return settled.join(t, F.col("source").eqNullSafe(F.col("_source"))).select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", "size", "m", (F.col("base") + F.col("extra")).alias("copies"), "source_size", "target")


def row_copies(total, m, number):
    """Copies of the row with this number (from 0) when ``m`` equal rows share ``total``."""
    return F.floor(total / m) + F.when(number < total % m, 1).otherwise(0)


def mix_report(decisions: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken (words, copies counted), one row per document row.

    Equal rows are written out in slices, which are dealt over tasks before they become rows.
    """
    keys = ["doc_id", "source", "size"]
    single = decisions.filter("m = 1").withColumn("k", F.lit(0).cast("long"))
    slices = decisions.filter("m > 1").withColumn(
        "slice", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("m") - 1) / SLICE))))
    tasks = int(decisions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = F.col("slice") * SLICE
    several = slices.repartition(tasks, *keys, "slice").withColumn(
        "k", F.explode(F.sequence(first, F.least(F.col("m"), first + SLICE) - 1))).drop("slice")
    copies = row_copies(F.col("copies"), F.col("m"), F.col("k"))
    return single.unionByName(several).select(
        "doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"))


def _numbered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``_k``, the number of a row among those of equal keys, from 0.

    Rows are numbered in slices of ``SLICE`` neighbours, and slices offset by the counts of those before.
    """
    # Written, so that a task that runs again finds each row in the slice that was counted.
    rows = saved(rows.withColumn("_place", F.monotonically_increasing_id()), "mix-equals")
    rows = rows.withColumn("_slice", F.floor(F.col("_place") / SLICE))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*keys, "_slice").agg(F.count("*").alias("_count"))
    offsets = counts.select(*[F.col(k).alias(f"{k}_of") for k in keys], F.col("_slice").alias("_slice_of"),
                            F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy(*keys, "_slice").orderBy("_place")) - 1
    same = F.col("_slice") == F.col("_slice_of")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_of"))
    return rows.withColumn("_in", inside).join(offsets, same).withColumn("_k", F.col("_in") + F.col("_offset"))


def mixed_documents(documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    source: str = "source", **options) -> DataFrame:
    """The documents as often as the mix takes them, with the same columns."""
    decisions = saved(decide(documents, doc_id, text, source, **options).filter("copies > 0").select(
        F.col("doc_id").alias("_doc_id"), F.col("source").alias("_source"), F.col("size").alias("_size"),
        F.col("m").alias("_m"), F.col("copies").alias("_copies")), "mix-decisions")
    names = {c: f"_d_{i}" for i, c in enumerate(documents.columns)}
    sized = documents.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]) \
        .withColumn("_n", n_words(names[text])).filter("_n > 0")
    same = (F.col(names[doc_id]).cast("long").eqNullSafe(F.col("_doc_id"))
            & F.col(names[source]).cast("string").eqNullSafe(F.col("_source")) & (F.col("_n") == F.col("_size")))
    single = sized.join(decisions.filter("_m = 1"), same).withColumn("_k", F.lit(0))
    # Rows with equals are few as a rule: Spark then broadcasts their decisions by the size of the file.
    repeated = saved(decisions.filter("_m > 1"), "mix-repeated")
    several = _numbered(sized.join(repeated, same), ["_doc_id", "_source", "_size"])
    copies = row_copies(F.col("_copies"), F.col("_m"), F.col("_k")).cast("int")
    kept = [*names.values(), "_copies", "_m", "_k"]
    both = single.select(*kept).unionByName(several.select(*kept))
    return both.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies))).select(
        *[F.col(n).alias(c) for c, n in names.items()])
