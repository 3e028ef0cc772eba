"""Reproducible session sampling per hour.

Every (session, day, hour) has a fixed random key: the md5 of its text and a seed. Drawing with
probability p is ``key < p`` (as a fraction of the key space), which needs no shuffle, and
drawing the first n is a ranking by the same key. So the topped-up sample is the drawn rows plus
the next ones in key order, and drawing again gives the same sample.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlens.functions.times import day_text
from visitlens.operators.ranking import SLICES, top_n
from visitlens.sources.tables import with_time

# Every hour gets at least 3 sessions, and at most 50 are topped up to.
FLOOR, CAP = 3, 50
DEFAULT_SEED = 42
# Tails of the Poisson distribution are summed in doubles, which holds far beyond any share in use.
MAX_POISSON_RATIO = 10.0

KEYS = ["session_id", "day", "hour"]
HOUR = ["day", "hour"]


def sample_key(seed: int = DEFAULT_SEED) -> Column:
    return F.md5(F.concat_ws("|", "session_id", "day", "hour", F.lit(seed)))


def key_limit(probability: float) -> str:
    """A key is below this text with the given probability (32 bits of resolution).

    From 1 on the limit is a text that is above every key.
    """
    return "g" if probability >= 1 else format(int(probability * 2**32), "08x")


def _copy_limits(ratio: float, mode: str) -> list[str]:
    """Keys below the i-th limit are drawn at least i+1 times."""
    if mode != "poisson":
        return [key_limit(ratio)]
    if not 0 < ratio <= MAX_POISSON_RATIO:
        raise ValueError(f"drawing with replacement needs a ratio above 0 and up to {MAX_POISSON_RATIO}")
    limits, rest, term, draws = [], 1.0 - math.exp(-ratio), math.exp(-ratio), 0
    while rest * 2**32 >= 1:  # until no key is left for so many copies
        limits.append(key_limit(rest))
        draws += 1
        term *= ratio / draws
        rest -= term
    return limits


def _drawn(ratio: float, mode: str, seed: int) -> Column:
    return sample_key(seed) < F.lit(_copy_limits(ratio, mode)[0])


def sample_stratified(
    hourly: DataFrame, ratio: float, mode: str = "bernoulli", seed: int = DEFAULT_SEED
) -> DataFrame:
    """Sampled (session_id, day, hour); with mode "poisson" drawn with replacement, so that a
    row may repeat. Decided row by row, without a shuffle."""
    drawn = hourly.where(_drawn(ratio, mode, seed))
    limits = _copy_limits(ratio, mode)
    if len(limits) > 1:
        key = sample_key(seed)
        copies = sum((key < F.lit(limit)).cast("int") for limit in limits)
        drawn = drawn.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    return drawn.select(*KEYS)


def sample_need(hourly: DataFrame, ratio: float, floor: int = FLOOR, cap: int = CAP) -> DataFrame:
    """day, hour, need: how many sessions the hour must have in the sample."""
    share = F.floor(F.count(F.lit(1)) * F.lit(float(ratio)))
    return hourly.groupBy(*HOUR).agg(
        F.least(F.greatest(F.lit(floor), share), F.lit(cap)).cast("int").alias("need")
    )


def sample_topup(
    hourly: DataFrame, ratio: float, mode: str = "bernoulli",
    floor: int = FLOOR, cap: int = CAP, seed: int = DEFAULT_SEED, extra: tuple[str, ...] = (),
) -> DataFrame:
    """The sessions an hour still needs after ``sample_stratified``, at most ``cap`` per hour."""
    key = sample_key(seed)
    first = top_n(hourly.select(*KEYS, *extra, key.alias("_key")), HOUR, [F.col("_key")], cap, "_rank")
    need = sample_need(hourly, ratio, floor, cap)
    undrawn = F.col("_key") >= F.lit(_copy_limits(ratio, mode)[0])
    return first.where(undrawn).join(need, HOUR).where("_rank <= need").select(*KEYS, *extra)


def sample_sessions(
    hourly: DataFrame, ratio: float = 0.01, mode: str = "bernoulli",
    floor: int = FLOOR, cap: int = CAP, seed: int = DEFAULT_SEED, extra: tuple[str, ...] = (),
) -> DataFrame:
    """Distinct (session_id, day, hour): the drawn share and the top-up. The two parts cannot
    overlap and ``hourly`` is unique, so no further distinct is needed. ``extra`` names columns
    of ``hourly`` to carry along."""
    drawn = hourly.where(_drawn(ratio, mode, seed)).select(*KEYS, *extra)
    return drawn.unionByName(sample_topup(hourly, ratio, mode, floor, cap, seed, extra))


def union_distinct_samples(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.unionByName(second).distinct()


def except_keys(all_keys: DataFrame, taken: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of ``all_keys`` with no row in ``taken``, e.g. hours without a sample."""
    return all_keys.select(*keys).distinct().join(taken.select(*keys), keys, "left_anti")


def sample_count_bounded(sample: DataFrame, cap: int = CAP) -> DataFrame:
    """day, hour, n_sampled, session_ids. The ids are given for hours below ``cap`` rows only.

    One pass: rows are dealt into slices of an hour, a slice counts its rows and gathers at most
    ``cap`` ids, and the hour adds up the counts and joins the ids of its slices.
    """
    sliced = sample.withColumn("_slice", F.pmod(F.xxhash64("session_id"), F.lit(SLICES)))
    window = Window.partitionBy(*HOUR, "_slice").orderBy("session_id")
    numbered = sliced.withColumn("_n", F.row_number().over(window))
    first = F.when(F.col("_n") <= cap, F.col("session_id"))
    slices = numbered.groupBy(*HOUR, "_slice").agg(
        F.count(F.lit(1)).alias("n"), F.collect_set(first).alias("ids"))
    hours = slices.groupBy(*HOUR).agg(F.sum("n").alias("n_sampled"), F.flatten(F.collect_list("ids")).alias("_ids"))
    kept = F.when(F.col("n_sampled") < cap, F.array_sort(F.array_distinct("_ids")))
    return hours.select(*HOUR, "n_sampled", kept.alias("session_ids"))


def sample_items(
    items: DataFrame, group: list[str], item: str, count: int | Column,
    exclude: DataFrame | None = None, seed: int = DEFAULT_SEED,
) -> DataFrame:
    """``count`` items of every group at random without replacement, all if there are fewer.

    ``count`` may be a column. ``exclude`` lists (group, item) rows that must not be chosen.
    """
    pool = items if exclude is None else items.join(exclude, [*group, item], "left_anti")
    key = F.md5(F.concat_ws("|", *group, item, F.lit(seed)))
    order = [F.col("_key"), F.col(item)]
    return top_n(pool.withColumn("_key", key), group, order, count).drop("_key")


def hour_columns(time: str) -> list[Column]:
    return [day_text(F.col(time)).alias("day"), F.hour(time).alias("hour")]


def with_hour(actions: DataFrame) -> DataFrame:
    return with_time(actions).select("*", *hour_columns("ts"))


def session_sample_detail(actions: DataFrame, sample: DataFrame) -> DataFrame:
    """All actions of the sampled sessions inside the sampled hour, with ``day`` and ``hour``.

    The hour is part of the join key.
    """
    return with_hour(actions).join(sample.select(*KEYS), KEYS)


def sampled_actions(
    actions: DataFrame, hourly: DataFrame, ratio: float, mode: str = "bernoulli",
    floor: int = FLOOR, cap: int = CAP, seed: int = DEFAULT_SEED,
) -> DataFrame:
    """``session_sample_detail`` of ``sample_sessions`` without joining the drawn share.

    Whether a row's session is drawn follows from the row itself, so that part is a filter of
    the scan. Only the top-up, at most ``cap`` sessions per hour, is joined; Spark picks the join by
    its measured size.
    """
    detail = with_hour(actions)
    topup = sample_topup(hourly, ratio, mode, floor, cap, seed)
    return detail.where(_drawn(ratio, mode, seed)).unionByName(detail.join(topup, KEYS))


def hour_top_sessions(detail: DataFrame, n: int = 5) -> DataFrame:
    """session_id, day, hour, n_actions: the sampled sessions of an hour with most actions."""
    return rank_hour_sessions(detail.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_actions")), n)


def rank_hour_sessions(counts: DataFrame, n: int = 5) -> DataFrame:
    return top_n(counts, HOUR, [F.col("n_actions").desc(), F.col("session_id")], n)
