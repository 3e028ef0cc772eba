"""URL rules by a cascade of Bloom filters: exact membership for a known universe of keys, no join.

Level 0 holds the listed keys. The keys of the universe that it takes for listed by mistake go into
level 1, the listed keys which level 1 takes for those go into level 2, and so on until no mistake is
left. A key of the universe is listed if the first level that does not hold it is odd, or if all hold
it and the last one is even. Since the universe is every key of the corpus, the answer is exact for
each page.

Level 0 is as exact as the ratio of listed to other keys asks for, so that about as many keys reach level 1
as are listed; from there on a level takes a sixteenth of the keys for listed. Levels are built by Spark: each key's
bit positions become (word, bits) rows that ``bit_or`` merges before and after the shuffle. Keys are dealt into shards
by hash, so that all levels of a shard have ``max_bytes`` at most. Shards are built, written, broadcast, asked and released one
after the other: driver and tasks hold one at a time. Keys that two levels running do not tell apart have equal hashes;
they are kept by name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import lower_ascii, mixed, saved

HASHES = 4  # per key from level 1 on: a level mistakes about one key in 16
BITS_PER_KEY = 6
MAX_BYTES = 64 << 20
MAX_NAMES = 100_000  # keys with equal hashes


@dataclass
class Level:
    bits: np.ndarray  # uint64
    n_bits: int
    number: int
    n_hashes: int = HASHES

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        result = np.ones(len(hashes), dtype=bool)
        for position in positions(hashes, self.number, self.n_bits, self.n_hashes):
            word = self.bits[(position >> np.uint64(6)).astype(np.int64)]
            result &= (word >> (position & np.uint64(63)) & np.uint64(1)).astype(bool)
        return result


@dataclass
class Shard:
    """Levels, and the names of listed and other keys that no level tells apart."""

    levels: list[Level]
    listed: frozenset[str] = frozenset()
    others: frozenset[str] = frozenset()

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        """What the levels say; keys in ``listed`` or ``others`` are not asked here."""
        result = np.full(len(hashes), len(self.levels) % 2 == 1)
        open_ = np.arange(len(hashes))
        for level in self.levels:
            held = level.holds(hashes[open_])
            result[open_[~held]] = level.number % 2 == 1
            open_ = open_[held]
        return result

    @property
    def n_bytes(self) -> int:
        return sum(level.bits.nbytes for level in self.levels)


@dataclass
class Cascade:
    """Written shards; the driver holds what was asked last, up to MAX_BYTES. ``contains`` is exact for keys of the
    universe."""

    shards: list[DataFrame]
    held: dict[int, Shard] = field(default_factory=dict)

    def shard(self, number: int) -> Shard:
        if number not in self.held:
            found = self._read(number)
            while self.held and sum(s.n_bytes for s in self.held.values()) + found.n_bytes > MAX_BYTES:
                self.held.pop(next(iter(self.held)))
            self.held[number] = found
        return self.held[number]

    def _read(self, number: int) -> Shard:
        rows = self.shards[number].collect()
        levels = [Level(np.frombuffer(r["bits"], dtype=np.uint64), r["n_bits"], r["number"], r["n_hashes"])
                  for r in sorted(rows, key=lambda r: r["number"]) if r["number"] >= 0]
        names = [r for r in rows if r["number"] < 0]
        return Shard(levels, frozenset(k for r in names for k in r["listed"]), frozenset(k for r in names for k in r["others"]))

    def contains(self, shard: int, hashes: np.ndarray, keys: list[str] | None = None) -> np.ndarray:
        asked = self.shard(shard)
        found = asked.contains(hashes)
        for at, key in enumerate(keys or []):
            if key in asked.listed or key in asked.others:
                found[at] = key in asked.listed
        return found


_SHARD_SCHEMA = ("number int, n_bits long, n_hashes int, bits binary, listed array<string>, others array<string>")


def _written(spark, shard: Shard) -> DataFrame:
    rows = [(level.number, level.n_bits, level.n_hashes, level.bits.tobytes(), [], []) for level in shard.levels]
    if shard.listed or shard.others:
        rows.append((-1, 0, 0, b"", sorted(shard.listed), sorted(shard.others)))
    return saved(spark.createDataFrame(rows, _SHARD_SCHEMA), "cascade-shard")


def positions(hashes: np.ndarray, level: int, n_bits: int, n_hashes: int = HASHES):
    """The bit positions of each key in a level, from its 64-bit hash."""
    base = mixed(hashes.view(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64))
    step = mixed(base) | np.uint64(1)
    for k in range(n_hashes):
        yield (base + np.uint64(k) * step) % np.uint64(n_bits)


def key_hash(key: Column) -> Column:
    return F.xxhash64(key)


def key_shard(key: Column, n_shards: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(7)), F.lit(n_shards)).cast("int")


def first_level(n_listed: int, n_others: int) -> tuple[int, int]:
    """Bits per key and hashes of level 0: no more mistakes than about seven for ten listed keys, and one in 16 at most."""
    rate = min(2.0 ** -HASHES, 0.7 * n_listed / max(1, n_others))
    return math.ceil(-math.log2(rate) / math.log(2)), max(HASHES, round(-math.log2(rate)))


def _level(keys: DataFrame, number: int, n_keys: int, bits_per_key: int, n_hashes: int) -> Level:
    """The filter of the keys, from their hashes."""
    n_bits = max(64, bits_per_key * n_keys)

    def spread(batches):
        for batch in batches:
            for position in positions(batch["hash"].to_numpy(np.int64), number, n_bits, n_hashes):
                yield pd.DataFrame({"word": (position >> np.uint64(6)).astype(np.int64),
                                    "bits": (np.uint64(1) << (position & np.uint64(63))).view(np.int64)})

    merged = keys.select("hash").mapInPandas(spread, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    frame = merged.toPandas()  # the filter of one level of one shard
    words = np.zeros((n_bits + 63) // 64, dtype=np.uint64)
    words[frame["word"].to_numpy(np.int64)] = frame["bits"].to_numpy(np.int64).view(np.uint64)
    return Level(words, n_bits, number, n_hashes)


def _names(keys: DataFrame) -> frozenset[str]:
    rows = keys.select("key").limit(MAX_NAMES + 1).collect()
    if len(rows) > MAX_NAMES:
        raise RuntimeError("too many keys with equal hashes")
    return frozenset(r["key"] for r in rows)


def _build_shard(keys: DataFrame, max_bytes: int) -> Shard | None:
    """The cascade of a shard's keys (hash, key, listed), or None if it is larger than ``max_bytes``."""
    spark = keys.sparkSession
    inside, outside = keys.filter("listed = 1"), keys.filter("listed = 0")
    sizes = {r["listed"]: r["n"] for r in keys.groupBy("listed").agg(F.count("*").alias("n")).collect()}
    n_inside, n_outside = sizes.get(1, 0), sizes.get(0, 0)
    shard, useless = Shard([]), 0
    bits_per_key, n_hashes = first_level(max(1, n_inside), n_outside)
    while n_inside:
        if shard.n_bytes + max(64, bits_per_key * n_inside) / 8 > max_bytes:
            return None
        level = _level(inside, len(shard.levels), n_inside, bits_per_key, n_hashes)
        shard.levels.append(level)
        held = spark.sparkContext.broadcast(level)

        def mistaken(batches, held=held):
            for batch in batches:
                yield batch[held.value.holds(batch["hash"].to_numpy(np.int64))]

        wrong = saved(outside.select("hash", "key").mapInPandas(mistaken, "hash long, key string"), "cascade-level")
        n_wrong = wrong.count()
        held.unpersist()
        useless = useless + 1 if n_wrong == n_outside else 0
        inside, outside, n_inside, n_outside = wrong, inside, n_wrong, n_inside
        bits_per_key, n_hashes = BITS_PER_KEY, HASHES
        if useless > 1 and n_inside:
            # Levels count from 0: an even one has just been made from listed keys.
            pair = _names(inside), _names(outside)
            shard.listed, shard.others = pair if len(shard.levels) % 2 == 0 else pair[::-1]
            break
    return shard


def build_cascade(listed: DataFrame, universe: DataFrame, key: str = "key",
                  max_bytes: int = MAX_BYTES) -> Cascade:
    """A cascade that tells the listed keys among the keys of ``universe``.

    Null keys are left out; repeated keys count once; listed keys outside the universe are added to it.
    An empty list gives a cascade that contains nothing.
    """
    spark = universe.sparkSession
    both = (listed.select(F.col(key).alias("key"), F.lit(1).alias("listed"))
            .unionByName(universe.select(F.col(key).alias("key"), F.lit(0).alias("listed"))))
    keys = (both.filter("key IS NOT NULL").groupBy("key").agg(F.max("listed").alias("listed"))
            .select(key_hash(F.col("key")).alias("hash"), "key", "listed"))
    keys = saved(keys, "cascade-keys")
    counts = {r["listed"]: r["n"] for r in keys.groupBy("listed").agg(F.count("*").alias("n")).collect()}
    n_listed = counts.get(1, 0)
    if not n_listed:
        return Cascade([_written(spark, Shard([]))])
    # Level 1 has about 0.7 of the listed keys, those after it a sixteenth each; a quarter more is for unequal shards.
    bits = first_level(n_listed, counts.get(0, 0))[0] + BITS_PER_KEY
    n_shards = max(1, math.ceil(1.25 * n_listed * bits / 8 / max_bytes))
    while n_shards <= 16 * n_listed:
        shards: list[DataFrame] = []
        for number in range(n_shards):
            mine = keys if n_shards == 1 else keys.filter(key_shard(F.col("key"), n_shards) == number)
            shard = _build_shard(mine, max_bytes)
            if shard is None:
                break
            shards.append(_written(spark, shard))
        else:
            return Cascade(shards)
        n_shards *= 2
    raise ValueError(f"{max_bytes} bytes are too few for the levels of a single key")


def with_host_and_path(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` (after the first ``://``, A-Z lower-cased) and ``path`` (up to ``?`` or ``#``).

    Both are empty for a null url and for one without ``://``. Columns of these names are replaced.
    """
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.regexp_replace(rest, "^[^/?#]*", ""), "^[^?#]*", 0)
    return pages.withColumns({"host": F.coalesce(lower_ascii(host), F.lit("")),
                              "path": F.coalesce(path, F.lit(""))})


def rule_keys(max_labels: int, path_lengths: list[int]) -> Column:
    """Every string a rule would have to be to fit: a suffix of the host's labels and a path prefix.

    Rules have at most ``max_labels`` labels and paths of ``path_lengths``; no other string can be one.
    """
    n_labels = F.size(F.split("host", "[.]"))
    suffixes = F.array_compact(F.array(*[F.when(n_labels >= n, F.substring_index("host", ".", -n))
                                         for n in range(1, max_labels + 1)]))
    fitting = F.array_compact(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n))
                                        for n in path_lengths]))
    pairs = F.flatten(F.transform(suffixes, lambda s: F.transform(fitting, lambda p: F.concat(s, p))))
    return F.when(F.col("host") != "", pairs).otherwise(F.array().cast("array<string>"))


def longest_rule(pages: DataFrame, rules: DataFrame, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``pages`` (with host and path) and the longest fitting ``rule``, its ``rule_verdict``, else null.

    ``rules``: rule (host and path, as ``net/es/``) and verdict (allow or block). Of a rule listed with
    both verdicts, allow holds.
    """
    rules = rules.filter("rule IS NOT NULL AND instr(rule, '/') > 1")
    shape = rules.agg(
        F.max(F.size(F.split(F.substring_index("rule", "/", 1), "[.]"))).alias("labels"),
        F.collect_set(F.length("rule") - F.length(F.substring_index("rule", "/", 1))).alias("lengths")).first()
    labels, lengths = shape["labels"] or 1, sorted(shape["lengths"])
    named = pages.withColumn("_keys", rule_keys(labels, lengths))
    universe = named.select(F.explode("_keys").alias("key")).distinct()
    cascades = {v: build_cascade(rules.filter(F.col("verdict") == v).select(F.col("rule").alias("key")),
                                 universe, max_bytes=max_bytes) for v in ("block", "allow")}
    chosen = named.withColumns({"rule": F.lit(None).cast("string"),
                                "rule_verdict": F.lit(None).cast("string")})
    for verdict, cascade in cascades.items():
        for shard in range(len(cascade.shards)):
            listed, held = _contains_column(pages.sparkSession, cascade, shard)
            hits = F.filter(listed(F.col("_keys")), lambda k: k.isNotNull())
            best = F.sort_array(F.transform(hits, lambda k: F.struct(F.length(k).alias("n"), k.alias("k"))),
                                asc=False)
            chosen = chosen.withColumn("_best", F.get(best, F.lit(0))["k"])
            better = F.length("_best") >= F.coalesce(F.length("rule"), F.lit(0))
            chosen = chosen.withColumns({
                "rule_verdict": F.when(better, F.lit(verdict)).otherwise(F.col("rule_verdict")),
                "rule": F.when(better, F.col("_best")).otherwise(F.col("rule"))})
            chosen = _released(chosen, held, len(cascade.shards))
    return chosen.drop("_keys", "_best")


def _released(rows: DataFrame, held, n_shards: int) -> DataFrame:
    """Of several shards, each is gone from the tasks before the next is sent: its answers are written."""
    if n_shards > 1:
        rows = saved(rows, "shard-answers")
        held.unpersist()
    return rows


def _contains_column(spark, cascade: Cascade, number: int):
    """Column function: an array of keys with null for those that are not listed in the shard; and what is broadcast."""
    n_shards, shard = len(cascade.shards), cascade.shard(number)
    held = spark.sparkContext.broadcast(shard)

    @F.pandas_udf("array<boolean>")
    def listed(hashes: pd.Series) -> pd.Series:
        sizes = [len(h) for h in hashes]
        flat = np.concatenate([np.asarray(h, dtype=np.int64) for h in hashes]) if sum(sizes) else \
            np.zeros(0, np.int64)
        return pd.Series(np.split(held.value.contains(flat), np.cumsum(sizes)[:-1]))

    def column(keys: Column) -> Column:
        flags = listed(F.transform(keys, key_hash))

        def chosen(key, flag):
            if shard.listed or shard.others:
                flag = F.when(key.isin(*shard.listed), True).when(key.isin(*shard.others), False).otherwise(flag)
            return F.when(flag & (key_shard(key, n_shards) == number), key)

        return F.zip_with(keys, flags, chosen)

    return column, held


def listed_hosts(judged: DataFrame) -> DataFrame:
    """Hosts (key) of which the rules block at least half of the pages: bad sites as a whole."""
    blocked = F.when(F.col("rule_verdict") == "block", 1).otherwise(0)
    return (judged.filter("host <> ''").groupBy(F.col("host").alias("key"))
            .agg(F.sum(blocked).alias("blocked"), F.count("*").alias("n"))
            .filter("2 * blocked >= n").select("key"))


def judge_pages(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url",
                max_bytes: int = MAX_BYTES) -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    The longest fitting rule decides. Pages without one are blocked if their host is on the list of bad
    sites (``listed_hosts``), else allowed. Both questions are asked of cascades. Null and odd urls have
    empty host and path, no rule, and are allowed; repeated rows and null ids keep their rows.
    """
    parsed = with_host_and_path(pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url")))
    ruled = saved(longest_rule(parsed.drop("url"), rules, max_bytes), "url-rules")
    hosts = build_cascade(listed_hosts(ruled), ruled.filter("host <> ''").select(F.col("host").alias("key"))
                          .distinct(), max_bytes=max_bytes)
    ruled = ruled.withColumn("_bad", F.lit(False))
    for shard in range(len(hosts.shards)):
        listed, held = _contains_column(pages.sparkSession, hosts, shard)
        bad = F.coalesce(F.get(listed(F.array("host")), F.lit(0)).isNotNull(), F.lit(False))
        ruled = _released(ruled.withColumn("_bad", F.col("_bad") | bad), held, len(hosts.shards))
    return ruled.select(
        "page_id", "host", "path", "rule",
        F.coalesce("rule_verdict", F.when(F.col("_bad"), "block").otherwise("allow")).alias("verdict"))
