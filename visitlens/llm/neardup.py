"""Near-duplicates: MinHash with banding, signature verification, full sets, connected components.

1. Each text becomes the set of its distinct five-word shingles and BANDS x ROWS_PER_BAND minima of
   universal hashes. Texts with equal sets are one class from here on, so copies cost nothing.
2. Classes that agree in all minima of a band share a bucket. With 32 bands of 6, a pair of
   similarity 0.85 shares none with probability 3e-7, one of 0.8 with 6e-5.
3. In each bucket every class is paired with the least one: as many pairs as members. Pairs whose
   signatures (the low bytes of the minima) and set sizes allow the similarity are held against their
   full sets, and the links among them give first components.
4. Only buckets in which several components meet are looked through pair by pair. They are split by
   set size, since the sizes of a linked pair differ by little, and then into slices of about ``SLICE``
   members or ``SLICE_BYTES`` of full sets, whichever is less; a task compares the signatures of two
   slices. Members with a possible partner in another component meet again with their full sets, which
   decide, and only links leave the task. Buckets of over ``SLICE`` members are dealt over ``SALTS``
   tasks wherever their members meet what is known of the bucket. Members of the next lower step are not
   sliced: all of them visit each slice of a step, so such a task is not bounded.
5. Components of all links, by alternating large-star and small-star.

So every pair that shares a bucket is either linked through others or decided on its full sets; nothing
is capped, and a group of copies or near copies of any size gives pairs in proportion to its members.

Defined results: a text with fewer than five words has its whole sequence as one shingle; one without
words, or null, has none and is linked with nothing. An id names one document: rows that share an id are
linked. Rows with a null id stand alone, with a null component, and are kept. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import mixed, saved, saved_in_small_batches
from visitlens.llm.components import components

WORDS = 5
BANDS, ROWS_PER_BAND = 32, 6
PERCENT = 85
MARGIN = 0.15  # a signature may fall so far below the similarity: five standard deviations and more
SLICE = 2_048
SLICE_BYTES = 32 << 20  # of full sets in a slice, 8 bytes a shingle
SALTS = 64
TEXTS = 256
_SCALE = np.uint64(0x9E3779B97F4A7C15)


def _parameters(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mixed(np.arange(1, 2 * n + 1, dtype=np.uint64))
    return (seeds[:n] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (seeds[n:] >> np.uint64(32)).astype(np.uint32)


MULTIPLIERS, ADDENDS = _parameters(BANDS * ROWS_PER_BAND)


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; A-Z are lower-cased, blanks of ASCII part words."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.zeros(0, dtype=np.uint64)
    ids = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), dtype=np.uint64, count=len(tokens))
    n = max(1, len(ids) - words + 1)
    sums = np.zeros(n, dtype=np.uint64)
    for k in range(min(words, len(ids))):
        sums = sums * _SCALE + ids[k:k + n]
    return np.unique(mixed(sums + np.uint64(min(words, len(ids)))))


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """A row of minima for each set; none may be empty."""
    values = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    result = np.empty((len(MULTIPLIERS), len(sets)), dtype=np.uint32)
    for k in range(len(MULTIPLIERS)):
        result[k] = np.minimum.reduceat(values * MULTIPLIERS[k] + ADDENDS[k], starts)
    return result.T


def band_keys(found: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(found), BANDS), dtype=np.uint64)
    for r in range(ROWS_PER_BAND):
        keys = keys * _SCALE + found[:, r::ROWS_PER_BAND]
    return mixed(keys + np.arange(BANDS, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)


def with_signatures(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n (shingles), cls (digest of the set), bands and signature; the last three null without words."""
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS):
                part = batch.slice(start, TEXTS)
                sets = [shingles(t or "") for t in part.column("text").to_pylist()]
                full = [i for i, s in enumerate(sets) if len(s)]
                cls, bands, signature = ([None] * len(sets) for _ in range(3))
                if full:
                    found = minima([sets[i] for i in full])
                    keys, low = band_keys(found), found.astype(np.uint8)
                    for at, i in enumerate(full):
                        cls[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                        bands[i], signature[i] = keys[at], low[at].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(cls, pa.binary()),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(signature, pa.binary())],
                    ["doc_id", "n", "cls", "bands", "signature"])

    return rows.mapInArrow(run, "doc_id long, n long, cls binary, bands array<long>, signature binary")


def _alike(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether signatures (rows of bytes) allow the similarity; of unequal minima one byte in 256 agrees."""
    agree = (a == b).mean(axis=-1)
    return (agree - 1 / 256) / (1 - 1 / 256) >= percent / 100 - MARGIN


def _signature_filter(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose set sizes and signatures allow the similarity."""
    sides = pairs
    for side in ("a", "b"):
        sides = sides.join(classes.select(F.col("rep").alias(side), F.col("n").alias(f"n_{side}"),
                                          F.col("signature").alias(f"s_{side}")), side)
    near = sides.filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8)
                               .reshape(batch.num_rows, -1) for c in ("s_a", "s_b"))
                yield batch.select(["a", "b"]).filter(pa.array(_alike(left, right, percent)))

    return near.select("a", "b", "s_a", "s_b").mapInArrow(run, "a long, b long")


def _sets(ids: DataFrame, documents: DataFrame) -> DataFrame:
    """id and shingles (sorted, packed) of the documents with these ids (column doc_id)."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS):
                part = batch.slice(start, TEXTS)
                sets = [shingles(t or "").tobytes() for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sets, pa.binary())], ["id", "shingles"])

    # A stored table has a measured size, by which Spark chooses to broadcast it or to shuffle.
    few = saved(ids.distinct(), "near-ids")
    return saved_in_small_batches(
        documents.join(few, "doc_id", "left_semi").mapInArrow(build, "id long, shingles binary"), "near-sets")


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union; an empty set is linked with nothing."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(x) + len(y) - both)


def _verified(pairs: DataFrame, documents: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked by their full sets."""
    pairs = saved(pairs, "near-pairs")
    sets = _sets(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")), documents)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = [_linked(*(np.frombuffer(v.as_py(), dtype=np.uint64) for v in both), percent)
                      for both in zip(batch.column("x"), batch.column("y"))]
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    joined = (pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a")
              .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b"))
    return saved_in_small_batches(joined.select("a", "b", "x", "y").mapInArrow(check, "a long, b long"), "near-links")


def _open_pairs(table: pa.Table, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row numbers x and those of its partners: pairs of different components in two slices of a bucket whose
    sizes and signatures allow the similarity, and which share no bucket of an earlier band. Keys of bands tell
    which buckets they share: bytes of a signature also agree by chance."""
    keys = table.column("bands").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
    signature = np.frombuffer(b"".join(table.column("signature").to_pylist()), dtype=np.uint8)
    signature = signature.reshape(table.num_rows, -1)
    n, component, mine = (table.column(c).to_numpy() for c in ("n", "component", "mine"))
    i, j, band = (table.column(c)[0].as_py() for c in ("i", "j", "band"))
    place = np.arange(len(mine))
    for x in np.flatnonzero(mine == i):
        others = (mine == j) if i != j else (mine == -1) | ((mine == i) & (place > x))
        others = np.flatnonzero(others & (component != component[x]) & (
            100 * np.minimum(n, n[x]) >= percent * np.maximum(n, n[x])))
        others = others[_alike(signature[others], signature[x], percent)]
        if len(others):
            others = others[(keys[others] == keys[x]).argmax(axis=1) == band]
        if len(others):
            yield x, others


def _links_of(table: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Links by full sets among the open pairs, as many as tie what they tie: fewer than there are rows."""
    rep = table.column("rep").to_pylist()
    sets = [np.frombuffer(v, dtype=np.uint64) for v in table.column("shingles").to_pylist()]
    group, links = {r: r for r in rep}, []

    def root(r):
        while group[r] != r:
            group[r] = r = group[group[r]]
        return r

    for x, others in _open_pairs(table, percent):
        for y in others:
            if root(rep[x]) != root(rep[y]) and _linked(sets[x], sets[y], percent):
                group[root(rep[x])] = root(rep[y])
                links.append((min(rep[x], rep[y]), max(rep[x], rep[y])))
    return links


def slice_counts(members: DataFrame) -> DataFrame:
    """key, step and slices: by members, or by the bytes of their full sets (column n) where those ask for more."""
    return members.groupBy("key", "step").agg(F.greatest(
        F.ceil(F.count("*") / SLICE), F.ceil(8 * F.sum("n") / SLICE_BYTES)).cast("int").alias("slices"))


def _salted(keys: DataFrame) -> DataFrame:
    """A row of a large bucket for each salt, so that it meets the bucket's members in ``SALTS`` places."""
    return keys.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _of_several(known: DataFrame) -> DataFrame:
    """The members of buckets in which several components meet, with their salt, and ``large`` by the bucket's size."""
    buckets = saved(known.groupBy("key").agg(
        (F.min("component") != F.max("component")).alias("several"), (F.count("*") > SLICE).alias("large")),
        "near-bucket-sizes")
    # Members of large buckets are told apart first; none of them comes near a join by key alone.
    large = saved(_salted(buckets.filter("large")).select("key", "salt", "several"), "near-large-buckets")
    salted = known.withColumn("salt", F.pmod(F.xxhash64("rep", F.lit("salt")), F.lit(SALTS)).cast("int"))
    told = salted.join(large, ["key", "salt"], "left")
    small = told.filter("several IS NULL").drop("several").join(
        buckets.filter("several AND NOT large").select("key"), "key").withColumn("large", F.lit(False))
    return small.unionByName(told.filter("several").drop("several").withColumn("large", F.lit(True)))


def _with_slices(members: DataFrame, slices: DataFrame, large_slices: DataFrame) -> DataFrame:
    """Members beside the number of slices of their (key, step); those without such a group go."""
    return members.filter("NOT large").join(slices, ["key", "step"]).unionByName(
        members.filter("large").join(large_slices, ["key", "step", "salt"]))


def _across_components(members: DataFrame, classes: DataFrame, labels: DataFrame, documents: DataFrame,
                       percent: int) -> DataFrame:
    """Links (a, b) between different components that share a bucket.

    Two rounds over the same groups: signatures tell which members have a partner at all, and the full
    sets of those are sent to where the pairs are. What leaves a group is members and links, in
    proportion to the members, never pairs.
    """
    known = saved(members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", "band", "rep", "n", F.coalesce("component", "rep").alias("component")), "near-members")
    # Sizes of a linked pair are in the same or in neighbouring steps of this scale.
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent)) + 1e-9).cast("int")
    home = saved(_of_several(known).withColumn("step", step), "near-mixed")
    slices = saved(slice_counts(home.filter("NOT large")), "near-slices")
    large_slices = saved(_salted(slice_counts(home.filter("large"))), "near-large-slices")
    mine = F.pmod(F.xxhash64("rep"), F.col("slices")).cast("int")
    columns = ["key", "band", "step", "i", "j", "mine", "rep", "n", "component"]
    # At home a member of slice i meets every slice; the pair of slices is named by (smaller, larger).
    at_home = (_with_slices(home, slices, large_slices).withColumn("mine", mine)
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
               .withColumns({"i": F.least("mine", "other"), "j": F.greatest("mine", "other")}).select(columns))
    # Members of the next lower step visit every slice; -1 marks them.
    visiting = (_with_slices(home.withColumn("step", F.col("step") + 1), slices, large_slices)
                .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
                .withColumns({"j": F.col("i"), "mine": F.lit(-1)}).select(columns))
    meeting = at_home.unionByName(visiting).join(classes.select("rep", "signature", "bands"), "rep")
    groups = ["key", "step", "i", "j"]

    def partners(table: pa.Table) -> pa.Table:
        found = sorted({int(r) for x, others in _open_pairs(table, percent) for r in (x, *others)})
        return table.take(pa.array(found, pa.int64()))

    schema = ("key long, band int, step int, i int, j int, mine int, rep long, n long, component long, "
              "signature binary, bands array<long>")
    left = saved(meeting.select(*columns, "signature", "bands").groupBy(*groups).applyInArrow(partners, schema), "near-partners")
    sets = _sets(left.select(F.col("rep").alias("doc_id")), documents)

    def link(table: pa.Table) -> pa.Table:
        links = _links_of(table, percent)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    full = left.join(sets.withColumnRenamed("id", "rep"), "rep")
    return saved_in_small_batches(full.groupBy(*groups).applyInArrow(link, "a long, b long").distinct(), "near-links")


def near_duplicates(documents: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept, a row per document row."""
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = saved_in_small_batches(with_signatures(rows), "signatures")
    named = signed.filter("doc_id IS NOT NULL AND n > 0")
    classes = saved(named.groupBy("cls").agg(
        F.min(F.struct("doc_id", "n", "bands", "signature")).alias("s")).select(
        "cls", F.col("s.doc_id").alias("rep"), "s.n", "s.bands", "s.signature"), "near-classes")

    spread = classes.select(F.posexplode("bands").alias("band", "key"), "rep", "n")
    buckets = spread.groupBy("key").agg(F.min("rep").alias("center"), F.count("*").alias("size")).filter("size > 1")
    members = saved(spread.join(buckets.drop("size"), "key"), "near-buckets")
    stars = members.filter("rep <> center").select(F.col("center").alias("a"), F.col("rep").alias("b")).distinct()
    links = _verified(_signature_filter(stars, classes, percent), rows, percent)

    # An id with several sets ties their classes.
    several = named.groupBy("doc_id").agg(F.min("cls").alias("low"), F.max("cls").alias("high")).filter("low <> high")
    ties = (named.select("doc_id", "cls").join(several.select("doc_id"), "doc_id")
            .join(classes.select("cls", "rep"), "cls").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")))
    links = links.unionByName(ties)
    labels = components(links)

    more = _across_components(members, classes, labels, rows, percent)
    # First components and the links found between them.
    labels = components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    of_class = classes.select("cls", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "cls", F.coalesce("component", "rep").alias("component"))
    return signed.select("doc_id", "n", "cls").join(of_class, "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(documents: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id",
                            text: str = "text") -> DataFrame:
    """The documents of which one per group stays, with all columns; of equal (id, text) rows one stays."""
    judged = near_duplicates(documents, percent, doc_id, text)
    dropped = judged.filter("NOT kept").select(F.col("doc_id").alias("_dropped")).distinct()
    stay = documents.join(dropped, documents[doc_id].cast("long") == dropped["_dropped"], "left_anti")
    return stay.dropDuplicates([doc_id, text])
