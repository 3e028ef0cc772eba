"""Whitening of embeddings by weighted multiplicity covariance.

1. Entries c become x = floor(scale * c) + shift; equal x vectors are one row with their number of copies.
2. Fit weights are one ("distinct") or the copies ("copies"). Weighted sums are exact; the covariance is a weighted
   product of rows centred at (n * x - S) / n, the difference exact, so that no digits are lost to the mean.
   Tasks add products for their rows; partial matrices are summed row by row in different tasks.
3. Eigenvectors of the small matrix (width x width) are found on the driver and sent with the tasks.
4. Each distinct vector is whitened once and joined back to its rows. A vector that more than a
   ``HOT_PART``-th of all rows share is joined in slices: fewer than ``HOT_PART`` vectors can be so frequent,
   so their list is bounded whatever the data hold.

Defined results: rows with a null vector or null or non-finite entries are left out; a table without other rows gives
no rows; rows with a null id and repeated rows are whitened like all others. Vectors of different widths, and entries
or sums beyond 64 bits, are an error. A component of no variance has null for ``whitened``, and ``identity_error``
covers the others. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import saved

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
HOT_PART = 10_000
ROWS = 4_096  # rows of one product
_LONG = 2**63 - 1


def integer_vectors(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE,
                    shift: int = SHIFT) -> DataFrame:
    """vec_id and x of the rows whose entries are all finite."""
    rows = embeddings.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    whole = rows.filter(F.col("v").isNotNull()).filter(F.coalesce(finite, F.lit(False)))
    return whole.select("vec_id", F.transform("v", lambda c: (F.floor(c * scale) + shift).cast("long")).alias("x"))


def _key() -> F.Column:
    return F.unhex(F.sha2(F.array_join(F.transform("x", lambda c: c.cast("string")), ","), 256))


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """key (digest), x and copies, a row per different x."""
    return vectors.groupBy(_key().alias("key"), "x").agg(F.count("*").alias("copies"))


def _matrix(batch: pa.RecordBatch, width: int | None = None) -> np.ndarray:
    column = batch.column("x")
    x = column.flatten().to_numpy()
    if width is not None and len(x) != width * len(column):
        raise ValueError("vectors of different widths")
    return x.reshape(len(column), -1)


def _weights(batch: pa.RecordBatch, weight: str) -> np.ndarray:
    return batch.column("copies").to_numpy() if weight == "copies" else np.ones(batch.num_rows, dtype=np.int64)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, exact."""
    if n * int(np.abs(x).max(initial=0)) + int(np.abs(sums).max(initial=0)) > _LONG:
        raise OverflowError("n * x - S is beyond 64 bits")
    return n * x - sums


def _weighted_sums(distinct: DataFrame, width: int, weight: str) -> tuple[int, np.ndarray]:
    """Number of fit vectors and exact sums per dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * (width + 1)
        for batch in batches:
            x, w = _matrix(batch, width), _weights(batch, weight)
            if int(np.abs(x).max(initial=0)) * int(w.sum()) > _LONG:
                raise OverflowError("a sum of entries is beyond 64 bits")
            total = [a + int(b) for a, b in zip(total, [w.sum(), *(w @ x)])]
        yield pa.RecordBatch.from_arrays([pa.array(range(width + 1)), pa.array(total, pa.int64())], ["at", "part"])

    parts = distinct.mapInArrow(add, "at long, part long")
    sums = dict(parts.groupBy("at").agg(F.sum("part")).collect())
    return sums[0], np.array([sums[k + 1] for k in range(width)], dtype=np.int64)


def _product_sum(parts: DataFrame, width: int) -> np.ndarray:
    """Sum of square matrices given as rows (at: row number, part: its doubles), in the order of tasks."""

    def add(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("task").to_numpy())
        rows = table.column("part").to_pylist()
        total = np.zeros(width)
        for k in order:
            total += np.frombuffer(rows[k], dtype=np.float64)
        return pa.table({"at": table.column("at").slice(0, 1), "part": pa.array([total.tobytes()], pa.binary())})

    result = np.zeros((width, width))
    for at, part in parts.groupBy("at").applyInArrow(add, "at long, part binary").collect():
        result[at] = np.frombuffer(part, dtype=np.float64)
    return result


def _covariance(distinct: DataFrame, width: int, n: int, sums: np.ndarray, weight: str,
                project: np.ndarray | None = None, mean: np.ndarray | None = None) -> np.ndarray:
    """Weighted covariance of the fit vectors, or of their projections less ``mean``; divisor n."""
    size = width if project is None else project.shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros((size, size))
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                z = _centred(_matrix(part, width), n, sums) / n
                if project is not None:
                    z = z @ project - mean
                total += (z * _weights(part, weight)[:, None]).T @ z
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()] * size, pa.int64()), pa.array(range(size)),
             pa.array([row.tobytes() for row in total], pa.binary())], ["task", "at", "part"])

    return _product_sum(distinct.mapInArrow(add, "task long, at long, part binary"), size) / n


def _projected_mean(distinct: DataFrame, width: int, n: int, sums: np.ndarray, weight: str,
                    project: np.ndarray) -> np.ndarray:
    """Mean of the projections over the fit list: zero but for rounding."""
    size = project.shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            total += _weights(batch, weight) @ (_centred(_matrix(batch, width), n, sums) / n @ project)
        yield pa.RecordBatch.from_arrays([pa.array(range(size)), pa.array(total)], ["at", "part"])

    found = dict(distinct.mapInArrow(add, "at long, part double").groupBy("at").agg(F.sum("part")).collect())
    return np.array([found[k] for k in range(size)]) / n


def directions(covariance: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns), each with its largest entry positive."""
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    largest = np.abs(vectors).argmax(axis=0)
    signs = np.sign(vectors[largest, np.arange(vectors.shape[1])])
    return values, vectors * np.where(signs == 0, 1, signs)


def whiten(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", weight: str = "distinct",
           components: int = COMPONENTS) -> DataFrame:
    """vec_id, copies, n, deviation (decimal, exact), whitened (array), explained (array), identity_error per row."""
    vectors = integer_vectors(embeddings, vec_id, vector)
    distinct = saved(distinct_vectors(vectors), "vectors")
    schema = "vec_id {}, copies long, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double".format(
        vectors.schema["vec_id"].dataType.simpleString())
    bounds = distinct.agg(F.min(F.size("x")), F.max(F.size("x")), F.sum("copies")).first()
    if not bounds[1]:
        if bounds[2]:
            raise ValueError("vectors without entries")
        return embeddings.sparkSession.createDataFrame([], schema)
    if bounds[0] != bounds[1]:
        raise ValueError("vectors of different widths")
    width, rows = bounds[1], bounds[2]

    n, sums = _weighted_sums(distinct, width, weight)
    covariance = _covariance(distinct, width, n, sums, weight)
    values, vectors_ = directions(covariance, components)
    real = values > width * np.finfo(float).eps * max(values[0], 0)
    project = vectors_[:, real] / np.sqrt(values[real])
    error = None
    if real.any():
        mean = _projected_mean(distinct, width, n, sums, weight, project)
        error = float(np.abs(_covariance(distinct, width, n, sums, weight, project, mean) - np.eye(int(real.sum()))).max())
    explained = [float(v) for v in values / np.trace(covariance)] if np.trace(covariance) > 0 else [None] * len(values)
    places = np.flatnonzero(real)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                away = _centred(_matrix(part, width), n, sums)
                most = int(np.abs(away).max(initial=0))
                exact = away if width * most * most <= _LONG else away.astype(object)
                z = np.full((part.num_rows, len(real)), np.nan)
                z[:, places] = (away / n) @ project
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("copies"),
                     pa.array([str(d) for d in (exact * exact).sum(axis=1)], pa.string()),
                     pa.array([[None if k not in kept else v for k, v in enumerate(row)] for row in z.tolist()],
                              pa.list_(pa.float64()))], ["key", "copies", "deviation", "whitened"])

    kept = set(places.tolist())
    done = distinct.mapInArrow(run, "key binary, copies long, deviation string, whitened array<double>")
    # A vector in more than rows / HOT_PART rows is joined in slices of about that many rows.
    share = max(1, rows // HOT_PART)
    slices = F.ceil(F.col("copies") / share).cast("int")
    hot = distinct.filter(F.col("copies") > share).select("key", slices.alias("slices"))
    salted = vectors.select("vec_id", _key().alias("key")).join(F.broadcast(hot), "key", "left").select(
        "vec_id", "key", F.when(F.col("slices").isNotNull(), F.pmod(
            F.xxhash64("vec_id", F.monotonically_increasing_id()), "slices")).otherwise(F.lit(0)).cast("int").alias("slice"))
    spread = done.withColumn("slice", F.explode(F.sequence(F.lit(0), slices - 1)))
    return salted.join(spread, ["key", "slice"]).select(
        "vec_id", "copies", F.lit(n).cast("long").alias("n"), F.col("deviation").cast("decimal(38,0)").alias("deviation"),
        "whitened", F.array(*(F.lit(v).cast("double") for v in explained)).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))


def components_of(whitened: DataFrame) -> DataFrame:
    """A row per vector and component, numbered from 1. A deviation beyond 64 bits is null."""
    return whitened.select(
        "vec_id", "n", F.expr("try_cast(deviation AS bigint)").alias("deviation"), "identity_error",
        F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c")).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", F.col("c.whitened").alias("whitened"),
        F.col("c.explained").alias("explained"), "identity_error")
