"""Insert-or-update on parquet: every batch is written once, the last version of a key wins.

A batch costs its own size only. Writing a version again replaces it, so a repeated streaming batch
changes nothing; writers never replace each other's versions. ``compact`` folds versions from time to
time; of a partitioned table it folds the partitions touched since the last fold and leaves the others alone.
Versions with nothing left are deleted, so a table has about two folds' worth of versions and one per partition
that no longer changes, however many batches there were.

Layout: ``<path>/version=<id>/writer=<name>/full=<0|1>``; ``full=1`` holds all keys (of its partitions) up
to that version. A boolean column ``removed`` in the schema makes a row the end of its key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from visitlens.operators.ranking import top_n

FOLD = "fold"


def _glob(spark: SparkSession, pattern: str) -> list:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [status.getPath() for status in fs.globStatus(target) or []]


def _delete(spark: SparkSession, pattern: str) -> None:
    for old in _glob(spark, pattern):
        old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)


def _value(path) -> str:
    return path.getName().split("=", 1)[1]


def _version_of(partition) -> int:
    return int(_value(partition.getParent().getParent().getParent()))


def _versions(spark: SparkSession, path: str, full: int | None = None) -> list[int]:
    """Finished versions: those since the last but one fold, and older ones that hold a partition's last fold."""
    found = _glob(spark, f"{path}/version=*/writer=*/full={'*' if full is None else full}/_SUCCESS")
    return sorted({_version_of(p) for p in found})


def next_version(spark: SparkSession, path: str) -> int:
    return max(_versions(spark, path), default=-1) + 1


def writers(spark: SparkSession, path: str) -> set[str]:
    return {_value(p) for p in _glob(spark, f"{path}/version=*/writer=*")} - {FOLD}


def partition_values(spark: SparkSession, path: str, version: int, writer: str, column: str) -> list[str]:
    """Values of the partition column in a version, from its folders."""
    return sorted(_value(p) for p in _glob(spark, f"{path}/version={version}/writer={writer}/full=0/{column}=*"))


def upsert(
    batch: DataFrame, path: str, keys: list[str], version: int,
    order_by: list | None = None, partition_by: str | None = None, writer: str = "batch",
) -> None:
    """Write ``batch`` as ``version`` of the table.

    ``order_by`` decides between rows of one key inside the batch (first wins) and may be
    left out where the keys are unique already.
    """
    rows = top_n(batch, keys, order_by, 1) if order_by else batch
    out = rows.write.mode("overwrite")
    if partition_by:
        out = out.partitionBy(partition_by)
    out.parquet(f"{path}/version={version}/writer={writer}/full=0")


def read_latest(
    spark: SparkSession, path: str, keys: list[str], schema: StructType | str,
    where: Column | None = None, partition_by: str | None = None, newest: list[Column] | None = None,
    removed: bool = False, partitions: list[str] | None = None,
) -> DataFrame:
    """The current row of every key. ``where`` on the partition column keeps other partitions unread; with
    ``partitions``, its values, other versions are not even listed.

    ``newest`` orders the rows of a key before their versions do. Keys that end with a ``removed`` row
    are left out, unless ``removed`` asks for them.
    """
    names = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    versions = _versions(spark, path)
    if not versions:
        return spark.createDataFrame([], names)
    # Partitions have folds of different age, and what they replaced is deleted; so all is read.
    base = versions[0] if partition_by else max(_versions(spark, path, full=1), default=versions[0])
    paths = [f"{path}/version={v}" for v in versions if v >= base]
    if partitions is not None:
        found = [p for value in partitions for p in _glob(spark, f"{path}/version=*/writer=*/full=*/{partition_by}={value}")]
        paths = [p.toString() for p in found if _version_of(p) in set(versions)]
        if not paths:
            return spark.createDataFrame([], names)
    reader = spark.read.option("basePath", path).schema(StructType(names.fields).add("version", "long").add(
        "writer", "string").add("full", "integer"))
    rows = reader.parquet(*paths)
    if where is not None:
        rows = rows.where(where)
    order = [*(newest or []), F.col("version").desc(), F.col("full").desc(), F.col("writer")]
    rows = top_n(rows, keys, order, 1).select(*names.fieldNames())
    if "removed" in names.fieldNames() and not removed:
        rows = rows.where("NOT coalesce(removed, false)")
    return rows


def compact(
    spark: SparkSession, path: str, keys: list[str], schema: StructType | str,
    partition_by: str | None = None, newest: list[Column] | None = None,
) -> None:
    """Fold what was written since the previous fold into the newest version and drop what is older than that.

    Versions between the previous fold and this one stay, for readers that listed them before.
    """
    versions = _versions(spark, path)
    previous = max(_versions(spark, path, full=1), default=None)
    if not versions or versions[-1] == previous:
        return
    where, touched = None, []
    if partition_by:
        recent = [v for v in versions if previous is None or v > previous]
        touched = sorted({_value(p) for v in recent for p in _glob(
            spark, f"{path}/version={v}/writer=*/full=0/{partition_by}=*")})
        where = F.col(partition_by).isin(touched)
    folded = read_latest(spark, path, keys, schema, where, partition_by, newest, removed=True)
    out = folded.write.mode("overwrite")
    if partition_by:
        out = out.partitionBy(partition_by)
    out.parquet(f"{path}/version={versions[-1]}/writer={FOLD}/full=1")
    if previous is None:
        return
    if not partition_by:
        for version in versions:
            if version < previous:
                _delete(spark, f"{path}/version={version}")
        return
    # Of a partition goes what is older than its last fold but this one, whether or not this fold touched it.
    folds = [(_value(p), _version_of(p)) for p in _glob(spark, f"{path}/version=*/writer=*/full=1/{partition_by}=*")]
    last = {value: max(v for other, v in folds if other == value and v <= previous)
            for value, version in folds if version <= previous}
    for old in _glob(spark, f"{path}/version=*/writer=*/full=*/{partition_by}=*"):
        if _version_of(old) < last.get(_value(old), 0):
            old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)
    for version in versions:
        if version < previous and not _glob(spark, f"{path}/version={version}/writer=*/full=*/{partition_by}=*"):
            _delete(spark, f"{path}/version={version}")
