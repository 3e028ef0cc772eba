"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Merge session windows before the shuffle, so a hot key travels as merged runs.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str, master: str | None = None, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str | None:
    """The folder named by ``spark.checkpoint.dir``, or the context's checkpoint folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    base = base or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return base or spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder that all executors share."""
    base = shared_folder(spark)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def write_shared(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder and return it read back, with its path."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
