"""A shared folder for sessions that name none."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession

from visitlens.session import shared_folder


def ensure_shared_folder(spark: SparkSession) -> None:
    """Leave a session's own setting alone. Else a local session gets a folder that goes with the process,
    and a cluster one in its warehouse, which executors share."""
    if shared_folder(spark):
        return
    if spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster"):
        folder = tempfile.mkdtemp(prefix="visitlens-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    else:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_visitlens"
    spark.sparkContext.setCheckpointDir(folder)
