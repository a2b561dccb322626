"""A folder for what a query writes and reads again."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir). Where the session names none, a temporary folder is
    set if all runs on this machine; on a cluster that is an error."""
    held = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not held:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        held = "file://" + folder
        spark.sparkContext.setCheckpointDir(held)
    return f"{held.rstrip('/')}/{name}-{uuid.uuid4().hex}"
