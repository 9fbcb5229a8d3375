"""The folder that driver and executors share, and tables written there."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession, name: str = "table") -> str:
    """A fresh path below the folder that the cluster names for checkpoints.

    Only a local session, where driver and executors are one machine, may be
    without that setting; it then gets a folder of its own.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_DIR} must name a shared folder")
        base = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set(CHECKPOINT_DIR, base)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def stored(frame: DataFrame, name: str = "table") -> DataFrame:
    """The rows of a frame, computed once, written to the shared folder and read back.

    The result has no lineage before the written files, so a lost executor
    costs only a new read.
    """
    spark = frame.sparkSession
    path = shared_folder(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
