"""The folder that driver and executors share, and tables written there."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir, set as the checkpoint folder, too. On one machine alone (a local master) one is made where
    there is none; elsewhere that is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="codetables-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/codetables/{label}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def without_shuffles(spark: SparkSession) -> Iterator[None]:
    """Files of the shuffles of what runs within are removed as soon as it has run, and not when the driver happens to
    collect its garbage."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """df written to a new table in the shared folder and read back: computed once, and safe from lost executors."""
    path = shared_path(df.sparkSession, label)
    with without_shuffles(df.sparkSession):
        df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)
