"""Cutting lineage in the folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's own checkpoint folder (``spark.checkpoint.dir``); only where none is set, as in tests, a temporary one."""
    bounded_batches(spark)
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(context.getConf().get("spark.checkpoint.dir") or tempfile.mkdtemp(prefix="sixfold-checkpoint-"))
    return context.getCheckpointDir()


#: Bytes of an Arrow batch between Spark and Python, at most about.
BATCH = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Let no Arrow batch be larger than ``BATCH`` (a single row may), unless the session says less.

    A task holds a batch several times, in the JVM, on its way and in Python, and rows here hold whole texts and sets.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = int(spark.conf.get(key).rstrip("b"))
    if held > BATCH:
        spark.conf.set(key, str(BATCH))


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and read it back from the shared folder, so that later jobs and lost executors do not redo it."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
