"""Session settings that the operators share."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession

#: Arrow batches that reach Python hold at most this many bytes or rows.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 4096


def bound_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of Python stages, so that long texts don't add up in a worker.

    Spark reads these settings of the session when a plan runs, so they stay; smaller ones of the caller are left.
    """
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        own = spark.conf.get(f"spark.sql.execution.arrow.{key}", None)
        if own is None or not own.isdigit() or not 0 < int(own) <= most:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", str(most))


def bounded_batches(rows: DataFrame, run, schema: str) -> DataFrame:
    """``rows.mapInArrow(run, schema)`` over bounded batches."""
    bound_batches(rows.sparkSession)
    return rows.mapInArrow(run, schema)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` or the context's checkpoint folder.

    Where neither is set, a session on one machine gets a folder of its own; on a cluster that raises.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = jvm_dir.get() if jvm_dir.isDefined() else None
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="geogrid-checkpoint-")
        spark.sparkContext.setCheckpointDir(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of our own in the shared folder, by Spark's file systems."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def cut(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def merged(left: DataFrame, right: DataFrame, on: str | list[str] | Column, how: str = "inner") -> DataFrame:
    """A join by sorting both sides. A broadcast join of tables that were shuffled already would collect one of them in
    the driver, once a join; operators of many joins thus fill it with garbage that it holds until its next collection."""
    return left.hint("merge").join(right.hint("merge"), on, how)
