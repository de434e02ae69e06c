"""The folder that driver and executors share, and tables that are small enough for each of them."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a table that is sent to all executors.
MOST_ROWS = 10_000


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir`` (or the context's checkpoint folder).

    Where neither is set, a session on one machine gets a temporary folder; on a cluster that raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        own = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = own.get() if own.isDefined() else None
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="geogrid-")
    return f"{root}/{name}-{uuid.uuid4().hex}"


def small(df: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """``df`` to be broadcast, after its rows were counted: a table of rules, labels or grids, which any row may
    match. Raises where it has more than ``most`` rows."""
    if df.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows can't be matched one by one")
    return F.broadcast(df)


def merged(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A join of two tables with a row for each pixel, by sorting both: neither is sent whole through the driver, however
    small Spark takes its compressed files to be."""
    return left.hint("merge").join(right.hint("merge"), on, how)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a written table in the shared folder."""
    path = shared_folder(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end in a folder, by Spark's file systems."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none where there is no such folder."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()) if fs.exists(root) else []


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of our own."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)
