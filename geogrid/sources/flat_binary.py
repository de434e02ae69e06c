"""Row-major raw arrays: read as records of a row by Spark's file systems, written by row ranges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_flat_binary(spark: SparkSession, path: str, rows: int, cols: int, dtype: str = "float32") -> DataFrame:
    """(y, x, value) of a row-major array in one file, on any store that Spark reads.

    The file is split at whole rows, each of which is a record; a file of another size than rows x cols raises.
    """
    kind = np.dtype(dtype)
    records = spark.sparkContext.binaryRecords(path, cols * kind.itemsize).zipWithIndex()
    lines = records.map(lambda x: (x[1], x[0])).toDF("y long, data binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column("y").to_numpy()
            if len(y) and y.max() >= rows:
                raise ValueError(f"{path} is longer than {rows} x {cols}")
            values = np.frombuffer(b"".join(batch.column("data").to_pylist()), kind).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(y, cols).astype(np.int32)), pa.array(np.tile(np.arange(cols, dtype=np.int32), len(y))), pa.array(values)], ["y", "x", "value"])

    return lines.mapInArrow(run, "y int, x int, value double")


def to_flat_blocks(grid: DataFrame, width: int, dtype: str = "float32", block_rows: int = 256, fill: float = 0.0) -> DataFrame:
    """(block, first_row, data): each block of rows as row-major bytes; cells without a value get ``fill``.

    Blocks in order make the file; each is made by one task from its own rows.
    """
    kind = np.dtype(dtype)

    def run(key, pdf):
        block = int(key[0])
        out = np.full((block_rows, width), fill, kind)
        ok = pdf["value"].notna().to_numpy()
        out[pdf["row"].to_numpy()[ok] - block * block_rows, pdf["col"].to_numpy()[ok]] = pdf["value"].to_numpy()[ok].astype(kind)
        last = int(pdf["row"].max()) - block * block_rows + 1
        return pd.DataFrame({"block": [block], "first_row": [block * block_rows], "data": [out[:last].tobytes()]})

    blocks = grid.select(F.floor(F.col("row") / block_rows).cast("int").alias("block"), F.col("row").cast("int"), F.col("col").cast("int"), F.col("value").cast("double"))
    return blocks.groupBy("block").applyInPandas(run, "block int, first_row int, data binary")
