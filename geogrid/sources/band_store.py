"""Bands and geolocation kept in tables bucketed by pixel, so that composites of any number of them are joined where they lie."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geogrid.sources.shared import shared_folder

#: Buckets of a store; about as many as tasks that should read a band at once.
BUCKETS = 64
#: Rows of a band that one bucket holds: a task sorts one bucket of each band that it joins, some 35 MB a band.
ROWS_A_BUCKET = 500_000
KEYS = ("y", "x")


def store_band(df: DataFrame, table: str, buckets: int = BUCKETS, keys: tuple[str, ...] = KEYS, path: str | None = None) -> str:
    """Writes a band (keys and any columns) as a table with one sorted file for each bucket; returns the table's name.

    All bands of a store need the same ``buckets`` and ``keys``. With ``path`` the table's files lie there. Rows with a
    missing key are dropped: they meet nothing.
    """
    placed = df.where(" and ".join(f"{k} is not null" for k in keys)).repartition(buckets, *keys)
    writer = placed.write.format("parquet").mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return table


def buckets_for(rows: int, least: int = 1) -> int:
    """Buckets for bands of so many rows, so that a task's share doesn't grow with them."""
    return max(least, -(-rows // ROWS_A_BUCKET))


def joined_bands(spark: SparkSession, tables: Mapping[str, str], keys: tuple[str, ...] = KEYS) -> DataFrame:
    """The pixels that all tables have, with a column for each: ``tables`` maps a column's new name to a table whose ``value``
    it is; a table named under ``""`` brings all its columns (geolocation). Equal buckets meet without a shuffle."""
    out = None
    for name, table in tables.items():
        band = spark.table(table)
        band = band.select(*keys, F.col("value").alias(name)) if name else band
        out = band if out is None else out.hint("merge").join(band.hint("merge"), list(keys))
    if out is None:
        raise ValueError("no tables to join")
    return out


def new_store(spark: SparkSession, bands: Mapping[str, DataFrame], buckets: int | None = None, keys: tuple[str, ...] = KEYS) -> dict[str, str]:
    """A store of some bands in the shared folder, under names of its own: what ``joined_bands`` takes.

    Without ``buckets``, the rows of all bands are counted, and the largest band decides (``BUCKETS`` at least).
    """
    if buckets is None:
        buckets = buckets_for(max((df.count() for df in bands.values()), default=0), BUCKETS)
    root, own = shared_folder(spark, "bands"), uuid.uuid4().hex
    return {name: store_band(df, f"band_{own}_{k}", buckets, keys, f"{root}/{k}") for k, (name, df) in enumerate(bands.items())}
