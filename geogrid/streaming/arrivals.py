"""Granules and pixels that arrive over time.

Masks, scalings, projections and tiles are stateless Columns and run on streams as they are. What
needs state: counts of valid pixels by time window with late data, and a store that new passes are
appended to, batch by batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from geogrid.sources.shared import remove, subfolders, written


def read_arrivals(spark: SparkSession, path: str, schema: str, per_batch: int = 64) -> DataFrame:
    """A stream of Parquet files as they land in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def valid_counts(pixels: DataFrame, time_col: str = "ts", window: str = "1 hour", late: str = "30 minutes") -> DataFrame:
    """(start, product, n_valid, n) by time window; pixels later than ``late`` behind the newest are dropped."""
    timed = pixels.withColumn("__t", F.col(time_col).cast("timestamp")).withWatermark("__t", late)
    counts = timed.groupBy(F.window("__t", window).alias("w"), "product").agg(F.count("value").alias("n_valid"), F.count("*").alias("n"))
    return counts.select(F.col("w.start").alias("start"), "product", "n_valid", "n")


def append_passes(grid: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch of gridded pixels into a store partitioned by area, product and batch.

    A batch that is tried again replaces itself alone, so passes that span batches lose nothing.
    """

    def store(batch: DataFrame, number: int) -> None:
        numbered = batch.withColumn("batch_id", F.lit(number).cast("long"))
        numbered.write.partitionBy("area_id", "product", "batch_id").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)

    return grid.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_pixels(spark: SparkSession, path: str) -> DataFrame:
    """The store's pixels, of each cell the one that came last with a value (of equal batches any of its values' largest)."""
    stored = spark.read.parquet(path).where("value is not null")
    best = stored.groupBy("area_id", "product", "row", "col").agg(F.max(F.struct("batch_id", "value")).alias("m"))
    return best.select("area_id", "product", "row", "col", F.col("m.value").alias("value"))


def compact_passes(spark: SparkSession, path: str, state: str) -> DataFrame:
    """The store's latest pixels, as ``latest_pixels``, kept up to date in ``state``; returns the new state.

    A state holds each cell's batch and value up to some batch. Only batches after it are read, so what a new pass costs
    depends on the cells and the pass, not on how many passes came before. States are written under the last batch they
    hold and older ones deleted once a newer one is whole; a broken attempt is made anew.
    """
    held = sorted(int(n.split("=")[1]) for n in subfolders(spark, state) if n.startswith("upto=") and written(spark, f"{state}/{n}"))
    stored = spark.read.parquet(path)
    last = held[-1] if held else None
    new = stored.where("value is not null").select("area_id", "product", "row", "col", F.col("batch_id").cast("long").alias("batch_id"), "value")
    if last is not None:
        new = new.where(F.col("batch_id") > last)
    newest = new.agg(F.max("batch_id")).first()[0]
    if newest is not None:
        rows = new if last is None else new.unionByName(spark.read.parquet(f"{state}/upto={last}").select(new.columns))
        best = rows.groupBy("area_id", "product", "row", "col").agg(F.max(F.struct("batch_id", "value")).alias("m"))
        best.select("area_id", "product", "row", "col", "m.batch_id", "m.value").write.mode("overwrite").parquet(f"{state}/upto={newest}")
        for old in held:
            remove(spark, f"{state}/upto={old}")
        last = newest
    if last is None:
        return new.drop("batch_id").limit(0)
    return spark.read.parquet(f"{state}/upto={last}").drop("batch_id")
