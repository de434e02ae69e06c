"""Operators on 10^7 made-up pixels: seconds, rows and the spread of tasks, one JSON line each. Not run by the driver.

    BENCH_CPUS=8 python bench_large.py [pixels]
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

REPO = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, REPO)
os.environ["PYTHONPATH"] = os.pathsep.join([REPO, *filter(None, [os.environ.get("PYTHONPATH")])])

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from geogrid.operators import nearest, resample, tiles  # noqa: E402

COLS = 3200


def swath(spark: SparkSession, pixels: int) -> DataFrame:
    """Scan lines of 3200 pixels, 0.0075 degrees apart along and across."""
    n = F.col("id")
    y, x = F.floor(n / COLS), n % COLS
    return spark.range(0, pixels, 1, 64).select(
        y.cast("int").alias("y"),
        x.cast("int").alias("x"),
        (F.lit(-100.0) + x * 0.0075 + y * 0.001).alias("lon"),
        (F.lit(20.0) + y * 0.0075 + x * 0.0005).alias("lat"),
        F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double").alias("value"),
    )


def timed(name: str, df: DataFrame, **more) -> None:
    began = time.time()
    rows = df.agg(F.count("*"), F.sum("value") if "value" in df.columns else F.lit(0)).first()[0]
    print(json.dumps({"bench": name, "sec": round(time.time() - began, 1), "rows": rows} | more), flush=True)


def main(pixels: int) -> None:
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "64")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    s = swath(spark, pixels)
    width, height = 3600, 3600
    placed = resample.swath_cells(s, {"proj": "longlat"}, -101.0, 47.0, 0.0075, 0.0075)
    for delta, distance in ((10.0, 1.0), (40.0, 2.0)):
        ellipses = resample.ewa_ellipses(placed, width, height, rows_per_scan=32, delta_max=delta, distance_max=distance)
        timed("ewa_tiles", tiles.ewa_tiles(ellipses, distance), pixels=pixels, weight_delta_max=delta, weight_distance_max=distance)
    dense = s.withColumn("lon", F.when(F.col("y") % 2 == 0, -100 + (F.col("lon") + 100) / 32).otherwise(F.col("lon"))).withColumn("lat", F.when(F.col("y") % 2 == 0, 20 + (F.col("lat") - 20) / 32).otherwise(F.col("lat")))
    cells = spark.range(0, 1000 * 1000, 1, 16).select(F.floor(F.col("id") / 1000).cast("int").alias("row"), (F.col("id") % 1000).cast("int").alias("col"), (F.lit(-100.5) + F.col("id") % 1000 * 0.025).alias("lon"), (F.lit(19.5) + F.floor(F.col("id") / 1000) * 0.025).alias("lat"))
    timed("nearest_adaptive", nearest.nearest_adaptive(cells, dense, 40000.0), pixels=pixels, cells=10**6, density="1000 times")
    grid = s.select(F.col("y").alias("row"), F.col("x").alias("col"), "value")
    timed("pyramid", resample.pyramid(grid, [2, 4, 8, 16, 32]), pixels=pixels)
    began = time.time()
    levels = resample.pyramid_cascade(grid, [2, 4, 8, 16, 32])
    print(json.dumps({"bench": "pyramid_cascade", "sec": round(time.time() - began, 1), "rows": levels.count(), "pixels": pixels}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main(int(sys.argv[1]) if len(sys.argv) > 1 else 10**7)
