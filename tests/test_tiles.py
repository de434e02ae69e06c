"""Work on tiles against row by row versions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from geogrid.operators import resample, tiles


def swath(spark, rows=60, cols=50):
    n = F.col("id")
    y, x = F.floor(n / cols), n % cols
    hashed = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000
    return spark.range(rows * cols * 2).select(
        F.when(n >= rows * cols, "b").otherwise("a").alias("product"),
        (y % rows).cast("int").alias("y"),
        x.cast("int").alias("x"),
        F.when(hashed > 0.03, x * 0.9 + (y % rows) * 0.2 + hashed - 3).alias("u"),
        ((y % rows) * 1.3 - x * 0.1 + hashed * 0.5 - 2).alias("v"),
        F.when(hashed < 0.9, F.round(hashed * 100 + x, 3)).alias("value"),
    )


@pytest.mark.parametrize(("side", "delta", "distance"), [(64, 10.0, 1.0), (4, 10.0, 2.0), (16, 40.0, 12.0)])
@pytest.mark.parametrize("largest", [False, True])
def test_ewa_tiles_equal_rows(spark, monkeypatch, side, delta, distance, largest):
    monkeypatch.setattr(tiles, "HELD", 3)
    monkeypatch.setattr(tiles, "AT_ONCE", 5000)
    placed = swath(spark).repartition(3)
    kwargs = {"rows_per_scan": 10, "delta_max": delta, "distance_max": distance, "keys": ("product",)}
    weights = resample.ewa_weights(placed, 45, 70, carry=("value",), **kwargs)
    if largest:
        weights = weights.withColumn("weight", F.round("weight", 9))
    want = {(r["product"], r["row"], r["col"]): r["value"] for r in resample.resample_ewa(None, weights, largest, keys=("product",)).collect()}
    ellipses = resample.ewa_ellipses(placed, 45, 70, **kwargs)
    got = {(r["product"], r["row"], r["col"]): r["value"] for r in tiles.ewa_tiles(ellipses, distance, maximum_weight=largest, keys=("product",), side=side).collect()}
    assert got.keys() == want.keys() and len(got) > 4000
    assert all(got[k] == pytest.approx(want[k], rel=1e-9) for k in want)


def test_ewa_tiles_without_keys_or_pixels(spark):
    placed = swath(spark).where("product = 'a'").drop("product")
    ellipses = resample.ewa_ellipses(placed, 45, 70)
    rows = resample.resample_ewa(None, resample.ewa_weights(placed, 45, 70, carry=("value",)), least_weight=0.5)
    want = {(r["row"], r["col"]): r["value"] for r in rows.collect()}
    got = {(r["row"], r["col"]): r["value"] for r in tiles.ewa_tiles(ellipses, least_weight=0.5).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    assert tiles.ewa_tiles(ellipses.where("value is null")).collect() == []
