"""Filters, grids, sinks, the flat binary source and streams on small tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from geogrid.operators import composites, decide, filters, grids, products, resample, sinks
from geogrid.sources import flat_binary, tables
from geogrid.streaming import arrivals


def test_coverage_of_known_areas(spark):
    hits = spark.range(40 * 60).select(F.when(F.col("id") % 60 < 30, "half").otherwise("other").alias("product"), F.floor(F.col("id") / 60).alias("row"), (F.col("id") % 60).alias("col"))
    full = hits.select(F.lit("full").alias("product"), "row", "col")
    got = dict(filters.coverage(hits.unionByName(full), 60, 40).collect())
    assert got == {"half": 0.5, "other": 0.5, "full": 1.0}
    away = hits.withColumn("col", F.col("col") + 1000)
    assert filters.coverage(away, 60, 40).count() == 0


def test_daylight_filters(spark):
    p = spark.createDataFrame([("a", "vis"), ("b", "ir"), ("c", "vis")], "product string, standard_name string")
    sun = spark.createDataFrame([("a", 0.05), ("b", 0.05)], "product string, sunlit double")
    only = spark.createDataFrame([("standard_name", "vis")], "key string, value string")
    names = lambda df: sorted(r["product"] for r in df.collect())
    assert names(filters.daylight_filter(p, sun, only, day=True)) == ["b", "c"]
    assert names(filters.daylight_filter(p, sun, only, day=False, fraction=0.99)) == ["b", "c"]
    assert names(filters.daylight_filter(p, sun, only, day=True, fraction=False)) == ["a", "b", "c"]
    assert names(filters.daylight_filter(p, sun, only.limit(0), day=True)) == ["a", "b", "c"]


def test_antimeridian_bounds(spark):
    pts = spark.createDataFrame([(179.5, 10.0), (-179.0, 11.0), (None, None), (178.0, 12.0)], "lon double, lat double")
    r = grids.swath_bounds(pts).first()
    assert (r["lon_min"], r["lon_max"], r["lat_min"], r["lat_max"]) == (178.0, -179.0, 10.0, 12.0)
    pole = pts.unionByName(spark.createDataFrame([(0.0, 89.95)], "lon double, lat double"))
    assert grids.swath_bounds(pole).first()["lon_min"] == -179.0


def test_resampling_decisions(spark):
    rules = tables.builtin_resampling_rules(spark)
    cols = "product string, name string, reader string, sensor array<string>, area_type string"
    p = spark.createDataFrame([("I01", "I01", "viirs_sdr", ["viirs"], "swath"), ("1", "1", "avhrr", ["avhrr"], "swath"), ("T4", "T4", "fires", ["viirs"], "swath"), ("C01", "C01", "abi", ["abi"], "area"), ("x", "x", "y", ["z"], "point")], cols)
    got = {r["product"]: (r["rule_id"], r["resampler"], r["kwargs"]) for r in decide.decide(p, rules).collect()}
    assert got["I01"] == ("default_viirs_sdr", "ewa", {"weight_delta_max": "40.0", "weight_distance_max": "2.0"})
    assert got["1"][2] == {"weight_delta_max": "10.0", "weight_distance_max": "1.0", "rows_per_scan": "0"}
    assert got["T4"][:2] == ("default_viirs_fire_T4", "nearest") and got["C01"][0] == "default_area"
    assert got["x"][0] is None


def test_constant_field_stays_constant(spark):
    px = spark.range(400).select(F.floor(F.col("id") / 20).cast("int").alias("y"), (F.col("id") % 20).cast("int").alias("x"), F.lit(7.5).alias("value"))
    placed = px.withColumn("lon", F.col("x") * 0.1).withColumn("lat", F.col("y") * -0.1)
    w = resample.ewa_weights(resample.swath_cells(placed, {"proj": "longlat"}, 0.0, 0.0, 0.07, 0.07), 25, 25, rows_per_scan=10)
    for mode in (True, False):
        got = resample.resample_ewa(px, w, maximum_weight=mode)
        assert got.count() > 500 and got.where(F.abs(F.col("value") - 7.5) > 1e-9).count() == 0


def test_grouped_store_replaces_and_keeps(spark, tmp_path):
    path = str(tmp_path / "store")
    one = spark.createDataFrame([("g", "a", 0, 0, 1.0), ("g", "b", 0, 0, 2.0)], "area_id string, product string, row int, col int, value double")
    sinks.write_grouped(one, path)
    sinks.write_grouped(one.where("product = 'a'").withColumn("value", F.lit(9.0)), path, append=True)
    assert {(r["product"], r["value"]) for r in spark.read.parquet(path).collect()} == {("a", 9.0), ("b", 2.0)}
    sinks.write_grouped(one.where("product = 'a'"), path)
    assert spark.read.parquet(path).count() == 1


def test_tiles_and_several_sinks(spark, tmp_path):
    t = spark.createDataFrame([(1, 1.0), (2, None)], "tile int, value double")
    sinks.multi_write(t, [lambda df: sinks.write_tiles(df, str(tmp_path / "t")), lambda df: df.write.parquet(str(tmp_path / "u"))])
    assert [r["tile"] for r in spark.read.parquet(str(tmp_path / "t")).collect()] == [1]
    assert spark.read.parquet(str(tmp_path / "u")).count() == 2


def test_flat_binary_there_and_back(spark, tmp_path):
    a = np.arange(60 * 7, dtype=np.float32).reshape(60, 7)
    path = str(tmp_path / "a.bin")
    a.tofile(path)
    df = flat_binary.read_flat_binary(spark, path, 60, 7)
    assert df.count() == 420 and df.agg(F.sum("value")).first()[0] == a.sum()
    blocks = flat_binary.to_flat_blocks(df.withColumnsRenamed({"y": "row", "x": "col"}), 7, block_rows=16).orderBy("block").collect()
    assert b"".join(bytes(b["data"]) for b in blocks) == a.tobytes()


def test_colormap_file(spark, tmp_path):
    (tmp_path / "x.cmap").write_text("# head\n0, 0, 0, 0\n\n 127 , 10, 20, 30, 40 # tail\n")
    got = tables.read_colormap(spark, str(tmp_path / "x.cmap")).collect()
    assert [tuple(r) for r in got] == [("x", 0.0, 0.0, 0.0, 0.0, 255.0), ("x", 127.0, 10.0, 20.0, 30.0, 40.0)]


def test_builtin_tables(spark):
    assert tables.builtin_grid_table(spark).count() == 55
    assert tables.builtin_grid_table(spark).where(grids.is_static() | F.col("ul_lon").isNotNull() | F.col("x_min").isNotNull()).count() == 22
    assert tables.builtin_resampling_rules(spark).count() == 40


def test_names_and_recipes(spark):
    c = products.output_name("{a!l}_{n:03d}.bin", {"a": F.lit("ABC"), "n": F.lit(7)})
    assert spark.range(1).select(c).first()[0] == "abc_007.bin"
    loop = {"p": composites.Recipe("p", ("q",), lambda q: q), "q": composites.Recipe("q", ("p",), lambda p: p), "r": composites.Recipe("r", ("v1",), lambda v: v)}
    assert composites.available_recipes(spark, ["v1"], loop) == ["r"]


def test_streams(spark, tmp_path):
    src, store = str(tmp_path / "in"), str(tmp_path / "store")
    schema = "area_id string, product string, row int, col int, value double"
    spark.createDataFrame([("g", "a", 0, 0, 1.0)], schema).write.parquet(src)
    arrivals.append_passes(arrivals.read_arrivals(spark, src, schema), store, str(tmp_path / "c")).awaitTermination(120)
    assert spark.read.parquet(store).count() == 1
    timed = spark.createDataFrame([("a", 1.0, "2024-01-01 00:10:00"), ("a", None, "2024-01-01 00:20:00")], "product string, value double, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    r = arrivals.valid_counts(timed).first()
    assert (r["n_valid"], r["n"]) == (1, 2)
