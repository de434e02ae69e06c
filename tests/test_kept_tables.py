"""Tables that are kept, levels made from levels, quantiles of groups, filters over neighbourhoods."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from geogrid.operators import compare, composites, resample, tiles
from geogrid.plans.queries import QUERIES
from geogrid.sources import band_store
from geogrid.sources.shared import subfolders
from geogrid.streaming import arrivals


def test_kept_index_is_looked_up(spark, tmp_path):
    swath = spark.range(400).selectExpr("cast(id div 20 as int) y", "cast(id % 20 as int) x", "id % 20 * 0.1 lon", "id div 20 * 0.1 lat", "id * 1.0 value")
    cells = spark.range(300).selectExpr("cast(id div 20 as int) row", "cast(id % 20 as int) col", "id % 20 * 0.09 + 0.01 lon", "id div 20 * 0.12 lat")
    path = str(tmp_path / "index")
    want = sorted(map(tuple, resample.nearest_index(cells, swath, 9000.0).collect()))
    first = resample.kept_nearest_index(path, cells, swath, 9000.0)
    again = resample.kept_nearest_index(path, cells.repartition(5), swath.repartition(3).drop("value"), 9000.0)
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and len(subfolders(spark, path)) == 1
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect())) == want
    moved = resample.kept_nearest_index(path, cells, swath.withColumn("lon", F.col("lon") + 0.02), 9000.0)
    assert len(subfolders(spark, path)) == 2 and sorted(map(tuple, moved.collect())) != want
    resample.kept_nearest_index(path, cells, swath, 8000.0)
    assert len(subfolders(spark, path)) == 3


def test_nearest_pixels_are_sent_nowhere_whole(spark, tmp_path):
    made = spark.range(400).selectExpr("cast(id div 20 as int) y", "cast(id % 20 as int) x", "id % 20 * 0.1D lon", "id div 20 * 0.1D lat", "id * 1.0D value")
    made.write.parquet(str(tmp_path / "swath"))
    swath = spark.read.parquet(str(tmp_path / "swath"))
    cells = swath.selectExpr("y row", "x col", "lon + 0.01D lon", "lat")
    outs = [resample.nearest_index(cells, swath, 9000.0), resample.nearest_index(cells, swath, 9000.0, spacing=4000.0), resample.resample_nearest(cells, swath, 9000.0)]
    for out in outs:
        assert len(out.collect()) == 400
        assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("method", ["average", "nearest"])
def test_cascade_equals_pyramid(spark, method):
    grid = spark.range(5000).selectExpr("cast(id div 71 as int) row", "cast(id % 71 as int) col", "if(id % 7 < 2, null, cast(id * 37 % 1001 as double)) value", "if(id % 2 = 0, 'a', 'b') k")
    factors = [2, 3, 4, 6, 8, 24]
    key = lambda r: (r["k"], r["factor"], r["row"], r["col"])
    want = {key(r): r["value"] for r in resample.pyramid(grid, factors, method, ("k",)).collect()}
    got = {key(r): r["value"] for r in resample.pyramid_cascade(grid, factors, method, ("k",)).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) if want[k] is not None else got[k] is None for k in want)


def test_quantiles_of_groups(spark):
    rng = np.random.default_rng(2)
    values = {"hot": np.round(rng.normal(0, 5, 4000), 1), "same": np.full(500, 7.25), "one": np.array([3.0]), "two": np.array([1.0, 2.0]), None: rng.uniform(0, 1, 37)}
    rows = [(g, i % 2, float(v)) for g, a in values.items() for i, v in enumerate(a)] + [("hot", 0, None), ("nan", 0, float("nan")), ("one", 0, float("nan")), ("empty", 1, None)]
    df = spark.createDataFrame(rows, "g string, h int, v double").repartition(7)
    shares = (0.0, 0.1, 0.25, 0.5, 0.77, 1.0)
    got = {(r["g"], r["share"]): (r["n"], r["quantile"]) for r in compare.grouped_quantiles(df, ("g",), "v", shares).collect()}
    assert got.keys() == {(g, q) for g in values for q in shares}
    for (g, q), (n, v) in got.items():
        assert n == len(values[g]) and v == pytest.approx(np.quantile(values[g], q), rel=1e-12)
    both = compare.grouped_quantiles(df, ("g", "h"), "v", (0.5,)).where("g = 'hot'").collect()
    assert {r["h"]: round(r["quantile"], 6) for r in both} == {h: round(float(np.median(values["hot"][h::2])), 6) for h in (0, 1)}
    assert compare.grouped_quantiles(df.limit(0), ("g",), "v", shares).collect() == []


@pytest.mark.parametrize("side", [3, 8, 64])
def test_neighbourhoods_across_tiles(spark, side):
    rng = np.random.default_rng(4)
    plane = rng.normal(size=(29, 37))
    plane[rng.random(plane.shape) < 0.1] = np.nan
    rows = [(k, int(r) - 5, int(c), None if np.isnan(v) else float(v)) for k in ("a", None) for (r, c), v in np.ndenumerate(plane) if (r + c) % 11]
    grid = spark.createDataFrame(rows, "k string, row int, col int, v double")

    def rough(v, w):
        out = np.full(v.shape, np.nan)
        for r in range(2, v.shape[0] - 2):
            for c in range(2, v.shape[1] - 2):
                part = v[r - 2 : r + 3, c - 2 : c + 3]
                if not np.isnan(part).all():
                    out[r, c] = np.nanmax(part) - np.nanmin(part) + 0 * np.nan_to_num(w[r, c])
        return out

    composites.register_surroundings("rough", ["v", "double"], rough, 2)
    composites.register_surroundings("needs_more", ["missing"], rough)
    doubled = grid.withColumn("double", F.col("v") * 2).withColumn("row", F.col("row").cast("long")).withColumn("col", F.col("col").cast("long"))
    got = composites.apply_surroundings(doubled, ["needs_more", "rough"], ("k",), side).where("k = 'a'").collect()
    held = {(r, c): v for k, r, c, v in rows if k == "a" and v is not None}
    for r in got:
        near = [held[a, b] for a in range(r["row"] - 2, r["row"] + 3) for b in range(r["col"] - 2, r["col"] + 3) if (a, b) in held]
        assert r["rough"] is None if not near else r["rough"] == pytest.approx(max(near) - min(near))
    assert len(got) == len(rows) // 2
    assert tiles.neighbourhood(grid.limit(0), lambda v: v, ("v",)).collect() == []


def test_store_is_compacted(spark, tmp_path):
    path, state = str(tmp_path / "store"), str(tmp_path / "state")

    def store(number, rows):
        df = spark.createDataFrame([("g", "p", r, c, v, number) for r, c, v in rows], "area_id string, product string, row int, col int, value double, batch_id long")
        df.write.partitionBy("area_id", "product", "batch_id").mode("append").parquet(path)

    def same():
        got = sorted(map(tuple, arrivals.compact_passes(spark, path, state).collect()))
        return got == sorted(map(tuple, arrivals.latest_pixels(spark, path).select("area_id", "product", "row", "col", "value").collect())) and got

    store(0, [(0, 0, 1.0), (0, 1, 2.0), (5, 5, None)])
    assert len(same()) == 2
    for n in range(1, 4):
        store(n, [(0, n, float(n)), (0, 0, None if n == 2 else 10.0 * n)])
        assert same() and subfolders(spark, state) == [f"upto={n}"]
    assert same()
    read = arrivals.compact_passes(spark, path, state)
    assert all("state" in f for f in read.inputFiles())


def test_stored_bands_meet_without_a_shuffle(spark):
    n = spark.range(3000)
    bands = {"": n.selectExpr("cast(id div 60 as int) y", "cast(id % 60 as int) x", "id * 0.01D lon", "id * 0.02D lat")}
    for k in range(5):
        bands[f"b{k}"] = n.where(f"id % {k + 7} <> 1").selectExpr("cast(id div 60 as int) y", "if(id = 5, null, cast(id % 60 as int)) x", f"if(id % 11 = 0, null, id * {k + 1.0}D) value")
    stored = band_store.new_store(spark, bands, buckets=5)
    joined = band_store.joined_bands(spark, stored)
    plan = joined.select("y", "x", (F.col("b0") - F.col("b4")).alias("d"), "lon")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 5
    want = {(i // 60, i % 60): [None if i % 11 == 0 else i * (k + 1.0) for k in range(5)] + [i * 0.01] for i in range(3000) if i != 5 and all(i % (k + 7) != 1 for k in range(5))}
    assert {(r["y"], r["x"]): [*(r[f"b{k}"] for k in range(5)), r["lon"]] for r in joined.collect()} == want
    band_store.store_band(bands["b0"].selectExpr("y", "x", "value + 1 as value"), stored["b0"], 5, path=None)
    assert band_store.joined_bands(spark, {"a": stored["b0"], "b": stored["b1"]}).where("a - 1 = b / 2").count() > 1000


def test_buckets_grow_with_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(band_store, "ROWS_A_BUCKET", 100, raising=False)
    lines = spark.range(4000).selectExpr("id div 4 as l_orderkey", "cast(id % 4 as int) as l_linenumber", "10.0D + id as l_extendedprice", "2.0D as l_quantity")
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    got = QUERIES["j1_j2_stored_bands"](spark, str(tmp_path))
    most = got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert got.rdd.getNumPartitions() == 40 and most <= 200
    want = {(i // 4, i % 4): (8.0 + i, round((1.0 + 8.0 + i) / 2, 6), round((6.0 + i / 2 - 10.0 - i) / (6.0 + i / 2 + 10.0 + i), 6)) for i in range(4000)}
    assert {(r["y"], r["x"]): (r["red"], r["green"], pytest.approx(r["blue"])) for r in got.collect()} == want
    stored = band_store.new_store(spark, {k: spark.range(n).selectExpr("id as y", "0 as x", "1.0D as value") for k, n in (("a", 9000), ("b", 500))})
    assert band_store.joined_bands(spark, stored).rdd.getNumPartitions() == 90
