"""The adaptive nearest index against brute force and against the voxel index."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from geogrid.operators import nearest, resample


def unit(lon, lat):
    a, b = np.radians(lon), np.radians(lat)
    return np.stack([np.cos(b) * np.cos(a), np.cos(b) * np.sin(a), np.sin(b)], axis=1)


def plain(cells, pixels, radius):
    p, s = unit(cells[:, 2], cells[:, 3]), unit(pixels[:, 2], pixels[:, 3])
    order = np.lexsort((pixels[:, 1], pixels[:, 0]))
    out = {}
    for i in range(0, len(p), 500):
        d2 = sum((p[i : i + 500, None, k] - s[None, order, k]) ** 2 for k in range(3))
        best = d2.argmin(axis=1)
        for j, b in enumerate(best):
            d = np.sqrt(d2[j, b]) * 6370997.0
            if d <= radius:
                out[int(cells[i + j, 0]), int(cells[i + j, 1])] = (int(pixels[order[b], 0]), int(pixels[order[b], 1]), d)
    return out


def frame(spark, points, names):
    kinds = f"{names[0]} int, {names[1]} int, lon double, lat double"
    return spark.createDataFrame([(int(a), int(b), None if np.isnan(c) else float(c), float(d)) for a, b, c, d in points], kinds)


def scattered(seed, n, place):
    rng = np.random.default_rng(seed)
    lon, lat = place(rng, n)
    return np.stack([np.arange(n) // 97, np.arange(n) % 97, lon, lat], axis=1)


def two_densities(rng, n):
    dense = n * 9 // 10
    lon = np.concatenate([rng.uniform(10, 10.4, dense), rng.uniform(0, 13, n - dense)])
    lat = np.concatenate([rng.uniform(50, 50.3, dense), rng.uniform(45, 55, n - dense)])
    return lon, lat


@pytest.mark.parametrize(("radius", "full"), [(40000.0, 16), (40000.0, 200), (1500.0, 16), (3e6, 40)])
def test_changing_density(spark, radius, full):
    pixels = scattered(1, 4000, two_densities)
    cells = scattered(2, 3000, lambda rng, n: (rng.uniform(-1, 14, n), rng.uniform(44.5, 55.5, n)))
    cells[::3, 2:] = scattered(3, 1000, lambda rng, n: (rng.uniform(9.8, 10.6, n), rng.uniform(49.9, 50.4, n)))[:, 2:]
    pixels[5, 2] = cells[7, 2] = np.nan
    got = nearest.nearest_adaptive(frame(spark, cells, ("row", "col")), frame(spark, pixels, ("y", "x")), radius, full=full).collect()
    known = plain(cells[~np.isnan(cells[:, 2])], pixels[~np.isnan(pixels[:, 2])], radius)
    assert {(r["row"], r["col"]): (r["y"], r["x"]) for r in got} == {k: v[:2] for k, v in known.items()}
    assert all(abs(r["distance"] - known[r["row"], r["col"]][2]) < 1e-6 for r in got)


def test_poles_dateline_and_copies(spark):
    around = lambda rng, n: (np.concatenate([rng.uniform(-180, 180, n // 2), rng.choice([179.99, -179.99, 180.0, 0.0], n - n // 2)]), np.concatenate([rng.choice([89.9, 89.99, -89.95, 90.0], n // 2), rng.uniform(-60, 60, n - n // 2)]))
    pixels, cells = scattered(4, 1500, around), scattered(5, 900, around)
    pixels[:300, 2:] = pixels[0, 2:]
    got = nearest.nearest_adaptive(frame(spark, cells, ("row", "col")), frame(spark, pixels, ("y", "x")), 2e5, full=8).collect()
    known = plain(cells, pixels, 2e5)
    assert {(r["row"], r["col"]): round(r["distance"], 5) for r in got} == {k: round(v[2], 5) for k, v in known.items()}
    first = [r for r in got if (r["y"], r["x"]) in {(i // 97, i % 97) for i in range(1, 300)}]
    assert not first  # of equal places the lowest y, x is named


def test_carried_columns_and_empty_tables(spark):
    pixels, cells = frame(spark, scattered(6, 500, two_densities), ("y", "x")), frame(spark, scattered(7, 300, two_densities), ("row", "col"))
    pixels = pixels.withColumn("value", F.col("y") * 100.0 + F.col("x")).withColumn("name", F.concat(F.lit("n"), "x"))
    want = resample.nearest_index(cells, pixels, 30000.0, carry=("value", "name")).collect()
    got = nearest.nearest_adaptive(cells, pixels, 30000.0, carry=("value", "name"), full=20).select(*want[0].__fields__).collect()
    near = lambda rows: sorted((r["row"], r["col"], r["y"], r["x"], r["value"], r["name"], round(r["distance"], 4)) for r in rows)
    assert near(got) == near(want) and len(got) > 200
    assert nearest.nearest_adaptive(cells, pixels.limit(0), 1000.0).collect() == []
    assert nearest.nearest_adaptive(cells.limit(0), pixels, 1000.0).collect() == []


def test_no_leaf_is_crowded(spark):
    pixels, cells = frame(spark, scattered(8, 6000, two_densities), ("y", "x")), frame(spark, scattered(9, 2000, two_densities), ("row", "col"))
    placed = nearest._placed(pixels).select("cell", F.lit(False).alias("target")).unionByName(nearest._placed(cells).select("cell", F.lit(True).alias("target")))
    tables = nearest.leaves(placed, 50)
    sizes = nearest._in_leaves(placed, tables).groupBy("leaf").agg(F.count_if("target").alias("t"), F.count_if(~F.col("target")).alias("s"), F.count("*").alias("n")).collect()
    assert sum(r["n"] for r in sizes) == 8000 and max(max(r["t"], r["s"]) for r in sizes) <= 50
    assert len(tables) > 1 and len({len(bin(r["leaf"])) for r in sizes}) > 3
