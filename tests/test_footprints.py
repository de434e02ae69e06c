"""Coverage and daylight by spherical area."""

from __future__ import annotations

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from geogrid.functions import spherical
from geogrid.operators import filters, footprints


def inside(ring, points):
    """Whether points are in a ring of less than a hemisphere: by the angles that its edges take up."""
    out = np.zeros(len(points))
    for a, b in zip(ring, np.roll(ring, -1, axis=0), strict=True):
        pa, pb = np.cross(points, a), np.cross(points, b)
        out += np.arctan2((np.cross(pa, pb) * points).sum(axis=1), (pa * pb).sum(axis=1))
    return (np.abs(out) > np.pi) & (points @ spherical.middle(ring) > 0)


def sampled(n=60000):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(n, 3))
    return v / np.linalg.norm(v, axis=1)[:, None]


def box(w, s, e, n, k=1):
    t = np.arange(k) / k
    lon = np.concatenate([w + (e - w) * t, np.full(k, e), e - (e - w) * t, np.full(k, w)])
    lat = np.concatenate([np.full(k, n), n - (n - s) * t, np.full(k, s), s + (n - s) * t])
    return spherical.vectors(lon, lat)


def test_areas_of_known_rings():
    octant = spherical.vectors([0, 90, 0], [0, 0, 90])
    assert spherical.area(octant) == pytest.approx(np.pi / 2)
    fine = box(-10, 20, 30, 60, 400)
    assert spherical.area(fine) == pytest.approx(np.radians(40) * (np.sin(np.radians(60)) - np.sin(np.radians(20))), rel=1e-5)
    half = spherical.vectors(np.arange(0, 360, 10), np.zeros(36))
    assert spherical.area(half) == pytest.approx(2 * np.pi)
    assert spherical.area(spherical.vectors([1, 2], [3, 4])) == 0


def test_overlaps_against_sampling():
    points = sampled()
    rings = [box(-10, 20, 30, 60, 5), box(170, -20, 200, 40, 3), box(5, 50, 80, 85, 6), box(-170, -80, 60, -40, 9)]
    star = np.where(np.arange(24) % 2, 25, 9)
    rings.append(spherical.vectors(20 + star * np.cos(np.arange(24) * np.pi / 12), 45 + star * np.sin(np.arange(24) * np.pi / 12)))
    rings.append(spherical.vectors(185 + star * np.sin(np.arange(24) * np.pi / 12), star * np.cos(np.arange(24) * np.pi / 12)))
    for a in rings:
        held = inside(a, points)
        for b in rings:
            want = (held & inside(b, points)).mean() * 4 * np.pi
            assert spherical.overlap(a, b) == pytest.approx(want, abs=0.02)
            assert spherical.overlap(a, b) == pytest.approx(spherical.overlap(b[::-1], a), abs=1e-9)
        assert spherical.overlap(a, a) == pytest.approx(spherical.area(a), rel=1e-9)
    assert spherical.overlap(box(0, 0, 10, 10), box(20, 0, 30, 10)) == 0


def raster(spark, name, lon, lat, shape, missing=None):
    """A swath of ``shape`` over functions of the shares down and across."""
    h, w = shape
    v, u = F.col("id").cast("double"), F.lit(0)
    v, u = F.floor(F.col("id") / w) / (h - 1), F.col("id") % w / (w - 1)
    df = spark.range(h * w).select(F.lit(name).alias("product"), F.floor(F.col("id") / w).cast("int").alias("y"), (F.col("id") % w).cast("int").alias("x"), lon(v, u).alias("lon"), lat(v, u).alias("lat"))
    return df if missing is None else df.withColumn("lon", F.when(~missing, F.col("lon")))


@pytest.mark.parametrize("shape", [(6, 5), (31, 40), (301, 200)])
def test_coverage_does_not_depend_on_spacing(spark, shape):
    whole = raster(spark, "whole", lambda v, u: u * 20 - 100, lambda v, u: v * -15 + 50, shape)
    half = raster(spark, "half", lambda v, u: u * 20 - 90, lambda v, u: v * -15 + 50, shape)
    away = raster(spark, "away", lambda v, u: u * 20 + 80, lambda v, u: v * -15 + 50, shape)
    torn = raster(spark, "torn", lambda v, u: u * 24 - 102, lambda v, u: v * -19 + 52, shape, (F.col("y") == 0) | (F.col("x") == 0))
    outlines = footprints.swath_outlines(whole.unionByName(half).unionByName(away).unionByName(torn), "product")
    grid = footprints.grid_outline(spark, "box", {"proj": "longlat"}, -100.0, 35.0, -80.0, 50.0)
    covered = footprints.coverage_by_area(outlines, grid)
    got = {r["product"]: r["coverage"] for r in covered.collect()}
    assert got["whole"] == pytest.approx(1, abs=0.004) and got["half"] == pytest.approx(0.5, abs=0.004)
    assert got["away"] == 0 and got["torn"] > (0.999 if shape[0] > 50 else 0.7)
    products = spark.createDataFrame([(n, None, False) for n in got], "product string, grid_coverage double, skip boolean")
    kept = filters.coverage_filter(products, covered.select("product", "coverage"))
    assert {r["product"] for r in kept.collect()} == {"whole", "half", "torn"}


def test_equal_outlines_and_projected_grids(spark):
    lcc = {"proj": "lcc", "lat_0": 25, "lat_1": 25, "lon_0": -95, "a": 6371200, "b": 6371200}
    polar = {"proj": "stere", "lat_0": 90, "lat_ts": 60, "lon_0": -150, "ellps": "WGS84"}
    disk = {"proj": "geos", "h": 35785831.0, "lon_0": -75, "a": 6378137.0, "b": 6356752.31414, "sweep": "x"}
    args = [("lcc", lcc, -2e6, -1e6, 2e6, 2e6), ("polar", polar, -3e6, -3e6, 3e6, 3e6), ("disk", disk, -5434894.885, -5434894.885, 5434894.885, 5434894.885)]
    grids = None
    for a in args:
        one = footprints.grid_outline(spark, *a)
        grids = one if grids is None else grids.unionByName(one)
    same = grids.select(F.col("area_id").alias("product"), "lons", "lats")
    got = {(r["product"], r["area_id"]): r["coverage"] for r in footprints.coverage_by_area(same, grids).collect()}
    assert all(got[n, n] == pytest.approx(1, abs=1e-9) for n in ("lcc", "polar", "disk"))
    assert got["polar", "lcc"] == 0 and got["disk", "lcc"] == pytest.approx(1, abs=1e-6) and 0 < got["lcc", "disk"] < 0.2
    (rim,) = grids.where("area_id = 'disk'").collect()
    share = spherical.area(spherical.vectors(rim["lons"], rim["lats"])) / (4 * np.pi)
    assert share == pytest.approx((1 - np.cos(np.radians(81.3))) / 2, abs=0.01)


def test_daylight_of_an_atlantic_granule(spark):
    """The granule of the reference's tests is a little over half and under 95 % in daylight, about 0.8."""
    swath = raster(spark, "I01", lambda v, u: (u * -20 - 45) * (v * 0.2 + 0.9), lambda v, u: (v * 30 + 25) * (u * 0.2 + 0.9), (96, 100))
    gaps = raster(spark, "gaps", lambda v, u: (u * -20 - 45) * (v * 0.2 + 0.9), lambda v, u: (v * 30 + 25) * (u * 0.2 + 0.9), (96, 100), (F.col("y") < 96) & (F.col("x") == 99))
    night = raster(spark, "night", lambda v, u: u * 10 + 170, lambda v, u: v * 10, (20, 20))
    dusk = raster(spark, "dusk", lambda v, u: u - 87, lambda v, u: v * 1 + 10, (20, 20))
    day = raster(spark, "day", lambda v, u: u * 10, lambda v, u: v * 10, (20, 20))
    line = raster(spark, "line", lambda v, u: u * 10, lambda v, u: u * 10, (2, 20)).where("y = 0")
    noon = datetime.datetime(2021, 1, 1, 12)
    rows = swath
    for other in (gaps, night, dusk, day, line):
        rows = rows.unionByName(other)
    outlines = footprints.swath_outlines(rows, "product").withColumn("time", F.lit(noon).cast("timestamp_ntz"))
    got = {r["product"]: r["sunlit"] for r in footprints.sunlit_by_area(outlines).collect()}
    assert 0.75 < got["I01"] < 0.85 and got["gaps"] == pytest.approx(got["I01"], abs=0.02)
    assert got["night"] == 0 and got["day"] == pytest.approx(1) and got["dusk"] == 1 and got["line"] is None
    hard = {r["product"]: r["sunlit"] for r in footprints.sunlit_by_area(outlines, limit=90.0).collect()}
    assert hard["dusk"] == 0 and hard["I01"] == got["I01"]
    products = spark.createDataFrame([(n,) for n in got], "product string")
    lit = footprints.sunlit_by_area(outlines)
    kept = lambda **k: sorted(r["product"] for r in filters.daylight_filter(products, lit, True, **k).collect())
    assert kept(day=True, fraction=0.95) == ["day", "dusk", "line"] and kept(day=False, fraction=0.5) == ["line", "night"]
    assert footprints.swath_outlines(swath.where("lon is null"), "product").count() == 0
