"""Known points, and there and back again."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from geogrid.functions import projections as P
from geogrid.plans.queries import QUERIES
from geogrid.plans.views import swath
from geogrid.sources.builtin_grids import grid_rows, parse_projection

#: Centre of the upper-left cell, cell size, and the outer corner of the same grid.
CORNERS = [
    ("211e", -123.044, 59.844, 1015.9),
    ("203", 115.601, 44.646, 1000.0),
    ("204", 110.0, 60.644, 1038.964),
    ("210", -77.0, 26.422, 1041.66),
]


@pytest.mark.parametrize("name,lon,lat,cell", CORNERS)
def test_two_descriptions_of_a_grid_meet(spark, name, lon, lat, cell):
    grid = next(g for g in grid_rows() if g["area_id"] == name)
    p = parse_projection(grid["proj"])
    one = spark.range(1)
    center = P.forward(p, F.lit(lon), F.lit(lat))
    corner = P.forward(p, F.lit(grid["ul_lon"]), F.lit(grid["ul_lat"]))
    r = one.select((center[0] - cell / 2 - corner[0]).alias("dx"), (center[1] + cell / 2 - corner[1]).alias("dy")).first()
    assert abs(r["dx"]) < 1e-3 and abs(r["dy"]) < 1e-3


PROJECTIONS = [
    "proj=longlat",
    "proj=lcc lat_1=25 lat_0=25 lon_0=-95 datum=WGS84",
    "proj=lcc lat_1=-25 lat_0=-25 lon_0=-55 datum=WGS84",
    "proj=lcc lat_1=33 lat_2=45 lat_0=39 lon_0=-96 ellps=GRS80",
    "proj=stere lat_0=90 lat_ts=45 lon_0=-150 datum=WGS84",
    "proj=stere lat_0=-90 lat_ts=-45 lon_0=-170 datum=WGS84",
    "proj=stere lat_0=90 lat_ts=90 lon_0=0 datum=WGS84",
    "proj=merc lon_0=-95 datum=WGS84",
    "proj=eqc lat_ts=20 lon_0=10 R=6371200",
]


@pytest.mark.parametrize("text", PROJECTIONS)
def test_round_trip(spark, text):
    p = parse_projection(text)
    south = "lat_0=-" in text
    df = spark.range(400).select((F.col("id") % 20 * 17.0 - 170).alias("lon"), ((F.floor(F.col("id") / 20) * 4.0 + 2) * (-1 if south else 1)).alias("lat"))
    lon, lat = P.inverse(p, *P.forward(p, F.col("lon"), F.col("lat")))
    worst = df.select(F.max(F.abs(P.wrap_lon(lon - F.col("lon")))).alias("a"), F.max(F.abs(lat - F.col("lat"))).alias("b")).first()
    assert worst["a"] < 1e-7 and worst["b"] < 1e-7


@pytest.mark.parametrize("sweep", ["x", "y"])
def test_geos_sees_half_the_earth(spark, sweep):
    p = parse_projection(f"proj=geos sweep={sweep} lon_0=-75 h=35786023 ellps=GRS80")
    df = spark.range(36 * 17).select((F.col("id") % 36 * 10.0 - 180).alias("lon"), (F.floor(F.col("id") / 36) * 10.0 - 80).alias("lat"))
    x, y = P.forward(p, F.col("lon"), F.col("lat"))
    lon, lat = P.inverse(p, x, y)
    r = df.select(x.isNull().alias("off"), (F.abs(P.wrap_lon(lon - F.col("lon"))) + F.abs(lat - F.col("lat"))).alias("e"), "lon", "lat").collect()
    seen = [q for q in r if not q["off"]]
    assert max(q["e"] for q in seen) < 1e-6
    assert {q["off"] for q in r if q["lon"] == -70 and abs(q["lat"]) < 60} == {False}
    assert all(q["off"] for q in r if q["lon"] in (100, 110))


def test_null_in_null_out(spark):
    for text in PROJECTIONS:
        x, y = P.forward(parse_projection(text), F.lit(None).cast("double"), F.lit(None).cast("double"))
        assert tuple(spark.range(1).select(x, y).first()) == (None, None)


def test_round_trip_of_passes_all_around(spark, tmp_path):
    """Passes far east of the first satellite's disk come back too."""
    events = spark.range(23 * 60).selectExpr("id div 60 * 60000 + id % 60 * 997 as event_id", "1.0D as value", "'view' as event_type", "timestamp_ntz'2024-01-01' as ts")
    events.write.parquet(str(tmp_path / "events.parquet"))
    want = {(e["y"], e["x"]): (round(e["lon"], 6), round(e["lat"], 6)) for e in swath(spark, str(tmp_path)).collect()}
    got = {(e["y"], e["x"]): (e["lon"], e["lat"]) for e in QUERIES["p6_geos_round_trip"](spark, str(tmp_path)).collect()}
    assert got == want and len(got) == 23 * 60


def test_a_satellite_sees_each_place(spark):
    places = spark.range(0, 360, 3).selectExpr("id - 180.0D lon").crossJoin(spark.range(0, 121, 15).selectExpr("id - 60.0D lat"))
    place = {"proj": "geos", "h": 35786023.0, "ellps": "GRS80", "lon_0": P.nearest_satellite(F.col("lon"))}
    x, y = P.forward(place, F.col("lon"), F.col("lat"))
    assert places.where(x.isNull() | y.isNull()).count() == 0
