"""Outlines of swaths and grids as spherical polygons; coverage and daylight as shares of area.

An outline is two arrays, ``lons`` and ``lats``, of a bounded number of corners, so a polygon is one small row however many
pixels its swath has. Great circles join the corners.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from geogrid.functions import spherical
from geogrid.functions.astronomy import gmst, sun_ra_dec, sun_zenith
from geogrid.functions.projections import inverse

#: Corners on each side of an outline, one more at its end.
CORNERS = 24
#: Outlines of less area (steradians; some 40 square metres) are lines.
LEAST_AREA = 1e-12
#: Steps by which an outline is drawn back onto the disk that a geostationary instrument sees, and each of them again.
DRAW_BACK = 400


def _part(value: Column, low: Column, high: Column, parts: int) -> Column:
    return F.floor((value - low) * parts / (high - low + 1))


def swath_outlines(swath: DataFrame, by: str, corners: int = CORNERS) -> DataFrame:
    """(by, lons, lats, lon_0, lat_0): the outline of each swath of pixels (y, x, lon, lat) and its first pixel.

    The outline runs along the first row with geolocation, down the last such pixel of some ``corners`` rows and the last row,
    back along that row and up the first pixels: rows, pixels and edges without geolocation are passed over. Swaths without
    any have no row. Two sums by row and by swath are all that is shuffled.
    """
    here = swath.where("lon is not null and lat is not null and not isnan(lon) and not isnan(lat)").select(by, "y", "x", "lon", "lat")
    point = F.struct("lon", "lat")
    rows = here.groupBy(by, "y").agg(F.min_by(point, "x").alias("left"), F.max_by(point, "x").alias("right"), F.min("x").alias("x0"), F.max("x").alias("x1"))
    ends = rows.groupBy(by).agg(F.min("y").alias("y0"), F.max("y").alias("y1"), F.min_by("left", "y").alias("corner"), *[f(c, "y").alias(f"{c}_{n}") for n, f in (("top", F.min_by), ("bottom", F.max_by)) for c in ("x0", "x1")])
    sided = rows.join(ends.select(by, "y0", "y1"), by)
    sided = sided.groupBy(by, F.when(F.col("y") == F.col("y1"), corners).otherwise(_part(F.col("y"), F.col("y0"), F.col("y1"), corners)).alias("part")).agg(*[F.min_by(c, "y").alias(c) for c in ("left", "right")])
    sides = sided.groupBy(by).agg(*[F.sort_array(F.collect_list(F.struct("part", c))).alias(c) for c in ("left", "right")])
    level = here.join(ends, by).where("y = y0 or y = y1")
    top = F.col("y") == F.col("y0")
    low, high = (F.when(top, F.col(f"{c}_top")).otherwise(F.col(f"{c}_bottom")) for c in ("x0", "x1"))
    part = F.when(F.col("x") == high, corners).otherwise(_part(F.col("x"), low, high, corners))
    level = level.groupBy(by, "y", "y0", part.alias("part")).agg(F.min_by(point, "x").alias("p"))
    chosen = lambda which: F.sort_array(F.collect_list(F.when(which, F.struct("part", "p"))))
    levels = level.groupBy(by).agg(chosen(F.col("y") == F.col("y0")).alias("top"), chosen(F.col("y") != F.col("y0")).alias("bottom"))
    bottom = F.when(F.size("bottom") > 0, F.col("bottom.p")).otherwise(F.col("top.p"))  # a single row goes back on itself
    points = F.concat("top.p", "right.right", F.reverse(bottom), F.reverse("left.left"))
    ring = sides.join(levels, by).join(ends.select(by, "corner"), by).withColumn("ring", points)
    return ring.select(by, F.col("ring.lon").alias("lons"), F.col("ring.lat").alias("lats"), F.col("corner.lon").alias("lon_0"), F.col("corner.lat").alias("lat_0"))


def grid_outline(spark: SparkSession, area_id: str, p: Mapping, x_min: float, y_min: float, x_max: float, y_max: float, corners: int = CORNERS) -> DataFrame:
    """(area_id, lons, lats) of a grid's outer edges; where they leave the disk that is seen, its rim."""
    k = F.col("id") % corners / corners
    side = F.floor(F.col("id") / corners)
    x = F.when(side == 0, F.lit(x_min) + k * (x_max - x_min)).when(side == 1, x_max).when(side == 2, F.lit(x_max) - k * (x_max - x_min)).otherwise(x_min)
    y = F.when(side == 0, y_max).when(side == 1, F.lit(y_max) - k * (y_max - y_min)).when(side == 2, y_min).otherwise(F.lit(y_min) + k * (y_max - y_min))
    edge = spark.range(4 * corners).select("id", x.alias("x"), y.alias("y"), F.lit(0.0).alias("low"))
    mid, step, lonlat = ((x_min + x_max) / 2, (y_min + y_max) / 2), 1.0, F.struct("lon", "lat")
    for _ in range(2 if p.get("proj") == "geos" else 0):
        # the first of ever finer steps towards the middle that lands on the disk
        tried = edge.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(DRAW_BACK)))).withColumn("back", F.col("low") + F.col("n") * (step / DRAW_BACK))
        lon, lat = inverse(p, *(m + (F.col(c) - m) * (1 - F.col("back")) for m, c in zip(mid, "xy", strict=True)))
        step /= DRAW_BACK
        edge = tried.where(lon.isNotNull() & lat.isNotNull()).groupBy("id", "x", "y").agg(F.greatest(F.min("back") - step, F.lit(0.0)).alias("low"), F.min("back").alias("back"))
    back = 1 - (F.col("back") if "back" in edge.columns else F.lit(0.0))
    lon, lat = inverse(p, *(m + (F.col(c) - m) * back for m, c in zip(mid, "xy", strict=True)))
    seen = edge.select("id", lon.alias("lon"), lat.alias("lat")).where("lon is not null and lat is not null").select("id", lonlat.alias("p"))
    ring = seen.agg(F.sort_array(F.collect_list(F.struct("id", "p"))).alias("ring"))
    return ring.select(F.lit(area_id).alias("area_id"), F.col("ring.p.lon").alias("lons"), F.col("ring.p.lat").alias("lats"))


@pandas_udf(DoubleType())
def covered_share(lons: pd.Series, lats: pd.Series, target_lons: pd.Series, target_lats: pd.Series) -> pd.Series:
    """The share of a target outline's area that another outline holds."""
    out = []
    for a, b, c, d in zip(lons, lats, target_lons, target_lats, strict=True):
        target = spherical.vectors(c, d)
        whole = spherical.area(target)
        out.append(min(1.0, spherical.overlap(spherical.vectors(a, b), target) / whole) if whole > LEAST_AREA else 0.0)
    return pd.Series(out, dtype=float)


@pandas_udf(DoubleType())
def _lit_share(lons: pd.Series, lats: pd.Series, sun_lon: pd.Series, sun_lat: pd.Series) -> pd.Series:
    out = []
    for a, b, lon, lat in zip(lons, lats, sun_lon, sun_lat, strict=True):
        ring = spherical.vectors(a, b)
        whole = spherical.area(ring)
        sun = spherical.vectors([lon], [lat], keep_all=True)[0]
        part = abs(spherical.signed_area(spherical.clip(ring, sun), spherical.middle(ring))) if whole > LEAST_AREA else 0.0
        out.append(min(1.0, part / whole) if whole > LEAST_AREA else np.nan)
    return pd.Series(out, dtype=float)


def coverage_by_area(outlines: DataFrame, targets: DataFrame, by: str = "product") -> DataFrame:
    """(by, area_id, coverage): the share of each target grid's area that each swath's outline covers.

    Equal outlines give 1, disjoint ones 0, whatever the distance between pixels.
    """
    pairs = outlines.select(by, "lons", "lats").crossJoin(F.broadcast(targets.select("area_id", F.col("lons").alias("t_lons"), F.col("lats").alias("t_lats"))))
    return pairs.select(by, "area_id", covered_share("lons", "lats", "t_lons", "t_lats").alias("coverage"))


def sunlit_by_area(outlines: DataFrame, time: str = "time", by: str = "product", limit: float = 100.0) -> DataFrame:
    """(by, sunlit): the share of each outline's area where the sun is up at ``time``.

    An outline wholly in the dark counts as lit where the sun's zenith angle at its first pixel is below ``limit`` (twilight).
    Outlines without area have null.
    """
    ra, dec = sun_ra_dec(F.col(time))
    share = F.nanvl(_lit_share("lons", "lats", F.degrees(ra - gmst(F.col(time))), F.degrees(dec)), F.lit(None).cast("double"))
    near = sun_zenith(F.col(time), F.col("lon_0"), F.col("lat_0")) < limit
    return outlines.withColumn("share", share).select(by, F.when(F.col("share") > 0, F.col("share")).when(F.col("share") == 0, near.cast("double")).alias("sunlit"))
