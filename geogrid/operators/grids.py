"""Target grids: geometry, choice, freezing, bounds, cells."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geogrid.functions.projections import forward, lon_360


def extent_from_center(df: DataFrame) -> DataFrame:
    """Outer edges from the centre of the upper-left pixel (x0, y0), cell sizes (ch < 0) and counts."""
    x0, y0, cw, ch, w, h = (F.col(c) for c in ("x0", "y0", "cw", "ch", "width", "height"))
    return df.withColumns({"x_min": x0 - cw / 2, "y_min": y0 + ch * (h - 1) + ch / 2, "x_max": x0 + cw * (w - 1) + cw / 2, "y_max": y0 - ch / 2})


def corner_extent(grids: DataFrame, p: Mapping) -> DataFrame:
    """Extent of static grids of one projection from their upper-left corner in degrees."""
    x, y = forward(p, F.col("ul_lon"), F.col("ul_lat"))
    out = grids.withColumn("x_min", x).withColumn("y_max", y)
    return out.withColumn("x_max", F.col("x_min") + F.col("dx") * F.col("width")).withColumn("y_min", F.col("y_max") - F.col("dy") * F.col("height"))


def is_static() -> Column:
    """All six size, cell and origin fields are set."""
    out = F.lit(True)
    for c in ("width", "height", "dx", "dy", "x_min", "y_max"):
        out = out & F.col(c).isNotNull()
    return out


def resolve_grid(names: DataFrame, areas: DataFrame, yaml: DataFrame, legacy: DataFrame, builtin: DataFrame) -> DataFrame:
    """``area_id`` of each asked name: none; MAX (finest) or MIN (coarsest) of the scene; else the first of the
    user's, the legacy and the builtin grids that has the name."""
    finest = areas.agg(F.min_by("area_id", F.struct("dx", "area_id")).alias("id"))
    coarsest = areas.agg(F.max_by("area_id", F.struct("dx", "area_id")).alias("id"))
    special = finest.select(F.lit("MAX").alias("name"), F.col("id").alias("area_id"), F.lit(0).alias("priority"))
    special = special.unionByName(coarsest.select(F.lit("MIN").alias("name"), F.col("id").alias("area_id"), F.lit(0).alias("priority")))
    found = special
    for k, t in enumerate((yaml, legacy, builtin), 1):
        found = found.unionByName(t.select(F.col("area_id").alias("name"), "area_id", F.lit(k).alias("priority")))
    best = found.groupBy("name").agg(F.min_by("area_id", "priority").alias("area_id"), F.min("priority").alias("priority"))
    return names.join(best, "name", "left")


def swath_bounds(swath: DataFrame, by: str | None = None) -> DataFrame:
    """Bounds without missing geolocation; a span over 355 degrees off the poles means the antimeridian is
    crossed: longitudes are then taken modulo 360 and the east bound less 360."""
    lon, lat = F.col("lon"), F.col("lat")
    keys = [by] if by else []
    raw = swath.groupBy(*keys).agg(F.min(lon).alias("w"), F.max(lon).alias("e"), F.min(lat).alias("lat_min"), F.max(lat).alias("lat_max"), F.min(lon_360(lon)).alias("w360"), F.max(lon_360(lon)).alias("e360"))
    pole = (F.col("lat_max") >= 90 - 0.1) | (F.col("lat_min") <= -90 + 0.1)
    over = (F.col("e") - F.col("w") > 355) & ~pole
    return raw.select(*keys, F.when(over, F.col("w360")).otherwise(F.col("w")).alias("lon_min"), F.when(over, F.col("e360") - 360).otherwise(F.col("e")).alias("lon_max"), "lat_min", "lat_max")


def freeze_grid(swath: DataFrame, p: Mapping, dx: float, dy: float, mode: str = "modify_crs") -> DataFrame:
    """One row: extent and size of a dynamic grid around a swath.

    Modes at the antimeridian: modify_crs (longitudes modulo 360 in a projection shifted by half a turn),
    modify_extents (x past 180 degrees), global_extents (the whole width). Projected grids take the bounds
    of x and y.
    """
    geographic = p.get("proj", "longlat") in ("longlat", "latlong")
    x, y = forward(p, F.col("lon"), F.col("lat"))
    agg = swath.select(x.alias("x"), y.alias("y"), lon_360(F.col("lon")).alias("x360")).agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"), F.min("x360").alias("w"), F.max("x360").alias("e"))
    crosses = (F.col("x1") - F.col("x0") > 355) if geographic else F.lit(False)
    if mode == "global_extents":
        lo, hi = F.when(crosses, F.lit(-180.0)), F.when(crosses, F.lit(180.0))
    elif mode == "modify_extents":
        lo, hi = F.when(crosses, F.col("w")), F.when(crosses, F.col("e"))
    else:
        lo, hi = F.when(crosses, F.col("w") - 180), F.when(crosses, F.col("e") - 180)
    agg = agg.withColumns({"x0": F.coalesce(lo, "x0"), "x1": F.coalesce(hi, "x1"), "crosses": crosses})
    w, h = F.ceil((F.col("x1") - F.col("x0")) / dx + 1).cast("int"), F.ceil((F.col("y1") - F.col("y0")) / dy + 1).cast("int")
    agg = agg.withColumn("width", w).withColumn("height", h)
    shift = F.lit(180.0) if mode == "modify_crs" else F.lit(0.0)
    return agg.select("width", "height", (F.col("x0") - dx / 2).alias("x_min"), (F.col("y1") + dy / 2 - F.col("height") * dy).alias("y_min"), (F.col("x0") - dx / 2 + F.col("width") * dx).alias("x_max"), (F.col("y1") + dy / 2).alias("y_max"), F.when(F.col("crosses"), shift).otherwise(0.0).alias("lon_shift"))


def native_pairs(grids: DataFrame, rtol: float = 1e-6) -> DataFrame:
    """(area_id, other): grids of one projection and extent whose widths are whole multiples."""
    a = grids.select(*[F.col(c).alias(c) for c in ("area_id", "proj", "width", "x_min", "y_min", "x_max", "y_max")])
    b = grids.select(*[F.col(c).alias(f"o_{c}") for c in ("area_id", "proj", "width", "x_min", "y_min", "x_max", "y_max")])
    close = F.lit(True)
    for c in ("x_min", "y_min", "x_max", "y_max"):
        close = close & (F.abs(F.col(c) - F.col(f"o_{c}")) <= F.abs(F.col(f"o_{c}")) * rtol + 1e-8)
    whole = (F.greatest("width", "o_width") % F.least("width", "o_width")) == 0
    return a.join(b, (F.col("proj") == F.col("o_proj")) & close & whole).select("area_id", F.col("o_area_id").alias("other"))


def choose_projection(lon: Column, lat: Column, fix_south: bool = False) -> Column:
    """PROJ string for a site: eqc near the equator, lcc, then stere. Southern sites get lat_0=90 too, unless
    ``fix_south``."""
    size = F.abs(lat)
    lat_0 = F.when(lat < 0, "-90").otherwise("90") if fix_south else F.lit("90")
    five = lambda c: F.format_string("%.5f", c)
    eqc = F.concat(F.lit("+proj=eqc +datum=WGS84 +ellps=WGS84 +lat_ts="), five(lat), F.lit(" +lon_0="), five(lon), F.lit(" +units=m +no_defs"))
    lcc = F.concat(F.lit("+proj=lcc +datum=WGS84 +ellps=WGS84 +lat_0="), five(lat), F.lit(" +lat_1="), five(lat), F.lit(" +lon_0="), five(lon), F.lit(" +units=m +no_defs"))
    stere = F.concat(F.lit("+proj=stere +datum=WGS84 +ellps=WGS84 +lat_0="), lat_0, F.lit(" +lat_ts="), five(lat), F.lit(" +lon_0="), five(lon), F.lit(" +units=m"))
    return F.when(size < 15, eqc).when(size < 70, lcc).otherwise(stere)


def centered_extent(x: Column, y: Column, width: Column, height: Column, dx: Column, dy: Column) -> dict[str, Column]:
    """Extent of a grid around a projected centre."""
    half_w, half_h = width / 2 * dx, height / 2 * F.abs(dy)
    return {"x_min": x - half_w, "y_min": y - half_h, "x_max": x + half_w, "y_max": y + half_h}


def cells(spark: SparkSession, width: int, height: int, x_min: float, y_max: float, dx: float, dy: float) -> DataFrame:
    """(row, col, x, y) of every cell centre."""
    ids = spark.range(width * height)
    row, col = F.floor(F.col("id") / width), F.col("id") % width
    return ids.select(row.cast("int").alias("row"), col.cast("int").alias("col"), (F.lit(x_min) + (col + 0.5) * dx).alias("x"), (F.lit(y_max) - (row + 0.5) * dy).alias("y"))


def cell_of(x: Column, y: Column, x_min: float, y_max: float, dx: float, dy: float) -> tuple[Column, Column]:
    """Row and column of the cell that holds a projected point."""
    return F.floor((F.lit(y_max) - y) / dy), F.floor((x - x_min) / dx)


def coarse_to_fine(areas: DataFrame, name: str = "area_id", height: str = "height") -> DataFrame:
    """``place`` of each area from the coarsest (fewest rows) on; a table of a scene's areas, so one small window."""
    return areas.withColumn("place", F.rank().over(Window.orderBy(height, name)))
