"""Masks on values, filters on products by daylight and coverage, cropping and orientation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geogrid.functions.enhance import sunz_correct
from geogrid.operators.products import matching

DEFAULT_FRACTION = 0.1


def mask_quality(v: Column, flag: Column, most: int | None) -> Column:
    """v where flag <= most; no limit with None."""
    return v if most is None else F.when(flag <= most, v)


def mask_flags(v: Column, flags: Column, bad: Sequence[int] = (), bits: int = 0) -> Column:
    """v unless its flag is among ``bad`` or has one of ``bits``."""
    ok = F.lit(True)
    if bad:
        ok = ok & ~flags.isin(*bad)
    if bits:
        ok = ok & (flags.bitwiseAND(F.lit(bits)) == 0)
    return F.when(ok, v)


def mask_good(v: Column, flags: Column, good: Sequence[int]) -> Column:
    return F.when(flags.isin(*good), v)


def mask_below_surface(v: Column, level: Column, surface_pressure: Column) -> Column:
    return F.when(level <= surface_pressure, v)


def between_levels(df: DataFrame, lo: float = 110.0, hi: float = 987.0, level_col: str = "level") -> DataFrame:
    return df.where(F.col(level_col).between(lo, hi))


def clip_negative(v: Column) -> Column:
    return F.when(v.isNotNull(), F.greatest(v, F.lit(0.0)))


def mask_saturated(v: Column, limit: float) -> Column:
    return F.when(v < limit, v)


def mask_space(v: Column, lon: Column) -> Column:
    """v where the inverse projection meets the disk."""
    return F.when(lon.isNotNull(), v)


def normalized(v: Column, sza: Column, divide: bool) -> Column:
    """A visible band with or without division by cos(sza)."""
    return sunz_correct(v, sza) if divide else v


def crop(swath: DataFrame, lon_min: float, lat_min: float, lon_max: float, lat_max: float) -> DataFrame:
    """The pixels inside the box, their y and x counted anew from the corner of what is left."""
    inside = swath.where(F.col("lon").between(lon_min, lon_max) & F.col("lat").between(lat_min, lat_max))
    corner = inside.agg(F.min("y").alias("__y0"), F.min("x").alias("__x0"))
    return inside.crossJoin(F.broadcast(corner)).withColumn("y", F.col("y") - F.col("__y0")).withColumn("x", F.col("x") - F.col("__x0")).drop("__y0", "__x0")


def orient(df: DataFrame, corner: str = "NE", y: str = "y", x: str = "x") -> DataFrame:
    """Rows and columns flipped so that the upper right corner is the one named."""
    size = df.agg(F.max(y).alias("__y1"), F.max(x).alias("__x1"))
    out = df.crossJoin(F.broadcast(size))
    if "S" in corner:
        out = out.withColumn(y, F.col("__y1") - F.col(y))
    if "W" in corner:
        out = out.withColumn(x, F.col("__x1") - F.col(x))
    return out.drop("__y1", "__x1")


def sunlit_fraction(pixels: DataFrame, by: str = "product", sza_col: str = "sza", limit: float = 90.0) -> DataFrame:
    """(by, sunlit): share of pixels with a zenith angle that are lit; null without any."""
    return pixels.groupBy(by).agg(F.avg((F.col(sza_col) < limit).cast("int")).alias("sunlit"))


def daylight_filter(products: DataFrame, sunlit: DataFrame, criteria: DataFrame | bool, day: bool, fraction: float | bool | None = None) -> DataFrame:
    """Products without those that match the criteria and have too little day (or night).

    ``fraction`` None is DEFAULT_FRACTION, False switches the filter off. Products of unknown share stay.
    """
    if fraction is False:
        return products
    least = DEFAULT_FRACTION if fraction is None else float(fraction)
    part = F.col("sunlit") if day else 1 - F.col("sunlit")
    dark = matching(products, criteria).join(sunlit, "product").where(part < least).select("product")
    return products.join(dark, "product", "left_anti")


def coverage(hits: DataFrame, width: int, height: int, by: str = "product", block: int = 1) -> DataFrame:
    """(by, coverage): share of the target grid's cells that are hit.

    ``hits`` holds (by, row, col). Identical areas give 1, disjoint ones no row. ``block`` counts blocks of so many
    cells a side instead, all of a block once a cell of it is hit: for pixels that lie further apart than cells.
    """
    blocks = -(-height // block) * -(-width // block)
    inside = hits.where(F.col("row").between(0, height - 1) & F.col("col").between(0, width - 1))
    cells = inside.select(by, F.floor(F.col("row") / block).alias("r"), F.floor(F.col("col") / block).alias("c")).distinct()
    return cells.groupBy(by).agg((F.count("*") / blocks).alias("coverage"))


def coverage_filter(products: DataFrame, covered: DataFrame, least: float | None = None) -> DataFrame:
    """Products whose coverage reaches the limit: a rule's ``grid_coverage``, else ``least``, else 0.1.

    Products resampled natively, without a second dimension or area, and those of a dynamic grid
    (``skip`` true) are not filtered, nor any with a limit of 0 or less.
    """
    limit = F.coalesce(F.col("grid_coverage").cast("double"), F.lit(least).cast("double"), F.lit(DEFAULT_FRACTION))
    joined = products.join(covered, "product", "left")
    return joined.where(F.col("skip") | (limit <= 0) | (F.coalesce("coverage", F.lit(0.0)) >= limit)).select(*[products[c] for c in products.columns])


def shared_coverage(products: DataFrame) -> DataFrame:
    """``coverage`` of the coarsest area (fewest rows) of the same platform and sensor; own where either is missing."""
    w = Window.partitionBy("platform_name", "sensor").orderBy("height", "product").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    known = F.col("platform_name").isNotNull() & F.col("sensor").isNotNull()
    return products.withColumn("coverage", F.when(known, F.first("coverage").over(w)).otherwise(F.col("coverage")))
