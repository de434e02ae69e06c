"""Overlays, mosaics, tiles and their counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overlay(background: DataFrame, foreground: DataFrame) -> DataFrame:
    """(row, col, value): the foreground where it is valid, else the background; cells of both."""
    b, f = background.select("row", "col", F.col("value").alias("b")), foreground.select("row", "col", F.col("value").alias("f"))
    return b.join(f, ["row", "col"], "full_outer").select("row", "col", F.coalesce("f", "b").alias("value"))


def overlay_alpha(background: DataFrame, foreground: DataFrame) -> DataFrame:
    """Colours (row, col, r, g, b, a) of the foreground over the background, by alpha (0..255)."""
    names = ("r", "g", "b", "a")
    b = background.select("row", "col", *[F.col(c).alias(f"b_{c}") for c in names])
    f = foreground.select("row", "col", *[F.col(c).alias(f"f_{c}") for c in names])
    both = b.join(f, ["row", "col"], "full_outer")
    fa, ba = F.coalesce("f_a", F.lit(0)) / 255.0, F.coalesce("b_a", F.lit(0)) / 255.0
    out = fa + ba * (F.lit(1.0) - fa)
    mix = lambda c: F.coalesce(F.try_divide(F.coalesce(f"f_{c}", F.lit(0)) * fa + F.coalesce(f"b_{c}", F.lit(0)) * ba * (F.lit(1.0) - fa), out), F.lit(0.0))
    return both.select("row", "col", *[mix(c).alias(c) for c in "rgb"], (out * 255.0).alias("a"))


def mosaic(passes: DataFrame) -> DataFrame:
    """(row, col, value): of the passes (seq, row, col, value) the latest valid value."""
    return passes.where("value is not null").groupBy("row", "col").agg(F.max_by("value", "seq").alias("value"))


def tile_counts(tiled: DataFrame) -> DataFrame:
    """(tile, n_valid) of the tiles that hold data."""
    return tiled.groupBy("tile").agg(F.count("value").alias("n_valid")).where("n_valid > 0")
