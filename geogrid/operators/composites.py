"""Derived products: band arithmetic, sharpening, day and night, and the registry of recipes."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geogrid.functions.enhance import METHODS, apply_operations, erf, sunz_correct
from geogrid.operators import tiles
from geogrid.sources.builtin_products import composite_rows
from geogrid.sources.builtin_rules import enhancement_rows, operations


def wide_bands(pixels: DataFrame, bands: Sequence[str], keys: Sequence[str] = ("y", "x")) -> DataFrame:
    """Long pixels (keys, product, value) as one column a band, by one aggregation instead of joins."""
    return pixels.where(F.col("product").isin(list(bands))).groupBy(*keys).agg(*[F.max(F.when(F.col("product") == b, F.col("value"))).alias(b) for b in bands])


def with_low_resolution(high: DataFrame, low: DataFrame, factor: int) -> DataFrame:
    """High-resolution pixels joined to the low-resolution pixel that holds them."""
    return high.withColumn("__r", F.floor(F.col("y") / factor)).withColumn("__c", F.floor(F.col("x") / factor)).join(low.withColumnsRenamed({"y": "__r", "x": "__c"}), ["__r", "__c"]).drop("__r", "__c")


def with_geolocation(pixels: DataFrame, swath: DataFrame) -> DataFrame:
    """Pixels with lon and lat; each distinct geolocation is read once, whatever the number of products."""
    return pixels.join(swath.dropDuplicates(["swath_id", "y", "x"]), ["swath_id", "y", "x"])


def rgb(r: Column, g: Column, b: Column) -> Column:
    """struct(r, g, b), null if a band is missing."""
    return F.when(r.isNotNull() & g.isNotNull() & b.isNotNull(), F.struct(r.alias("r"), g.alias("g"), b.alias("b")))


def single_band(v: Column) -> Column:
    return v


def difference(a: Column, b: Column) -> Column:
    return a - b


def band_sum(*bands: Column) -> Column:
    out = bands[0]
    for b in bands[1:]:
        out = out + b
    return out


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0."""
    return F.try_divide(a, b)


def normalized_difference(a: Column, b: Column) -> Column:
    return F.try_divide(a - b, a + b)


def weighted_sum(bands: Sequence[Column], weights: Sequence[float]) -> Column:
    """A synthetic band, as green of geostationary instruments."""
    return band_sum(*[b * float(w) for b, w in zip(bands, weights, strict=True)])


def sub_band(color: Column, band: str | int) -> Column:
    """One band of a colour; the name or the index must exist."""
    names = ("r", "g", "b")
    name = names[band] if isinstance(band, int) else band.lower()
    if name not in names:
        raise ValueError(f"no band {band!r}")
    return color.getField(name)


def pre_enhanced(v: Column, operations: Sequence[tuple[str, dict]]) -> Column:
    """A band enhanced inside a recipe."""
    return apply_operations(v, operations)


def sharpening_ratio(high: Column, low: Column) -> Column:
    """high / low where low is positive; 1 where the ratio is missing or not positive."""
    r = F.try_divide(high, low)
    return F.when((r > 0) & (low > 0), r).otherwise(F.lit(1.0))


def ratio_sharpened(r: Column, g: Column, b: Column, high: Column | None, which: str) -> Column:
    """RGB whose band ``which`` is replaced by the high-resolution one and whose others follow its ratio."""
    if high is None:
        return rgb(r, g, b)
    bands = {"r": r, "g": g, "b": b}
    k = sharpening_ratio(high, bands[which])
    sharp = {n: F.coalesce(high, v) if n == which else v * F.when(high.isNull(), F.lit(1.0)).otherwise(k) for n, v in bands.items()}
    return rgb(sharp["r"], sharp["g"], sharp["b"])


def self_sharpened(df: DataFrame, r: str, g: str, b: str, which: str, block: int = 2) -> DataFrame:
    """``rgb`` sharpened by its own high-resolution band against its block means."""
    w = Window.partitionBy(F.floor(F.col("y") / block), F.floor(F.col("x") / block))
    own = {"r": r, "g": g, "b": b}[which]
    low = F.avg(own).over(w)
    bands = {n: low if n == which else F.col(c) for n, c in (("r", r), ("g", g), ("b", b))}
    return df.withColumn("__high", F.col(own)).withColumn("__low", low).withColumn("rgb", ratio_sharpened(*[F.col("__low") if n == which else bands[n] for n in "rgb"], F.col("__high"), which)).drop("__high", "__low")


def day_night_mix(day: Column, night: Column, sza: Column, lo: float = 85.0, hi: float = 88.0) -> Column:
    """Day below ``lo`` degrees, night above ``hi``, linear between; one that is missing gives way."""
    w = F.least(F.greatest((F.lit(hi) - sza) / (hi - lo), F.lit(0.0)), F.lit(1.0))
    return F.coalesce(w * day + (F.lit(1.0) - w) * night, day, night)


def regime(sza: Column) -> Column:
    """day below 88 degrees, twilight to 100, night beyond."""
    return F.when(sza < 88, "day").when(sza <= 100, "mixed").when(sza.isNotNull(), "night")


def equalized(df: DataFrame, by: Sequence[str], value: str = "value", bins: int = 256, sigmas: float | None = 4.0) -> DataFrame:
    """``equalized`` (0 to 1): histogram equalization within each group of ``by``.

    Values more than ``sigmas`` deviations from the group's mean only count at the nearest limit. Groups
    are reduced to counts by bin before the running sum, so a group of any size is a few hundred rows.
    """
    stats = df.groupBy(*by).agg(F.avg(value).alias("__m"), F.stddev_pop(value).alias("__s"), F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    lo, hi = F.col("__lo"), F.col("__hi")
    if sigmas is not None:
        lo, hi = F.greatest(lo, F.col("__m") - F.col("__s") * sigmas), F.least(hi, F.col("__m") + F.col("__s") * sigmas)
    stats = stats.select(*[F.col(c).alias(f"__k_{c}") for c in by], lo.alias("__lo"), hi.alias("__hi"))
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__k_{c}"))
    joined = df.join(stats, same)
    share = F.coalesce(F.try_divide(F.least(F.greatest(F.col(value), F.col("__lo")), F.col("__hi")) - F.col("__lo"), F.col("__hi") - F.col("__lo")), F.lit(0.0))
    bin_ = F.when(F.col(value).isNotNull(), F.least(F.floor(share * bins), F.lit(bins - 1)))
    binned = joined.select(*df.columns, bin_.alias("__bin"))
    counts = binned.where("__bin is not null").groupBy(*by, "__bin").agg(F.count("*").alias("__n"))
    w = Window.partitionBy(*by)
    cdf = counts.withColumn("equalized", F.sum("__n").over(w.orderBy("__bin")) / F.sum("__n").over(w))
    cdf = cdf.select(*[F.col(c).alias(f"__k_{c}") for c in by], F.col("__bin").alias("__k_bin"), "equalized")
    return binned.join(cdf, same & (F.col("__bin") == F.col("__k_bin")), "left").select(*df.columns, "equalized")


def histogram_dnb(df: DataFrame, sza: str = "sza", value: str = "value") -> DataFrame:
    """Day-night band equalized within day, twilight and night."""
    return equalized(df.withColumn("regime", regime(F.col(sza))), ["regime"], value)


def adaptive_dnb(df: DataFrame, tile: int, sza: str = "sza", value: str = "value", bins: int = 64) -> DataFrame:
    """Equalization by regime and tile, each pixel blending the curves of its four nearest tile centres."""
    keyed = df.where(F.col(value).isNotNull()).withColumn("regime", regime(F.col(sza)))
    limits = keyed.groupBy("regime").agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    keyed = keyed.join(F.broadcast(limits), keyed["regime"].eqNullSafe(limits["regime"])).drop(limits["regime"])
    share = F.coalesce(F.try_divide(F.col(value) - F.col("__lo"), F.col("__hi") - F.col("__lo")), F.lit(0.0))
    keyed = keyed.withColumn("__bin", F.least(F.floor(share * bins), F.lit(bins - 1)))
    counts = keyed.groupBy("regime", F.floor(F.col("y") / tile).alias("__ty"), F.floor(F.col("x") / tile).alias("__tx"), "__bin").agg(F.count("*").alias("__n"))
    w = Window.partitionBy("regime", "__ty", "__tx")
    filled = counts.withColumn("__total", F.sum("__n").over(w)).withColumn("__sum", F.sum("__n").over(w.orderBy("__bin")))
    curve = filled.groupBy("regime", "__ty", "__tx").agg(F.array_sort(F.collect_list(F.struct("__bin", (F.col("__sum") / F.col("__total")).alias("p")))).alias("curve"))
    corners = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)])
    v, u = F.col("y") / tile - 0.5, F.col("x") / tile - 0.5
    near = keyed.withColumn("__c", F.explode(corners)).withColumn("__ty", F.floor(v) + F.col("__c.i")).withColumn("__tx", F.floor(u) + F.col("__c.j"))
    weight = (F.lit(1.0) - F.abs(v - F.col("__ty"))) * (F.lit(1.0) - F.abs(u - F.col("__tx")))
    near = near.withColumn("__w", weight).join(curve, ["regime", "__ty", "__tx"])
    below = F.filter("curve", lambda c: c["__bin"] <= F.col("__bin"))
    p = F.coalesce(F.try_element_at(below, F.lit(-1))["p"], F.lit(0.0))
    return near.groupBy("y", "x").agg(F.first("regime").alias("regime"), F.first(value).alias(value), (F.sum(p * F.col("__w")) / F.sum("__w")).alias("equalized"))


def dynamic_dnb(v: Column, sza: Column, lza: Column, moon_fraction: Column, saturation: bool = False) -> Column:
    """Day-night band between limits that follow sun and moon through error functions (Seaman and Miller 2015).

    With ``saturation`` values over the upper limit are compressed instead of cut.
    """

    def limit(level: float) -> Column:
        sun = F.pow(F.lit(10.0), (F.lit(1.0) - erf((sza - 95.0) / (5.0 * 1.4142135623730951))) * 3.5 - level)
        moon = (F.lit(1.0) - erf((lza - 95.0) / (5.0 * 1.4142135623730951))) * moon_fraction * 10.0 ** (-level + 0.5)
        return sun + moon

    lo, hi = limit(10.0), limit(8.5)
    share = F.greatest((v - lo) / (hi - lo), F.lit(0.0))
    if saturation:
        return F.sqrt(F.when(share > 1, F.lit(2.0) - F.lit(1.0) / share).otherwise(share) / 2)
    return F.sqrt(F.least(share, F.lit(1.0)))


def hncc_dnb(v: Column, sza: Column, lza: Column, moon_fraction: Column) -> Column:
    """Simplified near-constant contrast (Zinke 2017): the radiance over an expected one of sun and moon."""

    def gain(angle: Column) -> Column:
        phi = F.least(F.greatest(angle, F.lit(0.0)), F.lit(130.0))
        day = F.cos(F.radians(F.least(phi, F.lit(89.0)))) * 58.0 + 4.0
        dusk = F.pow(F.lit(10.0), (phi - 87.0) * 0.2117)
        night = F.lit(123.0) + (phi - 104.0) * 3.0
        return F.when(phi < 87, F.lit(1.0) / day).when(phi < 96, dusk * 0.25).otherwise(night)

    expected = F.lit(1.0) / gain(sza) + moon_fraction * 1e-6 / gain(lza)
    return F.greatest(v, F.lit(0.0)) / F.greatest(expected, F.lit(1e-12))


@dataclass
class Recipe:
    """A named derived product: a function of its inputs' Columns, with optional inputs. An input may name
    modifiers: ``M05+sunz_corrected``."""

    name: str
    inputs: tuple[str, ...]
    make: Callable[..., Column]
    optional: tuple[str, ...] = ()


RECIPES: dict[str, Recipe] = {}
#: Modifiers of inputs: the columns they read, and a function of the value and those.
MODIFIERS: dict[str, tuple[tuple[str, ...], Callable[..., Column]]] = {"sunz_corrected": (("solar_zenith_angle",), sunz_correct)}


def register_composite(name: str, inputs: Sequence[str], make: Callable[..., Column], optional: Sequence[str] = ()) -> None:
    """A user's composite; ``make`` gets a Column for each input, None for a missing optional one."""
    RECIPES[name] = Recipe(name, tuple(inputs), make, tuple(optional))


def register_modifier(name: str, inputs: Sequence[str], make: Callable[..., Column]) -> None:
    """A user's modifier, as an atmospheric correction; ``make`` gets the value and a Column for each of ``inputs``."""
    MODIFIERS[name] = (tuple(inputs), make)


#: Composites of surroundings: their inputs, a function of arrays (``tiles.neighbourhood``) and the cells it looks around.
SURROUNDINGS: dict[str, tuple[tuple[str, ...], Callable[..., np.ndarray], int]] = {}


def register_surroundings(name: str, inputs: Sequence[str], function: Callable[..., np.ndarray], halo: int = 1) -> None:
    """A user's composite of each cell's surroundings; ``function`` gets an array for each of ``inputs``."""
    SURROUNDINGS[name] = (tuple(inputs), function, halo)


def apply_surroundings(grid: DataFrame, wanted: Sequence[str], keys: tuple[str, ...] = (), side: int = tiles.SIDE) -> DataFrame:
    """``grid`` (keys, row, col, bands) with the wanted composites of surroundings as columns; later ones may read earlier ones.

    Those whose inputs are missing are left out. ``row`` and ``col`` may not repeat within ``keys``.
    """
    for name in wanted:
        inputs, function, halo = SURROUNDINGS[name]
        if set(inputs) <= set(grid.columns):
            made = tiles.neighbourhood(grid, function, inputs, halo, keys, side, name)
            grid = grid.join(made, [*keys, "row", "col"], "left")
    return grid


def _usable(spec: str, known: set[str]) -> bool:
    name, *modifiers = spec.split("+")
    return name in known and all(m in MODIFIERS and set(MODIFIERS[m][0]) <= known for m in modifiers)


def _input(spec: str, made: dict[str, Column]) -> Column:
    name, *modifiers = spec.split("+")
    out = made[name]
    for m in modifiers:
        needs, make = MODIFIERS[m]
        out = make(out, *[made[n] for n in needs])
    return out


def available_recipes(spark: SparkSession, have: Sequence[str], recipes: dict[str, Recipe] | None = None) -> list[str]:
    """Recipes whose inputs exist or can be made, in an order that makes inputs first; cycles drop out, as do recipes
    with a modifier that is not registered or lacks its columns."""
    recipes = RECIPES if recipes is None else recipes
    known, order = set(have), []
    while new := [n for n, r in sorted(recipes.items()) if n not in known and all(_usable(i, known) for i in r.inputs)]:
        order += new
        known.update(new)
    return order


def apply_recipes(df: DataFrame, wanted: Sequence[str], recipes: dict[str, Recipe] | None = None) -> DataFrame:
    """The wanted composites that can be made, as columns next to the bands; intermediate ones are inlined."""
    recipes = RECIPES if recipes is None else recipes
    order = available_recipes(df.sparkSession, df.columns, recipes)
    made: dict[str, Column] = {c: F.col(f"`{c}`") for c in df.columns}
    for n in order:
        r = recipes[n]
        optional = [_input(i, made) if _usable(i, set(made)) else None for i in r.optional]
        made[n] = r.make(*[_input(i, made) for i in r.inputs], *optional)
    return df.select("*", *[made[n].alias(n) for n in wanted if n in order])


def pre_enhanced_rgb(color: Column, operations: Sequence[tuple[str, dict]]) -> Column:
    """Each band of a colour enhanced inside a recipe."""
    return F.when(color.isNotNull(), F.struct(*[apply_operations(color[n], operations).alias(n) for n in "rgb"]))


def color_day_night(day: Column, night: Column, sza: Column) -> Column:
    """A colour by day and a single band by night, mixed band by band."""
    return F.struct(*[day_night_mix(day[n], night, sza).alias(n) for n in "rgb"])


def builtin_recipes(sensor: str) -> dict[str, Recipe]:
    """The builtin composites of an instrument. Inputs are columns on one grid; high-resolution ones too."""
    colors = operations(next(r["operations"] for r in enhancement_rows() if r["rule_id"] == "true_color_default"))
    makers: dict[str, Callable[[str], Callable[..., Column]]] = {
        "rgb": lambda _: rgb,
        "single": lambda _: single_band,
        "sum": lambda _: band_sum,
        "difference": lambda _: difference,
        "normalized_difference": lambda _: normalized_difference,
        "ratio_sharpened": lambda which: lambda r, g, b, high=None: ratio_sharpened(r, g, b, high, which),
        "pre_enhanced": lambda _: lambda c: pre_enhanced_rgb(c, colors),
        "sub_band": lambda band: lambda c: sub_band(c, band),
        "dynamic_dnb": lambda how: lambda v, sun, moon, part: dynamic_dnb(v, sun, moon, part, how == "saturation"),
        "day_night_mix": lambda _: color_day_night,
    }
    return {name: Recipe(name, inputs, makers[how](argument), optional) for name, how, inputs, optional, argument in composite_rows(sensor)}


def limb_corrected(pixels: DataFrame, coefficients: DataFrame) -> DataFrame:
    """(y, x, channel, corrected): coefficient rows (channel, scan_pos, surface, src_channel, coef, intercept)
    applied to brightness temperatures (y, x, channel, scan_pos, surface, value)."""
    source = pixels.withColumnRenamed("channel", "src_channel")
    joined = source.join(coefficients, ["scan_pos", "surface", "src_channel"])
    return joined.groupBy("y", "x", "channel").agg((F.sum(F.col("coef") * F.col("value")) + F.max("intercept")).alias("corrected"))


def register_defaults() -> None:
    """Generic recipes on bands named v1, v2, …"""
    register_composite("rgb_v", ["v1", "v2", "v2"], rgb)
    register_composite("diff_v", ["v1", "v2"], difference)
    register_composite("ndi_v", ["v1", "v2"], normalized_difference)
    register_composite("ratio_of_diff", ["diff_v", "v2"], ratio)


register_defaults()
__all__ = [n for n in dir() if not n.startswith("_")] + ["METHODS"]
