"""Resampling of pixels onto grid cells."""

from __future__ import annotations

import functools
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geogrid.functions.projections import EARTH_RADIUS, forward, unit_sphere
from geogrid.operators.grids import cell_of
from geogrid.sources.shared import checkpointed, merged, written

def native_up(pixels: DataFrame, factor: int, y: str = "y", x: str = "x") -> DataFrame:
    """Each pixel as factor x factor cells (row, col); no join."""
    steps = F.sequence(F.lit(0), F.lit(factor - 1))
    out = pixels.withColumn("__i", F.explode(steps)).withColumn("__j", F.explode(steps))
    return out.withColumn("row", F.col(y) * factor + F.col("__i")).withColumn("col", F.col(x) * factor + F.col("__j")).drop("__i", "__j", y, x)


def native_down(pixels: DataFrame, factor: int, value: str = "value", keys: tuple[str, ...] = (), y: str = "y", x: str = "x") -> DataFrame:
    """Mean of the valid pixels of each factor x factor block."""
    return pixels.groupBy(*keys, F.floor(F.col(y) / factor).cast("int").alias("row"), F.floor(F.col(x) / factor).cast("int").alias("col")).agg(F.avg(value).alias("value"))


def pyramid(grid: DataFrame, factors: list[int], method: str = "average", keys: tuple[str, ...] = ()) -> DataFrame:
    """Overviews (factor, row, col, value) by block mean or by the block's first valid cell."""
    levels = grid.withColumn("factor", F.explode(F.array(*map(F.lit, factors))))
    value = F.avg("value") if method == "average" else F.min_by("value", F.when(F.col("value").isNotNull(), F.struct("row", "col")))
    r, c = F.floor(F.col("row") / F.col("factor")), F.floor(F.col("col") / F.col("factor"))
    return levels.groupBy(*keys, "factor", r.cast("int").alias("r"), c.cast("int").alias("c")).agg(value.alias("value")).withColumnsRenamed({"r": "row", "c": "col"})


def pyramid_cascade(grid: DataFrame, factors: list[int], method: str = "average", keys: tuple[str, ...] = ()) -> DataFrame:
    """What ``pyramid`` gives, each level from the largest level before it whose factor divides its own.

    Levels are sums and counts, or first valid cells, kept as written tables: over factors 2, 4, 8, ... some 4/3 of the base
    grid is read in all, instead of the base once a factor.
    """
    mean = method == "average"
    first = F.when(F.col("value").isNotNull(), F.struct("row", "col", "value"))
    parts = [F.sum("value").alias("s"), F.count("value").alias("n")] if mean else [F.min(first).alias("s")]
    again = [F.sum("s").alias("s"), F.sum("n").alias("n")] if mean else [F.min("s").alias("s")]
    done: dict[int, DataFrame] = {}
    for f in sorted(set(factors)):
        below = max((g for g in done if f % g == 0), default=None)
        source, step = (grid, f) if below is None else (done[below], f // below)
        cell = [F.floor(F.col(c) / step).cast("int").alias(c) for c in ("row", "col")]
        done[f] = checkpointed(source.groupBy(*keys, *cell).agg(*(parts if below is None else again)))
    value = F.try_divide("s", "n") if mean else F.col("s.value")
    levels = [df.select(*keys, F.lit(f).alias("factor"), "row", "col", value.alias("value")) for f, df in done.items()]
    return functools.reduce(DataFrame.unionByName, levels)


#: Weights of an overview kernel by distance from the block centre in output pixels.
def kernel_weight(kind: str, d: Column) -> Column:
    a = F.abs(d)
    if kind == "bilinear":
        return F.greatest(F.lit(1.0) - a, F.lit(0.0))
    if kind == "cubic":
        return F.when(a <= 1, a * a * a * 1.5 - a * a * 2.5 + 1).when(a < 2, a * a * a * -0.5 + a * a * 2.5 - a * 4 + 2).otherwise(0.0)
    if kind == "cubicspline":
        return F.when(a <= 1, F.lit(2 / 3) - a * a + a * a * a / 2).when(a < 2, (F.lit(2.0) - a) * (F.lit(2.0) - a) * (F.lit(2.0) - a) / 6).otherwise(0.0)
    if kind == "lanczos":
        t = a * 3.141592653589793
        return F.when(a < 1e-12, F.lit(1.0)).when(a < 3, F.sin(t) * F.sin(t / 3) * 3 / (t * t)).otherwise(0.0)
    raise ValueError(f"kernel {kind!r} is not known")


_REACH = {"bilinear": 1, "cubic": 2, "cubicspline": 2, "lanczos": 3}


def kernel_overview(grid: DataFrame, factor: int, kind: str) -> DataFrame:
    """Overview by a separable kernel: each cell goes to the few output cells within the kernel's reach."""
    reach = _REACH[kind]
    u, w = (F.col("row") + 0.5) / factor - 0.5, (F.col("col") + 0.5) / factor - 0.5
    near = lambda c: F.sequence(F.floor(c) - reach + 1, F.floor(c) + reach)
    size = grid.agg(F.floor(F.max("row") / factor).alias("__r1"), F.floor(F.max("col") / factor).alias("__c1"))
    spread = grid.where("value is not null").select("value", u.alias("u"), w.alias("w"), F.explode(near(u)).alias("r")).select("*", F.explode(near(F.col("w"))).alias("c"))
    spread = spread.crossJoin(F.broadcast(size)).where("r between 0 and __r1 and c between 0 and __c1")
    weight = kernel_weight(kind, F.col("u") - F.col("r")) * kernel_weight(kind, F.col("w") - F.col("c"))
    sums = spread.withColumn("k", weight).groupBy(F.col("r").cast("int").alias("row"), F.col("c").cast("int").alias("col")).agg(F.sum("k").alias("n"), F.sum(F.col("k") * F.col("value")).alias("s"))
    return sums.select("row", "col", F.try_divide(F.col("s"), F.col("n")).alias("value"))


def nearest_index(cells: DataFrame, swath: DataFrame, radius: float, carry: tuple[str, ...] = (), spacing: float | None = None) -> DataFrame:
    """(row, col, y, x, distance): the nearest pixel of each cell within ``radius`` metres (straight, on a sphere).

    Points of the unit sphere fall into voxels of the radius's size; pixels are looked for in a cell's own
    and the 26 voxels around, an equi-join. Only valid pixels may be given. Ties go to the lowest y, x. The
    table can be kept and joined to any product of the same geolocation.

    With ``spacing``, the metres between pixels, the search begins at that radius and doubles it for the cells that
    have found none, so a radius of many pixels doesn't meet all of them in it.
    """
    reach = min(radius, spacing) if spacing else radius
    if reach >= radius:
        return _within(cells, swath, radius, carry)
    left, out = cells.select("row", "col", "lon", "lat"), None
    while True:
        found = _within(left, swath, reach, carry)
        if reach >= radius:
            return out.unionByName(found)
        found = checkpointed(found)
        out = found if out is None else out.unionByName(found)
        left = merged(left, found, ["row", "col"], "left_anti")
        reach = min(2 * reach, radius)


def geometry_fingerprint(cells: DataFrame, swath: DataFrame, radius: float) -> str:
    """Text that tells apart what a nearest index is made of: both tables' places, in any order, and the radius."""

    def summed(df: DataFrame, names: tuple[str, ...]) -> str:
        own = F.xxhash64(*names)
        row = df.agg(F.count("*").alias("n"), *[F.sum(F.shiftrightunsigned(own, k).bitwiseAND(F.lit(0xFFFFFFFF))).alias(f"s{k}") for k in (0, 32)], F.bit_xor(own).alias("x")).first()
        return "-".join(format((v or 0) & (2**64 - 1), "x") for v in row)

    return f"{summed(cells, ('row', 'col', 'lon', 'lat'))}_{summed(swath, ('y', 'x', 'lon', 'lat'))}_{float(radius).hex()}"


def kept_nearest_index(path: str, cells: DataFrame, swath: DataFrame, radius: float, spacing: float | None = None, buckets: int | None = None) -> DataFrame:
    """``nearest_index`` as a table kept in ``path`` under the geometry's fingerprint: looked up where it is there, else made.

    A changed grid, swath or radius has another fingerprint, so a stale index is never read; one that wasn't written to its end
    is made anew. The table is laid out by the pixels' rows, so bands of that geolocation meet it in order.
    """
    spark = cells.sparkSession
    folder = f"{path}/{geometry_fingerprint(cells, swath, radius)}"
    if not written(spark, folder):
        made = nearest_index(cells, swath, radius, spacing=spacing)
        made = made.repartitionByRange(buckets, "y", "x") if buckets else made.repartitionByRange("y", "x")
        made.sortWithinPartitions("y", "x").write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder)


def _within(cells: DataFrame, swath: DataFrame, radius: float, carry: tuple[str, ...]) -> DataFrame:
    size = radius / EARTH_RADIUS

    def placed(df: DataFrame) -> DataFrame:
        ux, uy, uz = unit_sphere(F.col("lon"), F.col("lat"))
        out = df.withColumns({"ux": ux, "uy": uy, "uz": uz})
        return out.withColumns({f"v{k}": F.floor(F.col(f"u{k}") / size) for k in "xyz"})

    around = F.sequence(F.lit(-1), F.lit(1))
    target = placed(cells.where("lon is not null and lat is not null").select("row", "col", "lon", "lat"))
    for k in "xyz":
        target = target.withColumn("__d", F.explode(around)).withColumn(f"v{k}", F.col(f"v{k}") + F.col("__d")).drop("__d")
    source = placed(swath.where("lon is not null and lat is not null").select("y", "x", "lon", "lat", *carry))
    source = source.select("y", "x", *carry, "vx", "vy", "vz", *[F.col(f"u{k}").alias(f"s{k}") for k in "xyz"])
    both = merged(target, source, ["vx", "vy", "vz"])
    d2 = sum(((F.col(f"u{k}") - F.col(f"s{k}")) * (F.col(f"u{k}") - F.col(f"s{k}")) for k in "xyz"), F.lit(0.0))
    near = both.withColumn("d", F.sqrt(d2) * EARTH_RADIUS).where(F.col("d") <= radius)
    best = near.groupBy("row", "col").agg(F.min(F.struct("d", "y", "x", *carry)).alias("m"))
    return best.select("row", "col", "m.y", "m.x", F.col("m.d").alias("distance"), *[f"m.{c}" for c in carry])


def resample_nearest(cells: DataFrame, swath: DataFrame, radius: float, value: str = "value") -> DataFrame:
    """``cells`` (row, col, lon, lat) with the value of the nearest valid pixel, null where none is near."""
    index = nearest_index(cells, swath.where(F.col(value).isNotNull()), radius, carry=(value,))
    return merged(cells.select("row", "col"), index.select("row", "col", F.col(value).alias("value")), ["row", "col"], "left")


def swath_cells(swath: DataFrame, p: Mapping, x_min: float, y_max: float, dx: float, dy: float) -> DataFrame:
    """The swath with fractional ``u`` (column) and ``v`` (row), cell centres at whole numbers."""
    x, y = forward(p, F.col("lon"), F.col("lat"))
    return swath.withColumn("u", (x - x_min) / dx - 0.5).withColumn("v", (F.lit(y_max) - y) / dy - 0.5)


def prune_blocks(placed: DataFrame, width: int, height: int, margin: float, block: int = 64) -> DataFrame:
    """Without the blocks of pixels whose bounds miss the grid by more than the margin."""
    keyed = placed.withColumn("__b", F.floor(F.col("y") / block)).withColumn("__c", F.floor(F.col("x") / block))
    box = keyed.groupBy("__b", "__c").agg(*[f(c).alias(f"{n}_{c}") for c in "uv" for n, f in (("lo", F.min), ("hi", F.max))])
    hit = box.where((F.col("hi_u") >= -margin) & (F.col("lo_u") <= width - 1 + margin) & (F.col("hi_v") >= -margin) & (F.col("lo_v") <= height - 1 + margin))
    return keyed.join(hit.select("__b", "__c"), ["__b", "__c"], "left_semi").drop("__b", "__c")


def ewa_ellipses(placed: DataFrame, width: int, height: int, rows_per_scan: int = 0, delta_max: float = 10.0, distance_max: float = 1.0, keys: tuple[str, ...] = ()) -> DataFrame:
    """``placed`` with the ellipse of each pixel's footprint (qa, qb, qc, qf) and the cells around it (r0 to r1, c0 to c1).

    Derivatives of u and v along the row and across rows of the same scan give the ellipse (Greene and
    Heckbert); its half widths are capped by ``delta_max``. Pixels away from the grid are dropped.
    """
    scan = F.floor(F.col("y") / rows_per_scan) if rows_per_scan else F.lit(0)
    placed = placed.withColumn("__scan", scan)
    along, across = Window.partitionBy(*keys, "y").orderBy("x"), Window.partitionBy(*keys, "__scan", "x").orderBy("y")

    def slope(c: str, w: Window, step: str) -> Column:
        before, after = F.lag(c).over(w), F.lead(c).over(w)
        gap = F.coalesce(F.lead(step).over(w), F.col(step)) - F.coalesce(F.lag(step).over(w), F.col(step))
        return F.coalesce(F.try_divide(F.coalesce(after, F.col(c)) - F.coalesce(before, F.col(c)), gap), F.lit(0.0))

    d = placed.withColumns({"ux": slope("u", along, "x"), "vx": slope("v", along, "x"), "uy": slope("u", across, "y"), "vy": slope("v", across, "y")})
    # x'Q x with footprint F = 1; the axes are at least one cell wide, as single-pixel lines would vanish.
    one = 1.0
    a, b, c = F.col("vx") ** 2 + F.col("vy") ** 2 + one, (F.col("ux") * F.col("vx") + F.col("uy") * F.col("vy")) * -2, F.col("ux") ** 2 + F.col("uy") ** 2 + one
    d = d.withColumns({"qa": a, "qb": b, "qc": c})
    f = F.col("qa") * F.col("qc") - F.col("qb") ** 2 / 4
    d = d.withColumn("qf", f)
    half_u = F.least(F.sqrt(F.col("qc")) * distance_max, F.lit(float(delta_max)))
    half_v = F.least(F.sqrt(F.col("qa")) * distance_max, F.lit(float(delta_max)))
    d = d.withColumns({"c0": F.greatest(F.ceil(F.col("u") - half_u), F.lit(0)), "c1": F.least(F.floor(F.col("u") + half_u), F.lit(width - 1)), "r0": F.greatest(F.ceil(F.col("v") - half_v), F.lit(0)), "r1": F.least(F.floor(F.col("v") + half_v), F.lit(height - 1))})
    return d.where("u is not null and v is not null and c0 <= c1 and r0 <= r1").drop("__scan", "ux", "vx", "uy", "vy")


def ewa_weights(placed: DataFrame, width: int, height: int, rows_per_scan: int = 0, delta_max: float = 10.0, distance_max: float = 1.0, alpha: float = 4.60517018598809, keys: tuple[str, ...] = (), carry: tuple[str, ...] = ()) -> DataFrame:
    """(y, x, row, col, weight, carried columns): the cells inside each pixel's elliptical footprint (``ewa_ellipses``).

    A cell at squared distance q <= distance_max**2 weighs exp(-alpha q / distance_max**2). alpha gives weight 0.01 at the
    edge. One pixel reaches at most (2 delta_max + 1)**2 cells, a row each: for wide footprints take ``ewa_tiles``.
    """
    hit = ewa_ellipses(placed, width, height, rows_per_scan, delta_max, distance_max, keys)
    spread = hit.withColumn("row", F.explode(F.sequence("r0", "r1"))).withColumn("col", F.explode(F.sequence("c0", "c1")))
    du, dv = F.col("col") - F.col("u"), F.col("row") - F.col("v")
    q = (F.col("qa") * du * du + F.col("qb") * du * dv + F.col("qc") * dv * dv) / F.col("qf")
    spread = spread.withColumn("q", q).where(F.col("q") <= distance_max * distance_max)
    weight = F.exp(F.col("q") * (-alpha / distance_max**2))
    return spread.select(*keys, "y", "x", F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), weight.alias("weight"), *carry)


def resample_ewa(pixels: DataFrame | None, weights: DataFrame, maximum_weight: bool = False, least_weight: float = 0.0, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, row, col, value): weighted mean of the valid pixels of a cell, or the one of largest weight.

    ``weights`` serve all products of a geolocation; for one product alone, weights that carry ``value`` need no
    join (``pixels`` None). Sums are combined before the shuffle, so cells where passes pile up are no hot spot.
    """
    joined = weights.where("value is not null") if pixels is None else pixels.where("value is not null").join(weights, ["y", "x"])
    if maximum_weight:
        best = joined.groupBy(*keys, "row", "col").agg(F.max(F.struct("weight", -F.col("y"), -F.col("x"), "value")).alias("m"))
        return best.select(*keys, "row", "col", F.col("m.value").alias("value"))
    sums = joined.groupBy(*keys, "row", "col").agg(F.sum("weight").alias("w"), F.sum(F.col("weight") * F.col("value")).alias("s"))
    return sums.where(F.col("w") > least_weight).select(*keys, "row", "col", (F.col("s") / F.col("w")).alias("value"))


def bin_average(swath: DataFrame, p: Mapping, x_min: float, y_max: float, dx: float, dy: float, width: int, height: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """Mean and count of the pixels in each cell."""
    x, y = forward(p, F.col("lon"), F.col("lat"))
    row, col = cell_of(x, y, x_min, y_max, dx, dy)
    placed = swath.withColumn("row", row.cast("int")).withColumn("col", col.cast("int"))
    placed = placed.where(F.col("row").between(0, height - 1) & F.col("col").between(0, width - 1))
    return placed.groupBy(*keys, "row", "col").agg(F.avg("value").alias("value"), F.count("value").alias("n"))


def frame_size(width: Column, height: Column, most: int = 4096) -> tuple[Column, Column]:
    """Frame size with the larger side at most ``most`` and even sides."""
    larger = F.greatest(width, height)
    scaled = lambda c: F.when(larger > most, F.floor(c * float(most) / larger)).otherwise(c)
    even = lambda c: (F.floor(scaled(c) / 2) * 2).cast("int")
    return even(width), even(height)


#: Rows that one task numbers.
ROWS_A_RANGE = 250_000


def frame_numbers(files: DataFrame, order: str = "pos", parts: int | None = None) -> DataFrame:
    """``frame`` as three digits in input order.

    Rows fall into at most ``parts`` (else one for ``ROWS_A_RANGE`` rows, 64 to 2048) ranges of ``order``, cut at values of least hash (so every evaluation
    cuts at the same ones); each range is numbered by itself, from the count of rows in the ranges before.
    """
    parts = parts or min(max(files.count() // ROWS_A_RANGE, 64), 2048)
    keys = files.select(F.col(order).alias("__k")).where("__k is not null").distinct()
    cuts = keys.orderBy(F.xxhash64("__k"), "__k").limit(16 * parts).agg(F.sort_array(F.collect_list("__k")).alias("__cuts"))
    cuts = cuts.select(F.filter("__cuts", lambda k, i: i % 16 == 15).alias("__cuts"))
    ranged = files.crossJoin(F.broadcast(cuts)).withColumn("__range", F.size(F.filter("__cuts", lambda k: k < F.col(order)))).drop("__cuts")
    counts = ranged.groupBy("__range").agg(F.count("*").alias("__n"))
    # One row a range.
    before = counts.select("__range", (F.sum("__n").over(Window.orderBy("__range")) - F.col("__n")).alias("__before"))
    numbered = ranged.withColumn("__i", F.row_number().over(Window.partitionBy("__range").orderBy(order)))
    frame = F.format_string("%03d", F.col("__before") + F.col("__i"))
    return numbered.join(F.broadcast(before), "__range").withColumn("frame", frame).select(*files.columns, "frame")
