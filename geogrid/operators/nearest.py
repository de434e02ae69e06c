"""Nearest pixels by an index that adapts to density: octree cells along a Morton curve, split until few points are left.

Points of the unit sphere get the number of their smallest cell, three bits a level behind a leading one, so that a
cell's parent is its number shifted by three bits and cells of all levels have different numbers. Cells are counted from
coarse to fine, only crowded ones further down; a leaf holds a bounded number of pixels and of targets.

Each target is first compared with the pixels of its own leaf. Where the distance found (or the radius) reaches over the
leaf's edge, the leaves whose pixels' box is near enough follow. So a target is copied only where it lies at an edge, and
neither dense pixels nor wide gaps make a hot key.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geogrid.functions.projections import EARTH_RADIUS, unit_sphere
from geogrid.sources.shared import checkpointed

#: Levels of cells (the smallest is some 12 metres wide), those at which cells are counted, points in a leaf.
LEVELS, BANDS, FULL = 20, (8, 12, 16, 20), 1024
#: Distances that are computed at once.
AT_ONCE = 1 << 21


def _spread(n: Column) -> Column:
    """The bits of a number below 2**20, three apart."""
    for step, mask in ((32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249)):
        n = n.bitwiseOR(F.shiftleft(n, step)).bitwiseAND(F.lit(mask))
    return n


def _cell(x: Column, y: Column, z: Column) -> Column:
    """Number of the smallest cell that holds a point, or of the cell with these whole coordinates."""
    one, two, three = (_spread(c.cast("long")) for c in (x, y, z))
    return F.lit(1 << (3 * LEVELS)).bitwiseOR(one).bitwiseOR(F.shiftleft(two, 1)).bitwiseOR(F.shiftleft(three, 2))


def _whole(c: Column) -> Column:
    return F.least(F.greatest(F.floor((c + 1) * (1 << (LEVELS - 1))), F.lit(0)), F.lit((1 << LEVELS) - 1))


def _at(cell: Column, level: int) -> Column:
    """The ancestor of a smallest cell at a level."""
    return F.shiftright(cell, 3 * (LEVELS - level))


def _up(cell: Column, levels: Column) -> Column:
    return F.call_function("shiftright", cell, (levels * 3).cast("int"))


def _placed(df: DataFrame) -> DataFrame:
    known = df.where("lon is not null and lat is not null and not isnan(lon) and not isnan(lat)")
    out = known.withColumns(dict(zip(("px", "py", "pz"), unit_sphere(F.col("lon"), F.col("lat")), strict=True)))
    return out.withColumn("cell", _cell(*(_whole(F.col(c)) for c in ("px", "py", "pz"))))


def leaves(points: DataFrame, full: int = FULL) -> list[tuple[int, DataFrame]]:
    """For each of ``BANDS`` the cells of that level and the ``leaf`` that holds them, null where that is a smaller one.

    ``points`` has ``cell`` and ``target`` (boolean). A leaf is the largest cell with at most ``full`` pixels and as many
    targets. Points of one smallest cell stay together.
    """
    out, left, top = [], points.select("cell", "target"), 0
    for level in BANDS:
        counts = left.groupBy(_at(F.col("cell"), level).alias("band")).agg(F.count_if("target").alias("t"), F.count_if(~F.col("target")).alias("s"))
        counts = checkpointed(counts)
        up = counts.select("*", F.explode(F.sequence(F.lit(top), F.lit(level))).alias("level"))
        up = up.withColumn("at", _up(F.col("band"), level - F.col("level")))
        sums = up.groupBy("at").agg(F.sum("t").alias("t"), F.sum("s").alias("s"))
        fits = sums.where(((F.col("t") <= full) & (F.col("s") <= full)) | (F.lit(level == LEVELS) & (F.length(F.bin("at")) == 3 * LEVELS + 1))).select("at")
        found = up.join(fits, "at").groupBy("band").agg(F.min_by("at", "level").alias("leaf"))
        table = checkpointed(counts.select("band").join(found, "band", "left"))
        out.append((level, table))
        crowded = table.where("leaf is null").select("band")
        if level == LEVELS or crowded.isEmpty():
            break
        left = left.join(crowded, _at(F.col("cell"), level) == F.col("band"), "left_semi")
        top = level + 1
    return out


def _in_leaves(points: DataFrame, tables: list[tuple[int, DataFrame]]) -> DataFrame:
    parts, left = [], points
    for level, table in tables:
        met = left.withColumn("band", _at(F.col("cell"), level)).join(table, "band").drop("band")
        parts.append(met.where("leaf is not null"))
        left = met.where("leaf is null").drop("leaf")
    return reduce(DataFrame.unionByName, parts)


def _meet(both: DataFrame, carry: tuple[str, ...], radius: float) -> DataFrame:
    """Each target (leaf, part, row, col, p) with the nearest of its leaf's pixels: distance ``d``, y, x, carried columns."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in both.schema.fields if f.name not in ("part", "target"))
    names = [c for c in both.columns if c not in ("part", "target")]
    own = ["y", "x", *carry]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, pixels, held = None, None, []
        for batch in batches:
            marks = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("leaf", "part", "target")])
            cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
            for i, j in zip(np.append(0, cuts), np.append(cuts, batch.num_rows), strict=True):
                if j == i:
                    continue
                now, is_target = (marks[0, i], marks[1, i]), marks[2, i]
                if now != key:
                    key, held, pixels = now, [], None
                part = batch.slice(i, j - i)
                if not is_target:
                    held.append(part)
                    continue
                if pixels is None:
                    pixels = pa.Table.from_batches(held, batch.schema).sort_by([("y", "ascending"), ("x", "ascending")]) if held else batch.schema.empty_table()
                    place = np.stack([pixels.column(c).to_numpy() for c in ("px", "py", "pz")], axis=1).astype(float)
                step = max(1, AT_ONCE // max(1, len(place)))
                for a in range(0, part.num_rows, step):
                    some = part.slice(a, step)
                    yield nearest(some, pixels, place)

    def nearest(targets: pa.RecordBatch, pixels: pa.Table, place: np.ndarray) -> pa.RecordBatch:
        p = np.stack([targets.column(c).to_numpy() for c in ("px", "py", "pz")], axis=1)
        columns = {c: targets.column(c) for c in names}
        if len(place):
            d2 = np.zeros((len(p), len(place)))
            for k in range(3):
                d2 += (p[:, k, None] - place[None, :, k]) ** 2
            best = d2.argmin(axis=1)
            d = np.sqrt(d2[np.arange(len(p)), best]) * EARTH_RADIUS
            near = d <= radius
            index = pa.array(np.where(near, best, 0), mask=~near)
            columns["d"] = pa.array(d, mask=~near)
            for c in own:
                columns[c] = pixels.column(c).combine_chunks().take(index)
        return pa.RecordBatch.from_arrays([columns[c] for c in names], names)

    dealt = both.repartition("leaf", "part").sortWithinPartitions("leaf", "part", "target")
    return dealt.mapInArrow(run, kinds)


def _box_distance(farthest: bool) -> Column:
    """Distance in metres from a target to a box of pixels, or to its farthest corner."""
    total = F.lit(0.0)
    for k in "xyz":
        p, lo, hi = (F.col(f"{c}{k}") for c in ("p", "lo_", "hi_"))
        d = F.greatest(F.abs(p - lo), F.abs(p - hi)) if farthest else F.greatest(lo - p, p - hi, F.lit(0.0))
        total = total + d * d
    return F.sqrt(total) * EARTH_RADIUS


def nearest_adaptive(cells: DataFrame, swath: DataFrame, radius: float, carry: tuple[str, ...] = (), full: int = FULL) -> DataFrame:
    """(row, col, y, x, distance, carried columns): what ``resample.nearest_index`` gives, for any density of pixels.

    Ties go to the lowest y, x. Cells and pixels without a place are passed over.
    """
    targets = _placed(cells.select("row", "col", "lon", "lat")).drop("lon", "lat")
    pixels = _placed(swath.select("y", "x", "lon", "lat", *carry)).drop("lon", "lat")
    marked = targets.select("cell", F.lit(True).alias("target")).unionByName(pixels.select("cell", F.lit(False).alias("target")))
    tables = leaves(marked, full)
    sources = checkpointed(_in_leaves(pixels, tables))
    blank = [F.lit(None).cast(swath.schema[c].dataType).alias(c) for c in ("y", "x", *carry)]
    asked = _in_leaves(targets, tables).select("leaf", "cell", "row", "col", "px", "py", "pz", F.lit(None).cast("double").alias("d"), *blank)
    own = [F.lit(None).cast(cells.schema[c].dataType).alias(c) for c in ("row", "col")]
    given = sources.select("leaf", "cell", *own, "px", "py", "pz", F.lit(None).cast("double").alias("d"), "y", "x", *carry)

    def both(rows: DataFrame, pixels: DataFrame) -> DataFrame:
        return rows.withColumn("target", F.lit(True)).unionByName(pixels.withColumn("target", F.lit(False)))

    first = checkpointed(_meet(both(asked.withColumn("part", F.lit(0)), given.withColumn("part", F.lit(0))), carry, radius))
    reach = F.least(F.coalesce("d", F.lit(float(radius))), F.lit(float(radius))) / EARTH_RADIUS * (1 + 1e-9)
    level = ((F.length(F.bin("leaf")) - 1) / 3).cast("int")
    side = F.pow(F.lit(2.0), 1 - level)
    into = [(F.col(p) + 1) - F.floor((F.col(p) + 1) / side) * side for p in ("px", "py", "pz")]
    inside = F.least(*into, *[side - c for c in into]) > reach
    open_ = first.where(~inside).select("row", "col", "px", "py", "pz", F.col("leaf").alias("home"), reach.alias("reach"))
    boxes = sources.groupBy("leaf").agg(*[f(f"p{k}").alias(f"{n}_{k}") for k in "xyz" for n, f in (("lo", F.min), ("hi", F.max))])
    boxes = checkpointed(boxes.withColumn("level", level))
    lowest = boxes.agg(F.min("level")).first()[0]
    if lowest is None:
        return _result(first, carry)
    at = F.least(F.greatest(F.floor(-F.log2("reach")).cast("int"), F.lit(0)), F.lit(LEVELS))
    corner = lambda p, sign: _whole(F.col(p) + sign * F.col("reach"))
    ranges = [F.array_distinct(F.array(corner(p, -1), corner(p, 1))) for p in ("px", "py", "pz")]
    asked = open_.withColumn("at", at)
    for name, both_ends in zip("ijk", ranges, strict=True):
        asked = asked.withColumn(name, F.explode(both_ends))
    asked = asked.withColumn("near", _up(_cell(F.col("i"), F.col("j"), F.col("k")), LEVELS - F.col("at"))).drop("i", "j", "k").distinct()
    steps = F.sequence(F.lit(0), F.greatest(F.col("at") - lowest, F.lit(0)))
    asked = asked.withColumn("up", F.explode(steps)).withColumn("key", _up(F.col("near"), F.col("up")))
    known = boxes.withColumn("down", F.explode(F.sequence(F.lit(0), F.col("level")))).withColumn("key", _up(F.col("leaf"), F.col("down")))
    met = asked.join(known, "key").where("(up = 0 or down = 0) and leaf <> home")
    met = met.withColumn("least", _box_distance(False)).where(F.col("least") <= F.col("reach") * EARTH_RADIUS)
    met = met.select("row", "col", "px", "py", "pz", "leaf", "least", _box_distance(True).alias("most")).distinct()
    sure = F.min("most").over(Window.partitionBy("row", "col"))
    pairs = checkpointed(met.withColumn("sure", sure).where(F.col("least") <= F.col("sure") * (1 + 1e-9)).select("row", "col", "px", "py", "pz", "leaf"))
    parts = pairs.groupBy("leaf").agg(F.ceil(F.count("*") / full).cast("int").alias("parts"))
    more = pairs.join(parts, "leaf").select("leaf", F.lit(None).cast("long").alias("cell"), "row", "col", "px", "py", "pz", F.lit(None).cast("double").alias("d"), *blank, F.pmod(F.xxhash64("row", "col"), F.col("parts")).cast("int").alias("part"))
    copies = given.join(parts, "leaf").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    return _result(first.unionByName(_meet(both(more, copies), carry, radius)), carry)


def _result(found: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    best = found.where("d is not null").groupBy("row", "col").agg(F.min(F.struct("d", "y", "x", *carry)).alias("m"))
    return best.select("row", "col", "m.y", "m.x", F.col("m.d").alias("distance"), *[f"m.{c}" for c in carry])
