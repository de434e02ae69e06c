"""Work on dense tiles of a grid, in Arrow batches: elliptical weighting by accumulators, filters over neighbourhoods.

A tile is a square of ``side`` cells a side and travels as one row. Accumulators are filled where the pixels are read and
meet by tile, already summed, so what is shuffled depends on the tiles a task touches instead of on the size of footprints.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Cells a side, accumulators that a task holds, cells that are weighed at once.
SIDE, HELD, AT_ONCE = 64, 256, 1 << 19
_PIXELS = ("y", "x", "u", "v", "qa", "qb", "qc", "qf", "r0", "r1", "c0", "c1", "value")


def _weighed(p: dict[str, np.ndarray], distance_max: float, alpha: float) -> Iterator[tuple[np.ndarray, ...]]:
    """(pixel, row, col, weight) of the cells within some pixels' ellipses, a bounded number at a time."""
    size = (p["r1"] - p["r0"] + 1) * (p["c1"] - p["c0"] + 1)
    order = np.argsort(np.log2(size).astype(int), kind="stable")
    at = 0
    while at < len(order):
        some = order[at : at + max(1, AT_ONCE // (4 * int(size[order[at]])))]
        high, wide = ((p[b] - p[a])[some] + 1 for a, b in (("r0", "r1"), ("c0", "c1")))
        n = np.maximum.accumulate(high) * np.maximum.accumulate(wide) * np.arange(1, len(some) + 1)
        some = some[: max(1, int(np.searchsorted(n, AT_ONCE, "right")))]
        at += len(some)
        get = lambda c: p[c][some, None, None]  # noqa: B023, E731
        rows = get("r0") + np.arange(int(high[: len(some)].max()))[None, :, None]
        cols = get("c0") + np.arange(int(wide[: len(some)].max()))[None, None, :]
        du, dv = cols - get("u"), rows - get("v")
        q = (get("qa") * du * du + get("qb") * du * dv + get("qc") * dv * dv) / get("qf")
        i, j, k = np.nonzero((q <= distance_max * distance_max) & (rows <= get("r1")) & (cols <= get("c1")))
        yield some[i], rows[i, j, 0], cols[i, 0, k], np.exp(q[i, j, k] * (-alpha / distance_max**2))


class _Means:
    """Tiles of sums of weights and of weighted values."""

    planes = 2

    @staticmethod
    def of(p, pixel, flat, weight, n) -> np.ndarray:
        return np.stack([np.bincount(flat, weight, n), np.bincount(flat, weight * p["value"][pixel], n)])

    @staticmethod
    def add(a: np.ndarray, b: np.ndarray) -> None:
        a += b

    @staticmethod
    def values(a: np.ndarray) -> np.ndarray:
        return a[1] / np.where(a[0] > 0, a[0], 1)


class _Largest:
    """Tiles of the largest weight (to nine digits) with its pixel's place and value; ties go to the lowest y, x."""

    planes = 4

    @staticmethod
    def of(p, pixel, flat, weight, n) -> np.ndarray:
        weight = np.round(weight, 9)
        y, x = p["y"][pixel], p["x"][pixel]
        order = np.lexsort((-x, -y, weight, flat))
        last = order[np.append(flat[order][1:] != flat[order][:-1], True)]
        out = np.zeros((4, n))
        out[:, flat[last]] = np.stack([weight, y, x, p["value"][pixel]])[:, last]
        return out

    @staticmethod
    def add(a: np.ndarray, b: np.ndarray) -> None:
        better = (b[0] > a[0]) | (b[0] == a[0]) & ((b[1] < a[1]) | (b[1] == a[1]) & (b[2] < a[2]))
        a[:, better] = b[:, better]

    @staticmethod
    def values(a: np.ndarray) -> np.ndarray:
        return a[3]


def ewa_tiles(ellipses: DataFrame, distance_max: float = 1.0, alpha: float = 4.60517018598809, maximum_weight: bool = False, least_weight: float = 0.0, keys: tuple[str, ...] = (), side: int = SIDE) -> DataFrame:
    """(keys, row, col, value): what ``resample_ewa`` gives, from pixels with ``value`` and their ellipses (``ewa_ellipses``).

    Each task adds its pixels to at most ``HELD`` tiles and hands those on when there are more. A cell where many
    passes pile up costs each task one tile.
    """
    kind = _Largest if maximum_weight else _Means
    pixels = ellipses.where("value is not null").select(*keys, *_PIXELS)
    named = [f"{k} {pixels.schema[k].dataType.simpleString()}" for k in keys]
    cells = side * side

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        schema = None
        for batch in batches:
            schema = schema or pa.schema([*(batch.schema.field(k) for k in keys), ("t_row", pa.int32()), ("t_col", pa.int32()), ("data", pa.binary())])
            p = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in _PIXELS}
            labels = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True)) if keys else None
            groups = {(): np.arange(batch.num_rows)}
            if labels:
                names = {label: n for n, label in enumerate(dict.fromkeys(labels))}
                code = np.array([names[x] for x in labels])
                groups = {label: np.flatnonzero(code == n) for label, n in names.items()}
            for label, members in groups.items():
                own = {c: a[members] for c, a in p.items()}
                for pixel, row, col, weight in _weighed(own, distance_max, alpha):
                    _put(held, label, own, pixel, row, col, weight)
                if len(held) > HELD:
                    yield _rows(held, schema)
                    held = {}
        if held:
            yield _rows(held, schema)

    def _put(held, label, p, pixel, row, col, weight) -> None:
        if not len(pixel):
            return
        r0, c0 = row.min() // side, col.min() // side
        high, wide = row.max() // side - r0 + 1, col.max() // side - c0 + 1
        if high * wide > 64 and pixel[0] != pixel[-1]:
            half = len(pixel) // 2
            for part in (slice(None, half), slice(half, None)):
                _put(held, label, p, pixel[part], row[part], col[part], weight[part])
            return
        tile = (row // side - r0) * wide + col // side - c0
        flat = (tile * cells + row % side * side + col % side).astype(np.int64)
        full = kind.of(p, pixel, flat, weight, int(high * wide * cells)).reshape(kind.planes, -1, cells)
        for t in np.flatnonzero((full[0] > 0).any(axis=1)):
            at = (*label, int(r0 + t // wide), int(c0 + t % wide))
            if at in held:
                kind.add(held[at], full[:, t])
            else:
                held[at] = full[:, t].copy()

    def _rows(held, schema) -> pa.RecordBatch:
        columns = [*zip(*held), [a.tobytes() for a in held.values()]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total, schema = None, None, None
        for batch in batches:
            schema = schema or pa.schema([*(batch.schema.field(k) for k in keys), ("row", pa.int32()), ("col", pa.int32()), ("value", pa.float64())])
            for *at, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = np.frombuffer(data).reshape(kind.planes, cells)
                if at == last:
                    kind.add(total, part)
                    continue
                if last is not None:
                    yield _cells(last, total, schema)
                last, total = at, part.copy()
        if last is not None:
            yield _cells(last, total, schema)

    def _cells(at, total, schema) -> pa.RecordBatch:
        full = np.flatnonzero((total[0] > 0) & (total[0] > least_weight))
        *label, t_row, t_col = at
        values = [*([x] * len(full) for x in label), t_row * side + full // side, t_col * side + full % side, kind.values(total)[full]]
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

    parts = pixels.mapInArrow(fill, ", ".join([*named, "t_row int", "t_col int", "data binary"]))
    tile = [*keys, "t_row", "t_col"]
    return parts.repartition(*tile).sortWithinPartitions(*tile).mapInArrow(merge, ", ".join([*named, "row int", "col int", "value double"]))


def neighbourhood(grid: DataFrame, function: Callable[..., np.ndarray], values: tuple[str, ...] = ("value",), halo: int = 1, keys: tuple[str, ...] = (), side: int = SIDE, out: str = "value") -> DataFrame:
    """(keys, row, col, out): a function of each cell's surroundings, for filters that no Column can express.

    ``function`` gets an array for each of ``values`` with a tile and ``halo`` cells around it (NaN where the grid has no cell or a
    null) and returns an array of the same shape, of which the tile is kept; NaN becomes null. A cell goes to its own
    tile and to those within ``halo`` cells, so results don't depend on where tiles end. Cells of the grid alone are
    returned. One tile with its halo is what a task holds.
    """
    named = [f"`{k}` {grid.schema[k].dataType.simpleString()}" for k in keys]
    reach = lambda c: F.sequence(F.floor((F.col(c) - halo) / side), F.floor((F.col(c) + halo) / side))
    spread = grid.select(*keys, F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), *[F.col(v).cast("double").alias(f"v{n}") for n, v in enumerate(values)])
    spread = spread.withColumn("t_row", F.explode(reach("row"))).withColumn("t_col", F.explode(reach("col")))
    wide = side + 2 * halo

    def run(tile: pa.Table) -> pa.Table:
        t_row, t_col = tile.column("t_row")[0].as_py(), tile.column("t_col")[0].as_py()
        row, col = tile.column("row").to_numpy() - t_row * side + halo, tile.column("col").to_numpy() - t_col * side + halo
        planes = []
        for n in range(len(values)):
            plane = np.full((wide, wide), np.nan)
            plane[row, col] = tile.column(f"v{n}").to_numpy()
            planes.append(plane)
        made = np.asarray(function(*planes), float)
        own = (row >= halo) & (row < halo + side) & (col >= halo) & (col < halo + side)
        kept = tile.filter(pa.array(own))
        found = made[row[own], col[own]]
        columns = {k: kept.column(k) for k in keys} | {"row": kept.column("row"), "col": kept.column("col"), out: pa.array(found, mask=np.isnan(found))}
        return pa.table(columns)

    return spread.groupBy(*keys, "t_row", "t_col").applyInArrow(run, ", ".join([*named, "row long", "col long", f"`{out}` double"]))
