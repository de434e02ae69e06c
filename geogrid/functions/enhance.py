"""Value scaling, colours and quantization as Column expressions. Null is "no data" throughout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from geogrid.sources.builtin_colors import color_tables

#: Limits of the logical types, which Spark's types may exceed.
DTYPES = {
    "uint8": (0, 255, "short"),
    "uint16": (0, 65535, "int"),
    "uint32": (0, 4294967295, "long"),
    "uint64": (0, 18446744073709551615, "decimal(20,0)"),
    "int8": (-128, 127, "byte"),
    "int16": (-32768, 32767, "short"),
    "int32": (-2147483648, 2147483647, "int"),
    "int64": (-9223372036854775808, 9223372036854775807, "long"),
    "float32": (None, None, "float"),
    "float64": (None, None, "double"),
}


def clamp(v: Column, lo: float, hi: float) -> Column:
    """v within [lo, hi]; null stays null (greatest and least alone would skip it)."""
    return F.when(v.isNotNull(), F.least(F.greatest(v, F.lit(lo)), F.lit(hi)))


def sunz_correct(v: Column, sza: Column, max_angle: float | None = None) -> Column:
    """v / cos(sza); beyond ``max_angle`` the angle counts as that."""
    angle = F.least(sza, F.lit(float(max_angle))) if max_angle is not None else sza
    return v / F.cos(F.radians(angle))


def crude_stretch(v: Column, lo: float, hi: float) -> Column:
    """(v - lo) / (hi - lo); lo > hi inverts."""
    return (v - lo) / (float(hi) - float(lo))


def linear_stretch(v: Column, lo: Column, hi: Column) -> Column:
    """Stretch between data limits; a constant band gives 0."""
    return F.when(v.isNotNull(), F.coalesce(F.try_divide(v - lo, hi - lo), F.lit(0.0)))


def gamma_stretch(v: Column, g: float) -> Column:
    return F.when(v >= 0, F.pow(v, F.lit(1.0 / g)))


def btemp_threshold(v: Column, lo: float, hi: float, threshold: float, break_at: float = 176.0 / 255.0) -> Column:
    """Two-slope inverted stretch: cold values to [break, 1], warm ones to [0, break]."""
    cold = F.lit(1.0) - (v - lo) * ((1.0 - break_at) / (threshold - lo))
    warm = F.lit(break_at) - (v - threshold) * (break_at / (hi - threshold))
    return F.when(v >= threshold, warm).when(v.isNotNull(), cold)


def piecewise_linear(v: Column, xp: Sequence[float], fp: Sequence[float], reference: float | None = None) -> Column:
    """Linear between control points, clamped at the ends; ``reference`` divides both axes."""
    k = float(reference or 1.0)
    xp, fp = [x / k for x in xp], [y / k for y in fp]
    out = F.when(v <= xp[0], F.lit(fp[0]))
    for x0, x1, y0, y1 in zip(xp, xp[1:], fp, fp[1:], strict=False):
        if x1 > x0:
            out = out.when(v <= x1, F.lit(y1) - (F.lit(x1) - v) * ((y1 - y0) / (x1 - x0)))
    return out.when(v > xp[-1], F.lit(fp[-1]))


def temperature_difference(v: Column, lo: float = -10.0, hi: float = 10.0) -> Column:
    """Differences to 5..205 of 255, with 4 and 206 for what lies outside."""
    scaled = crude_stretch(v, lo, hi) * (200.0 / 255.0)
    return clamp(scaled, -1.0 / 255.0, 201.0 / 255.0) + 5.0 / 255.0


def cloud_layers_lmh(mask: Column) -> Column:
    """Low (bits 0, 1), middle (2, 3) and high (4) cloud as 1 + 2 + 4."""

    def any_bit(bits: int, value: int) -> Column:
        return F.when(mask.bitwiseAND(F.lit(bits)) != 0, F.lit(value)).otherwise(F.lit(0))

    return F.when(mask.isNotNull(), any_bit(0b11, 1) + any_bit(0b1100, 2) + any_bit(0b10000, 4))


def clip_to_dtype(v: Column, dtype: str) -> Column:
    lo, hi, _ = DTYPES[dtype]
    return v if lo is None else clamp(v, float(lo), float(hi))


def quantize(v: Column, src: str, dst: str, enhanced: bool = False, fill: float = 0) -> Column:
    """A value of type ``src`` as ``dst``: enhanced floats are scaled to the integer range, then values are
    clipped and truncated; null becomes ``fill`` (before the cast, so that no missing value is lost)."""
    lo, hi, kind = DTYPES[dst]
    if lo is None:
        return F.coalesce(v.cast(kind), F.lit(fill).cast(kind)) if not src.startswith("float") else v.cast(kind)
    if src.startswith("float") and enhanced:
        v = v * float(hi - lo) + float(lo)
    # The largest 64-bit integers are no doubles; the next ones below are.
    top = float(hi) if abs(hi) < 2**53 else float(hi) * (1 - 2.0**-53)
    clipped = F.when(v.isNotNull() & ~F.isnan(v.cast("double")), F.least(F.greatest(v.cast("double"), F.lit(float(lo))), F.lit(top)))
    whole = F.when(clipped >= 0, F.floor(clipped.cast("decimal(38,10)") if hi > 2**62 else clipped)).otherwise(F.ceil(clipped))
    return F.coalesce(whole.cast(kind), F.lit(fill).cast(kind))


def default_output_dtype(dtype: str) -> str:
    return "float32" if dtype == "float64" else dtype


def alpha(v: Column) -> Column:
    return F.when(v.isNull(), F.lit(0)).otherwise(F.lit(255))


def to_rgba(mode: str, *bands: Column) -> Column:
    """L, LA, RGB or RGBA bands as struct(r, g, b, a) of 0..255; a missing alpha marks valid data."""
    if mode in ("L", "LA"):
        r = g = b = bands[0]
    else:
        r, g, b = bands[:3]
    a = bands[-1] if mode.endswith("A") else F.when(r.isNull() | g.isNull() | b.isNull(), F.lit(0)).otherwise(F.lit(255))
    return F.struct(r.alias("r"), g.alias("g"), b.alias("b"), a.alias("a"))


def snap(v: Column, tolerance: float = 0.001) -> Column:
    """The nearest integer if within the tolerance."""
    return F.when(F.abs(v - F.rint(v)) <= tolerance, F.rint(v)).otherwise(v)


def color_limits(scale: Column, offset: Column, dtype: str, arg_min: float | None = None, arg_max: float | None = None) -> tuple[Column, Column]:
    """Value limits of an integer image: given ones, or from scale and offset, or the type's.

    A NaN scale or offset tells of a non-linear scaling and raises.
    """
    lo, hi, _ = DTYPES[dtype]
    if arg_min is not None:
        return F.lit(float(arg_min)), F.lit(float(arg_max))
    bad = F.isnan(scale) | F.isnan(offset)
    fail = F.raise_error(F.lit("limits can't follow from a NaN scale or offset")).cast("double")
    vmin = F.when(scale.isNull(), F.lit(float(lo))).when(bad, fail).otherwise(snap(offset))
    vmax = F.when(scale.isNull(), F.lit(float(hi))).when(bad, fail).otherwise(snap(scale * float(hi - lo) + offset))
    return vmin, vmax


def _points(values: Sequence[float], lo: float | None, hi: float | None) -> list[float]:
    if lo is None or hi is None:
        return [float(v) for v in values]
    first, last = float(values[0]), float(values[-1])
    return [lo + (float(v) - first) / (last - first) * (hi - lo) for v in values]


def colorize(v: Column, values: Sequence[float], colors: Sequence[Sequence[float]], lo: float | None = None, hi: float | None = None) -> Column:
    """struct(r, g, b, a), linear between control points and clamped; lo > hi reverses the range.

    ``values`` may step (equal or nearly equal neighbours), as in category tables. Colours without
    alpha have alpha 255.
    """
    at = _points(values, lo, hi)
    rows = sorted(zip(at, ([*map(float, c), 255.0][:4] for c in colors), strict=True), key=lambda x: x[0])
    xs = [x for x, _ in rows]
    out = [piecewise_linear(v, xs, [c[k] for _, c in rows]).alias(name) for k, name in enumerate("rgba")]
    return F.when(v.isNotNull(), F.struct(*out))


def palettize(v: Column, values: Sequence[float], lo: float | None = None, hi: float | None = None) -> Column:
    """Index of the last control point not above v, clamped to the table."""
    at = _points(values, lo, hi)
    up = at[-1] >= at[0]
    out = F.lit(0)
    for k, x in enumerate(at[1:], 1):
        out = F.when((v >= x) if up else (v <= x), F.lit(k)).otherwise(out) if up else F.when(v <= x, F.lit(k)).otherwise(out)
    return F.when(v.isNotNull(), out)


def erf(x: Column) -> Column:
    """Error function (Abramowitz and Stegun 7.1.26, error below 1.5e-7)."""
    ax = F.abs(x)
    t = F.lit(1.0) / (ax * 0.3275911 + 1)
    poly = F.lit(1.061405429)
    for c in (-1.453152027, 1.421413741, -0.284496736, 0.254829592):
        poly = poly * t + c
    return F.signum(x) * (F.lit(1.0) - poly * t * F.exp(-ax * ax))


def isclose(a: Column, b: Column, atol: float = 0.0, rtol: float = 0.0) -> Column:
    """|a - b| <= atol + rtol |b|; two missing values are equal, one is not. b is the actual value."""
    gone_a, gone_b = a.isNull() | F.isnan(a.cast("double")), b.isNull() | F.isnan(b.cast("double"))
    close = F.abs(a - b) <= F.lit(float(atol)) + F.abs(b) * float(rtol)
    return F.when(gone_a | gone_b, gone_a & gone_b).otherwise(close)


#: Enhancement methods by name, for rules; users add theirs with ``register_enhancement``.
METHODS: dict = {
    "crude": lambda v, min_stretch, max_stretch: crude_stretch(v, min_stretch, max_stretch),
    "gamma": lambda v, gamma: gamma_stretch(v, gamma),
    "btemp_threshold": lambda v, min_in, max_in, threshold: btemp_threshold(v, min_in, max_in, threshold),
    "piecewise_linear": lambda v, xp, fp, reference_scale_factor=None: piecewise_linear(v, xp, fp, reference_scale_factor),
    "temperature_difference": lambda v, min_stretch=-10.0, max_stretch=10.0: temperature_difference(v, min_stretch, max_stretch),
    "cloud_layers": lambda v: cloud_layers_lmh(v.cast("int")),
    "colorize": lambda v, table, lo=None, hi=None: colorize(v, *palette(table), lo, hi),
}

#: Colour tables by name: positions and colours; users add theirs with ``register_palette``.
PALETTES: dict[str, tuple[list[float], list[tuple[int, ...]]]] = color_tables()


def register_palette(name: str, values: Sequence[float], colors: Sequence[Sequence[float]]) -> None:
    """A user's colour table under a name that rules may use."""
    PALETTES[name] = (list(values), [tuple(c) for c in colors])


def palette(name: str) -> tuple[list[float], list[tuple[int, ...]]]:
    if name not in PALETTES:
        raise ValueError(f"colour table {name!r} is not builtin: read it with tables.read_colormap and register it")
    return PALETTES[name]


def colormap_256(values: Sequence[float], colors: Sequence[Sequence[float]], index: Column) -> Column:
    """A colour table of 0..1 at ``index`` / 255, as whole levels of 0..255 (halves to even)."""
    c = colorize(index / 255.0, values, colors)
    level = lambda n: F.bround(F.least(F.greatest(c[n], F.lit(0.0)), F.lit(1.0)) * 255).cast("int").alias(n)
    return F.when(index.isNotNull(), F.struct(level("r"), level("g"), level("b")))


def register_enhancement(name: str, method) -> None:
    """``method(Column, **kwargs) -> Column`` under a name that rules may use."""
    METHODS[name] = method


def apply_operations(v: Column, operations: Sequence[tuple[str, dict]], limits: tuple[Column, Column] | None = None) -> Column:
    """The operations in order; an empty list leaves the value. ``auto`` stretches between ``limits``."""
    for name, kwargs in operations:
        if name == "auto":
            if limits is None:
                raise ValueError("an auto stretch needs the data's limits")
            v = linear_stretch(v, *limits)
        else:
            v = METHODS[name](v, **kwargs)
    return v


def tile_number(row: Column, col: Column, n_rows: int, n_cols: int, tiles: tuple[int, int] | None = None, size: tuple[int, int] | None = None) -> Column:
    """1-based tile from the upper left along columns; a pixel size overrides the counts."""
    if size is None:
        size = (-(-n_rows // tiles[0]), -(-n_cols // tiles[1]))
    across = -(-n_cols // size[1])
    return (F.floor(row / size[0]) * across + F.floor(col / size[1]) + 1).cast("int")


def tile_letter(x: Column, y: Column, x0: float, y0: float, width: float, height: float, across: int) -> Column:
    """Letter and 2 x 2 part of a fixed tile grid in projection space, from its upper-left corner; null outside."""
    u, w = (x - x0) / width, (F.lit(y0) - y) / height
    number = (F.floor(w) * across + F.floor(u)).cast("int")
    part = (F.floor((w - F.floor(w)) * 2) * 2 + F.floor((u - F.floor(u)) * 2) + 1).cast("int")
    inside = (u >= 0) & (u < across) & (w >= 0) & (number < 26)
    return F.when(inside, F.concat(F.char(number + 65), F.lpad(part.cast("string"), 2, "0")))


def tile_shift(origin: Column, tile_origin: float, pixel: float) -> Column:
    """The offset (at most half a pixel) that moves a sector's origin onto the tile grid."""
    steps = (origin - tile_origin) / pixel
    return (F.rint(steps) - steps) * pixel
