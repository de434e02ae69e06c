"""Queries of resampling, composites, mosaics, comparison and sinks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geogrid.functions import enhance
from geogrid.operators import compare, composites, grids, mosaic, nearest, resample, sinks, tiles
from geogrid.operators.enhancement import data_limits
from geogrid.plans.scalar_queries import LCC, r
from geogrid.plans.views import BANDS, SWATH
from geogrid.plans.views import bands as bands_view
from geogrid.plans.views import swath as swath_view
from geogrid.sources import band_store
from geogrid.sources.shared import shared_folder

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_RAD = "(pi()/180)"
#: Holds every pixel of the swath view.
_GRID = {"x_min": -2003000.0, "y_max": 8007000.0, "dx": 20000.0, "dy": 20000.0, "width": 720, "height": 480}
_T0 = f"tan(pi()/4-25*{_RAD}/2)"
_XY = f"""xy as (select y, x, product, value, sza, 6371200.0*cos(25*{_RAD})/(sin(25*{_RAD})*pow({_T0}, sin(25*{_RAD})))*pow(tan(pi()/4-lat*{_RAD}/2), sin(25*{_RAD})) as rho, sin(25*{_RAD})*(lon+95)*{_RAD} as th, 6371200.0*cos(25*{_RAD})/sin(25*{_RAD}) as rho0 from swath),
cell as (select y, x, product, value, sza, cast(floor((8007000.0 - (rho0 - rho*cos(th)))/20000.0) as int) as row, cast(floor((rho*sin(th) + 2003000.0)/20000.0) as int) as col from xy)"""


@query(f"""with {SWATH}, {_XY}, b as (select product, row, col, avg(value) as v, count(value) as n from cell where row between 0 and 479 and col between 0 and 719 group by 1, 2, 3)
select product, row, col, n, cast(trunc(least(greatest(round(v/500.0, 9)*255, 0.0), 255.0)) as smallint) as level, 255 as alpha from b""")
def flagship_grid_image(spark: SparkSession, d: str) -> DataFrame:
    """Swath to projected cells, block mean, stretch, byte levels and alpha."""
    got = resample.bin_average(swath_view(spark, d), LCC, keys=("product",), **_GRID)
    level = enhance.quantize(F.round(enhance.crude_stretch(F.col("value"), 0, 500), 9), "float64", "uint8", enhanced=True)
    return got.select("product", "row", "col", "n", level.alias("level"), enhance.alpha(F.col("value")).alias("alpha"))


@query(f"with {SWATH}, i(k) as (select unnest(range(2))) select cast(y*2 + a.k as int) as row, cast(x*2 + b.k as int) as col, value from swath, i a, i b where y < 1000000")
def r1_native_up(spark: SparkSession, d: str) -> DataFrame:
    return resample.native_up(swath_view(spark, d).select("y", "x", "value"), 2).select(F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), "value")


@query(f"with {SWATH} select product, cast(floor(y/4.0) as int) as row, cast(floor(x/4.0) as int) as col, round(avg(value), 6) + 0.0 as value from swath group by 1, 2, 3")
def r2_a1_native_down(spark: SparkSession, d: str) -> DataFrame:
    return resample.native_down(swath_view(spark, d), 4, keys=("product",)).withColumn("value", r(F.col("value")))


@query(f"""with {SWATH}, f(factor) as (values (2), (4)) select factor, cast(floor(y/factor) as int) as row, cast(floor(x/factor) as int) as col, round(avg(value), 6) + 0.0 as value, arg_min(value, y*1000 + x) as first from swath, f group by factor, floor(y/factor), floor(x/factor)""".replace("floor(y/factor)", "floor(cast(y as double)/factor)").replace("floor(x/factor)", "floor(cast(x as double)/factor)"))
def r15_pyramid(spark: SparkSession, d: str) -> DataFrame:
    g = swath_view(spark, d).select(F.col("y").alias("row"), F.col("x").alias("col"), "value")
    mean = resample.pyramid(g, [2, 4]).withColumn("value", r(F.col("value")))
    first = resample.pyramid(g, [2, 4], "nearest").withColumnRenamed("value", "first")
    return mean.join(first, ["factor", "row", "col"])


@query(ORACLES["r15_pyramid"])
def r15_pyramid_cascade(spark: SparkSession, d: str) -> DataFrame:
    """Each level from the one before it."""
    g = swath_view(spark, d).select(F.col("y").alias("row"), F.col("x").alias("col"), "value")
    mean = resample.pyramid_cascade(g, [2, 4]).withColumn("value", r(F.col("value")))
    first = resample.pyramid_cascade(g, [2, 4], "nearest").withColumnRenamed("value", "first")
    return mean.join(first, ["factor", "row", "col"])


def _mean3(v: np.ndarray) -> np.ndarray:
    """Mean of the valid cells among a cell and the eight around it."""
    known = ~np.isnan(v)
    total, count = np.zeros_like(v), np.zeros_like(v)
    for a in (slice(None, -2), slice(1, -1), slice(2, None)):
        for b in (slice(None, -2), slice(1, -1), slice(2, None)):
            total[1:-1, 1:-1] += np.where(known, v, 0)[a, b]
            count[1:-1, 1:-1] += known[a, b]
    return np.where(count > 0, total / np.where(count > 0, count, 1), np.nan)


@query(f"""with {SWATH}, near as (select a.y, a.x, b.value from swath as a cross join (values (-1), (0), (1)) as i(dy) cross join (values (-1), (0), (1)) as j(dx)
 join swath as b on b.y = a.y + dy and b.x = a.x + dx) select cast(y as bigint) as row, cast(x as bigint) as col, round(avg(value), 6) + 0.0 as smooth from near group by y, x""")
def u1_surroundings(spark: SparkSession, d: str) -> DataFrame:
    """A user's filter of 3 x 3 cells over tiles with a halo."""
    composites.register_surroundings("smooth", ["value"], _mean3)
    g = swath_view(spark, d).select(F.col("y").cast("long").alias("row"), F.col("x").cast("long").alias("col"), "value")
    return composites.apply_surroundings(g, ["smooth"]).select("row", "col", r(F.col("smooth")).alias("smooth"))


@query("""with q as (select l_returnflag, cast(l_linenumber as int) as l_linenumber, count(*) as n, quantile_cont(l_extendedprice, [0.0, 0.25, 0.5, 0.9, 1.0]) as qs from lineitem group by 1, 2),
u as (select l_returnflag, l_linenumber, n, unnest([0.0, 0.25, 0.5, 0.9, 1.0]) as share, unnest(qs) as v from q)
select l_returnflag, l_linenumber, n, cast(share as double) as share, round(v, 5) + 0.0 as quantile from u""")
def a11_grouped_quantiles(spark: SparkSession, d: str) -> DataFrame:
    lines = spark.read.parquet(f"{d}/lineitem.parquet")
    found = compare.grouped_quantiles(lines, ("l_returnflag", "l_linenumber"), "l_extendedprice", (0.0, 0.25, 0.5, 0.9, 1.0))
    return found.select("l_returnflag", F.col("l_linenumber").cast("int").alias("l_linenumber"), "n", "share", r(F.col("quantile"), 5).alias("quantile"))


@query(f"""with {SWATH}, g as (select y as row, x as col, value, (y + 0.5)/5.0 - 0.5 as u, (x + 0.5)/5.0 - 0.5 as w from swath), m as (select floor(max(row)/5.0) as r1, floor(max(col)/5.0) as c1 from g),
s as (select value, u, w, unnest(range(cast(floor(u) as bigint), cast(floor(u) as bigint) + 2)) as r from g), t as (select *, unnest(range(cast(floor(w) as bigint), cast(floor(w) as bigint) + 2)) as c from s)
select cast(r as int) as row, cast(c as int) as col, round(sum((1-abs(u-r))*(1-abs(w-c))*value)/sum((1-abs(u-r))*(1-abs(w-c))), 8) + 0.0 as value from t, m where r between 0 and r1 and c between 0 and c1 group by r, c""")
def r15_kernel(spark: SparkSession, d: str) -> DataFrame:
    g = swath_view(spark, d).select(F.col("y").alias("row"), F.col("x").alias("col"), "value")
    return resample.kernel_overview(g, 5, "bilinear").withColumn("value", r(F.col("value"), 8))


_CELLS = f"cells as (select y as row, x as col, lon + 0.013 as lon, lat - 0.004 as lat from swath)"


#: Cells and pixels meet in tenths of a degree of latitude, each pixel in its own and the two beside it.
_MET = f"""c as (select *, cos(lat*{_RAD})*cos(lon*{_RAD}) as ux, cos(lat*{_RAD})*sin(lon*{_RAD}) as uy, sin(lat*{_RAD}) as uz, floor(lat*10) as k, floor(lon*5) as m from cells),
t as (select *, unnest([floor(lat*10) - 1, floor(lat*10), floor(lat*10) + 1]) as k from s), u as (select *, unnest([floor(lon*5) - 1, floor(lon*5), floor(lon*5) + 1]) as m from t),
j as (select row, col, y, x, value, 6370997.0*sqrt(pow(c.ux-u.ux,2)+pow(c.uy-u.uy,2)+pow(c.uz-u.uz,2)) as d from c join u using (k, m))"""
_UNIT = f"cos(lat*{_RAD})*cos(lon*{_RAD}) as ux, cos(lat*{_RAD})*sin(lon*{_RAD}) as uy, sin(lat*{_RAD}) as uz"


def _all_cells(s: DataFrame) -> DataFrame:
    return s.select(F.col("y").alias("row"), F.col("x").alias("col"), (F.col("lon") + 0.013).alias("lon"), (F.col("lat") - 0.004).alias("lat"))


@query(f"""with {SWATH}, {_CELLS}, s as (select *, {_UNIT} from swath where product <> 'view'), {_MET}, b as (select row, col, arg_min(value, d) as value from j where d <= 6000 group by row, col)
select c.row, c.col, b.value from cells c left join b on b.row = c.row and b.col = c.col""")
def r3_j5_nearest(spark: SparkSession, d: str) -> DataFrame:
    """Every cell as target."""
    s = swath_view(spark, d)
    return resample.resample_nearest(_all_cells(s), s.where("product <> 'view'"), 6000.0)


@query(f"""with {SWATH}, {_CELLS}, s as (select *, {_UNIT} from swath), {_MET}
select row, col, arg_min(y, d) as y, arg_min(x, d) as x, round(min(d), 2) + 0.0 as distance from j where d <= 6000 group by row, col""")
def r14_nearest_index(spark: SparkSession, d: str) -> DataFrame:
    s = swath_view(spark, d)
    return resample.nearest_index(_all_cells(s), s, 6000.0).withColumn("distance", r(F.col("distance"), 2))


@query(ORACLES["r14_nearest_index"])
def r14_kept_index(spark: SparkSession, d: str) -> DataFrame:
    """Made once, then looked up."""
    s, path = swath_view(spark, d), shared_folder(spark, "index")
    resample.kept_nearest_index(path, _all_cells(s), s, 6000.0)
    return resample.kept_nearest_index(path, _all_cells(s), s, 6000.0).withColumn("distance", r(F.col("distance"), 2))


@query(ORACLES["r14_nearest_index"])
def r14_adaptive_index(spark: SparkSession, d: str) -> DataFrame:
    """The same pixels by octree leaves that adapt to density."""
    s = swath_view(spark, d)
    return nearest.nearest_adaptive(_all_cells(s), s, 6000.0).withColumn("distance", r(F.col("distance"), 2))


_EWA = f"""{SWATH}, p as (select y, x, value, (lon + 96)/0.25 - 0.5 as u, (57 - lat)/0.25 - 0.5 as v, floor(y/16.0) as scan from swath),
d as (select *, (coalesce(lead(u) over a, u) - coalesce(lag(u) over a, u)) / nullif(coalesce(lead(x) over a, x) - coalesce(lag(x) over a, x), 0) as ux, (coalesce(lead(v) over a, v) - coalesce(lag(v) over a, v)) / nullif(coalesce(lead(x) over a, x) - coalesce(lag(x) over a, x), 0) as vx,
 (coalesce(lead(u) over b, u) - coalesce(lag(u) over b, u)) / nullif(coalesce(lead(y) over b, y) - coalesce(lag(y) over b, y), 0) as uy, (coalesce(lead(v) over b, v) - coalesce(lag(v) over b, v)) / nullif(coalesce(lead(y) over b, y) - coalesce(lag(y) over b, y), 0) as vy
 from p window a as (partition by y order by x), b as (partition by scan, x order by y)),
e as (select y, x, value, u, v, pow(coalesce(vx,0),2)+pow(coalesce(vy,0),2)+1 as qa, -2*(coalesce(ux,0)*coalesce(vx,0)+coalesce(uy,0)*coalesce(vy,0)) as qb, pow(coalesce(ux,0),2)+pow(coalesce(uy,0),2)+1 as qc from d),
f as (select *, qa*qc - qb*qb/4 as qf, least(sqrt(qc)*2.0, 10.0) as hu, least(sqrt(qa)*2.0, 10.0) as hv from e),
g as (select *, unnest(range(greatest(cast(ceil(u-hu) as bigint), 0), least(cast(floor(u+hu) as bigint), 731) + 1)) as col from f), h as (select *, unnest(range(greatest(cast(ceil(v-hv) as bigint), 0), least(cast(floor(v+hv) as bigint), 131) + 1)) as row from g),
q as (select y, x, value, row, col, (qa*(col-u)*(col-u) + qb*(col-u)*(row-v) + qc*(row-v)*(row-v))/qf as q from h),
w as (select y, x, value, cast(row as int) as row, cast(col as int) as col, exp(-4.60517018598809/4*q) as weight from q where q <= 4)"""


def _ellipses(spark: SparkSession, d: str) -> DataFrame:
    placed = resample.swath_cells(swath_view(spark, d), {"proj": "longlat"}, -96.0, 57.0, 0.25, 0.25)
    return resample.ewa_ellipses(resample.prune_blocks(placed, 732, 132, 3.0, block=32), 732, 132, rows_per_scan=16, delta_max=10.0, distance_max=2.0)


def _weights(spark: SparkSession, d: str, carry: tuple[str, ...] = ()) -> DataFrame:
    placed = resample.swath_cells(swath_view(spark, d), {"proj": "longlat"}, -96.0, 57.0, 0.25, 0.25)
    placed = resample.prune_blocks(placed, 732, 132, 3.0, block=32)
    return resample.ewa_weights(placed, 732, 132, rows_per_scan=16, delta_max=10.0, distance_max=2.0, carry=carry)


@query(f"with {_EWA} select row, col, round(sum(weight*value)/sum(weight), 5) + 0.0 as value from w group by row, col")
def r4_w7_a2_ewa(spark: SparkSession, d: str) -> DataFrame:
    """One product: weights carry the values."""
    return resample.resample_ewa(None, _weights(spark, d, ("value",))).withColumn("value", r(F.col("value"), 5))


@query(f"with {_EWA} select row, col, arg_max(value, (weight, -y, -x)) as value from (select row, col, round(weight, 9) as weight, y, x, value from w) group by row, col")
def r5_a3_ewa_maximum(spark: SparkSession, d: str) -> DataFrame:
    """Weights kept apart, joined to pixels."""
    weights = _weights(spark, d)
    return resample.resample_ewa(swath_view(spark, d), weights.withColumn("weight", F.round("weight", 9)), maximum_weight=True)


@query(f"with {_EWA} select row, col, round(sum(weight*value)/sum(weight), 5) + 0.0 as value from w where value is not null group by row, col")
def r4_r13_ewa_tiles(spark: SparkSession, d: str) -> DataFrame:
    """Dense accumulators of tiles in place of a row for each pixel and cell."""
    return tiles.ewa_tiles(_ellipses(spark, d), distance_max=2.0).withColumn("value", r(F.col("value"), 5))


@query(f"with {_EWA} select row, col, arg_max(value, (weight, -y, -x)) as value from (select row, col, round(weight, 9) as weight, y, x, value from w where value is not null) group by row, col")
def r5_ewa_tiles_maximum(spark: SparkSession, d: str) -> DataFrame:
    return tiles.ewa_tiles(_ellipses(spark, d), distance_max=2.0, maximum_weight=True)


@query(f"with {BANDS}, n as (select y, row_number() over (order by y, x) as pos, x, cast(floor(v1) as int) + 1 as w, cast(floor(v2) as int)*100 + 1 as h from bands), k as (select *, greatest(w, h) as m from n) select printf('%03d', pos) as frame, y, x, cast(floor(case when m > 4096 then floor(w*4096.0::double/m) else w end/2.0)*2 as int) as width, cast(floor(case when m > 4096 then floor(h*4096.0::double/m) else h end/2.0)*2 as int) as height from k")
def r16_w10_frames(spark: SparkSession, d: str) -> DataFrame:
    """Frames of all rows."""
    return _frames(bands_view(spark, d))


def _frames(bands: DataFrame) -> DataFrame:
    b = bands.select("y", "x", (F.col("v1").cast("int") + 1).alias("w"), (F.col("v2").cast("int") * 100 + 1).alias("h"), F.struct("y", "x").alias("pos"))
    width, height = resample.frame_size(F.col("w"), F.col("h"))
    return resample.frame_numbers(b).select("frame", "y", "x", width.alias("width"), height.alias("height"))


@query(f"""with {BANDS} select y, x, v1 as red, v2 as green, v1 - v2 as c4, v1 + v2 + v2 as c5, case when v2 <> 0 then round(v1/v2, 9) + 0.0 end as c6, case when v1 + v2 <> 0 then round((v1-v2)/(v1+v2), 6) + 0.0 end as nd, v2 as c9, round(v1*0.25 + v2*0.75, 6) + 0.0 as c16, round((v1 - 900)/104100.0, 6) + 0.0 as c8 from bands""")
def c1_c16_arithmetic(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.col("v1"), F.col("v2")
    c = composites.rgb(a, b, b)
    return bands_view(spark, d).select(
        "y",
        "x",
        composites.sub_band(c, "R").alias("red"),
        composites.sub_band(c, 1).alias("green"),
        composites.difference(a, b).alias("c4"),
        composites.band_sum(a, b, b).alias("c5"),
        r(composites.ratio(a, b), 9).alias("c6"),
        r(composites.normalized_difference(a, b)).alias("nd"),
        composites.single_band(b).alias("c9"),
        r(composites.weighted_sum([a, b], [0.25, 0.75])).alias("c16"),
        r(composites.pre_enhanced(a, [("crude", {"min_stretch": 900, "max_stretch": 105000})])).alias("c8"),
    )


@query(f"""with {BANDS}, lo as (select y, x, v2*1000 as g from bands), j as (select h.y, h.x, h.v1 as hi, l.g from bands h join lo l on floor(h.y/2.0) = l.y and floor(h.x/2.0) = l.x)
select y, x, round(hi, 6) + 0.0 as red, round(g*(case when g > 0 and hi > 0 then hi/g else 1.0 end), 6) + 0.0 as green from j""")
def c2_j2_sharpened(spark: SparkSession, d: str) -> DataFrame:
    b = bands_view(spark, d)
    both = composites.with_low_resolution(b.select("y", "x", "v1"), b.select("y", "x", (F.col("v2") * 1000).alias("g")), 2)
    c = composites.ratio_sharpened(F.col("g"), F.col("g"), F.col("g"), F.col("v1"), "r")
    return both.select("y", "x", c.alias("c")).select("y", "x", r(F.col("c.r")).alias("red"), r(F.col("c.g")).alias("green"))


@query(f"""with {BANDS}, w as (select y, x, v1, v2, avg(v1) over (partition by floor(y/2.0), floor(x/2.0)) as low from bands)
select y, x, round(v1, 6) + 0.0 as red, round(v2*(case when low > 0 and v1/low > 0 then v1/low else 1.0 end), 6) + 0.0 as green from w""")
def c3_w8_self_sharpened(spark: SparkSession, d: str) -> DataFrame:
    got = composites.self_sharpened(bands_view(spark, d), "v1", "v2", "v2", "r")
    return got.select("y", "x", r(F.col("rgb.r")).alias("red"), r(F.col("rgb.g")).alias("green"))


@query(f"with {SWATH}, w as (select y, x, value, sza, least(greatest((100 - sza)/12.0, 0.0), 1.0) as k from swath) select y, x, round(k*value + (1-k)*(value*2 + 1), 6) + 0.0 as mix from w")
def c10_day_night(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("value")
    return swath_view(spark, d).select("y", "x", r(composites.day_night_mix(v, v * 2 + 1, F.col("sza"), 88.0, 100.0)).alias("mix"))


@query(f"""with {SWATH}, g as (select y, x, value, case when sza < 88 then 'day' when sza <= 100 then 'mixed' else 'night' end as regime from swath),
s as (select regime, greatest(min(value), avg(value) - 4*stddev_pop(value)) as lo, least(max(value), avg(value) + 4*stddev_pop(value)) as hi from g group by regime),
b as (select y, x, value, regime, least(floor((least(greatest(value, lo), hi) - lo)/(hi - lo)*256), 255) as bin from g join s using (regime)),
c as (select regime, bin, count(*) as n from b group by 1, 2), d as (select regime, bin, sum(n) over (partition by regime order by bin)/sum(n) over (partition by regime) as p from c)
select y, x, regime, round(cast(p as double), 6) + 0.0 as equalized from b join d using (regime, bin)""")
def c11_w5_a16_histogram(spark: SparkSession, d: str) -> DataFrame:
    got = composites.histogram_dnb(swath_view(spark, d).select("y", "x", "value", "sza"))
    return got.select("y", "x", "regime", r(F.col("equalized")).alias("equalized"))


@query(f"""with {SWATH}, g as (select y, x, value, case when sza < 88 then 'day' when sza <= 100 then 'mixed' else 'night' end as regime from swath),
l as (select regime, min(value) as lo, max(value) as hi from g group by regime), b as (select y, x, g.regime, value, least(floor((value - lo)/(hi - lo)*64), 63) as bin from g join l using (regime)),
c as (select regime, floor(y/25.0) as ty, floor(x/25.0) as tx, bin, count(*) as n from b group by 1, 2, 3, 4),
p as (select regime, ty, tx, bin, sum(n) over (partition by regime, ty, tx order by bin)/sum(n) over (partition by regime, ty, tx) as p from c),
k as (select unnest([0, 0, 1, 1]) as i, unnest([0, 1, 0, 1]) as j), n as (select y, x, regime, bin, y/25.0 - 0.5 as v, x/25.0 - 0.5 as u, floor(y/25.0 - 0.5) + i as ty, floor(x/25.0 - 0.5) + j as tx from b, k),
t as (select distinct regime, ty, tx from p), m as (select n.*, (1 - abs(v - ty))*(1 - abs(u - tx)) as w, coalesce((select max(p.p) from p where p.regime = n.regime and p.ty = n.ty and p.tx = n.tx and p.bin <= n.bin), 0) as p from n join t using (regime, ty, tx))
select y, x, regime, round(sum(cast(p as double)*w)/sum(w), 6) + 0.0 as equalized from m group by y, x, regime""")
def c12_w6_adaptive(spark: SparkSession, d: str) -> DataFrame:
    got = composites.adaptive_dnb(swath_view(spark, d).select("y", "x", "value", "sza"), 25)
    return got.select("y", "x", "regime", r(F.col("equalized")).alias("equalized"))


@query(f"with {BANDS} select y, x, case when v2 <> 0 then round((v1 - v2)/v2, 9) + 0.0 end as ratio_of_diff, round((v1-v2)/(v1+v2), 6) + 0.0 as ndi_v from bands")
def c17_u1_recipes(spark: SparkSession, d: str) -> DataFrame:
    got = composites.apply_recipes(bands_view(spark, d), ["ratio_of_diff", "ndi_v", "unknown"])
    return got.select("y", "x", r(F.col("ratio_of_diff"), 9).alias("ratio_of_diff"), r(F.col("ndi_v")).alias("ndi_v"))


@query(f"with {SWATH} select y, x, max(case when product = 'view' then value end) as view, max(case when product = 'click' then value end) as click, round(max(lon), 6) + 0.0 as lon from swath where product in ('view', 'click') group by y, x")
def j1_j3_bands(spark: SparkSession, d: str) -> DataFrame:
    s = swath_view(spark, d).withColumn("swath_id", F.lit("a"))
    wide = composites.wide_bands(s, ["view", "click"], keys=("swath_id", "y", "x"))
    return composites.with_geolocation(wide, s.select("swath_id", "y", "x", "lon")).select("y", "x", "view", "click", r(F.col("lon")).alias("lon"))


@query(f"""with {SWATH}, c(surface, channel, src, k, b) as (values (0, 'c1', 'view', 0.5, 1.0), (0, 'c1', 'click', 0.25, 1.0), (1, 'c1', 'view', 0.75, 2.0))
select cast(floor(y/10.0) as int) as y, 0 as x, channel, round(sum(cast(k as double)*value) + max(cast(b as double)), 6) + 0.0 as corrected from swath join c on surface = x % 2 and src = product group by floor(y/10.0), channel""")
def j15_limb(spark: SparkSession, d: str) -> DataFrame:
    table = spark.createDataFrame([(0, 0, "c1", "view", 0.5, 1.0), (0, 1, "c1", "view", 0.75, 2.0), (0, 0, "c1", "click", 0.25, 1.0)], "scan_pos int, surface int, channel string, src_channel string, coef double, intercept double")
    px = swath_view(spark, d).select(F.floor(F.col("y") / 10).cast("int").alias("y"), F.lit(0).alias("x"), F.col("product").alias("channel"), F.lit(0).alias("scan_pos"), (F.col("x") % 2).cast("int").alias("surface"), "value")
    return composites.limb_corrected(px, table).withColumn("corrected", r(F.col("corrected")))


_LAYERS = f"{SWATH}, a as (select cast(floor(y/2.0) as int) as row, cast(floor(x/2.0) as int) as col, max(value) as value from swath where product in ('view', 'click', 'error') group by 1, 2), b as (select cast(floor(y/2.0) as int) as row, cast(floor(x/2.0) as int) as col, max(case when value > 60 then value end) as value from swath where product in ('signup', 'purchase') group by 1, 2)"


def _layer(spark: SparkSession, d: str, names: list[str], least: float) -> DataFrame:
    s = swath_view(spark, d).where(F.col("product").isin(names))
    return s.groupBy(F.floor(F.col("y") / 2).cast("int").alias("row"), F.floor(F.col("x") / 2).cast("int").alias("col")).agg(F.max(F.when(F.col("value") > least, F.col("value"))).alias("value"))


@query(f"with {_LAYERS} select row, col, coalesce(b.value, a.value) as value from a full join b using (row, col)")
def j9_overlay(spark: SparkSession, d: str) -> DataFrame:
    return mosaic.overlay(_layer(spark, d, ["view", "click", "error"], -1e9), _layer(spark, d, ["signup", "purchase"], 60.0))


@query(f"with {SWATH}, p as (select length(product)*100 + ascii(product) as seq, cast(floor(y/2.0) as int) as row, cast(floor(x/2.0) as int) as col, max(case when value > 20 then value end) as value from swath group by 1, 2, 3) select row, col, arg_max(value, seq) as value from p where value is not null group by row, col")
def j10_mosaic(spark: SparkSession, d: str) -> DataFrame:
    s = swath_view(spark, d)
    p = s.groupBy((F.length("product") * 100 + F.ascii("product")).alias("seq"), F.floor(F.col("y") / 2).cast("int").alias("row"), F.floor(F.col("x") / 2).cast("int").alias("col")).agg(F.max(F.when(F.col("value") > 20, F.col("value"))).alias("value"))
    return mosaic.mosaic(p)


@query(f"with {SWATH} select cast(floor(y/16.0)*4 + floor(x/25.0) + 1 as int) as tile, count(case when value > 300 then 1 end) as n_valid from swath group by 1 having count(case when value > 300 then 1 end) > 0")
def k5_a15_tiles(spark: SparkSession, d: str) -> DataFrame:
    s = swath_view(spark, d).select(enhance.tile_number(F.col("y"), F.col("x"), 100, 100, size=(16, 25)).alias("tile"), F.when(F.col("value") > 300, F.col("value")).alias("value"))
    return mosaic.tile_counts(s)


_SIDES = f"""{BANDS}, e as (select 'f' || (y % 7) as file, 'v' || x as variable, y, x, v1 as value from bands), a as (select file, variable, y, x, value + case when y % 11 = 0 then 1.0 else 0.0 end as value from e where not (file = 'f3') and not (file = 'f4' and variable = 'v2') and not (file = 'f5' and y > 9000 and variable = 'v1'))"""


_STATUS = """n as (select file, variable, max(y) as my, count(*) as n from e group by 1, 2), m as (select file, variable, max(y) as my, count(*) as n from a group by 1, 2),
s as (select file, variable, count(*) as same from e join a using (file, variable, y, x) where abs(e.value - a.value) <= 0.1 group by 1, 2),
c as (select file, variable, n.n - (case when n.n = m.n and n.my = m.my then coalesce(same, 0) else 0 end) as nd, m.n is null or n.n <> m.n or n.my <> m.my or coalesce(same, 0) < n.n as failed from n left join m using (file, variable) left join s using (file, variable))"""


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e = bands_view(spark, d).select(F.concat(F.lit("f"), F.col("y") % 7).alias("file"), F.concat(F.lit("v"), "x").alias("variable"), "y", "x", F.col("v1").alias("value"))
    a = e.where("not (file = 'f3') and not (file = 'f4' and variable = 'v2') and not (file = 'f5' and y > 9000 and variable = 'v1')")
    return e, a.withColumn("value", F.col("value") + F.when(F.col("y") % 11 == 0, 1.0).otherwise(0.0))


@query(f"""with {_SIDES}, n as (select file, variable, max(y) as my, count(*) as n from e group by 1, 2), m as (select file, variable, max(y) as my, count(*) as n from a group by 1, 2),
s as (select file, variable, count(*) as same from e join a using (file, variable, y, x) where abs(e.value - a.value) <= 0.1 group by 1, 2)
select file, variable, case when file not in (select file from a) then 'missing file' when m.n is null then 'missing variable' when n.n <> m.n or n.my <> m.my then 'shape' else 'compared' end as status, n.n as total,
 case when n.n = m.n and n.my = m.my then coalesce(same, 0) else 0 end as n_equal, case when n.n = m.n and n.my = m.my then n.n - coalesce(same, 0) else n.n end as n_different,
 round(case when n.n = m.n and n.my = m.my then n.n - coalesce(same, 0) else n.n end*100.0/n.n, 6) as percent,
 not (n.n = m.n and n.my = m.my) or m.n is null or (n.n - coalesce(same, 0)) > n.n*0.09 as failed from n left join m using (file, variable) left join s using (file, variable)""")
def v1_v3_j11_compare(spark: SparkSession, d: str) -> DataFrame:
    got = compare.compare_variables(*_sides(spark, d), atol=0.1, margin=9.0)
    return got.withColumn("percent", F.round("percent", 6))


@query(f"with {_SIDES}, {_STATUS} select file, variable, cast(sum(nd) as bigint) as n_different, bool_or(failed) as failed from c group by rollup (file, variable)")
def a10_v5_roll_up(spark: SparkSession, d: str) -> DataFrame:
    e, a = _sides(spark, d)
    return compare.roll_up(compare.compare_variables(e, a, atol=0.1))


@query(f"""with {_SIDES}, {_STATUS}, f as (select file, bool_or(failed) as failed from c group by file)
select file, (select cast(count(*) filter (failed) as int) from f) as n_failed from (select distinct file from e) where file not in (select file from a)""")
def j12_o2_missing_files(spark: SparkSession, d: str) -> DataFrame:
    e, a = _sides(spark, d)
    failed = compare.n_failed_files(compare.compare_variables(e, a, atol=0.1))
    return compare.missing(e, a).crossJoin(failed.select(F.col("n_failed").cast("int").alias("n_failed")))


@query(f"""with {SWATH}, x as (select value - sza as diff from swath), l as (select min(diff) as lo, max(diff) as hi, count(*) as n from x), b as (select cast(least(floor((diff - lo)/(hi - lo)*100), 99) as int) as bin, lo, hi, l.n as total from x, l)
select bin, count(*) as n, round(count(*)/(any_value(total)*(any_value(hi) - any_value(lo))/100), 6) + 0.0 as density, (select round(quantile_cont(diff, 0.25), 6) + 0.0 from x) as q25, (select round(quantile_cont(diff, 0.75), 6) + 0.0 from x) as q75 from b group by bin""")
def v6_a11_a13_profile(spark: SparkSession, d: str) -> DataFrame:
    quantiles, bins = compare.difference_profile(swath_view(spark, d).select((F.col("value") - F.col("sza")).alias("diff")))
    return bins.crossJoin(F.broadcast(quantiles)).select("bin", "n", r(F.col("density")).alias("density"), r(F.col("q25")).alias("q25"), r(F.col("q75")).alias("q75"))


@query(f"""with {SWATH} select 'lon' as "column", count(*) as n, 0 as n_missing, round(min(lon), 6) as least, round(max(lon), 6) as largest from swath union all select 'v', count(*), count(*) filter (value < 5), min(case when value >= 5 then value end), max(value) from swath""")
def a12_data_profile(spark: SparkSession, d: str) -> DataFrame:
    s = swath_view(spark, d).withColumn("v", F.when(F.col("value") >= 5, F.col("value")))
    got = compare.data_profile(s, ["lon", "v"])
    return got.withColumn("least", F.round("least", 6)).withColumn("largest", F.round("largest", 6))


@query(f"with {SWATH}, l as (select product, min(value) as lo, max(value) as hi from swath group by product) select y, x, round((value - lo)/(hi - lo), 6) + 0.0 as stretched from swath join l using (product)")
def a14_data_stretch(spark: SparkSession, d: str) -> DataFrame:
    s = swath_view(spark, d)
    return s.join(data_limits(s), "product").select("y", "x", r(enhance.linear_stretch(F.col("value"), F.col("lo"), F.col("hi"))).alias("stretched"))


@query(f"with {SWATH}, t as (select cast(floor(value/10) as double) as value, max(sza) as red from swath group by 1), u as (select value, case when cast(value as int) % 5 = 0 then red + 1 else red end as red from t) select count(*) as n_different from t join u using (value) where t.red <> u.red")
def a18_v4_colormaps(spark: SparkSession, d: str) -> DataFrame:
    t = swath_view(spark, d).groupBy(F.floor(F.col("value") / 10).cast("double").alias("value")).agg(F.max("sza").alias("r"))
    t = t.withColumns({"g": F.lit(0.0), "b": F.lit(0.0), "a": F.lit(255.0)})
    u = t.withColumn("r", F.when(F.col("value").cast("int") % 5 == 0, F.col("r") + 1).otherwise(F.col("r")))
    return compare.compare_colormaps(t, u)


@query(f"with {SWATH}, m as (select cast(max(y) as int) + 1 as h from swath), i as (select unnest(range((select h*100 from m))) as i) select cast(floor(i/100.0) as int) as row, cast(i % 100 as int) as col, round(-95 + (i % 100 + 0.5)*0.05, 6) + 0.0 as longitude, round(30 - (floor(i/100.0) + 0.5)*0.05, 6) + 0.0 as latitude from i")
def g13_k2_cells(spark: SparkSession, d: str) -> DataFrame:
    height = swath_view(spark, d).agg((F.max("y") + 1).alias("h")).first()["h"]
    cells = grids.cells(spark, 100, height, -95.0, 30.0, 0.05, 0.05)
    got = sinks.with_cell_geolocation(cells, {"proj": "longlat"})
    return got.select("row", "col", r(F.col("longitude")).alias("longitude"), r(F.col("latitude")).alias("latitude"))


@query(f"""with {SWATH}, g as (select product, count(*) as width, max(y) + 1 as height, min(lon) as x_min, max(lat) as y_max from swath group by product) select product as area_id, 'longlat' as proj4_definition, height, width, 0.05 as cell_height, 0.05 as cell_width, round(x_min + 0.025, 5) + 0.0 as origin_x, round(y_max - 0.025, 5) + 0.0 as origin_y from g""")
def k3_group_attributes(spark: SparkSession, d: str) -> DataFrame:
    g = swath_view(spark, d).groupBy(F.col("product").alias("area_id")).agg(F.count("*").alias("width"), (F.max("y") + 1).alias("height"), F.min("lon").alias("x_min"), F.max("lat").alias("y_max"))
    got = sinks.group_attributes(g.withColumns({"proj": F.lit("longlat"), "dx": F.lit(0.05), "dy": F.lit(0.05)}))
    return got.withColumn("origin_x", F.col("origin_x") + 0.0).withColumn("origin_y", F.col("origin_y") + 0.0)


@query(f"with {SWATH} select y as row, x as col, cast(trunc(least(greatest(value, 0.0), 255.0)) as smallint) as value from swath")
def k4_binary_values(spark: SparkSession, d: str) -> DataFrame:
    g = swath_view(spark, d).select(F.col("y").alias("row"), F.col("x").alias("col"), "value")
    return sinks.binary_values(g, "float32", "uint8")


@query(f"with {SWATH}, c as (select y, max(x) as h from swath group by y) select product, cast(rank() over (order by max(y), product) as int) as place, max(y) as height from swath group by product")
def a6_o4_coarse_to_fine(spark: SparkSession, d: str) -> DataFrame:
    g = swath_view(spark, d).groupBy("product").agg(F.max("y").alias("height"))
    return grids.coarse_to_fine(g, "product").select("product", "place", "height")


@query(f"with {SWATH} select count(distinct (lon, lat)) as n_points, count(distinct product) as n_products from swath")
def a17_distinct(spark: SparkSession, d: str) -> DataFrame:
    return compare.distinct_counts(swath_view(spark, d), {"n_points": ("lon", "lat"), "n_products": ("product",)})


@query(f"""with {BANDS}, f as (select y, x, cast(n as double) as v3, v1 - v2 as v4, v1*0.5 + n as v5 from bands)
select y, x, round(v1 - v2, 6) + 0.0 as red, round((v3 + v4)/2, 6) + 0.0 as green, round(case when v5 + v1 <> 0 then (v5 - v1)/(v5 + v1) end, 6) + 0.0 as blue from bands join f using (y, x)""")
def j1_j2_stored_bands(spark: SparkSession, d: str) -> DataFrame:
    """A composite of five bands from a bucketed store."""
    b = bands_view(spark, d)
    made = {"v1": F.col("v1"), "v2": F.col("v2"), "v3": F.col("n").cast("double"), "v4": F.col("v1") - F.col("v2"), "v5": F.col("v1") * 0.5 + F.col("n")}
    # There are at most as many pixels as lines, which the files' footers count.
    buckets = band_store.buckets_for(spark.read.parquet(f"{d}/lineitem.parquet").count(), 8)
    stored = band_store.new_store(spark, {name: b.select("y", "x", c.alias("value")) for name, c in made.items()}, buckets=buckets)
    v = band_store.joined_bands(spark, stored)
    blue = F.try_divide(F.col("v5") - F.col("v1"), F.col("v5") + F.col("v1"))
    return v.select("y", "x", r(F.col("v1") - F.col("v2")).alias("red"), r((F.col("v3") + F.col("v4")) / 2).alias("green"), r(blue).alias("blue"))
