"""Queries of coverage and daylight by spherical area."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geogrid.operators import filters, footprints, resample
from geogrid.plans.scalar_queries import r
from geogrid.plans.views import SWATH
from geogrid.plans.views import swath as swath_view

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
#: Corners of each side of the outlines, pixels averaged into one along each side, and longitude-latitude boxes (west, south, east, north).
CORNERS, SPACINGS = 6, (1, 4, 10)
BOXES = {"whole": (-96.0, 24.0, -80.0, 57.0), "part": (-93.0, 30.0, -91.0, 40.0), "away": (10.0, -40.0, 20.0, -30.0)}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return add


def _cross(a: str, b: str) -> str:
    return ", ".join(f"'{k}': {a}.{i}*{b}.{j} - {a}.{j}*{b}.{i}" for k, i, j in (("x", "y", "z"), ("y", "z", "x"), ("z", "x", "y")))


def _dot(a: str, b: str) -> str:
    return f"({a}.x*{b}.x + {a}.y*{b}.y + {a}.z*{b}.z)"


def _unit(x: str, y: str, z: str) -> str:
    size = f"sqrt(({x})*({x}) + ({y})*({y}) + ({z})*({z}))"
    return f"{{'x': ({x})/{size}, 'y': ({y})/{size}, 'z': ({z})/{size}}}"


def _turned(lon: str, lat: str) -> str:
    return f"{{'x': cos(radians({lat}))*cos(radians({lon})), 'y': cos(radians({lat}))*sin(radians({lon})), 'z': sin(radians({lat}))}}"


def _clipped(ring: str, pole: str) -> str:
    a, b = f"{ring}[i]", f"{ring}[i % len({ring}) + 1]"
    da, db = _dot(a, pole), _dot(b, pole)
    mid = _unit(*(f"{a}.{k}*abs({db}) + {b}.{k}*abs({da})" for k in "xyz"))
    return f"""list_filter(flatten(list_transform(range(1, len({ring}) + 1), lambda i:
      [CASE WHEN {da} >= 0 THEN {a} END, CASE WHEN ({da} >= 0) <> ({db} >= 0) THEN {mid} END])), lambda p: p IS NOT NULL)"""


def _area(ring: str, o: str) -> str:
    a, b = f"{ring}[i]", f"{ring}[i % len({ring}) + 1]"
    volume = f"({a}.x*({b}.y*{o}.z - {b}.z*{o}.y) + {a}.y*({b}.z*{o}.x - {b}.x*{o}.z) + {a}.z*({b}.x*{o}.y - {b}.y*{o}.x))"
    return f"coalesce(list_sum(list_transform(range(1, len({ring}) + 1), lambda i: 2*atan2({volume}, 1 + {_dot(a, o)} + {_dot(b, o)} + {_dot(a, b)}))), 0)"


_MEAN = _unit(*(f"list_sum(list_transform(ring, lambda p: p.{k}))" for k in "xyz"))
_OUTLINES = f"""{SWATH}, points as (
 select cast(floor(y/600.0) as int) as pass, f, cast(floor(y/cast(f as double)) as int) as y, cast(floor(x/cast(f as double)) as int) as x, avg(lon) as lon, avg(lat) as lat
 from swath, (values {", ".join(f"({f})" for f in SPACINGS)}) as s(f) group by all
), lines as (
 select pass, f, y, arg_min({{'lon': lon, 'lat': lat}}, x) as l, arg_max({{'lon': lon, 'lat': lat}}, x) as r, min(x) as x0, max(x) as x1 from points group by all
), ends as (
 select pass, f, min(y) as y0, max(y) as y1, arg_min(l, y) as corner, arg_min(x0, y) as tx0, arg_min(x1, y) as tx1, arg_max(x0, y) as bx0, arg_max(x1, y) as bx1 from lines group by all
), sided as (
 select pass, f, case when y = y1 then {CORNERS} else floor((y - y0)*{CORNERS}/cast(y1 - y0 + 1 as double)) end as part, arg_min(l, y) as l, arg_min(r, y) as r
 from lines join ends using (pass, f) group by all
), level as (
 select pass, f, y = y0 as top, y0 = y1 as single, case when x = (case when y = y0 then tx1 else bx1 end) then {CORNERS}
  else floor((x - case when y = y0 then tx0 else bx0 end)*{CORNERS}/cast(case when y = y0 then tx1 - tx0 else bx1 - bx0 end + 1 as double)) end as part,
  arg_min({{'lon': lon, 'lat': lat}}, x) as p
 from points join ends using (pass, f) where y = y0 or y = y1 group by all
), corners as (
 select pass, f, 1 as side, part as k, p from level where top union all select pass, f, 2, part, r from sided
 union all select pass, f, 3, -part, p from level where not top or single union all select pass, f, 4, -part, l from sided
), outlines as (
 select pass, f, list({_turned("p.lon", "p.lat")} order by side, k) as ring, first(corner) as corner from corners join ends using (pass, f) group by pass, f
), turned as (
 select pass, f, corner, case when {_area("ring", "o")} < 0 then list_reverse(ring) else ring end as ring, o from (select *, {_MEAN} as o from outlines)
)"""
_BOX_ROWS = ", ".join(f"('{n}', {w}, {s}, {e}, {north})" for n, (w, s, e, north) in BOXES.items())
_COVERAGE = f"""with recursive {_OUTLINES}, boxes as (
 select a, list({_turned("lon", "lat")} order by side, k) as ring from (
  select a, side, k, case side when 0 then w + k*(e - w) when 1 then e when 2 then e - k*(e - w) else w end as lon,
   case side when 0 then n when 1 then n - k*(n - s) when 2 then s else s + k*(n - s) end as lat
  from (values {_BOX_ROWS}) as b(a, w, s, e, n), range(0, 4) as sides(side), (select range/{CORNERS}.0 as k from range(0, {CORNERS})))
 group by a
), targets as (
 select a, list_reverse(ring) as ring, {_MEAN} as o from boxes
), triangles as (
 select a, j, o, one, two, sign({_dot("c", "o")}) as s, {_unit(*(f"o.{k} + one.{k} + two.{k}" for k in "xyz"))} as mid,
  2*atan2({_dot("c", "o")}, 1 + {_dot("one", "o")} + {_dot("two", "o")} + {_dot("one", "two")}) as own,
  [{{{_cross("o", "one")}}}, {{{_cross("one", "two")}}}, {{{_cross("two", "o")}}}] as poles
 from (select *, {{{_cross("one", "two")}}} as c from (select a, o, j, ring[j] as one, ring[j % len(ring) + 1] as two from (select *, unnest(range(1, len(ring) + 1)) as j from targets)))
), cut(pass, f, a, j, step, ring) as (
 select pass, f, a, j, 0, turned.ring from turned, triangles
 union all
 select pass, f, a, j, step + 1, {_clipped("ring", "pole")}
 from (select pass, f, cut.a, cut.j, step, ring, {{'x': s*poles[step + 1].x, 'y': s*poles[step + 1].y, 'z': s*poles[step + 1].z}} as pole
  from cut join triangles as t on t.a = cut.a and t.j = cut.j where step < 3)
), shares as (
 select pass, f, cut.a, greatest(sum(s*{_area("ring", "mid")}), 0) as part, sum(own) as whole from cut join triangles as t on t.a = cut.a and t.j = cut.j where step = 3 group by all
)
select pass, f as spacing, a as area_id, round(least(part/whole, 1), 6) + 0.0 as coverage, part/whole >= 0.1 as kept from shares"""

_RAD = "pi()/180"
_SUN = f"""with {_OUTLINES}, t as (select cast(floor(y/600.0) as int) as pass, epoch_us(max(ts))/1e6/86400.0 - 10957.5 as d from swath group by all),
g as (select *, ((357.528 + 0.98560028*d) - 360*floor((357.528 + 0.98560028*d)/360))*{_RAD} as g, (280.460 + 0.9856474*d) - 360*floor((280.460 + 0.9856474*d)/360) as q from t),
l as (select *, (q + 1.915*sin(g) + 0.020*sin(2*g))*{_RAD} as l, (23.439 - 0.0000004*d)*{_RAD} as e from g),
sun as (select pass, degrees(atan2(cos(e)*sin(l), cos(l)) - ((280.46061837 + 360.98564736629*d) - 360*floor((280.46061837 + 360.98564736629*d)/360))*{_RAD}) as lon,
 degrees(asin(sin(e)*sin(l))) as lat from l),
lit as (select pass, f, corner, {_turned("lon", "lat")} as sun, ring, o from turned join sun using (pass)),
shares as (select pass, f, case when {_area("ring", "o")} > 1e-12 then abs({_area("part", "o")})/{_area("ring", "o")} end as share, degrees(acos({_dot("sun", "first")})) as zenith
 from (select *, {_clipped("ring", "sun")} as part, {_turned("corner.lon", "corner.lat")} as first from lit))
select pass, f as spacing, round(case when share is null then null when share > 0 then least(share, 1) when zenith < 100 then 1 else 0 end, 6) + 0.0 as sunlit from shares"""


def _outlines(spark: SparkSession, d: str) -> DataFrame:
    """(id, lons, lats, ...): outlines of each pass with its pixels averaged in blocks of three sizes; id is pass:spacing."""
    swath = swath_view(spark, d).withColumn("pass", F.floor(F.col("y") / 600))
    out = None
    for f in SPACINGS:
        lon, lat = (resample.native_down(swath, f, c, keys=("pass",)).withColumnRenamed("value", c) for c in ("lon", "lat"))
        one = lon.join(lat, ["pass", "row", "col"]).select(F.concat_ws(":", "pass", F.lit(f)).alias("id"), F.col("row").alias("y"), F.col("col").alias("x"), "lon", "lat")
        out = one if out is None else out.unionByName(one)
    return footprints.swath_outlines(out, "id", CORNERS)


def _named(df: DataFrame, *more: str) -> DataFrame:
    part = F.split("id", ":")
    return df.select(part[0].cast("int").alias("pass"), part[1].cast("int").alias("spacing"), *more)


@query(_COVERAGE)
def f4_a8_area_coverage(spark: SparkSession, d: str) -> DataFrame:
    targets = None
    for name, (w, s, e, n) in BOXES.items():
        one = footprints.grid_outline(spark, name, {"proj": "longlat"}, w, s, e, n, CORNERS)
        targets = one if targets is None else targets.unionByName(one)
    covered = footprints.coverage_by_area(_outlines(spark, d), targets, "id").withColumn("product", F.concat_ws("|", "id", "area_id"))
    asked = covered.select("product", F.lit(None).cast("double").alias("grid_coverage"), F.lit(False).alias("skip"))
    kept = filters.coverage_filter(asked, covered.select("product", "coverage")).select("product", F.lit(True).alias("kept"))
    return _named(covered.join(kept, "product", "left").withColumn("kept", F.coalesce("kept", F.lit(False))).withColumn("coverage", r(F.col("coverage"))), "area_id", "coverage", "kept")


@query(_SUN)
def f3_a7_area_daylight(spark: SparkSession, d: str) -> DataFrame:
    times = swath_view(spark, d).groupBy(F.floor(F.col("y") / 600).alias("pass")).agg(F.max("ts").alias("time"))
    outlines = _outlines(spark, d).withColumn("pass", F.split("id", ":")[0].cast("long")).join(times, "pass")
    return _named(footprints.sunlit_by_area(outlines, by="id").withColumn("sunlit", r(F.col("sunlit"))), "sunlit")
