"""Queries of builtin tables, enhancement and composites end to end, sinks read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geogrid.functions import enhance
from geogrid.operators import composites, decide, enhancement, filters, products, resample, sinks
from geogrid.plans.scalar_queries import r
from geogrid.plans.views import BANDS, PRODUCTS, SWATH
from geogrid.plans.views import bands as bands_view
from geogrid.plans.views import products as products_view
from geogrid.plans.views import swath as swath_view
from geogrid.sources import builtin_products, builtin_rules, tables
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


def _values(rows: list[tuple]) -> str:
    text = lambda v: "null" if v is None else str(v) if isinstance(v, int) else f"'{v}'"
    return "values " + ", ".join(f"({', '.join(map(text, row))})" for row in rows)


_DEFAULTS = [x for x in builtin_products.default_product_rows() if x[0] in ("viirs_sdr", "modis_l1b")]


@query(f"with {PRODUCTS}, d(reader, product, pos) as ({_values(_DEFAULTS)}) select p.product as of_product, d.product, d.pos from products p join d on d.reader = p.reader")
def n8_default_products(spark: SparkSession, d: str) -> DataFrame:
    """The default products of each product's reader, all of them available."""
    own = products_view(spark, d).select(F.col("product").alias("of_product"), "reader")
    wanted = own.join(tables.builtin_default_products(spark), "reader")
    kept = products.select_products(None, wanted.select("product", "pos").distinct(), wanted)
    return wanted.join(kept.select("product").distinct(), "product", "left_semi").select("of_product", "product", "pos")


_DAY = [x[3] for x in builtin_products.day_night_rows() if x[:2] == ("viirs_sdr", "day")]


@query(f"""with {PRODUCTS}, l as (select product, avg(case when sza < 88 then 1 else 0 end) as lit from swath group by product)
select product, reader, standard_name in ({', '.join(f"'{x}'" for x in _DAY)}) as by_day from products join l using (product) where not (standard_name in ({', '.join(f"'{x}'" for x in _DAY)}) and lit < 0.489)""")
def n9_day_criteria(spark: SparkSession, d: str) -> DataFrame:
    """Products by the builtin day criteria of their readers."""
    lit = filters.sunlit_fraction(swath_view(spark, d), limit=88.0)
    p, kept = products_view(spark, d), None
    for reader in ("viirs_sdr", "modis_l1b"):
        own = p.where(F.col("reader") == reader)
        part = filters.daylight_filter(own.withColumn("sensor", F.array_join("sensor", "-")), lit, tables.builtin_criteria(spark, reader, "day"), day=True, fraction=0.489)
        kept = part if kept is None else kept.unionByName(part)
    return kept.select("product", "reader", F.col("standard_name").isin(_DAY).alias("by_day"))


_ELEMENTS = [(n, e) for n, reader, s, e, _ in builtin_products.element_rows() if s in (None, "modis") and reader is None]


@query(f"with {BANDS}, e(name, element) as ({_values(_ELEMENTS)}), n as (select distinct cast(y % 40 as varchar) as product from bands union select 'btemp_88v' union select 'viirs_crefl08') select n.product, coalesce(e.element, n.product) as element from n left join e on e.name = n.product")
def t4_builtin_elements(spark: SparkSession, d: str) -> DataFrame:
    names = bands_view(spark, d).select((F.col("y") % 40).cast("string").alias("product")).distinct()
    names = names.unionByName(spark.createDataFrame([("btemp_88v",), ("viirs_crefl08",)], "product string"))
    p = names.withColumn("reader", F.lit("modis_l1b")).withColumn("sensor", F.lit("modis"))
    return sinks.element_label(p, tables.builtin_elements(spark)).select("product", "element")


#: name, sensor, standard name and reader of made-up products over the swath's pixels, the rule they get, and its SQL on v.
_CASES = [
    ("M15", "viirs", "toa_brightness_temperature", "viirs_sdr", "brightness_temperature_default", "case when v >= 242 then 176/255.0 - (v - 242)*(176/255.0/(330 - 242.0)) else 1 - (v - 163)*((1 - 176/255.0)/(242 - 163.0)) end"),
    ("M05", "viirs", "toa_bidirectional_reflectance", "viirs_sdr", "reflectance_default", "case when v/100.0 >= 0 then pow(v/100.0, 0.5) end"),
    ("ifog", "viirs", "temperature_difference", "viirs_sdr", "temperature_difference", "least(greatest((v + 10)/20.0*(200/255.0), -1/255.0), 201/255.0) + 5/255.0"),
    ("TPW", "atms", "none", "mirs", "tpw", "(v + 1.333)/(7.1666 + 1.333)"),
    ("CLW", "atms", "none", "mirs", "cloud_liquid_water", "v/0.7"),
    ("C07", "abi", "none", "abi_l1b", "channel_7_default", "(v - 400.15)/(164.15 - 400.15)"),
    ("sst", "modis", "sea_surface_temperature", "modis_l2", "sea_surface_temperature1", "(v - 267.317)/(309.816 - 267.317)"),
    ("lst", "modis", "land_surface_temperature", "modis_l2", "land_surface_temperature", "(v - 233.2)/(322.0 - 233.2)"),
    ("ndvi", "modis", "ndvi", "modis_l2", "ndvi", "case when v <= -1 then 0.0 when v <= 0 then 0.192156863 - (0 - v)*0.192156863 when v <= 1 then 1 - (1 - v)*(1 - 0.192156863) else 1.0 end"),
    ("nbr", "viirs", "normalized_burn_ratio", "viirs_sdr", "nbr", "(v + 1)/2.0"),
    ("rgb", "viirs", "true_color", "viirs_sdr", "true_color_default", "(select case when w <= 0 then 0.0 when w <= 25/255.0 then 90/255.0 - (25/255.0 - w)*3.6 when w <= 55/255.0 then 140/255.0 - (55/255.0 - w)*(50/30.0) when w <= 100/255.0 then 175/255.0 - (100/255.0 - w)*(35/45.0) when w <= 1 then 1 - (1 - w)*(80/155.0) else 1.0 end from (select (v + 1)/111.0 as w))"),
    ("LST", "abi", "none", "abi_l2_nc", "lst", None),
    ("Snow_Cover", "amsr2", "none", "amsr2_l2_gaasp", "gaasp_snow_cover", None),
]
#: Red of the rainbow at equal steps between 223.15 and 429.15, linear between them.
_REDS = (0, 0, 0, 0, 128, 255, 255, 255, 128)
_RAINBOW_RED = (
    "case when v <= 223.15 then 0.0 "
    + " ".join(f"when v <= 223.15 + 25.75*{k + 1} then {a} + ({b} - {a})*(v - 223.15 - 25.75*{k})/25.75" for k, (a, b) in enumerate(zip(_REDS, _REDS[1:], strict=False)))
    + " when v is not null then 128.0 end"
)
_CASE_SQL = " ".join(f"when k = {k} then {sql or 'null'}" for k, (*_, sql) in enumerate(_CASES))
_RULE_SQL = " ".join(f"when k = {k} then '{rule}'" for k, (*_, rule, _) in enumerate(_CASES))


@query(f"""with {SWATH}, q as (select y, x, value as v, (y*100 + x) % {len(_CASES)} as k from swath) select y, x, case {_RULE_SQL} end as rule_id, round(case {_CASE_SQL} end, 6) + 0.0 as enhanced,
 round(case when k = 12 then case when v <= 0.5 then 0.0 when v >= 3.5001 then 250.0 when v >= 0.5001 and v <= 1.5 then 45.0 when v >= 1.5001 and v <= 2.5 then 46.0 when v >= 2.5001 and v <= 3.5 then 211.0 end
  when k = 11 then {_RAINBOW_RED} end, 6) + 0.0 as red from q""")
def m18_u2_enhanced_pixels(spark: SparkSession, d: str) -> DataFrame:
    """Each pixel by the builtin rule of its (made-up) product: rule chosen, its operations applied."""
    k = ((F.col("y") * 100 + F.col("x")) % len(_CASES)).cast("int")
    pick = lambda j: F.get(F.array(*[F.lit(c[j]) for c in _CASES]), k)
    pixels = swath_view(spark, d).select("y", "x", "value", pick(0).alias("product"))
    attributes = spark.createDataFrame([(n, n, [s], std, reader, "area") for n, s, std, reader, _, _ in _CASES], "product string, name string, sensor array<string>, standard_name string, reader string, area_type string")
    decided = decide.decide(attributes, tables.builtin_enhancement_rules(spark))
    got = enhancement.enhance_pixels(pixels, decided, builtin_rules.enhancement_rows())
    return got.select("y", "x", "rule_id", r(F.col("enhanced")).alias("enhanced"), r(F.col("color.r")).alias("red"))


@query(f"with {SWATH}, l as (select product, min(value) as lo, max(value) as hi from swath group by product) select y, x, round((value - lo)/(hi - lo)*2 + 1, 6) + 0.0 as enhanced from swath join l using (product)")
def a14_u2_user_rule(spark: SparkSession, d: str) -> DataFrame:
    """A user's rule with a stretch between data limits and a method of the user's own."""
    enhance.register_enhancement("doubled", lambda v: v * 2 + 1)
    builtin_rules.ARGUMENTS.setdefault("doubled", ())
    rules = [{"rule_id": "mine", "operations": ["auto", "doubled"]}]
    s = swath_view(spark, d).select("y", "x", "product", "value")
    decided = s.select("product").distinct().withColumn("rule_id", F.lit("mine"))
    return enhancement.enhance_pixels(s, decided, rules).select("y", "x", r(F.col("enhanced")).alias("enhanced"))


_SCENE = f"""{BANDS}, m as (select y, x, y % 80 + 0.3 as sza, v1/2000 as m05, v2/2 as m04, (v1/4000 + v2)/2 as m03, v2*1.5 as m07, v1/1500 as m11, v1/1800 as i01, v2*1.4 as i02 from bands),
c as (select y, x, 0.9*m05/cos(radians(sza)) as m05, 0.9*m04/cos(radians(sza)) as m04, 0.9*m03/cos(radians(sza)) as m03, 0.9*m07/cos(radians(sza)) as m07, 0.9*m11/cos(radians(sza)) as m11, 0.9*i01/cos(radians(sza)) as i01, 0.9*i02/cos(radians(sza)) as i02, m11 as raw_m11, i02 as raw_i02, m05 as raw_m05, sza from m),
k as (select *, case when i01 > 0 and m05 > 0 then i01/m05 else 1.0 end as ratio, case when i02 > 0 and m07 > 0 then i02/m07 else 1.0 end as green from c)"""


def _curve(v: str) -> str:
    return f"(select case when w <= 0 then 0.0 when w <= 25/255.0 then 90/255.0 - (25/255.0 - w)*3.6 when w <= 55/255.0 then 140/255.0 - (55/255.0 - w)*(50/30.0) when w <= 100/255.0 then 175/255.0 - (100/255.0 - w)*(35/45.0) when w <= 1 then 1 - (1 - w)*(80/155.0) else 1.0 end from (select ({v} + 1)/111.0 as w))"


@query(f"""with {_SCENE} select y, x, round(i01, 6) + 0.0 as true_red, round(m04*ratio, 6) + 0.0 as true_green, round(m03*ratio, 6) + 0.0 as true_blue, round(m11*green, 6) + 0.0 as false_red, round(i02, 6) + 0.0 as false_green,
 round(raw_m05/cos(radians(sza)), 6) + 0.0 as raw_red, round(raw_m11 - raw_i02, 6) + 0.0 as ifog, round((raw_m11 - raw_i02)/(raw_m11 + raw_i02), 6) + 0.0 as nbr, round({_curve('i01')}, 6) + 0.0 as crefl08, round(m05, 6) + 0.0 as crefl01 from k""")
def c17_builtin_composites(spark: SparkSession, d: str) -> DataFrame:
    """Builtin recipes of one instrument, nested ones and optional sharpening included, on bands made of two."""
    composites.register_modifier("rayleigh_corrected", (), lambda v: v * 0.9)
    v1, v2 = F.col("v1"), F.col("v2")
    scene = {"M05": v1 / 2000, "M04": v2 / 2, "M03": (v1 / 4000 + v2) / 2, "M07": v2 * 1.5, "M11": v1 / 1500, "I01": v1 / 1800, "I02": v2 * 1.4, "I05": v1 / 1500, "I04": v2 * 1.4}
    b = bands_view(spark, d).select("y", "x", (F.col("y") % 80 + 0.3).alias("solar_zenith_angle"), *[c.alias(n) for n, c in scene.items()])
    got = composites.apply_recipes(b, ["true_color", "false_color", "true_color_raw", "ifog", "nbr", "viirs_crefl08", "_crefl01"], composites.builtin_recipes("viirs"))
    six = lambda c, n: r(F.col(c)).alias(n)
    return got.select("y", "x", six("true_color.r", "true_red"), six("true_color.g", "true_green"), six("true_color.b", "true_blue"), six("false_color.r", "false_red"), six("false_color.g", "false_green"), six("true_color_raw.r", "raw_red"), six("ifog", "ifog"), six("nbr", "nbr"), six("viirs_crefl08", "crefl08"), six("_crefl01", "crefl01"))


@query(f"with {SWATH} select product, count(*) as n, round(sum(case when product = 'click' then value + 1 else value end), 4) + 0.0 as total from swath where product in ('view', 'click') group by product")
def s1_k1_grouped_store(spark: SparkSession, d: str) -> DataFrame:
    """A grouped store, one product of it written anew, and two products read back."""
    s = swath_view(spark, d).select(F.lit("grid").alias("area_id"), "product", F.col("y").alias("row"), F.col("x").alias("col"), "value")
    path = shared_folder(spark, "grouped")
    sinks.write_grouped(s, path)
    sinks.write_grouped(s.where("product = 'click'").withColumn("value", F.col("value") + 1), path, append=True)
    got = tables.read_products(spark, path, ["view", "click"])
    return got.groupBy("product").agg(F.count("*").alias("n"), r(F.sum("value"), 4).alias("total"))


@query(f"with {SWATH} select 'product=' || product as folder, true as has_bytes from swath group by product")
def s2_list_inputs(spark: SparkSession, d: str) -> DataFrame:
    """Files below a folder, by their folder."""
    path = shared_folder(spark, "listed")
    swath_view(spark, d).select("product", "value").write.partitionBy("product").parquet(path)
    listed = tables.list_inputs(spark, [path], "*.parquet")
    return listed.groupBy(F.regexp_extract("path", "/(product=[^/]+)/", 1).alias("folder")).agg((F.min("bytes") > 0).alias("has_bytes"))


@query(f"with {SWATH}, t as (select floor(value/50)*50 as v, max(sza) as red, count(*) % 256 as green from swath group by 1) select v as value, red as r, green::double as g, 7.0 as b, 255.0 as a from t")
def s7_u4_colormap_file(spark: SparkSession, d: str) -> DataFrame:
    """A colour table written as text and read back."""
    t = swath_view(spark, d).groupBy((F.floor(F.col("value") / 50) * 50).alias("v")).agg(F.max("sza").alias("red"), (F.count("*") % 256).alias("green"))
    path = shared_folder(spark, "colors")
    t.select(F.concat_ws(", ", "v", "red", "green", F.lit("7 # a remark")).alias("value")).write.text(path)
    return tables.read_colormap(spark, path, "mine").drop("name")


@query(f"with {SWATH}, t as (select cast(floor(y/16.0)*4 + floor(x/25.0) + 1 as int) as tile, value from swath where value > 100) select tile, count(*) as n, count(*) as again from t group by tile")
def k5_k9_tiles_and_copy(spark: SparkSession, d: str) -> DataFrame:
    """Tiles and a plain copy from one computation, both read back."""
    s = swath_view(spark, d).select(enhance.tile_number(F.col("y"), F.col("x"), 100, 100, size=(16, 25)).alias("tile"), F.when(F.col("value") > 100, F.col("value")).alias("value"))
    tiles, copy = shared_folder(spark, "tiles"), shared_folder(spark, "copy")
    sinks.multi_write(s, [lambda df: sinks.write_tiles(df, tiles), lambda df: df.write.parquet(copy)])
    one = spark.read.parquet(tiles).groupBy("tile").agg(F.count("*").alias("n"))
    two = spark.read.parquet(copy).where("value is not null").groupBy("tile").agg(F.count("*").alias("again"))
    return one.join(two, "tile").select("tile", "n", "again")


def _kernel_sql(weight: str, reach: int) -> str:
    k = lambda d: weight.replace("@", f"abs({d})")
    w = f"({k('u-r')})*({k('w-c')})"
    return f"""with {SWATH}, g as (select y as row, x as col, value, (y + 0.5)/5.0 - 0.5 as u, (x + 0.5)/5.0 - 0.5 as w from swath), m as (select floor(max(row)/5.0) as r1, floor(max(col)/5.0) as c1 from g),
s as (select value, u, w, unnest(range(cast(floor(u) as bigint) - {reach - 1}, cast(floor(u) as bigint) + {reach + 1})) as r from g), t as (select *, unnest(range(cast(floor(w) as bigint) - {reach - 1}, cast(floor(w) as bigint) + {reach + 1})) as c from s)
select cast(r as int) as row, cast(c as int) as col, round(sum({w}*value)/sum({w}), 6) + 0.0 as value from t, m where r between 0 and r1 and c between 0 and c1 group by r, c"""


_KERNELS = {
    "cubic": ("case when @ <= 1 then 1.5*@*@*@ - 2.5*@*@ + 1 when @ < 2 then -0.5*@*@*@ + 2.5*@*@ - 4*@ + 2 else 0.0 end", 2),
    "cubicspline": ("case when @ <= 1 then 2/3.0 - @*@ + @*@*@/2 when @ < 2 then pow(2 - @, 3)/6 else 0.0 end", 2),
    "lanczos": ("case when @ < 1e-12 then 1.0 when @ < 3 then 3*sin(pi()*@)*sin(pi()*@/3)/(pi()*pi()*@*@) else 0.0 end", 3),
}


def _kernel(kind: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        g = swath_view(spark, d).select(F.col("y").alias("row"), F.col("x").alias("col"), "value")
        return resample.kernel_overview(g, 5, kind).withColumn("value", r(F.col("value")))

    run.__name__ = f"r15_{kind}"
    query(_kernel_sql(*_KERNELS[kind]))(run)


for _kind in _KERNELS:
    _kernel(_kind)


def _erf(x: str) -> str:
    t = f"(1/(1 + 0.3275911*abs({x})))"
    return f"(sign({x})*(1 - ((((1.061405429*{t} - 1.453152027)*{t} + 1.421413741)*{t} - 0.284496736)*{t} + 0.254829592)*{t}*exp(-({x})*({x}))))"


_ANGLES = "(({0} - 95.0)/(5*1.4142135623730951))"
_SUN, _MOON = _ANGLES.format("sza"), _ANGLES.format("(180 - sza)")


def _limit(level: float) -> str:
    return f"(pow(10, (1 - {_erf(_SUN)})*3.5 - {level}) + (1 - {_erf(_MOON)})*0.5*pow(10, -{level} + 0.5))"


def _gain(angle: str) -> str:
    phi = f"least(greatest({angle}, 0.0), 130.0)"
    return f"(case when {phi} < 87 then 1/(cos(radians(least({phi}, 89.0)))*58 + 4) when {phi} < 96 then 0.25*pow(10, ({phi} - 87)*0.2117) else 123 + ({phi} - 104)*3 end)"


@query(f"""with {SWATH}, q as (select y, x, value*1e-9 as v, sza, {_limit(10.0)} as lo, {_limit(8.5)} as hi from swath), s as (select *, greatest((v - lo)/(hi - lo), 0.0) as share from q)
select y, x, round(sqrt(least(share, 1.0)), 6) + 0.0 as dynamic, round(sqrt((case when share > 1 then 2 - 1/share else share end)/2), 6) + 0.0 as saturated,
 round(ln(1 + greatest(v, 0.0)/greatest(1/{_gain('sza')} + 0.5e-6/{_gain('(180 - sza)')}, 1e-12)), 6) + 0.0 as hncc from s""")
def c13_c14_dnb(spark: SparkSession, d: str) -> DataFrame:
    """Error-function and near-constant-contrast scalings; SQL has the same approximation of the error function."""
    v, s = F.col("value") * 1e-9, F.col("sza")
    lza: Column = F.lit(180.0) - s
    half = F.lit(0.5)
    return swath_view(spark, d).select("y", "x", r(composites.dynamic_dnb(v, s, lza, half)).alias("dynamic"), r(composites.dynamic_dnb(v, s, lza, half, True)).alias("saturated"), r(F.log1p(composites.hncc_dnb(v, s, lza, half))).alias("hncc"))
