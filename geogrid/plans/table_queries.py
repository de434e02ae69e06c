"""Queries of granules, products, rules, filters and grids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geogrid.operators import compare, decide, filters, grids, products, sinks
from geogrid.plans.scalar_queries import r
from geogrid.plans.views import BANDS, GRANULES, PRODUCTS, SWATH
from geogrid.plans.views import bands as bands_view
from geogrid.plans.views import granules as granules_view
from geogrid.plans.views import products as products_view
from geogrid.plans.views import swath as swath_view
from geogrid.sources import builtin_rules, granules, tables
from geogrid.sources.builtin_rules import MATCH_KEYS

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_LISTED = f"""with {GRANULES}, listed as (select gid, start_time as s, 'b/SVI01_npp_d' || strftime(start_time, '%Y%m%d') || '_t' || strftime(start_time + to_seconds(86390 + gid % 20), '%H%M%S') || cast(gid % 10 as varchar) || '_e' || strftime(start_time + to_seconds(86390 + gid % 20 + 90), '%H%M%S') || '0_b1.h5' as path, gid % 20 as k from granules)"""


@query(f"""{_LISTED} select gid, path, s + (case when k < 10 then to_seconds(86390 + k) else to_seconds(k - 10) end) + to_milliseconds(100*(gid % 10)) as start_time,
 s + (case when k < 10 then to_seconds(86400 + 80 + k) else to_seconds(k + 80) end) as end_time from listed""")
def s3_granule_catalog(spark: SparkSession, d: str) -> DataFrame:
    g = granules_view(spark, d)
    begin = F.timestamp_add("SECOND", F.lit(86390) + F.col("gid") % 20, F.col("start_time"))
    end = F.timestamp_add("SECOND", F.lit(86480) + F.col("gid") % 20, F.col("start_time"))
    path = F.concat(F.lit("b/SVI01_npp_d"), F.date_format("start_time", "yyyyMMdd"), F.lit("_t"), F.date_format(begin, "HHmmss"), (F.col("gid") % 10).cast("string"), F.lit("_e"), F.date_format(end, "HHmmss"), F.lit("0_b1.h5"))
    return granules.granule_times(g.select("gid", path.alias("path")))


_REQUESTS = f"""{GRANULES}, requests as (select o_orderkey % 5 as sat, cast(o_orderdate as timestamp) - interval '20' minute as start_time, cast(o_orderdate as timestamp) + interval '25' minute as end_time, o_orderkey as rid from orders)"""


@query(f"with {_REQUESTS} select rid, gid, g.sat from granules g join requests q on g.sat = q.sat and g.start_time <= q.end_time and g.end_time >= q.start_time")
def s4_j4_search(spark: SparkSession, d: str) -> DataFrame:
    """A request for each order."""
    return _search(spark, d, spark.read.parquet(f"{d}/orders.parquet"))


def _search(spark: SparkSession, d: str, o: DataFrame) -> DataFrame:
    t = F.col("o_orderdate").cast("timestamp_ntz")
    asked = o.select((F.col("o_orderkey") % 5).alias("sat"), F.timestamp_add("MINUTE", F.lit(-20), t).alias("start_time"), F.timestamp_add("MINUTE", F.lit(25), t).alias("end_time"), F.col("o_orderkey").alias("rid"))
    return granules.search_granules(granules_view(spark, d), asked, ("sat",)).select(F.col("r_rid").alias("rid"), "gid", "sat")


@query(f"""with {GRANULES}, b as (select gid, case gid % 4 when 0 then 'I01' when 1 then 'M12' when 2 then 'GDNBO' else 'DNB' end as band, start_time, unnest(generate_series(date_trunc('hour', start_time - interval '1' minute), date_trunc('hour', end_time), interval '1' hour)) as h from granules)
select gid, band, case band when 'I01' then 'VIIRS-I1-SDR' when 'M12' then 'VIIRS-M12-SDR' when 'DNB' then 'VIIRS-DNB-SDR' else 'VIIRS-DNB-GEO' end as prefix, case band when 'I01' then 1 when 'M12' then 17 when 'DNB' then 22 else 25 end as band_order,
 'https://noaa.s3.amazonaws.com/x/' || band as uri, strftime(h, '%Y/%m/%d %H') as hour from b""")
def s5_s6_o3_prefixes(spark: SparkSession, d: str) -> DataFrame:
    return _prefixes(granules_view(spark, d))


def _prefixes(listed: DataFrame) -> DataFrame:
    band = F.element_at(F.array(*map(F.lit, ("I01", "M12", "GDNBO", "DNB"))), (F.col("gid") % 4 + 1).cast("int"))
    asked = listed.select("gid", band.alias("band"), "start_time", "end_time")
    got = granules.expand_bands(asked)
    hours = granules.hours_of(F.timestamp_add("MINUTE", F.lit(-1), F.col("start_time")), F.col("end_time"))
    out = got.select("gid", "band", granules.band_prefix(F.col("band")).alias("prefix"), "band_order", granules.granule_uri(F.concat(F.lit("noaa/x/"), "band"), "https").alias("uri"), F.explode(hours).alias("h"))
    return out.select("gid", "band", "prefix", "band_order", "uri", F.date_format("h", "yyyy/MM/dd HH").alias("hour"))


_ALIASES = "aliases(alias, internal, pos) as (values ('vis', 'view', 1), ('visible', 'view', 2), ('buy', 'purchase', 3), ('click', 'error', 4))"
_ALIAS_ROWS = [("vis", "view", 1), ("visible", "view", 2), ("buy", "purchase", 3), ("click", "error", 4)]


@query(f"""with {PRODUCTS}, {_ALIASES}, u as (select product as name from products union all select 'buy' union all select 'vis')
select name, coalesce((select internal from aliases where alias = name), name) as internal_name from u""")
def n1_to_internal(spark: SparkSession, d: str) -> DataFrame:
    names = products_view(spark, d).select(F.col("product").alias("name")).unionByName(spark.createDataFrame([("buy",), ("vis",)], "name string"))
    return products.to_internal(names, spark.createDataFrame(_ALIAS_ROWS, "alias string, internal string, pos int"))


@query(f"""with {PRODUCTS}, {_ALIASES} select product as name, coalesce((select arg_max(alias, pos) from aliases where internal = product), case when product not in (select alias from aliases) then product end) as alias from products""")
def n2_to_alias(spark: SparkSession, d: str) -> DataFrame:
    names = products_view(spark, d).select(F.col("product").alias("name"))
    return products.to_alias(names, spark.createDataFrame(_ALIAS_ROWS, "alias string, internal string, pos int"))


@query(f"""with {PRODUCTS} select product, case when platform_name = 'Suomi-NPP' then 'npp' else 'aqua' end as platform, case when length(product) % 2 = 0 then 'viirs' else 'modis' end as sensors, 'native' as area, upper(product) || '_' || strftime(ts, '%Y%m%d_%H%M%S') || '.dat' as file_name
 from products join (select product as p, min(ts) as ts from swath group by product) on p = product""")
def n5_n6_n7_k7_names(spark: SparkSession, d: str) -> DataFrame:
    times = swath_view(spark, d).groupBy("product").agg(F.min("ts").alias("ts"))
    df = products_view(spark, d).join(times, "product")
    name = products.output_name("{product!u}_{ts:%Y%m%d_%H%M%S}.dat", {"product": F.col("product"), "ts": F.col("ts")})
    return df.select("product", products.platform_alias(F.col("platform_name")).alias("platform"), F.array_join(products.sensor_alias("sensor"), "-").alias("sensors"), products.area_or_native(F.lit(None).cast("string")).alias("area"), name.alias("file_name"))


@query(f"""with {PRODUCTS} select case when product in ('click', 'view') then 'standard' when product in ('error') then 'custom' else 'other' end as section, product, case when product in ('click', 'view') then '' else '*' end || product as label from products""")
def n4_o1_list_products(spark: SparkSession, d: str) -> DataFrame:
    named = lambda *n: spark.createDataFrame([(x,) for x in n], "product string")
    return products.list_products(products_view(spark, d), named("click", "view"), named("error", "view"))


_TOKENS = "tokens as (select case event_id % 3 when 0 then event_type when 1 then 'no_' || event_type else upper(event_type) end as product, event_id as pos from events)"


def _tokens(spark: SparkSession, d: str) -> DataFrame:
    """A long user list: names that exist, others, and many repeats."""
    e = spark.read.parquet(f"{d}/events.parquet")
    n, kind = F.col("event_id"), F.col("event_type")
    return e.select(F.when(n % 3 == 0, kind).when(n % 3 == 1, F.concat(F.lit("no_"), kind)).otherwise(F.upper(kind)).alias("product"), n.alias("pos"))


@query(f"with {_TOKENS} select product, min(pos) as pos from tokens where product in (select event_type from events) group by product")
def f1_w9_select(spark: SparkSession, d: str) -> DataFrame:
    user = _tokens(spark, d)
    return products.select_products(user, user, products_view(spark, d))


@query(f"with {PRODUCTS} select product, n from products where reader = 'viirs_sdr' or product = 'click'")
def f2_o7_criteria(spark: SparkSession, d: str) -> DataFrame:
    criteria = [spark.createDataFrame([x], "key string, value string") for x in (("reader", "viirs_sdr"), ("product", "click"))]
    p = products_view(spark, d).withColumn("sensor", F.array_join("sensor", "-"))
    return products.matching(p, products.merged_criteria(*criteria)).select("product", "n")


@query(f"with {_TOKENS} select array_to_string(list_sort(list(distinct product)), ',') as missing from tokens where product not in (select event_type from events)")
def f15_o6_missing(spark: SparkSession, d: str) -> DataFrame:
    return products.missing_products(_tokens(spark, d), products_view(spark, d)).select(F.array_join("missing", ",").alias("missing"))


@query(f"""with {PRODUCTS}, g("group", member, member_pos) as (select 'g' || length(product), product, row_number() over (partition by length(product) order by product desc) from products),
t as (select token, min(pos) as pos from (select case event_id % 2 when 0 then event_type else 'g' || length(event_type) end as token, event_id as pos from events) group by token),
j as (select coalesce(member, token) as product, row_number() over (order by pos, coalesce(member_pos, 0)) as pos from t left join g on token = "group") select product, cast(min(pos) as int) as pos from j group by product""")
def f13_groups(spark: SparkSession, d: str) -> DataFrame:
    """Names and groups of names mixed in one list; a group's members come in its order."""
    from pyspark.sql import Window

    p = products_view(spark, d)
    size = F.length("product")
    groups = p.select(F.concat(F.lit("g"), size).alias("group"), "product", F.row_number().over(Window.partitionBy(size).orderBy(F.desc("product"))).alias("member_pos"))
    e = spark.read.parquet(f"{d}/events.parquet")
    token = F.when(F.col("event_id") % 2 == 0, F.col("event_type")).otherwise(F.concat(F.lit("g"), F.length("event_type")))
    tokens = e.groupBy(token.alias("product")).agg(F.min("event_id").alias("pos"))
    return products.expand_groups(tokens, groups).join(p.select("product"), "product", "left_semi")


@query(f"with {SWATH} select product, round(avg(case when sza < 90 then 1 else 0 end), 6) + 0.0 as sunlit from swath group by product having avg(case when sza < 90 then 1 else 0 end) >= 0.5")
def f3_a7_daylight(spark: SparkSession, d: str) -> DataFrame:
    lit = filters.sunlit_fraction(swath_view(spark, d))
    kept = filters.daylight_filter(products_view(spark, d), lit, True, day=True, fraction=0.5)
    return kept.join(lit, "product").select("product", r(F.col("sunlit")).alias("sunlit"))


@query(f"""with {SWATH}, c as (select distinct product, cast(floor((57.0-lat)/0.1) as int) as row, cast(floor((lon+96.0)/0.1) as int) as col from swath)
select product, round(count(*)/585600.0, 7) + 0.0 as coverage from c where row between 0 and 319 and col between 0 and 1829 group by product having count(*)/585600.0 >= 0.0002""")
def f4_a8_coverage(spark: SparkSession, d: str) -> DataFrame:
    row, col = grids.cell_of(F.col("lon"), F.col("lat"), -96.0, 57.0, 0.1, 0.1)
    hits = swath_view(spark, d).select("product", row.cast("int").alias("row"), col.cast("int").alias("col"))
    covered = filters.coverage(hits, 1830, 320)
    wanted = products_view(spark, d).select("product", F.lit(None).cast("double").alias("grid_coverage"), F.lit(False).alias("skip"))
    return filters.coverage_filter(wanted, covered, 0.0002).join(covered, "product").select("product", r(F.col("coverage"), 7).alias("coverage"))


@query(f"""with {PRODUCTS}, h as (select product, platform_name, sensor, max(y) + 1 as height, avg(case when sza < 45 then 1 else 0 end) as own from swath join products using (product) group by 1, 2, 3)
select product, round(first_value(own) over (partition by platform_name, sensor order by height, product), 6) + 0.0 as coverage from h""")
def w4_shared_coverage(spark: SparkSession, d: str) -> DataFrame:
    own = swath_view(spark, d).groupBy("product").agg((F.max("y") + 1).alias("height"), F.avg((F.col("sza") < 45).cast("int")).alias("coverage"))
    shared = filters.shared_coverage(products_view(spark, d).join(own, "product"))
    return shared.select("product", r(F.col("coverage")).alias("coverage"))


@query(f"with {SWATH}, i as (select * from swath where lon between -94 and -91 and lat between 25.2 and 29), o as (select min(y) as y0, min(x) as x0 from i) select cast(y - y0 as int) as y, cast(x - x0 as int) as x, value from i, o")
def f5_crop(spark: SparkSession, d: str) -> DataFrame:
    return filters.crop(swath_view(spark, d), -94, 25.2, -91, 29).select("y", "x", "value")


@query(f"""with {SWATH} select y, x, case when cast(sza as int) % 4 <= 1 then value end as f6, case when cast(sza as int) & 6 = 0 then value end as f7, case when cast(sza as int) % 5 in (0, 1) then value end as f8,
 case when sza <= 100 then value end as f9, case when value < 100 then value end as f11, greatest(value - 50, 0.0) as f11_clip from swath""")
def f6_f11_masks(spark: SparkSession, d: str) -> DataFrame:
    v, q = F.col("value"), F.col("sza").cast("int")
    return swath_view(spark, d).select(
        "y",
        "x",
        filters.mask_quality(v, q % 4, 1).alias("f6"),
        filters.mask_flags(v, q, bits=6).alias("f7"),
        filters.mask_good(v, q % 5, [0, 1]).alias("f8"),
        filters.mask_below_surface(v, F.col("sza"), F.lit(100.0)).alias("f9"),
        filters.mask_saturated(v, 100.0).alias("f11"),
        filters.clip_negative(v - 50).alias("f11_clip"),
    )


@query(f"with {SWATH} select product || '_' || case when sza >= 5 then cast(cast(sza as int) as varchar) else printf('%.3f', sza) end || 'mb' as name, count(*) as n from swath where sza between 2 and 150 group by 1")
def f9_f10_levels(spark: SparkSession, d: str) -> DataFrame:
    df = filters.between_levels(swath_view(spark, d), 2, 150, "sza")
    return df.groupBy(products.pressure_name(F.col("product"), F.col("sza")).alias("name")).agg(F.count("*").alias("n"))


@query(f"with {SWATH}, m as (select max(y) as y1, max(x) as x1 from swath) select y1 - y as y, x1 - x as x, value, case when sza < 80 then round(value/cos(sza*pi()/180), 6) + 0.0 end as f14 from swath, m")
def f12_f14_orient(spark: SparkSession, d: str) -> DataFrame:
    df = filters.orient(swath_view(spark, d), "SW")
    return df.select("y", "x", "value", F.when(F.col("sza") < 80, r(filters.normalized(F.col("value"), F.col("sza"), True))).alias("f14"))


@query(f"with {SWATH}, s as (select product, lon - 85.02 as l, lat from swath) select product, round(min(l), 6) + 0.0 as lon_min, round(max(l), 6) + 0.0 as lon_max, round(min(lat), 6) + 0.0 as lat_min, round(max(lat), 6) + 0.0 as lat_max from s group by product")
def g12_a4_bounds(spark: SparkSession, d: str) -> DataFrame:
    df = grids.swath_bounds(swath_view(spark, d).withColumn("lon", F.col("lon") - 85.02), "product")
    return df.select("product", *[r(F.col(c)).alias(c) for c in ("lon_min", "lon_max", "lat_min", "lat_max")])


@query(f"""with {SWATH}, s as (select (lon + 274.5) - 360*floor((lon + 274.5 + 180)/360) as l, lat from swath), b as (select min(l - 360*floor(l/360)) as w, max(l - 360*floor(l/360)) as e, min(lat) as s, max(lat) as n from s)
select cast(ceil((e-w)/0.5 + 1) as int) as width, cast(ceil((n-s)/0.5 + 1) as int) as height, round(w - 0.25, 6) + 0.0 as x_min, round(n + 0.25, 6) + 0.0 as y_max from b""")
def g3_freeze(spark: SparkSession, d: str) -> DataFrame:
    from geogrid.functions.projections import wrap_lon

    df = swath_view(spark, d).withColumn("lon", wrap_lon(F.col("lon") + 274.5))
    got = grids.freeze_grid(df, {"proj": "longlat"}, 0.5, 0.5, "modify_extents")
    return got.select("width", "height", r(F.col("x_min")).alias("x_min"), r(F.col("y_max")).alias("y_max"))


@query(f"""with {BANDS}, s as (select y, x, (y % 360) - 180.0 as lon, cast(y % 179 as double) - 89 as lat, cast(10 + x as int) as w from bands)
select y, x, case when abs(lat) < 15 then 'eqc' when abs(lat) < 70 then 'lcc' else 'stere' end as kind, round(lon - w/2.0*100, 6) + 0.0 as x_min, round(lat + w/2.0*50, 6) + 0.0 as y_max, round(lon - 50, 6) + 0.0 as edge_x, round(lat + 25, 6) + 0.0 as edge_y from s""")
def g5_g6_g10_sites(spark: SparkSession, d: str) -> DataFrame:
    y = F.col("y")
    s = bands_view(spark, d).select("y", "x", (y % 360 - 180.0).alias("lon"), ((y % 179).cast("double") - 89).alias("lat"), (F.col("x") + 10).cast("int").alias("width"), (F.col("x") + 10).cast("int").alias("height"))
    around = grids.centered_extent(F.col("lon"), F.col("lat"), F.col("width"), F.col("height"), F.lit(100.0), F.lit(-50.0))
    edge = grids.extent_from_center(s.withColumns({"x0": F.col("lon"), "y0": F.col("lat"), "cw": F.lit(100.0), "ch": F.lit(-50.0)}))
    kind = F.regexp_extract(grids.choose_projection(F.col("lon"), F.col("lat")), "proj=([a-z]+)", 1)
    return edge.select("y", "x", kind.alias("kind"), r(around["x_min"]).alias("x_min"), r(around["y_max"]).alias("y_max"), r(F.col("x_min")).alias("edge_x"), r(F.col("y_max")).alias("edge_y"))


@query(f"""with {PRODUCTS}, areas as (select product as area_id, max(y) + 1.0 as dx from swath group by product),
names(name) as (values ('MAX'), ('MIN'), ('wgs84_fit'), ('mine'), ('zzz'))
select name, case name when 'MAX' then (select area_id from areas order by dx, area_id limit 1) when 'MIN' then (select area_id from areas order by dx desc, area_id desc limit 1) when 'wgs84_fit' then 'wgs84_fit' when 'mine' then 'mine' end as area_id from names""")
def g1_g2_resolve(spark: SparkSession, d: str) -> DataFrame:
    areas = swath_view(spark, d).groupBy(F.col("product").alias("area_id")).agg((F.max("y") + 1.0).alias("dx"))
    names = spark.createDataFrame([("MAX",), ("MIN",), ("wgs84_fit",), ("mine",), ("zzz",)], "name string")
    own = spark.createDataFrame([("mine",)], "area_id string")
    builtin = tables.builtin_grid_table(spark)
    return grids.resolve_grid(names, areas, own, own.limit(0), builtin).select("name", "area_id")


@query(f"""with {PRODUCTS} select product, case when sensor = 'viirs' then 'default_viirs_sdr' else 'default_modis' end as rule_id, 'ewa' as resampler,
 case when sensor = 'viirs' then 'weight_delta_max=40.0,weight_distance_max=2.0' else 'weight_delta_max=10.0,weight_distance_max=1.0' end as kwargs from products""")
def r7_w1_decide(spark: SparkSession, d: str) -> DataFrame:
    p = products_view(spark, d).withColumn("name", F.col("product"))
    got = decide.decide(p, tables.builtin_resampling_rules(spark))
    return got.select("product", "rule_id", "resampler", decide.kwargs_key(F.col("kwargs")).alias("kwargs"))


#: User rules over the builtin ones: one by name, one by reader, one that repeats a builtin rule's keys.
USER_RULES = [
    ("mine_named", {"name": "n3"}, "native", {}),
    ("mine_reader", {"reader": "viirs_sdr", "units": "K"}, "nearest", {"radius_of_influence": "3000"}),
    ("mine_again", {"area_type": "swath", "sensor": "mwr"}, "ewa", {"weight_delta_max": "20.0"}),
]


def _attribute_values(rows: list[dict]) -> dict[str, list[str]]:
    """By match key, all values that rules ask for, and one that none does."""
    return {k: [*dict.fromkeys(r["keys"][k] for r in rows if k in r["keys"]), "other"] for k in MATCH_KEYS}


def _rule_table_sql(rows: list[dict], values: dict[str, list[str]]) -> str:
    """Parts as products: each attribute a value picked by the key's digits; the best rule by counting matches."""
    text = lambda v: "null" if v is None else f"'{v}'"
    rules = ", ".join(f"({text(r['rule_id'])}, {k}, {', '.join(text(r['keys'].get(c)) for c in MATCH_KEYS)})" for k, r in enumerate(rows))
    step, picks = 1, []
    for key, options in values.items():
        picks.append(f"[{', '.join(map(text, options))}][cast(floor(p_partkey/{step}.0) as bigint) % {len(options)} + 1] as {key}")
        step *= 2
    match = " and ".join(f"(r.{k} is null or r.{k} = p.{k})" for k in MATCH_KEYS)
    size = " + ".join(f"(r.{k} is not null)::int" for k in MATCH_KEYS)
    return f"""with r(rule_id, n, {", ".join(MATCH_KEYS)}) as (values {rules}), p as (select p_partkey, {", ".join(picks)} from part),
 m as (select p_partkey, rule_id, row_number() over (partition by p_partkey order by r.name is not null desc, {size} desc, n desc) as rank from p join r on {match})
 select cast(p_partkey as varchar) as product, rule_id from part left join (select * from m where rank = 1) using (p_partkey)"""


def _rule_products(spark: SparkSession, d: str, values: dict[str, list[str]]) -> DataFrame:
    step, columns = 1, []
    for key, options in values.items():
        pick = F.get(F.array(*map(F.lit, options)), (F.floor(F.col("p_partkey") / step) % len(options)).cast("int"))
        columns.append((F.array(pick) if key == "sensor" else pick).alias(key))
        step *= 2
    return spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").cast("string").alias("product"), *columns)


_RESAMPLING = [*builtin_rules.resampling_rows(), *({"rule_id": n, "keys": keys, "resampler": how, "kwargs": kw} for n, keys, how, kw in USER_RULES)]
_RESAMPLING_VALUES = _attribute_values(_RESAMPLING)
_ENHANCEMENT_VALUES = _attribute_values(builtin_rules.enhancement_rows())


@query(_rule_table_sql(_RESAMPLING, _RESAMPLING_VALUES))
def r7_u5_user_rules(spark: SparkSession, d: str) -> DataFrame:
    """Every part a product with attributes of its own; builtin resampling rules with a user's layer over them."""
    builtin = tables.builtin_resampling_rules(spark)
    own = spark.createDataFrame([(n, "resampling", keys, how, None, kw, 1000 + k) for k, (n, keys, how, kw) in enumerate(USER_RULES)], builtin.schema)
    return decide.decide(_rule_products(spark, d, _RESAMPLING_VALUES), builtin.unionByName(own)).select("product", "rule_id")


@query(_rule_table_sql(builtin_rules.enhancement_rows(), _ENHANCEMENT_VALUES))
def m18_all_rules(spark: SparkSession, d: str) -> DataFrame:
    """Every part a product with attributes of its own; all builtin enhancement rules."""
    return decide.decide(_rule_products(spark, d, _ENHANCEMENT_VALUES), tables.builtin_enhancement_rules(spark)).select("product", "rule_id")


@query(f"with {PRODUCTS} select product, case when standard_name = 'toa_brightness_temperature' then 'brightness_temperature_default' else 'reflectance_default' end as rule_id from products")
def m18_m19_enhancement_rule(spark: SparkSession, d: str) -> DataFrame:
    p = products_view(spark, d).withColumn("name", F.col("product"))
    return decide.decide(p, tables.builtin_enhancement_rules(spark)).select("product", "rule_id")


@query(f"""with {PRODUCTS} select 'ewa' as resampler, case when sensor = 'viirs' then 'weight_delta_max=40.0,weight_distance_max=5' else 'weight_delta_max=10.0,weight_distance_max=5' end as kwargs_key, 'wgs84_fit' as target, array_to_string(list_sort(list(product)), ',') as products from products group by 1, 2, 3""")
def r8_r9_groups(spark: SparkSession, d: str) -> DataFrame:
    p = products_view(spark, d).withColumn("name", F.col("product"))
    got = decide.decide(p, tables.builtin_resampling_rules(spark))
    got = got.withColumn("target", decide.default_target(F.col("resampler"), F.col("default_target"), F.lit(False)))
    groups = decide.resampling_groups(got, F.create_map(F.lit("weight_distance_max"), F.lit("5")))
    return groups.withColumn("products", F.array_join("products", ","))


@query(f"""with {PRODUCTS}, t(grid) as (values ('MAX'), ('wgs84_fit')) select product, grid, case when grid = 'MAX' then 'native' else 'nearest' end as resampler, grid = 'MAX' as preserved from products, t where product not in ('error') and product <> 'view'""")
def r6_r10_r11_r12_plan(spark: SparkSession, d: str) -> DataFrame:
    targets = spark.createDataFrame([("MAX",), ("wgs84_fit",)], "grid string")
    p = products_view(spark, d).select("product")
    out = decide.limit_output(p, p.where("product <> 'view'"), p.where("product = 'error'"))
    choice = decide.default_resampler(F.col("grid"), F.lit(False))
    return decide.to_many(out, targets).select("product", "grid", choice.alias("resampler"), decide.preserves_resolution(F.col("grid"), F.lit(None).cast("string")).alias("preserved"))


@query(f"""with {PRODUCTS}, layers as (select 1 as layer, product as rule_id, 'n' as key, cast(n as varchar) as value from products union all select 2, product, 'n', case when product < 'p' then 'later' end from products union all select 2, product, 'only', 'x' from products)
select distinct rule_id, key, last_value(value ignore nulls) over (partition by rule_id, key order by layer rows between unbounded preceding and unbounded following) as value from layers""")
def w3_s9_layers(spark: SparkSession, d: str) -> DataFrame:
    p = products_view(spark, d)
    one = p.select(F.lit(1).alias("layer"), F.col("product").alias("rule_id"), F.lit("n").alias("key"), F.col("n").cast("string").alias("value"))
    two = p.select(F.lit(2), "product", F.lit("n"), F.when(F.col("product") < "p", "later"))
    three = p.select(F.lit(2), "product", F.lit("only"), F.lit("x"))
    return tables.merge_layers(one.union(two).union(three))


@query(f"""with {PRODUCTS}, g as (select product as area_id, n as width, 1 as load_order from products union all select 'view', 7, 9 union all select 'new', 8, 10)
select area_id, arg_max(width, load_order) as width, count(*) as n_definitions from g group by area_id""")
def w2_s8_user_grids(spark: SparkSession, d: str) -> DataFrame:
    base = products_view(spark, d).select(F.col("product").alias("area_id"), F.col("n").alias("width"), F.lit(1).alias("load_order"))
    user = spark.createDataFrame([("view", 7, 1), ("new", 8, 2)], "area_id string, width long, load_order int")
    return tables.with_user_grids(base, user).select("area_id", "width", "n_definitions")


@query(f"""with {BANDS}, w as (select distinct 'b' || (y % 50) as name, cast(1 + y % 4 as int) as k from bands), h as (select distinct 'b' || (y % 50) as name, cast(x % 3 as int) as k from bands where y % 5 <> 3)
select name, array_to_string(['a', 'b', 'c', 'd'][1:w.k], ',') as wanted, array_to_string(['a', 'b', 'c', 'd'][1:(select max(h.k) from h where h.name = w.name and h.k <= w.k)], ',') as matched from w where exists (select 1 from h where h.name = w.name and h.k <= w.k)""")
def n3_relaxed(spark: SparkSession, d: str) -> DataFrame:
    """Identities with up to four modifiers against ones with up to two."""
    b = bands_view(spark, d)
    letters = F.array(*map(F.lit, "abcd"))
    name = F.concat(F.lit("b"), F.col("y") % 50).alias("name")
    wanted = b.select(name, F.slice(letters, F.lit(1), (F.col("y") % 4 + 1).cast("int")).alias("modifiers")).distinct()
    have = b.where("y % 5 <> 3").select(name, F.slice(letters, F.lit(1), (F.col("x") % 3).cast("int")).alias("modifiers")).distinct()
    numbered = wanted.select(F.concat_ws("|", "name", F.array_join("modifiers", ",")).alias("id"), "name", "modifiers")
    out = None
    for size in range(1, 5):  # one wanted identity a name at a time
        part = products.relaxed_match(numbered.where(F.size("modifiers") == size).select("name", "modifiers"), have)
        part = part.select("name", F.array_join(F.slice(letters, 1, size), ",").alias("wanted"), "matched")
        out = part if out is None else out.unionByName(part)
    return out


@query(f"with {GRANULES} select sat, min(start_time) as start_time, max(end_time) as end_time, min(start_time) + to_microseconds(cast(floor((epoch_us(max(end_time)) - epoch_us(min(start_time)))/2) as bigint)) as mid_time from granules group by sat")
def a5_time_span(spark: SparkSession, d: str) -> DataFrame:
    return compare.time_span(granules_view(spark, d), "sat")


@query(f"""with {PRODUCTS} select case when product in ('view', 'click') then 'fast' when product = 'error' then 'bad' end as "group", case when product = 'x' then 'C_x' else product end as product, n from products where product in ('view', 'click', 'error')""")
def k6_cf_groups(spark: SparkSession, d: str) -> DataFrame:
    got = sinks.cf_groups(products_view(spark, d), {"fast": ["view", "click"], "bad": ["error"]}, exclude=["units", "standard_name"], numeric_prefix="C_")
    return got.select("group", "product", "n")


@query(f"""with {PRODUCTS} select product, case when product = 'view' then 'View Element' when sensor = 'modis' then 'Modis Element' else product end as element, case when product = 'view' then 'K' when sensor = 'modis' then '1' end as l_units from products""")
def t4_elements(spark: SparkSession, d: str) -> DataFrame:
    labels = spark.createDataFrame([("view", None, None, "View Element", "K"), (None, None, "modis", "Modis Element", "1")], "name string, reader string, sensor string, element string, units string")
    p = products_view(spark, d).withColumn("sensor", F.get("sensor", F.lit(0)))
    return sinks.element_label(p, labels).select("product", "element", "l_units")


@query(f"""with {PRODUCTS}, g as (select product as area_id, (max(x) + 1)*(1 + length(product) % 4) as width, length(product) % 2 as x_min, 10.0 + (ascii(product) % 2)*1e-5 + length(product)*1e-9 as y_max from swath group by product)
select a.area_id, b.area_id as other from g a join g b on greatest(a.width, b.width) % least(a.width, b.width) = 0 and a.x_min = b.x_min and abs(a.y_max - b.y_max) <= abs(b.y_max)*1e-6 + 1e-8""")
def g4_g11_native(spark: SparkSession, d: str) -> DataFrame:
    g = swath_view(spark, d).groupBy(F.col("product").alias("area_id")).agg(((F.max("x") + 1) * (F.first(F.length("product")) % 4 + 1)).alias("width"), (F.max("y") + 1).alias("height"))
    top = F.lit(10.0) + (F.ascii("area_id") % 2) * 1e-5 + F.length("area_id") * 1e-9
    g = g.withColumns({"proj": F.lit("longlat"), "x_min": (F.length("area_id") % 2).cast("double"), "y_min": F.lit(0.0), "x_max": F.lit(10.0), "y_max": top, "dx": F.lit(1.0), "dy": F.lit(1.0)})
    return grids.native_pairs(g.where(grids.is_static()))
