"""Which products: selection, naming, aliases, criteria."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geogrid.sources.builtin_rules import PLATFORMS


def keep_first(df: DataFrame, key: str, pos: str = "pos") -> DataFrame:
    """One row a key, the one that comes first."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(pos))).where("__n = 1").drop("__n")


def select_products(user: DataFrame | None, defaults: DataFrame, available: DataFrame) -> DataFrame:
    """(product, pos): the user's list without repeats, or else the defaults; only what is available."""
    wanted = keep_first(user if user is not None else defaults, "product")
    return wanted.join(available.select("product").distinct(), "product", "left_semi")


def missing_products(wanted: DataFrame, available: DataFrame) -> DataFrame:
    """One row: the sorted distinct names that aren't available."""
    gone = wanted.join(available.select("product"), "product", "left_anti")
    return gone.agg(F.array_sort(F.collect_set("product")).alias("missing"))


def matching(products: DataFrame, criteria: DataFrame | bool) -> DataFrame:
    """Products that any criterion (key, value) names; True: all; an empty table: none."""
    if isinstance(criteria, bool):
        return products if criteria else products.limit(0)
    keys = [c for c in products.columns if c != "product"] + ["product"]
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in keys])
    hit = products.select("product", F.explode(pairs).alias("p")).select("product", "p.*").join(criteria, ["key", "value"], "left_semi")
    return products.join(hit.select("product").distinct(), "product", "left_semi")


def merged_criteria(*criteria: DataFrame) -> DataFrame:
    """Criteria of several readers together."""
    out = criteria[0]
    for c in criteria[1:]:
        out = out.unionByName(c)
    return out.distinct()


def expand_groups(tokens: DataFrame, groups: DataFrame) -> DataFrame:
    """(product, pos): group tokens replaced by their members (group, product, member_pos), others as they are.

    A user's list of names and its members, so one task numbers them.
    """
    joined = tokens.withColumnRenamed("product", "token").join(groups.withColumnRenamed("group", "token"), "token", "left")
    order = F.row_number().over(Window.orderBy("pos", F.coalesce("member_pos", F.lit(0))))
    return keep_first(joined.select(F.coalesce("product", "token").alias("product"), order.alias("pos")), "product")


def to_internal(names: DataFrame, aliases: DataFrame) -> DataFrame:
    """``internal`` for each user name: the alias table's (alias, internal), or the name itself."""
    return names.join(aliases, names["name"] == aliases["alias"], "left").select(names["*"], F.coalesce("internal", "name").alias("internal_name"))


def to_alias(names: DataFrame, aliases: DataFrame) -> DataFrame:
    """``alias`` for each internal name: the last alias of it; the name itself if it has none; null if the name
    is an alias of something else, as it would not come back."""
    last = aliases.groupBy("internal").agg(F.max_by("alias", "pos").alias("alias"))
    taken = aliases.select(F.col("alias").alias("name"), F.col("internal").alias("other")).dropDuplicates(["name"])
    joined = names.join(last, names["name"] == last["internal"], "left").join(taken, "name", "left")
    return joined.select("name", F.coalesce("alias", F.when(F.col("other").isNull() | (F.col("other") == F.col("name")), F.col("name"))).alias("alias"))


def relaxed_match(wanted: DataFrame, available: DataFrame) -> DataFrame:
    """(name, matched): the available identity with the most modifiers after dropping them from the end one by one."""
    prefixes = wanted.select("name", "modifiers", F.explode(F.sequence(F.lit(0), F.size("modifiers"))).alias("n"))
    tried = prefixes.select("name", "n", F.concat_ws(",", F.slice("modifiers", 1, F.col("n"))).alias("mods"))
    have = available.select("name", F.concat_ws(",", "modifiers").alias("mods")).distinct()
    return tried.join(have, ["name", "mods"]).groupBy("name").agg(F.max_by("mods", "n").alias("matched"))


def list_products(available: DataFrame, standard: DataFrame, custom: DataFrame) -> DataFrame:
    """(section, product, label): standard, custom and other available products; * marks what isn't standard."""
    names = available.select("product").distinct()
    std, own = (t.select("product").distinct() for t in (standard, custom))
    parts = [("standard", names.intersect(std)), ("custom", names.intersect(own.subtract(std))), ("other", names.subtract(std).subtract(own))]
    out = None
    for section, part in parts:
        part = part.select(F.lit(section).alias("section"), "product", F.concat(F.lit("" if section == "standard" else "*"), "product").alias("label"))
        out = part if out is None else out.unionByName(part)
    return out.orderBy("section", "product")


def platform_alias(name: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in PLATFORMS.items() for x in kv])
    return F.coalesce(F.try_element_at(table, F.replace(F.lower(name), F.lit("-"), F.lit(""))), name)


def sensor_alias(sensors: Column) -> Column:
    """A sorted set of sensor names in lower case without hyphens."""
    return F.array_sort(F.array_distinct(F.transform(sensors, lambda s: F.replace(F.lower(s), F.lit("-"), F.lit("")))))


def area_or_native(area_id: Column) -> Column:
    return F.coalesce(area_id, F.lit("native"))


def pressure_name(base: Column, level: Column) -> Column:
    """Product of a pressure level: whole numbers from 5 on, three decimals below."""
    text = F.when(level >= 5, F.format_string("%.0f", level)).otherwise(F.format_string("%.3f", level))
    return F.concat(base, F.lit("_"), text, F.lit("mb"))


def output_name(pattern: str, columns: dict[str, Column]) -> Column:
    """A name from a pattern like ``{platform_name!u}_{start_time:%Y%m%d_%H%M%S}.dat``."""
    codes = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss", "%j": "DDD", "%y": "yy"}
    parts: list[Column] = []
    for text, field, spec, _ in string.Formatter().parse(_case_flags(pattern)):
        if text:
            parts.append(F.lit(text))
        if field is None:
            continue
        name, case = [*field.split("__case_"), ""][:2]
        c = columns[name]
        if spec and "%" in spec:
            for k, v in codes.items():
                spec = spec.replace(k, v)
            c = F.date_format(c, spec)
        elif spec and spec.endswith("d"):
            c = F.format_string("%" + spec, c.cast("int"))
        c = c.cast("string")
        parts.append(F.lower(c) if case == "l" else F.upper(c) if case == "u" else c)
    return F.concat(*parts)


def _case_flags(pattern: str) -> str:
    return pattern.replace("!l", "__case_l").replace("!u", "__case_u")
