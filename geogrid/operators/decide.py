"""Rules: the best one for each product, resampling choices and groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geogrid.sources.builtin_rules import MATCH_KEYS
from geogrid.sources.shared import small


def decide(products: DataFrame, rules: DataFrame) -> DataFrame:
    """Each product with its best rule: all of the rule's keys match (sensor: any of the product's), then a
    match of the name wins, then more keys, then the later rule. Products without a rule have a null rule.

    The rules meet each product's attributes once; more than ``shared.MOST_ROWS`` of them raise.
    """
    sets = {k: F.array(F.col(k)) if k != "sensor" else F.col(k) for k in MATCH_KEYS if k in products.columns}
    ok = F.lit(True)
    for k in MATCH_KEYS:
        wanted = F.try_element_at(F.col("keys"), F.lit(k))
        held = F.coalesce(F.array_contains(sets[k], wanted), F.lit(False)) if k in sets else F.lit(False)
        ok = ok & (wanted.isNull() | held)
    own = rules.withColumnRenamed("kind", "rule_kind")
    joined = products.join(small(own), ok, "left")
    rank = Window.partitionBy("product").orderBy(F.coalesce(F.map_contains_key("keys", "name"), F.lit(False)).desc(), F.coalesce(F.size("keys"), F.lit(0)).desc(), F.desc("load_order"))
    return joined.withColumn("__n", F.row_number().over(rank)).where("__n = 1").drop("__n", "rule_kind")


def require_rules(decided: DataFrame) -> DataFrame:
    """``decided``, raising at the first product without a rule."""
    gone = F.raise_error(F.concat(F.lit("no rule for product "), F.col("product"))).cast("string")
    return decided.withColumn("rule_id", F.coalesce("rule_id", gone))


def default_resampler(grid: Column, native: Column) -> Column:
    """native for MIN, MAX and native grids, else nearest."""
    return F.when(grid.isin("MIN", "MAX") | native, F.lit("native")).otherwise(F.lit("nearest"))


def default_target(resampler: Column, rule_target: Column, geostationary: Column) -> Column:
    """Grid where none is asked: MAX for native resampling and geostationary data, else wgs84_fit."""
    return F.coalesce(rule_target, F.when((resampler == "native") | geostationary, F.lit("MAX")).otherwise(F.lit("wgs84_fit")))


def kwargs_key(kwargs: Column) -> Column:
    """A map's canonical text: entries sorted by key."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(kwargs)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")


def merged_kwargs(rule: Column, given: Column) -> Column:
    """A rule's arguments with the given ones over them."""
    empty = F.create_map().cast("map<string,string>")
    rule, given = F.coalesce(rule, empty), F.coalesce(given, empty)
    return F.map_concat(F.map_filter(rule, lambda k, _: ~F.map_contains_key(given, k)), given)


def resampling_groups(decided: DataFrame, given: Column | None = None) -> DataFrame:
    """(resampler, kwargs_key, target, products): products that share one geometry pass, sorted."""
    kwargs = merged_kwargs(F.col("kwargs"), given) if given is not None else F.col("kwargs")
    keyed = decided.withColumn("kwargs_key", kwargs_key(F.coalesce(kwargs, F.create_map().cast("map<string,string>"))))
    return keyed.groupBy("resampler", "kwargs_key", "target").agg(F.array_sort(F.collect_set("product")).alias("products"))


def preserves_resolution(grid: Column, resampler: Column) -> Column:
    """Products keep their own resolution: native or default resampling onto MIN or MAX."""
    return grid.isin("MIN", "MAX") & (resampler.isNull() | (resampler == "native"))


def to_many(products: DataFrame, grids: DataFrame) -> DataFrame:
    """Every product with every target grid; grids are a handful of rows."""
    return products.crossJoin(small(grids))


def limit_output(produced: DataFrame, wishlist: DataFrame, preserved: DataFrame) -> DataFrame:
    """Produced products that were asked for and aren't kept elsewhere."""
    return produced.join(wishlist.select("product"), "product", "left_semi").join(preserved.select("product"), "product", "left_anti")
