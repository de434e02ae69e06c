"""Tables that the operators read: pixels, grids, rules, colormaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geogrid.sources import builtin_grids, builtin_products, builtin_rules

GRID_SCHEMA = "area_id string, proj string, dx double, dy double, width int, height int, ul_lon double, ul_lat double, x_min double, y_min double, x_max double, y_max double, load_order int"
RESAMPLING_SCHEMA = "rule_id string, kind string, keys map<string,string>, resampler string, default_target string, kwargs map<string,string>, load_order int"
ENHANCEMENT_SCHEMA = "rule_id string, kind string, keys map<string,string>, operations array<string>, load_order int"


def read_products(spark: SparkSession, path: str, products: list[str], **options: str) -> DataFrame:
    """Pixels of the requested products only; with files partitioned by product the others aren't opened."""
    return spark.read.options(**options).parquet(path).where(F.col("product").isin(products))


def list_inputs(spark: SparkSession, paths: list[str], glob: str | None = None) -> DataFrame:
    """(path, bytes, modified) of files under files, directories and globs."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(paths).select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def without_missing(df: DataFrame, value_col: str = "value", fill: float | None = None) -> DataFrame:
    """NaN and the fill value as null, the only mark of missing data inside."""
    v = F.col(value_col)
    bad = F.isnan(v.cast("double")) | (v == F.lit(fill) if fill is not None else F.lit(False))
    return df.withColumn(value_col, F.when(~bad, v))


def read_colormap(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """(name, value, r, g, b, a): comma-separated rows of 4 or 5 numbers; # comments and blanks are skipped, a
    missing alpha is 255."""
    lines = spark.read.text(path).select(F.trim(F.regexp_replace("value", "#.*$", "")).alias("line")).where("line <> ''")
    parts = F.transform(F.split("line", ","), lambda x: F.trim(x).cast("double"))
    cells = lines.select(parts.alias("p"))
    got = [F.get("p", F.lit(k)).alias(c) for k, c in enumerate(("value", "r", "g", "b"))]
    return cells.select(F.lit(name or path.rsplit("/", 1)[-1].rsplit(".", 1)[0]).alias("name"), *got, F.coalesce(F.get("p", F.lit(4)), F.lit(255.0)).alias("a")).orderBy("value")


def builtin_grid_table(spark: SparkSession) -> DataFrame:
    rows = builtin_grids.grid_rows()
    names = [c.split()[0] for c in GRID_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], GRID_SCHEMA)


def builtin_resampling_rules(spark: SparkSession) -> DataFrame:
    rows = builtin_rules.resampling_rows()
    return spark.createDataFrame([tuple(r[n] for n in ("rule_id", "kind", "keys", "resampler", "default_target", "kwargs", "load_order")) for r in rows], RESAMPLING_SCHEMA)


def builtin_enhancement_rules(spark: SparkSession) -> DataFrame:
    rows = builtin_rules.enhancement_rows()
    return spark.createDataFrame([tuple(r[n] for n in ("rule_id", "kind", "keys", "operations", "load_order")) for r in rows], ENHANCEMENT_SCHEMA)


def last_definition(df: DataFrame, key: str, order: str = "load_order") -> DataFrame:
    """The last row of each key, with ``n_definitions`` (over 1: it was defined anew)."""
    w = Window.partitionBy(key)
    ranked = df.withColumn("n_definitions", F.count("*").over(w)).withColumn("__n", F.row_number().over(w.orderBy(F.desc(order))))
    return ranked.where("__n = 1").drop("__n")


def with_user_grids(builtin: DataFrame, user: DataFrame) -> DataFrame:
    """Builtin and user grids; the user's definition of a name wins."""
    top = builtin.agg(F.max("load_order").alias("top"))
    later = user.crossJoin(F.broadcast(top)).withColumn("load_order", F.col("load_order") + F.coalesce("top", F.lit(0)) + 1).drop("top")
    return last_definition(builtin.unionByName(later), "area_id")


def merge_layers(layers: DataFrame) -> DataFrame:
    """Rules or settings of several layers (layer, rule_id, key, value): the last layer with a value wins, key
    by key."""
    w = Window.partitionBy("rule_id", "key").orderBy("layer").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return layers.select("rule_id", "key", F.last("value", ignorenulls=True).over(w).alias("value")).distinct()


def builtin_default_products(spark: SparkSession) -> DataFrame:
    """(reader, product, pos) of what is loaded where no product is asked for."""
    return spark.createDataFrame(builtin_products.default_product_rows(), "reader string, product string, pos int")


def builtin_criteria(spark: SparkSession, reader: str, light: str) -> DataFrame:
    """(key, value): which products of a reader need ``light`` (day or night)."""
    rows = [(key, v) for own, kind, key, v in builtin_products.day_night_rows() if (own, kind) == (reader, light)]
    return spark.createDataFrame(rows, "key string, value string")


def builtin_elements(spark: SparkSession) -> DataFrame:
    """(name, reader, sensor, element, units): physical elements of products."""
    return spark.createDataFrame(builtin_products.element_rows(), "name string, reader string, sensor string, element string, units string")
