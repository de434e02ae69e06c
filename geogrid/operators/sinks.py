"""Writing gridded results: grouped stores, tiles, groups by name, raw blocks."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geogrid.functions.enhance import default_output_dtype, quantize
from geogrid.functions.projections import inverse
from geogrid.sources.shared import small


def write_grouped(grid: DataFrame, path: str, append: bool = False) -> None:
    """One store partitioned by area and product; appending replaces the products written anew and leaves others."""
    writer = grid.write.partitionBy("area_id", "product")
    if append:
        writer.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    else:
        writer.option("partitionOverwriteMode", "static").mode("overwrite").parquet(path)


def with_cell_geolocation(cells: DataFrame, p: Mapping) -> DataFrame:
    """Cells (row, col, x, y) with longitude and latitude."""
    lon, lat = inverse(p, F.col("x"), F.col("y"))
    return cells.withColumn("longitude", lon).withColumn("latitude", lat)


def group_attributes(grids: DataFrame) -> DataFrame:
    """(area_id, proj4_definition, height, width, cell_height, cell_width, origin_x, origin_y); sizes and origin rounded to 5."""
    five = lambda c: F.round(c, 5)
    return grids.select("area_id", F.col("proj").alias("proj4_definition"), "height", "width", five(F.abs("dy")).alias("cell_height"), five(F.col("dx")).alias("cell_width"), five(F.col("x_min") + F.col("dx") / 2).alias("origin_x"), five(F.col("y_max") - F.abs("dy") / 2).alias("origin_y"))


def dataset_attributes(products: DataFrame) -> DataFrame:
    """(product, satellite, sensor, start_time, end_time) as text."""
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    return products.select("product", F.col("platform_name").alias("satellite"), F.array_join(F.array_sort("sensor"), "-").alias("sensor"), iso("start_time").alias("start_time"), iso("end_time").alias("end_time"))


def binary_values(grid: DataFrame, src: str, dst: str | None = None, enhanced: bool = False, fill: float = 0) -> DataFrame:
    """``value`` as the output type, sorted by row and column within row ranges."""
    dst = dst or default_output_dtype(src)
    return grid.withColumn("value", quantize(F.col("value"), src, dst, enhanced, fill)).repartitionByRange("row").sortWithinPartitions("row", "col")


def write_tiles(tiled: DataFrame, path: str) -> None:
    """A folder a tile; tiles without data are not written."""
    tiled.where("value is not null").write.partitionBy("tile").mode("overwrite").parquet(path)


def cf_groups(grid: DataFrame, groups: Mapping[str, list[str]] | None, exclude: list[str] | None = None, numeric_prefix: str = "CHANNEL_") -> DataFrame:
    """``grid`` with ``group`` (products outside every group are dropped) and names that don't begin with a digit;
    columns of ``exclude`` are dropped."""
    name = F.when(F.regexp_like("product", F.lit("^[0-9]")), F.concat(F.lit(numeric_prefix), "product")).otherwise(F.col("product"))
    out = grid
    if groups:
        pairs = [F.lit(x) for g, members in groups.items() for m in members for x in (m, g)]
        out = out.withColumn("group", F.try_element_at(F.create_map(*pairs), F.col("product"))).where("`group` is not null")
    else:
        out = out.withColumn("group", F.lit(None).cast("string"))
    return out.withColumn("product", name).drop(*(exclude or []))


def one_grid(grid: DataFrame) -> DataFrame:
    """``grid``, raising if a group mixes areas."""
    w = Window.partitionBy("group")
    mixed = F.min("area_id").over(w) != F.max("area_id").over(w)
    return grid.withColumn("area_id", F.when(mixed, F.raise_error(F.lit("a group mixes grids")).cast("string")).otherwise(F.col("area_id")))


def multi_write(grid: DataFrame, writers: list[Callable[[DataFrame], None]]) -> None:
    """Several sinks from one computation."""
    kept = grid.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for write in writers:
            write(kept)
    finally:
        kept.unpersist()


def element_label(products: DataFrame, labels: DataFrame) -> DataFrame:
    """``element`` and ``units`` of each product from label rules (name, reader, sensor, element, units): the most
    specific matching row."""
    keys = ("name", "reader", "sensor")
    rule = labels.select(*[F.col(k).alias(f"l_{k}") for k in keys], "element", F.col("units").alias("l_units"))
    ok: Column = F.lit(True)
    for k, c in zip(keys, ("product", "reader", "sensor"), strict=True):
        ok = ok & (F.col(f"l_{k}").isNull() | (F.col(f"l_{k}") == F.col(c)))
    n = sum((F.col(f"l_{k}").isNotNull().cast("int") for k in keys), F.lit(0))
    joined = products.join(small(rule), ok, "left").withColumn("__n", F.row_number().over(Window.partitionBy("product").orderBy(F.col("l_name").isNotNull().desc(), n.desc(), "element")))
    return joined.where("__n = 1").select(*[products[c] for c in products.columns], F.coalesce("element", "product").alias("element"), "l_units")
