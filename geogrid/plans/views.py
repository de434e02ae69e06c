"""Views of the given tables in the shapes that grid operators read, in Spark and in SQL.

swath: a raster 100 pixels wide with geolocation, in passes of 600 rows that lie side by side between 25 and 56
degrees north, so that grids over that range hold every pixel at every size; bands: two aligned bands; granules:
90-second intervals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def swath(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    n = F.col("event_id")
    row, col = F.floor(n / 100.0), n % 100
    number, own = F.floor(n / 60000.0), row % 600
    shift = (number % 23) * 7.0 + F.floor(number / 23.0) * 0.0131
    return e.select(
        row.cast("int").alias("y"),
        col.cast("int").alias("x"),
        (F.lit(-95.0) + col * 0.05 + own * 0.01 + shift).alias("lon"),
        (F.lit(25.0) + own * 0.05 + col * 0.005).alias("lat"),
        (n * 37 % 180).cast("double").alias("sza"),
        "value",
        F.col("event_type").alias("product"),
        "ts",
    )


def bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return li.groupBy(F.col("l_orderkey").alias("y"), F.col("l_linenumber").alias("x")).agg(F.max("l_extendedprice").alias("v1"), F.max("l_quantity").alias("v2"), F.count("*").alias("n"))


def granules(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return o.select(F.col("o_orderkey").alias("gid"), (F.col("o_orderkey") % 5).alias("sat"), F.col("o_orderdate").cast("timestamp_ntz").alias("start_time"), F.timestamp_add("SECOND", F.lit(90), F.col("o_orderdate").cast("timestamp_ntz")).alias("end_time"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a product of the swath, with attributes."""
    names = swath(spark, sf_dir).groupBy("product").agg(F.count("*").alias("n"))
    even = F.length("product") % 2 == 0
    return names.select(
        "product",
        F.when(even, "viirs_sdr").otherwise("modis_l1b").alias("reader"),
        F.when(even, F.array(F.lit("viirs"))).otherwise(F.array(F.lit("modis"))).alias("sensor"),
        F.when(even, "Suomi-NPP").otherwise("EOS-Aqua").alias("platform_name"),
        F.lit("swath").alias("area_type"),
        F.when(even, "toa_bidirectional_reflectance").otherwise("toa_brightness_temperature").alias("standard_name"),
        "n",
    )


SWATH = """swath as (
select cast(floor(event_id/cast(100 as double)) as int) as y, cast(event_id % 100 as int) as x,
       cast(-95 as double) + (event_id % 100)*cast(0.05 as double) + (floor(event_id/cast(100 as double)) % 600)*cast(0.01 as double)
         + ((floor(event_id/cast(60000 as double)) % 23)*cast(7 as double) + floor(floor(event_id/cast(60000 as double))/cast(23 as double))*cast(0.0131 as double)) as lon,
       cast(25 as double) + (floor(event_id/cast(100 as double)) % 600)*cast(0.05 as double) + (event_id % 100)*cast(0.005 as double) as lat,
       cast(event_id*37 % 180 as double) as sza, value, event_type as product, ts
from events)"""
BANDS = """bands as (
select l_orderkey as y, l_linenumber as x, max(l_extendedprice) as v1, max(l_quantity) as v2, count(*) as n
from lineitem group by l_orderkey, l_linenumber)"""
GRANULES = """granules as (
select o_orderkey as gid, o_orderkey % 5 as sat, cast(o_orderdate as timestamp) as start_time,
       cast(o_orderdate as timestamp) + interval '90' second as end_time from orders)"""
PRODUCTS = f"""{SWATH}, products as (
select product, case when length(product) % 2 = 0 then 'viirs_sdr' else 'modis_l1b' end as reader,
       case when length(product) % 2 = 0 then 'viirs' else 'modis' end as sensor,
       case when length(product) % 2 = 0 then 'Suomi-NPP' else 'EOS-Aqua' end as platform_name,
       'swath' as area_type,
       case when length(product) % 2 = 0 then 'toa_bidirectional_reflectance' else 'toa_brightness_temperature' end as standard_name,
       count(*) as n from swath group by product)"""
