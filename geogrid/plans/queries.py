"""Registered queries of the grid operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from geogrid.plans import area_queries, product_queries, raster_queries, scalar_queries, table_queries

_PARTS = (area_queries, product_queries, raster_queries, scalar_queries, table_queries)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {n: q for p in _PARTS for n, q in p.QUERIES.items()}
ORACLES: dict[str, str] = {n: q for p in _PARTS for n, q in p.ORACLES.items()}
