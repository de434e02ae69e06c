"""Comparing two outputs pixel by pixel, and profiles of data."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geogrid.functions.enhance import isclose
from geogrid.sources.shared import checkpointed

KEYS = ("file", "variable", "y", "x")


def compare_pixels(expected: DataFrame, actual: DataFrame, atol: float = 0.0, rtol: float = 0.0) -> DataFrame:
    """(file, variable, y, x, in_expected, in_actual, equal) of both sides' pixels (file, variable, y, x, value)."""
    a = expected.select(*KEYS, F.col("value").alias("a"), F.lit(True).alias("in_a"))
    b = actual.select(*KEYS, F.col("value").alias("b"), F.lit(True).alias("in_b"))
    both = a.join(b, list(KEYS), "full_outer")
    here, there = F.coalesce("in_a", F.lit(False)), F.coalesce("in_b", F.lit(False))
    return both.select(*KEYS, here.alias("in_expected"), there.alias("in_actual"), (here & there & isclose(F.col("a"), F.col("b"), atol, rtol)).alias("equal"))


def compare_variables(expected: DataFrame, actual: DataFrame, atol: float = 0.0, rtol: float = 0.0, margin: float = 0.0, strict: bool = False) -> DataFrame:
    """(file, variable, status, total, n_equal, n_different, percent, failed) for each variable of ``expected``.

    A missing file or variable fails, as does another shape (then 100 % differ); otherwise more than
    ``margin`` percent of different pixels fail. What only ``actual`` has is ignored unless ``strict``.
    """
    keys = ["file", "variable"]
    shape = lambda df, p: df.groupBy(*keys).agg(F.max("y").alias(f"{p}y"), F.max("x").alias(f"{p}x"), F.count("*").alias(f"{p}n"))
    shapes = shape(expected, "a").join(shape(actual, "b"), keys, "full_outer" if strict else "left")
    close = compare_pixels(expected, actual, atol, rtol).where("in_expected").groupBy(*keys).agg(F.count_if("equal").alias("same"))
    files = actual.select("file").distinct().withColumn("__f", F.lit(True))
    joined = shapes.join(close, keys, "left").join(files, "file", "left")
    alike = (F.col("ay") == F.col("by")) & (F.col("ax") == F.col("bx")) & (F.col("an") == F.col("bn"))
    status = F.when(F.col("an").isNull(), "unexpected").when(F.col("__f").isNull(), "missing file").when(F.col("bn").isNull(), "missing variable").when(~alike, "shape").otherwise("compared")
    total = F.coalesce("an", "bn")
    equal = F.when(status == "compared", F.coalesce("same", F.lit(0))).otherwise(0)
    out = joined.select(*keys, status.alias("status"), total.alias("total"), equal.alias("n_equal"))
    out = out.withColumn("n_different", F.col("total") - F.col("n_equal")).withColumn("percent", F.col("n_different") * 100.0 / F.col("total"))
    return out.withColumn("failed", (F.col("status") != "compared") | (F.col("n_different") > F.col("total") * (margin / 100.0)))


def roll_up(compared: DataFrame) -> DataFrame:
    """(file, variable, n_different, failed): by variable, by file (variable null), and in all (both null)."""
    sums = compared.rollup("file", "variable").agg(F.sum("n_different").alias("n_different"), F.bool_or("failed").alias("failed"))
    return sums


def n_failed_files(compared: DataFrame) -> DataFrame:
    """One row: the number of files with a failed variable, which is the exit status."""
    files = compared.groupBy("file").agg(F.bool_or("failed").alias("failed"))
    return files.agg(F.count_if("failed").alias("n_failed"))


def missing(expected: DataFrame, actual: DataFrame, key: str = "file") -> DataFrame:
    """Keys of ``expected`` that ``actual`` lacks, sorted; logs are skipped."""
    return expected.select(key).distinct().where(~F.col(key).endswith(".log")).join(actual.select(key), key, "left_anti").orderBy(key)


def exact_quantiles(df: DataFrame, col: str, shares: tuple[float, ...], bins: int = 4096, most: int = 100_000) -> list[float | None]:
    """The quantiles of the valid values, between neighbouring ranks linear; None without any.

    Values are counted in bins by Spark; a bin that holds a wanted rank is counted anew in finer ones until it has
    at most ``most`` values, which are all that reaches the driver.
    """
    ok = df.where(F.col(col).isNotNull() & ~F.isnan(col)).select(F.col(col).cast("double").alias("v"))
    first = ok.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n")).first()
    if not first["n"]:
        return [None for _ in shares]

    def binned(lo: float, hi: float) -> DataFrame:
        share = (F.col("v") - lo) / (hi - lo)
        return ok.where((F.col("v") >= lo) & (F.col("v") <= hi)).withColumn("bin", F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int"))

    @functools.cache
    def counts(lo: float, hi: float) -> list:
        return sorted(binned(lo, hi).groupBy("bin").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect())

    @functools.cache
    def values(lo: float, hi: float, number: int) -> list[float]:
        return sorted(r["v"] for r in binned(lo, hi).where(F.col("bin") == number).select("v").collect())

    def ranked(rank: int) -> float:
        lo, hi = first["lo"], first["hi"]
        while lo < hi:
            for r in counts(lo, hi):
                if rank < r["n"]:
                    break
                rank -= r["n"]
            if r["n"] <= most:
                return values(lo, hi, r["bin"])[rank]
            lo, hi = r["lo"], r["hi"]
        return lo

    out = []
    for q in shares:
        at = q * (first["n"] - 1)
        low, part = int(at), at - int(at)
        out.append(ranked(low) if not part else ranked(low) * (1 - part) + ranked(low + 1) * part)
    return out


def grouped_quantiles(df: DataFrame, by: tuple[str, ...], col: str, shares: tuple[float, ...]) -> DataFrame:
    """(by, n, share, quantile) of the valid values of every group, between neighbouring ranks linear, in a fixed number of jobs.

    Equal values of a group are counted first; the counts are ranged over partitions by group and value, so a group that
    holds most rows is spread. Sums within partitions and of the partitions before give each value the ranks it
    holds; only values that hold a wanted rank are kept. Groups without valid values have no row.
    """
    valid = df.where(F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double"))).select(*by, F.col(col).cast("double").alias("__v"))
    counts = valid.groupBy(*by, "__v").agg(F.count("*").alias("__c"))
    ranged = checkpointed(counts.repartitionByRange(*by, "__v").withColumn("__p", F.spark_partition_id()))
    parts = ranged.groupBy(*by, "__p").agg(F.sum("__c").alias("__s"))
    before = F.sum("__s").over(Window.partitionBy(*by).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1))
    total = F.sum("__s").over(Window.partitionBy(*by))
    parts = parts.select(*by, "__p", F.coalesce(before, F.lit(0)).alias("__b"), total.alias("n"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*by, "__p")]
    running = ranged.withColumn("__r", F.sum("__c").over(Window.partitionBy(*by, "__p").orderBy("__v")))
    ranks = running.alias("a").join(parts.alias("b"), functools.reduce(lambda x, y: x & y, same)).select(*[f"a.{c}" for c in by], "__v", "n", (F.col("__b") + F.col("__r") - F.col("__c")).alias("__lo"), (F.col("__b") + F.col("__r")).alias("__hi"))
    wanted = ranks.select("*", F.explode(F.array(*[F.struct(F.lit(float(q)).alias("q"), (F.col("n") - 1).alias("m")) for q in shares])).alias("w"))
    at = F.col("w.q") * F.col("w.m")
    wanted = wanted.withColumn("__at", at).withColumn("__f", F.floor(at))
    holds = lambda rank: (F.col("__lo") <= rank) & (rank < F.col("__hi"))
    low, high = F.when(holds(F.col("__f")), F.col("__v")), F.when(holds(F.ceil("__at")), F.col("__v"))
    found = wanted.where(low.isNotNull() | high.isNotNull()).groupBy(*by, "n", F.col("w.q").alias("share")).agg(F.max(low).alias("__x"), F.max(high).alias("__y"), F.first(F.col("__at") - F.col("__f")).alias("__part"))
    return found.select(*by, "n", "share", (F.col("__x") * (1 - F.col("__part")) + F.col("__y") * F.col("__part")).alias("quantile"))


def difference_profile(diffs: DataFrame, bins: int = 100, col: str = "diff") -> tuple[DataFrame, DataFrame]:
    """Quartiles of the valid differences, and a density histogram (bin from 0, n, density) over their range."""
    ok = diffs.where(F.col(col).isNotNull() & ~F.isnan(col))
    found = exact_quantiles(diffs, col, (0.0, 0.25, 0.5, 0.75, 1.0))
    quantiles = diffs.sparkSession.range(1).select(*[F.lit(v).cast("double").alias(f"q{k * 25}") for k, v in enumerate(found)])
    return quantiles, histogram(ok, col, bins)


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """(bin, n, density): equal bins from least to largest value, the last closed."""
    limits = df.agg(F.min(col).alias("__lo"), F.max(col).alias("__hi"), F.count(col).alias("__n"))
    share = F.coalesce(F.try_divide(F.col(col) - F.col("__lo"), F.col("__hi") - F.col("__lo")), F.lit(0.0))
    binned = df.where(F.col(col).isNotNull()).crossJoin(F.broadcast(limits)).withColumn("bin", F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int"))
    counts = binned.groupBy("bin").agg(F.count("*").alias("n"), F.first("__lo").alias("lo"), F.first("__hi").alias("hi"), F.first("__n").alias("total"))
    width = (F.col("hi") - F.col("lo")) / bins
    return counts.select("bin", "n", F.try_divide(F.col("n").cast("double"), F.col("total") * width).alias("density"))


def data_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n, n_missing, least, largest) in one pass."""
    parts = [F.struct(F.lit(c).alias("column"), F.count("*").alias("n"), F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).alias("n_missing"), F.min(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))).alias("least"), F.max(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))).alias("largest")) for c in columns]
    return df.agg(F.array(*parts).alias("p")).select(F.explode("p").alias("p")).select("p.*")


def compare_colormaps(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row (n_different): of two tables (value, r, g, b, a), the difference in size, or else the rows that
    differ at all. Colour tables have some hundred rows, so each is numbered in one task."""
    key = ("value", "r", "g", "b", "a")
    def placed(t: DataFrame, p: str) -> DataFrame:
        n = F.row_number().over(Window.orderBy("value", "r", "g", "b", "a"))
        return t.select(n.alias("n"), F.struct(*key).alias(p))

    both = placed(a, "a").join(placed(b, "b"), "n", "full_outer")
    sizes = both.agg(F.count("a").alias("na"), F.count("b").alias("nb"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("d"))
    return sizes.select(F.when(F.col("na") != F.col("nb"), F.abs(F.col("na") - F.col("nb"))).otherwise(F.col("d")).alias("n_different"))


def time_span(df: DataFrame, by: str | None = None) -> DataFrame:
    """(start_time, end_time, mid_time) of a scene, or of each group."""
    out = df.groupBy(*([by] if by else [])).agg(F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"))
    half = F.timestamp_diff("MICROSECOND", F.col("start_time"), F.col("end_time")) / 2
    return out.withColumn("mid_time", F.timestamp_add("MICROSECOND", half.cast("long"), F.col("start_time")))


def distinct_counts(df: DataFrame, counted: dict[str, tuple[str, ...]]) -> DataFrame:
    """One row: for each name the number of distinct combinations of its columns, as of swaths or identifiers.

    Each is an aggregation of its own, so that rows are combined before they are shuffled.
    """
    out: DataFrame | None = None
    for name, columns in counted.items():
        one = df.where(" and ".join(f"`{c}` is not null" for c in columns)).select(*columns).distinct().agg(F.count("*").alias(name))
        out = one if out is None else out.crossJoin(F.broadcast(one))
    return out
