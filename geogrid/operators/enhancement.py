"""Enhancement of pixels by the rules chosen for their products."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geogrid.functions.enhance import apply_operations, linear_stretch
from geogrid.sources.builtin_rules import operations

COLOR = "struct<r:double,g:double,b:double,a:double>"


def data_limits(pixels: DataFrame, by: str = "product", value: str = "value") -> DataFrame:
    """(by, lo, hi): the limits of each product's valid data."""
    return pixels.groupBy(by).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))


def enhance_pixels(pixels: DataFrame, decided: DataFrame, rules: Sequence[dict], value: str = "value") -> DataFrame:
    """``pixels`` with ``rule_id``, ``enhanced`` and ``color`` (struct of r, g, b, a), by the rule that ``decided`` has
    for their product.

    Rules that end in a colour table give ``color`` alone, others ``enhanced`` alone; products without a rule are stretched
    between the limits of their valid data. ``rules`` are rows as of ``builtin_rules.enhancement_rows``; of them, those in use
    (at most as many as there are rules) become branches of one expression.
    """
    used = {r["rule_id"] for r in decided.select("rule_id").distinct().limit(len(rules) + 1).collect()}
    chosen = {r["rule_id"]: operations(r["operations"]) for r in rules if r["rule_id"] in used}
    joined = pixels.join(decided.select("product", "rule_id"), "product", "left")
    stretched = joined.where(F.col("rule_id").isNull() | F.col("rule_id").isin([r for r, ops in chosen.items() if any(name == "auto" for name, _ in ops)]))
    joined = joined.join(data_limits(stretched, value=value).withColumnsRenamed({"lo": "__lo", "hi": "__hi"}), "product", "left")
    limits: tuple[Column, Column] = (F.col("__lo"), F.col("__hi"))
    plain, color = F.when(F.col("rule_id").isNull(), linear_stretch(F.col(value), *limits)), F.lit(None).cast(COLOR)
    for rule, ops in chosen.items():
        out = apply_operations(F.col(value), ops, limits)
        colored = bool(ops) and ops[-1][0] == "colorize"
        here = F.col("rule_id") == rule
        plain = F.when(here, F.lit(None).cast("double") if colored else out.cast("double")).otherwise(plain)
        color = F.when(here, out.cast(COLOR)).otherwise(color) if colored else color
    return joined.withColumn("enhanced", plain).withColumn("color", color).drop("__lo", "__hi")
