"""Connected components of a link table by hooking to the least neighbour and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geogrid.llm.session import cut, merged

#: Jumps of a round: one in the first, then one more each round, up to so many.
MOST_JUMPS = 4


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the least node reachable.

    Each round hooks every node to its least neighbour, follows those pointers and contracts the links. Groups
    around one node are done in two rounds, which need few jumps; deeper ones get more jumps in later rounds, as each
    doubles the depth. Every join and grouping is a job that the driver keeps books of, so none is run without
    need. Only sums by key are gathered, so a node with very many links is no hot spot. An empty table gives an
    empty table.
    """
    edges = cut(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct())
    labels, jumps = None, 1
    while labels is None or not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("p")))
        for _ in range(jumps):
            up = hook.select(F.col("a").alias("p"), F.col("p").alias("pp"))
            hook = merged(hook, up, "p", "left").select("a", F.coalesce("pp", "p").alias("p"))
        hook = cut(hook)
        if labels is None:  # every node is hooked in the first round
            labels = hook.select(F.col("a").alias("node"), F.col("p").alias("root"))
        else:
            labels = cut(merged(labels, hook.select(F.col("a").alias("root"), "p"), "root", "left").select("node", F.coalesce("p", "root").alias("root")))
        one = merged(merged(edges, hook, "a").select(F.col("p").alias("x"), F.col("b").alias("a")), hook, "a").select("x", F.col("p").alias("y"))
        edges = cut(one.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        jumps = min(jumps + 1, MOST_JUMPS)
    return labels
