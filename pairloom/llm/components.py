"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.scratch import stage


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31))).alias("hash")).first()
    return row["n"], row["hash"] or 0


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links`` (a, b): the smallest node that it is linked with, over any way.

    Alternating large-star and small-star steps. A step only takes minima per node and joins them
    to the edges; the number of edges never grows, and the steps are few even for long chains. Each
    pass is written, so a lost executor costs that pass only.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    held = stage(edges, "links")
    edges, state = held.df, _state(held.df)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, held = held, stage(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        last.drop()
        edges = held.df
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
