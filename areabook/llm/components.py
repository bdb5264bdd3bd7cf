"""Connected components by alternating large-star and small-star joins, a written table a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return r.n, r.x


def connected(links: DataFrame, st, max_rounds: int = 64) -> DataFrame:
    """(node, root) of every node of links(a, b); root is the smallest node reachable. Each round
    pre-aggregates the smallest neighbour of a node and joins it back, so a node with very many
    neighbours is an ordinary skewed join key."""
    pairs = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = st.stage(pairs, "links")
    mark = _mark(edges)
    for k in range(max_rounds):
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        edges = st.stage(small, f"round{k}")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
