"""Roll-ups over a report tree that is a table.

A tree of accounts or areas is a table of (parent, child) edges. Its closure, every (ancestor, leaf) pair, comes
from joining paths with paths: each round doubles the length of the paths known, so a tree of depth d takes
log2(d) rounds, each a written table. A cycle shows as a node that is its own ancestor and is an error. A node
under several parents counts once in each ancestor. With the closure, all levels of a roll-up are one grouped sum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areabook.functions.columns import stage_double, to_stage
from areabook.plans.staging import Stager


class TreeCycle(ValueError):
    """A node of the report tree is among its own descendants."""


def closure(edges: DataFrame, stager: Stager | None = None) -> DataFrame:
    """(ancestor, leaf) of edges(parent, child); edges with a NULL end are no edges."""
    st = stager or Stager(edges.sparkSession, "tree")
    ends = edges.select(F.col("parent").alias("ancestor"), F.col("child").alias("node")).dropna().distinct()
    paths = st.stage(ends, "edges")
    inner = paths.select(F.col("ancestor").alias("node")).distinct()
    n = paths.count()
    while True:
        loop = paths.filter("ancestor = node").select("node").limit(3).collect()
        if loop:
            raise TreeCycle(f"nodes under themselves: {', '.join(str(r.node) for r in loop)}")
        far = paths.select(F.col("ancestor").alias("node"), F.col("node").alias("_far"))
        longer = paths.join(far, "node").select("ancestor", F.col("_far").alias("node"))
        paths = st.stage(paths.union(longer).distinct(), "paths")
        if (now := paths.count()) == n:
            return paths.join(inner, "node", "left_anti").select("ancestor", F.col("node").alias("leaf"))
        n = now


def rollup(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows (fin_id, area_code, value, month_key) of every ancestor: the sum of its leaves an area and month, for areas
    that have a leaf's row. `rows` holds leaves and may hold other lines; sums are exact (decimals)."""
    return (rows.join(pairs, rows["fin_id"] == pairs["leaf"])
            .groupBy("ancestor", "month_key", "area_code").agg(to_stage(F.sum(stage_double("value"))).alias("value"))
            .select(F.col("ancestor").cast("int").alias("fin_id"), "area_code", F.col("value").cast("double").alias("value"), "month_key"))
