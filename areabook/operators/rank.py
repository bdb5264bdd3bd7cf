"""Exact rank() / dense_rank() without a single-partition window.

A SQL window `rank() over (partition by p order by v)` puts each partition
into one task; the scorecards rank whole employee populations within a
handful of criteria (or globally), so each partition is a third of the data
or all of it. Instead:

1. collapse to distinct (p, v) keys with their row counts (map-side partial
   aggregation, so a hot value costs nothing);
2. range-partition the keys by (p, v) and take, inside each range partition,
   the running count of the keys before each one (a window per range
   partition: bounded by the partition size);
3. aggregate the keys to one row per (range partition, p): its rows and the
   count before its first key. Prefix sums over these rows (bounded by the
   number of range partitions and of report months x criteria) give what to add
   to a running count: the rows of earlier partitions, less the rows ahead of
   the first key of p;
4. one join adds it, one join on (p, v) brings the rank back (AQE broadcasts it when
   small, splits skewed keys otherwise).

rank counts rows ahead (+1); dense_rank counts distinct keys ahead (+1).
NULL placement follows PostgreSQL: NULLs last ascending, first descending."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areabook.plans.staging import Stager


def _order(col: str, descending: bool, nulls_first: bool) -> Column:
    c = F.col(col)
    if descending:
        return c.desc_nulls_first() if nulls_first else c.desc_nulls_last()
    return c.asc_nulls_first() if nulls_first else c.asc_nulls_last()


def rank_table(df: DataFrame, order_col: str, partition_cols: Sequence[str] = (), *,
               descending: bool = False, dense: bool = False, weight_col: str | None = None,
               nulls_first: bool | None = None, out: str = "rank",
               stager: Stager | None = None, partitions: int | None = None) -> DataFrame:
    """(partition_cols..., order_col, out): the rank of every distinct key."""
    spark = df.sparkSession
    pc = list(partition_cols)
    if nulls_first is None:
        nulls_first = descending
    st = stager or Stager(spark, "rank")
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    weight = F.lit(1).cast("long") if weight_col is None else F.col(weight_col).cast("long")
    keys = df.groupBy(*pc, order_col).agg(F.sum(weight).alias("_w"))
    if dense:
        keys = keys.withColumn("_w", F.lit(1).cast("long"))
    sort = [F.col(c).asc_nulls_first() for c in pc] + [_order(order_col, descending, nulls_first)]

    in_part = Window.partitionBy("_pid").orderBy(*sort)
    local = (keys.repartitionByRange(n_parts, *sort)
             .withColumn("_pid", F.spark_partition_id())
             .select(*pc, order_col, "_w", "_pid",
                     F.coalesce(F.sum("_w").over(in_part.rowsBetween(Window.unboundedPreceding, -1)),
                                F.lit(0).cast("long")).alias("_before")))
    # written once: the partition ids must be the same for every reader
    local = st.stage(local, f"rank-{out}")

    small = local.groupBy("_pid", *pc).agg(F.sum("_w").alias("_n"), F.min("_before").alias("_b"))
    earlier = Window.orderBy("_pid").rangeBetween(Window.unboundedPreceding, -1)
    off = F.coalesce(F.sum("_n").over(earlier), F.lit(0).cast("long"))
    small = small.withColumn("_off", off)
    start = F.min(F.col("_off") + F.col("_b")).over(Window.partitionBy(*pc)) if pc else F.lit(0)
    shift = small.select("_pid", *pc, (F.col("_off") - start).alias("_shift"))
    g, s = local.alias("g"), shift.alias("s")
    cond = [F.col("g._pid") == F.col("s._pid")] + [F.col(f"g.{c}").eqNullSafe(F.col(f"s.{c}")) for c in pc]
    return g.join(s, cond).select(*[F.col(f"g.{c}").alias(c) for c in pc], F.col(f"g.{order_col}"),
                                  (F.col("_before") + F.col("_shift") + 1).cast("long").alias(out))


def join_rank(df: DataFrame, ranks: DataFrame, order_col: str, partition_cols: Sequence[str], out: str) -> DataFrame:
    """Attach a rank table to its rows (null-safe on the keys)."""
    left, right = df.alias("l"), ranks.alias("r")
    keys_ = list(partition_cols) + [order_col]
    cond = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in keys_]
    return left.join(right, cond).select("l.*", F.col(f"r.{out}").cast("long").alias(out))


def rank_by(df: DataFrame, order_col: str, partition_cols: Sequence[str] = (), *,
            descending: bool = False, dense: bool = False, weight_col: str | None = None,
            nulls_first: bool | None = None, out: str = "rank",
            stager: Stager | None = None, partitions: int | None = None) -> DataFrame:
    """`df` plus column `out` = rank()/dense_rank() over (partition by
    partition_cols order by order_col [desc]). `weight_col`: each row stands
    for that many rows (rank only)."""
    pc = list(partition_cols)
    ranks = rank_table(df, order_col, pc, descending=descending, dense=dense, weight_col=weight_col,
                       nulls_first=nulls_first, out=out, stager=stager, partitions=partitions)
    return join_rank(df, ranks, order_col, pc, out)
