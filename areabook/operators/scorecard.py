"""Scorecard building blocks: area metrics spread to the area's managers and
ranked, criteria attached, scores summed and ranked."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rank_area_metrics(area_rows: DataFrame, employees: DataFrame, methods: dict[str, tuple[str, bool]],
                      default: tuple[str, bool]) -> DataFrame:
    """Rank area-level metrics as if spread to every manager of the area.

    area_rows: (month_key, area_code, criteria_code, value). An area without managers
    drops out (inner join), and the rank of a value counts managers, not
    areas, ahead of it; but all of this is computed on the per-area table
    weighted by the manager count, so no window ever sees the manager rows.
    methods: criteria_code -> (method, ascending); others use `default`. All criteria share one window: descending
    ones are ordered by the negated value. NULLs come last ascending, first descending."""
    counts = employees.groupBy("month_key", "area_code").agg(F.count(F.lit(1)).alias("_n_emp"))
    dense, asc = F.lit(default[0] == "dense_rank"), F.lit(default[1])
    for code, (method, up) in methods.items():
        dense = F.when(F.col("criteria_code") == code, F.lit(method == "dense_rank")).otherwise(dense)
        asc = F.when(F.col("criteria_code") == code, F.lit(up)).otherwise(asc)
    v = F.col("value")
    rows = (area_rows.join(counts, ["month_key", "area_code"])
            .withColumn("_dense", dense).withColumn("_nulls", F.when(v.isNotNull(), 0).when(asc, 1).otherwise(-1))
            .withColumn("_at", F.when(asc, v).otherwise(-v)))
    group, at = ["month_key", "criteria_code"], ["_nulls", "_at"]
    order = Window.partitionBy(*group).orderBy(*at)
    upto = F.sum("_n_emp").over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    peers = F.sum("_n_emp").over(Window.partitionBy(*group, *at))
    rank = F.when(F.col("_dense"), F.dense_rank().over(order)).otherwise(upto - peers + 1)
    return rows.withColumn("rank_kpi", rank.cast("long")).drop("_n_emp", "_dense", *at)


def spread_to_employees(ranked_area: DataFrame, employees: DataFrame) -> DataFrame:
    """(month_key, area_code, employee_id, criteria_code, value, rank_kpi): one
    row per manager of the area. The per-area side is small (areas x
    criteria); the planner broadcasts it, so the manager side is never
    shuffled for this join."""
    return employees.join(ranked_area, ["month_key", "area_code"]).select(
        "month_key", "area_code", "employee_id", "criteria_code", "value", "rank_kpi")


def scores(level1: DataFrame, by: Sequence[str], type_col: str) -> DataFrame:
    """Add overall_score = sum(rank_kpi) per `by` and type_score per (`by`,
    type). The per-`by` window runs first so one hash exchange on `by` serves
    both windows."""
    w_all = Window.partitionBy(*by)
    w_type = Window.partitionBy(*by, type_col)
    return (level1.withColumn("overall_score", F.sum("rank_kpi").over(w_all))
            .withColumn("type_score", F.sum("rank_kpi").over(w_type)))


def repeated_codes(dim: DataFrame) -> DataFrame:
    """(criteria_code, repeats): codes that a criteria dimension lists more than once; each listing multiplies the criterion's rows."""
    return dim.groupBy("criteria_code").agg((F.count(F.lit(1)) - 1).alias("repeats")).filter("repeats > 0")
