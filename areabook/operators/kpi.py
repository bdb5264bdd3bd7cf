"""KPI-fact aggregates: headcounts and per-employee KPI averages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areabook.functions.columns import as_months, avg_of
from areabook.operators.cumulate import running_sums


def headcount_cumulative(kpi: DataFrame, month) -> DataFrame:
    """(month_key, area_code, headcount): distinct employees up to `month`,
    NULL values included. countDistinct plans as a two-phase aggregate (dedupe
    on (area, employee) map-side, then count), so a hot area costs no skew.
    For a list of months: the employees whose first month in the area it is are counted by
    month, and the counts summed on (an employee is one row, however many months follow)."""
    months = as_months(month)
    facts = kpi.filter(F.col("month_report") <= months[-1])
    if len(months) == 1:
        return (facts.groupBy(F.lit(months[0]).alias("month_key"), "area_code")
                .agg(F.countDistinct("employee_id").alias("headcount")))
    first = facts.groupBy("area_code", "employee_id").agg(F.min("month_report").alias("_first"))
    return running_sums(first.groupBy("area_code", "_first").agg(F.count("employee_id").alias("headcount")), "_first", months,
                        ["area_code"], ["headcount"])


def headcount_in_month(kpi: DataFrame, month) -> DataFrame:
    """(month_key, area_code, headcount): distinct employees with a value in
    the report month itself (each of a list of months)."""
    months = as_months(month)
    return (kpi.filter(F.col("month_report").isin(*months) & F.col("value").isNotNull())
            .groupBy(F.col("month_report").alias("month_key"), "area_code")
            .agg(F.countDistinct("employee_id").alias("headcount")))


def headcount_monthly_avg(kpi: DataFrame, month) -> DataFrame:
    """(month_key, area_code, avg_headcount): average over months of the
    monthly distinct employees with a value, cumulative to the report month."""
    months = as_months(month)
    monthly = (kpi.filter((F.col("month_report") <= months[-1]) & F.col("value").isNotNull())
               .groupBy("area_code", "month_report")
               .agg(F.countDistinct("employee_id").alias("s")).withColumn("n", F.lit(1).cast("long")))
    run = running_sums(monthly, "month_report", months, ["area_code"], ["s", "n"])
    return run.select("month_key", "area_code", (F.col("s").cast("double") / F.col("n")).alias("avg_headcount"))


def employee_kpi(kpi: DataFrame, month, code_col: str) -> DataFrame:
    """(month_key, area_code, employee_id, criteria_code, value): average
    non-null KPI value per area, employee and code, cumulative to the report
    month. For a list of months: sums and counts per calendar month once, summed on
    from month to month."""
    months = as_months(month)
    facts = kpi.filter((F.col("month_report") <= months[-1]) & F.col("value").isNotNull())
    keys = ["area_code", "employee_id", F.col(code_col).alias("criteria_code")]
    if len(months) == 1:
        return (facts.groupBy(F.lit(months[0]).alias("month_key"), *keys)
                .agg(avg_of("value").alias("value")))
    monthly = facts.groupBy("month_report", *keys).agg(F.sum("value").alias("_s"), F.count("value").alias("_n"))
    run = running_sums(monthly, "month_report", months, ["area_code", "employee_id", "criteria_code"], ["_s", "_n"])
    return run.select("month_key", "area_code", "employee_id", "criteria_code", (F.col("_s").cast("double") / F.col("_n")).alias("value"))


def area_employees(emp_kpi: DataFrame) -> DataFrame:
    """Distinct (month_key, area_code, employee_id) having any non-null KPI
    value; derived from the per-employee averages instead of another scan."""
    return emp_kpi.select("month_key", "area_code", "employee_id").distinct()
