"""Monthly loan-book store: per (calendar month, area) partial sums.

The loan book is a month-by-month snapshot, so a cumulative report re-reads
every past snapshot. The store keeps, per month and area, every sum the
drivers need, plus the write-off sums per write-off year (the write-off
ratio counts write-offs from the report's year on, so the year must stay a
key). Refreshing reads only the changed months; a report rebuilds the
(month, area) table from the store and continues as usual."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areabook.functions.columns import as_months, yyyymm_year_text
from areabook.operators.drivers import BASE, base_sums, writeoff_list, writeoff_sums
from areabook.plans.staging import Stager
from areabook.sources.sinks import publish_month


def refresh_loan_store(loan: DataFrame, months: Sequence[int], path: str) -> None:
    """Recompute and replace the store partitions of the listed calendar months. The snapshots are read once, to their sums
    by write-off year (none: not written off); both tables derive from those."""
    rows = loan.filter(F.col("kpi_month").isin(*as_months(months)))
    by_year = (rows.groupBy("kpi_month", "area_code", yyyymm_year_text("write_off_month").alias("wo_year"))
               .agg(*base_sums(), *writeoff_sums()))
    by_year = Stager(loan.sparkSession, "loan_store").stage(by_year, "by-year")
    # the types of one sum, not of a sum of sums: months refreshed before and after are one table
    kinds = {f.name: f.dataType for f in by_year.schema.fields}
    monthly = by_year.groupBy("kpi_month", "area_code").agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in BASE])
    publish_month(monthly, f"{path}/monthly", partition_col="kpi_month", months=months)
    writeoffs = by_year.filter("wo_year is not null").select("kpi_month", "area_code", "wo_year", "s", "n", "nn")
    publish_month(writeoffs, f"{path}/writeoff", partition_col="kpi_month", months=months)


def month_area_from_store(spark: SparkSession, path: str, report_months) -> DataFrame:
    """The (kpi_month, area) table of `drivers.loan_month_area` rebuilt from the
    store for the given report months (same columns, same values)."""
    last = as_months(report_months)[-1]
    base = spark.read.parquet(f"{path}/monthly").filter(F.col("kpi_month") <= last)
    wo = spark.read.parquet(f"{path}/writeoff").filter(F.col("kpi_month") <= last)
    lists = wo.groupBy("kpi_month", F.col("area_code").alias("_area")).agg(writeoff_list()).withColumnRenamed("kpi_month", "_month")
    j = base.join(lists, (base["kpi_month"] == lists["_month"]) & base["area_code"].eqNullSafe(lists["_area"]), "left")
    return j.select("kpi_month", "area_code", *BASE, F.coalesce("writeoffs", F.array()).alias("writeoffs"))
