"""Monthly KPI store, three tables under one folder:

* managers: (area, manager, number): every manager that an area ever had, numbered from 1 within the area. Numbers are
  stable: a refresh appends the new ones, counted on from the area's last (one refresh of a store at a time).
* bitmaps: per (calendar month, area, bucket of 32,768 numbers) the managers with a row, and those with a value, as
  bitmaps of the numbers. The summaries only need headcounts from the KPI facts (cumulative distinct
  managers, managers with a value in the month, average monthly managers); all three are bit counts of
  exact unions, so a report reads no manager rows: 4 KB stand for up to 32,768 of them.
* values_<code column>: per (month, area, manager, criterion) the sum and
  count of non-null values, from which the scorecards' cumulative averages
  are rebuilt exactly (the average is sum / count).

Same contract as the other stores: refresh only changed months."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areabook.functions.columns import as_months
from areabook.operators.cumulate import running_sums
from areabook.operators.rank import rank_table
from areabook.plans.staging import Stager
from areabook.sources.sinks import publish_month


CODE_COLUMNS = ("kpi_code", "criteria_code")
MANAGERS = "area_code string, employee_id string, number long"


def _managers(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(MANAGERS).parquet(f"{path}/managers")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANAGERS)


def _same_manager(left: DataFrame, right: DataFrame):
    return left["area_code"].eqNullSafe(right["_area"]) & (left["employee_id"] == right["_employee"])


def _number_managers(rows: DataFrame, path: str, st: Stager) -> None:
    """Appends the managers of `rows` that have no number yet. An area's new managers are ranked by id (exactly and
    without one task an area, see operators.rank) behind its last number."""
    known = _managers(rows.sparkSession, path)
    k = known.select(F.col("area_code").alias("_area"), F.col("employee_id").alias("_employee"))
    seen = rows.filter("employee_id is not null").select("area_code", "employee_id").distinct()
    new = st.stage(seen.join(k, _same_manager(seen, k), "left_anti"), "new-managers")
    last = known.groupBy(F.col("area_code").alias("_area")).agg(F.max("number").alias("last"))
    ranked = rank_table(new, "employee_id", ["area_code"], out="number", stager=st)
    numbered = ranked.join(last, ranked["area_code"].eqNullSafe(last["_area"]), "left")
    st.stage(numbered.select("area_code", "employee_id", (F.col("number") + F.coalesce("last", F.lit(0))).alias("number")),
             "numbered").write.mode("append").parquet(f"{path}/managers")


def refresh_kpi_store(kpi: DataFrame, months: Sequence[int], path: str,
                      code_cols: Sequence[str] = CODE_COLUMNS) -> None:
    """The facts are read once, to one row per (month, area, manager, codes); all tables derive from that."""
    keys, st = ["ym", "area_code", "employee_id"], Stager(kpi.sparkSession, "kpi_store")
    rows = (kpi.filter(F.col("month_report").isin(*as_months(months)))
            .groupBy(F.col("month_report").alias("ym"), "area_code", "employee_id", *code_cols)
            .agg(F.sum("value").alias("s"), F.count("value").alias("n")))
    rows = st.stage(rows, "months")
    valued = {r.ym: r.valued for r in rows.groupBy("ym").agg((F.sum("n") > 0).alias("valued")).collect()}

    def values(code: str) -> None:
        sums = (rows.filter(F.col("n") > 0).groupBy(*keys, F.col(code).alias("criteria_code"))
                .agg(F.sum("s").alias("s"), F.sum("n").alias("n")))
        publish_month(sums, f"{path}/values_{code}", partition_col="ym", months=months, full=[m for m, v in valued.items() if v])

    def bitmaps() -> None:
        _number_managers(rows, path, st)
        publish_month(_bits(rows, _managers(kpi.sparkSession, path)), f"{path}/bitmaps", partition_col="ym", months=months, full=list(valued))

    with ThreadPoolExecutor(max_workers=1 + len(code_cols)) as pool:     # independent tables, side by side
        for done in [pool.submit(bitmaps), *[pool.submit(values, code) for code in code_cols]]:
            done.result()


def _bits(rows: DataFrame, managers: DataFrame) -> DataFrame:
    """(ym, area_code, bucket, any_bits, value_bits, has_value). A bucket's rows are brought together as numbers and its bitmaps made
    once, in one task: partial bitmaps of every bucket in every task would be 4 KB for a few bits each, and both their number and the
    tasks grow with the managers. Rows without a manager stay, as an area without bits: it has rows, but no heads."""
    area = [F.col("area_code").isNull().alias("_no_area"), F.coalesce("area_code", F.lit("")).alias("_area")]
    no = managers.select(*area, "employee_id", "number")
    at = F.bitmap_bit_position("number")
    # joined by manager, then one row a manager and month without another exchange
    heads = (rows.select("ym", *area, "employee_id", (F.col("n") > 0).alias("has_value")).join(no, ["_no_area", "_area", "employee_id"], "left")
             .groupBy("_no_area", "_area", "employee_id", "number", "ym").agg(F.max("has_value").alias("has_value"))
             .select("ym", F.when(~F.col("_no_area"), F.col("_area")).alias("area_code"),
                     F.coalesce(F.bitmap_bucket_number("number"), F.lit(1).cast("long")).alias("bucket"), at.cast("int").alias("_at"), "has_value"))
    return (heads.repartition("ym", "area_code", "bucket").groupBy("ym", "area_code", "bucket")
            .agg(F.bitmap_construct_agg("_at").alias("any_bits"),
                 F.bitmap_construct_agg(F.when(F.col("has_value"), F.col("_at"))).alias("value_bits"), F.max("has_value").alias("has_value")))


def employee_kpi_from_store(spark: SparkSession, path: str, month, code_col: str) -> DataFrame:
    """As kpi.employee_kpi: cumulative average value per (area, manager,
    criterion) for each report month."""
    months = as_months(month)
    monthly = spark.read.parquet(f"{path}/values_{code_col}").filter(F.col("ym") <= months[-1])
    run = running_sums(monthly, "ym", months, ["area_code", "employee_id", "criteria_code"], ["s", "n"])
    return run.select("month_key", "area_code", "employee_id", "criteria_code", (F.col("s").cast("double") / F.col("n")).alias("value"))


def _bitmaps(spark: SparkSession, path: str, months) -> DataFrame:
    return spark.read.parquet(f"{path}/bitmaps").filter(F.col("ym") <= as_months(months)[-1])


def headcount_cumulative_from_store(spark: SparkSession, path: str, month) -> DataFrame:
    """As kpi.headcount_cumulative: distinct managers up to each report month."""
    union = running_sums(_bitmaps(spark, path, month), "ym", month, ["area_code", "bucket"], ["any_bits"], F.bitmap_or_agg)
    return union.groupBy("month_key", "area_code").agg(F.sum(F.bitmap_count("any_bits")).alias("headcount"))


def _monthly_managers(bits: DataFrame) -> DataFrame:
    """(ym, area_code, n): managers with a value, for months and areas that have values."""
    return (bits.groupBy("ym", "area_code").agg(F.sum(F.bitmap_count("value_bits")).alias("n"), F.max("has_value").alias("has_value"))
            .filter("has_value").drop("has_value"))


def headcount_in_month_from_store(spark: SparkSession, path: str, month) -> DataFrame:
    """As kpi.headcount_in_month: managers with a value in the report month."""
    bits = _bitmaps(spark, path, month).filter(F.col("ym").isin(*as_months(month)))
    return _monthly_managers(bits).select(F.col("ym").alias("month_key"), "area_code", F.col("n").alias("headcount"))


def headcount_monthly_avg_from_store(spark: SparkSession, path: str, month) -> DataFrame:
    """As kpi.headcount_monthly_avg: average monthly managers with a value."""
    monthly = _monthly_managers(_bitmaps(spark, path, month)).withColumn("_one", F.lit(1).cast("long"))
    run = running_sums(monthly, "ym", month, ["area_code"], ["n", "_one"])
    return run.select("month_key", "area_code", (F.col("n").cast("double") / F.col("_one")).alias("avg_headcount"))
