"""Allocation drivers and loan-book ratios.

The loan book is aggregated ONCE to (month, area) with every conditional sum
any driver or ratio needs (the source report scans it up to 12 times), then
once more to one row per (report month, area). Shares divide by per-month
totals of that small table (area_row.shares), never by a
single-partition window over detail rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areabook.functions.columns import as_months, avg_of, report_months_from, yyyymm_year_text
from areabook.operators.area_row import shares


#: Sums of a month and area that no report year changes; names as in loan_month_area.
BASE = ("b1", "b2", "b2_5", "dnck", "psdn_nn", "dnx", "n_dnx", "wo_1", "wo_2", "wo_2_5", "psdn", "dnx0", "n_rows")


def base_sums() -> list[Column]:
    """Two families of sums over loan-book rows: "present-only" sums (NULL when no row of the kind
    exists, so averages run over the months where the kind exists) and
    "zero-filled" sums (0 when absent, averages over every month of the area)."""
    op, b = F.col("outstanding_principal"), F.col("max_bucket")
    b345 = b.isin(3, 4, 5)
    return [
        # present-only
        F.sum(F.when(b == 1, op)).alias("b1"),
        F.sum(F.when(b == 2, op)).alias("b2"),
        F.sum(F.when(b.isin(2, 3, 4, 5), op)).alias("b2_5"),
        F.sum(op).alias("dnck"),
        F.sum(F.when(op.isNotNull(), F.col("psdn"))).alias("psdn_nn"),
        F.sum(F.when(b345, op)).alias("dnx"),
        F.count_if(b345).alias("n_dnx"),
        # zero-filled
        F.sum(F.when(b == 1, op).otherwise(0)).alias("wo_1"),
        F.sum(F.when(b == 2, op).otherwise(0)).alias("wo_2"),
        F.sum(F.when(b >= 2, op).otherwise(0)).alias("wo_2_5"),
        F.sum(F.col("psdn")).alias("psdn"),
        F.sum(F.when(b345, op).otherwise(0)).alias("dnx0"),
        F.count(F.lit(1)).alias("n_rows")]


def writeoff_sums() -> list[Column]:
    """Of rows written off in one year: their amounts, their number, and how many have an amount."""
    wbp = F.col("write_off_balance_principal")
    return [F.sum(wbp).alias("s"), F.count(F.lit(1)).alias("n"), F.count(wbp).alias("nn")]


def writeoff_list() -> Column:
    """Aggregate: the write-off years of a month and area with their sums (as many as there are years)."""
    return F.array_sort(F.collect_list(F.when(F.col("wo_year").isNotNull(), F.struct("wo_year", "s", "n", "nn")))).alias("writeoffs")


def loan_month_area(loan: DataFrame, month) -> DataFrame:
    """One pass over the loan book, cumulative to `month` (or the last of a
    list of months): per (kpi_month, area) the BASE sums, and the write-offs by their year. A report counts
    write-offs from its own year on (see loan_area), so what is aggregated here does not depend on the months asked for."""
    by_year = (loan.filter(F.col("kpi_month") <= as_months(month)[-1])
               .groupBy("kpi_month", "area_code", yyyymm_year_text("write_off_month").alias("wo_year"))
               .agg(*base_sums(), *writeoff_sums()))
    return by_year.groupBy("kpi_month", "area_code").agg(*[F.sum(c).alias(c) for c in BASE], writeoff_list())


def loan_area(month_area: DataFrame, month) -> DataFrame:
    """One row per (report month, area): the averages of monthly totals and
    card counts over the months up to the report month. Each (kpi_month,
    area) row is spread to the report months at or after it (a small table:
    months x areas)."""
    months = as_months(month)
    spread = (month_area.withColumn("month_key", F.lit(months[0])) if len(months) == 1
              else month_area.select("*", F.explode(report_months_from("kpi_month", months)).alias("month_key")))
    # write-offs from the report's year on: a suffix of the month's years
    counted = F.filter("writeoffs", lambda w: w["wo_year"] >= F.substring(F.col("month_key").cast("string"), 1, 4))

    def total(field: str) -> Column:
        some = F.filter(F.transform(counted, lambda w: w[field]), lambda v: v.isNotNull())
        kind = "decimal(38,2)" if field == "s" else "long"
        return F.when(F.size(some) > 0, F.aggregate(some, F.lit(0).cast(kind), lambda x, v: (x + v).cast(kind)))

    spread = spread.select("*", total("s").alias("wo"), F.coalesce(total("n"), F.lit(0)).alias("n_wo"),
                           F.coalesce(total("nn"), F.lit(0)).alias("_nn"))
    # sum(case when counted then amount else 0 end): NULL only if every row counts and none has an amount
    wo0 = F.when((F.col("n_rows") > F.col("n_wo")) | (F.col("_nn") > 0), F.coalesce("wo", F.lit(0)))
    spread = spread.withColumn("wo0", wo0)
    both = (F.col("n_dnx") > 0) & (F.col("n_wo") > 0)   # month kept by the 3-way inner join
    return spread.groupBy("month_key", "area_code").agg(
        avg_of("b1").alias("avg_b1"),
        avg_of("b2").alias("avg_b2"),
        avg_of("b2_5").alias("avg_b2_5"),
        avg_of("dnck").alias("avg_all"),
        F.sum("psdn_nn").alias("cards"),
        avg_of("wo_1").alias("avg_wo_1"),
        avg_of("wo_2").alias("avg_wo_2"),
        avg_of("wo_2_5").alias("avg_wo_2_5"),
        F.sum("psdn").alias("psdn_all"),
        avg_of("dnx0").alias("avg_dnx0"),
        avg_of("wo0").alias("avg_wo0"),
        avg_of(F.when(both, F.col("dnx"))).alias("npl_dnx"),
        avg_of(F.when(both, F.col("wo"))).alias("npl_wo"),
        avg_of(F.when(both, F.col("dnck"))).alias("npl_dnck"),
        F.count_if(both).alias("npl_months"),
    )


# Summary-A drivers: name -> (column of loan_area, is it an average?)
LOAN_DRIVERS_A = {
    "bal_b1": ("avg_b1", True),
    "bal_b2": ("avg_b2", True),
    "bal_b2_5": ("avg_b2_5", True),
    "bal_all": ("avg_all", True),
    "cards": ("cards", False),
}

# Summary-B drivers (one table, inner-joined)
LOAN_DRIVERS_B = {
    "wo_1": ("avg_wo_1", True),
    "wo_2": ("avg_wo_2", True),
    "wo_2_5": ("avg_wo_2_5", True),
    "wo": ("avg_all", True),
    "psdn": ("psdn_all", False),
}


def driver_share(area_table: DataFrame, driver: str, specs=LOAN_DRIVERS_A) -> DataFrame:
    """(area_code, share) of one loan-book driver; areas whose driver value is
    NULL keep a NULL share (they exist in the grouped driver table)."""
    return area_table.select("area_code", shares({"share": specs[driver]})["share"].alias("share"))


def npl_ratio_a(area_table: DataFrame) -> DataFrame:
    """S04 of scorecard A: (avg dnx + avg wo) / (avg dnck + avg wo) over the
    months having both bucket 3-5 rows and write-off rows; other areas drop."""
    t = area_table.filter(F.col("npl_months") > 0)
    return t.select("month_key", "area_code", F.try_divide(F.col("npl_dnx") + F.col("npl_wo"),
                                              F.col("npl_dnck") + F.col("npl_wo")).alias("value"))


def npl_ratio_b() -> Column:
    """B26, over the columns of loan_area: zero-filled averages over every month of the area."""
    return F.try_divide(F.col("avg_dnx0") + F.col("avg_wo0"), F.col("avg_all") + F.col("avg_wo0"))


def writeoff_ratio_b() -> Column:
    """B27: avg wo / (avg dnck + avg wo)."""
    return F.try_divide(F.col("avg_wo0"), F.col("avg_all") + F.col("avg_wo0"))
