"""JOB2, summary B: the same report from ledger lines already tagged with a
report line, drivers from one conditional aggregate of the loan book.

Two tables are written: the areas (one row a month and area: its tagged lines, loan-book averages and
headcounts) and the result, whose lines and ratios are expressions over that row. The month's head-office
pools are one row a month, joined by month; other totals are windows by month."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areabook.functions.columns import STAGE_TYPE, ratio, round_half_up, stage_double, to_stage
from areabook.operators.area_row import KEYS, in_month, outer_join, shares
from areabook.operators.drivers import LOAN_DRIVERS_B, loan_area, loan_month_area, npl_ratio_b, writeoff_ratio_b
from areabook.operators.kpi import headcount_in_month, headcount_monthly_avg
from areabook.operators.tagged import line_area_sums
from areabook.plans import rules as R
from areabook.plans.kpi_store import headcount_in_month_from_store, headcount_monthly_avg_from_store
from areabook.plans.loan_store import month_area_from_store
from areabook.plans.tagged_store import line_sums_from_store
from areabook.plans.staging import Stager
from areabook.sources.inputs import Inputs


@dataclass
class SummaryB:
    areas: DataFrame           # one row a (month, area): what the lines are computed from
    result: DataFrame          # everything, as stored

    @cached_property
    def drivers(self) -> DataFrame:
        """Per area: loan-book shares and headcount share (inner)."""
        return (with_drivers(self.areas).filter("_driven")
                .select("month_key", "area_code", *[f"s_{d}" for d in LOAN_DRIVERS_B], f"s_{R.B_DEFAULT_DRIVER}"))

    @property
    def alloc(self) -> DataFrame:
        """Lines 1-5, 12-20."""
        return self.result.filter(F.col("fin_id").isin(*R.B_ALLOC_LINES))


#: Driver -> (column of the area row, is it an average?)
DRIVERS = {**LOAN_DRIVERS_B, R.B_DEFAULT_DRIVER: ("avg_headcount", True)}


def _added(values: Column, kind: str = STAGE_TYPE) -> Column:
    """Sum of an array of decimals without its NULLs; NULL if none is left. The type is the same at every step: a wider one
    would lose decimals."""
    some = F.filter(values, lambda v: v.isNotNull())
    return F.when(F.size(some) > 0, F.aggregate(some, F.lit(0).cast(kind), lambda a, v: (a + v).cast(kind)))


def _row(fin, value: Column) -> Column:
    return F.struct((F.lit(fin) if isinstance(fin, int) else fin).alias("fin_id"), value.alias("value"))


def with_drivers(areas: DataFrame) -> DataFrame:
    """areas with the share of every driver, s_<driver>, for areas that both the loan book and the KPI facts know."""
    both = F.col("in_loan") & F.col("avg_headcount").isNotNull() & F.col("area_code").isNotNull()
    return areas.select("*", F.coalesce(both, F.lit(False)).alias("_driven"),
                        *[s.alias(f"s_{d}") for d, s in shares(DRIVERS).items()])


def report_rows(areas: DataFrame) -> DataFrame:
    """(month_key, area_code, rows): all lines and ratios (fin_id, value) of variant B, values as DOUBLE. To be written
    before it is read row by row (see area_row.Book.wide)."""
    # head-office sums of each tagged line: one row a month. A line with several head areas keeps them all
    # (each allocates on its own, as the report's join does)
    heads = areas.groupBy("month_key").agg(F.flatten(F.collect_list(
        F.filter("tagged", lambda t: t["n_head"] > 0))).alias("_heads"))
    x = with_drivers(areas).join(heads, "month_key")

    share = F.col(f"s_{R.B_DEFAULT_DRIVER}")

    def share_of(line: Column) -> Column:
        return reduce(lambda other, item: F.when(line == item[0], F.col(f"s_{item[1]}")).otherwise(other),
                      sorted(R.B_LINE_DRIVER.items()), share)

    own = F.filter(F.coalesce("tagged", F.array()), lambda t: t["fin_id_lv3"].isin(*R.B_ALLOC_LINES))
    alloc = F.flatten(F.transform(own, lambda t: F.transform(
        F.filter("_heads", lambda h: h["fin_id_lv3"] == t["fin_id_lv3"]),
        lambda h: _row(t["fin_id_lv3"], stage_double(t["value"] + h["value_head"] * share_of(t["fin_id_lv3"]))))))
    none = F.array().cast(f"array<struct<fin_id: int, value: {STAGE_TYPE}>>")
    x = x.withColumn("_alloc", F.when(F.col("_driven"), alloc).otherwise(none))

    # funding lines: head pool of each line x area income / (funding revenue + total income)
    earned = F.transform(F.filter("_alloc", lambda r: r["fin_id"].isin(*R.B_INCOME_LINES)), lambda r: r["value"])
    x = x.withColumn("_earned", earned).withColumn("_inc", _added(F.col("_earned")))
    x = x.withColumn("_total", to_stage(F.sum("_inc").over(in_month())))

    def pool(line: int) -> tuple[Column, Column]:
        """(the month has head rows of the line, their sum)"""
        rows = F.filter("_heads", lambda h: h["fin_id_lv3"] == line)
        return F.size(rows) > 0, _added(F.transform(rows, lambda h: h["value_head"]), "decimal(38,2)")

    has_revenue, revenue = pool(R.B_FUNDING_REVENUE_LINE)
    part = F.try_divide(F.col("_inc").cast("double"), (revenue + F.col("_total")).cast("double"))
    funding = []
    for line in R.B_FUNDING_LINES:
        has, amount = pool(line)
        value = to_stage(round_half_up(amount * part * 1, 0))
        funding.append(F.when((F.size("_earned") > 0) & has & has_revenue, F.array(_row(line, value))).otherwise(none))
    managers = F.when(F.col("headcount").isNotNull(), F.array(_row(R.B_HEADCOUNT_FIN, to_stage("headcount")))).otherwise(none)
    x = x.withColumn("_book", F.concat(managers, "_alloc", *funding))

    def total(cond) -> Column:
        return _added(F.transform("_book", lambda r: F.when(cond(r["fin_id"]), r["value"]).otherwise(F.lit(0).cast(STAGE_TYPE))))

    x = x.select("*", total(lambda f: f.between(*R.B_TN_RANGE)).alias("_tn"), total(lambda f: f.between(*R.B_CP_RANGE)).alias("_cp"),
                 total(lambda f: f.between(*R.B_LN_RANGE)).alias("_ln"), total(lambda f: f.isin(*R.B_MARGIN_DEN_IDS)).alias("_tn2"),
                 total(lambda f: f.isin(*R.B_CAPITAL_DEN_IDS)).alias("_cp2"))
    listed, c = F.size("_book") > 0, F.col
    staffed = listed & c("avg_headcount").isNotNull() & c("area_code").isNotNull()
    ratios = [(listed, R.B_CIR_FIN, ratio(-c("_cp"), c("_tn"))), (listed, R.B_MARGIN_FIN, ratio(c("_ln"), c("_tn2"))),
              (listed, R.B_CAPITAL_FIN, ratio(-c("_ln"), c("_cp2"))),
              (staffed, R.B_PER_HEAD_FIN, F.try_divide(c("_ln").cast("double"), c("avg_headcount"))),
              (c("in_loan"), R.B_NPL_FIN, npl_ratio_b()), (c("in_loan"), R.B_WO_FIN, writeoff_ratio_b())]
    empty = F.array().cast("array<struct<fin_id: int, value: double>>")
    out = F.concat(F.transform("_book", lambda r: _row(r["fin_id"], r["value"].cast("double"))),
                   *[F.when(held, F.array(_row(fin, v))).otherwise(empty) for held, fin, v in ratios])
    return x.select(*KEYS, out.alias("rows"))


def build(inputs: Inputs, month, stager: Stager | None = None, loan_store: str | None = None,
          tagged_store: str | None = None, kpi_store: str | None = None) -> SummaryB:
    """`month`: a report month or a list of them (one pass over each source).
    `loan_store` / `tagged_store` / `kpi_store`: read the monthly stores
    instead of the loan snapshots / tagged-ledger / KPI-fact history."""
    spark = inputs.kpi.sparkSession
    st = stager or Stager(spark, "summary_b")
    lines = line_sums_from_store(spark, tagged_store, month) if tagged_store else line_area_sums(inputs.balance_txn, month)
    tagged = lines.groupBy(*KEYS).agg(F.collect_list(F.struct("fin_id_lv3", "value", "value_head", "n_head")).alias("tagged"))
    loan = loan_area(month_area_from_store(spark, loan_store, month) if loan_store else loan_month_area(inputs.loan, month),
                     month).withColumn("in_loan", F.lit(True))
    heads = headcount_in_month_from_store(spark, kpi_store, month) if kpi_store else headcount_in_month(inputs.kpi, month)
    avg_heads = headcount_monthly_avg_from_store(spark, kpi_store, month) if kpi_store else headcount_monthly_avg(inputs.kpi, month)
    areas = st.stage(outer_join([tagged, loan, heads, avg_heads]), "areas")
    lines = st.stage(report_rows(areas), "lines")
    result = lines.select(*KEYS, F.inline("rows")).select("fin_id", "area_code", "value", "month_key")
    return SummaryB(areas, result)


def summary_b(inputs: Inputs, month) -> DataFrame:
    """fact_monthly_summary rows of variant B for `month` (value as DOUBLE)."""
    return build(inputs, month).result


#: Ratios that the source report divides without a guard.
UNGUARDED = (R.B_CIR_FIN, R.B_MARGIN_FIN, R.B_CAPITAL_FIN)


def zero_denominators(result: DataFrame) -> DataFrame:
    """(month_key, fin_id, n_ratios, n_zero): ratios of each unguarded line, and those without a value for
    a zero denominator (their numerators are never NULL)."""
    return (result.filter(F.col("fin_id").isin(*UNGUARDED)).groupBy("month_key", "fin_id")
            .agg(F.count(F.lit(1)).alias("n_ratios"), F.count_if(F.col("value").isNull()).alias("n_zero")))


def repeated_heads(areas: DataFrame) -> DataFrame:
    """(month_key, fin_id_lv3, repeats): head areas of a line beyond the first; each of them allocates on its own, so the line's
    rows are multiplied."""
    heads = areas.select("month_key", F.explode(F.filter("tagged", lambda t: t["n_head"] > 0))).select("month_key", "col.fin_id_lv3")
    return heads.groupBy("month_key", "fin_id_lv3").agg((F.count(F.lit(1)) - 1).alias("repeats")).filter("repeats > 0")
