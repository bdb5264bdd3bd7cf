"""JOB1, summary A: per-area P&L lines from the raw ledger, allocated,
rolled up and turned into ratios for one report month (cumulative) or several
(one pass; every row carries month_key).

Two tables are written (see plans.staging):
  1. areas    one row a (month, area): the ledger's rule sums (one scan, or the monthly store), the loan book's driver
              averages and the headcount, joined by area
  2. lines    all lines, roll-ups and ratios as expressions over that row; driver totals, head-office pools and
              the total card income are windows over one exchange by month (operators.area_row); the result is this
              table, line by line
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areabook.functions.columns import stage_double, to_stage
from areabook.operators.area_row import (HEAD_OFFICE, Book, Line, added, allocated, in_month, outer_join, percent_ratio, pool,
                                         shares)
from areabook.operators.drivers import LOAN_DRIVERS_A, loan_area, loan_month_area
from areabook.operators.kpi import headcount_cumulative
from areabook.operators.ledger import ledger_area_sums, pivot_rules, unpivot_rules
from areabook.operators.rollup import closure
from areabook.plans import rules as R
from areabook.plans.kpi_store import headcount_cumulative_from_store
from areabook.plans.ledger_store import rule_sums_from_store
from areabook.plans.loan_store import month_area_from_store
from areabook.plans.staging import Stager
from areabook.sources.inputs import Inputs


@dataclass
class SummaryA:
    areas: DataFrame           # one row a (month, area): what the lines are computed from
    rules: R.RuleSet
    result: DataFrame          # everything, as stored
    loan_columns: list[str]

    @cached_property
    def rule_sums(self) -> DataFrame:
        """(month_key, rule, area_code, direct_sum, n_rows, head_sum)"""
        return unpivot_rules(self.areas, self.rules.accounts)

    @cached_property
    def loan_area(self) -> DataFrame:
        """Per-area loan-book drivers."""
        return self.areas.filter("in_loan").select(*self.loan_columns)

    @cached_property
    def headcount(self) -> DataFrame:
        return self.areas.filter("headcount is not null").select("month_key", "area_code", "headcount")

    @cached_property
    def shares(self) -> DataFrame:
        """(month_key, driver, area_code, share)"""
        return _long_shares(self.areas)


def _month_area(inputs: Inputs, month, loan_store: str | None) -> DataFrame:
    if loan_store:
        return month_area_from_store(inputs.kpi.sparkSession, loan_store, month)
    return loan_month_area(inputs.loan, month)


def ratio_specs():
    """(fin_id, base lines, numerator lines, denominator lines) of the ratios."""
    return [
        (R.CIR_FIN_A, (7,), (8,), (7,)),
        (R.MARGIN_FIN_A, (1,), (1,), R.MARGIN_DEN_IDS_A),
        (R.CAPITAL_FIN_A, (1,), (1,), R.MARGIN_DEN_IDS_A),
        (R.PER_HEAD_FIN_A, (R.HEADCOUNT_FIN_A,), (1,), (R.HEADCOUNT_FIN_A,)),
    ]


#: Driver -> (column of the area row, is it an average?)
DRIVERS = {**LOAN_DRIVERS_A, "headcount": ("headcount", False)}
CARD_INCOME = 4
TOTALS = (5, 6, 8, 7, 1)


def report_lines(areas: DataFrame, rules: R.RuleSet) -> Book:
    """All lines of variant A over the area rows: totals, allocation, funding, roll-ups and ratios in order."""
    at = {r.key: i for i, r in enumerate(rules.accounts)}
    used = sorted({at[ln.rule] for ln in rules.alloc_lines})
    named = {ln.driver for ln in rules.alloc_lines}
    costs = {key: at[key] for key in (*[k for _, k in rules.funding_lines], rules.funding_revenue)}
    coded = F.col("area_code").isNotNull()       # an area without a code is in the totals, but takes no share
    rows = areas.select("*", *[pool(f"p{i}").alias(f"_pool{i}") for i in used],
                        *[pool(f"d{i}").alias(f"_company{i}") for i in costs.values()],
                        *[F.when(coded, s).alias(f"_s_{d}") for d, s in shares({d: DRIVERS[d] for d in sorted(named)}).items()])
    book = Book(rows)
    book.put({R.HEADCOUNT_FIN_A: Line(F.col("headcount").isNotNull(), to_stage("headcount")),
              **{ln.fin_id: allocated(ln, at[ln.rule], F.col(f"_s_{ln.driver}")) for ln in rules.alloc_lines}})

    leaves: dict[int, list[int]] = {}
    for parent, leaf in closure(rules.rollups):
        leaves.setdefault(parent, []).append(leaf)
    book.put({CARD_INCOME: added(book.some(leaves[CARD_INCOME]))})
    # funding lines: company cost x area card income / (total card income + company funding revenue);
    # head office takes the total's share
    income = book.line(CARD_INCOME)
    book.rows = book.rows.withColumn("_income", to_stage(F.sum(F.when(income.held, income.value)).over(in_month())))
    base = F.when(F.col("area_code") == HEAD_OFFICE, F.col("_income")).otherwise(income.value)
    revenue = F.col(f"_company{costs[rules.funding_revenue]}")
    part = F.try_divide(base.cast("double"), (F.col("_income") + revenue).cast("double"))
    book.put({fin: Line(income.held, stage_double(F.col(f"_company{costs[key]}") * part)) for fin, key in rules.funding_lines})
    book.put({p: added(book.some(leaves[p])) for p in TOTALS})
    book.put({fin: percent_ratio(*[book.some(x) for x in spec]) for fin, *spec in ratio_specs()})
    return book


def _long_shares(areas: DataFrame) -> DataFrame:
    wide = areas.select("month_key", "area_code", *{c for c, _ in DRIVERS.values()}, "in_loan",
                        *[s.alias(f"_s_{d}") for d, s in shares(DRIVERS).items()])
    packed = F.array(*[F.struct(F.lit(d).alias("driver"), F.col(f"_s_{d}").alias("share"),
                                (F.col("headcount") if d == "headcount" else F.col("in_loan")).isNotNull().alias("held"))
                       for d in DRIVERS])
    return wide.select("month_key", "area_code", F.inline(packed)).filter("held").select("month_key", "driver", "area_code", "share")


def build(inputs: Inputs, month, rules: R.RuleSet,
          stager: Stager | None = None, ledger_store: str | None = None,
          loan_store: str | None = None, kpi_store: str | None = None) -> SummaryA:
    """`month`: a report month or a list of them. `ledger_store` /
    `loan_store` / `kpi_store`: read the monthly stores (plans.ledger_store,
    plans.loan_store, plans.kpi_store) instead of the raw history."""
    spark = inputs.loan.sparkSession
    st = stager or Stager(spark, "summary_a")
    sums = (pivot_rules(rule_sums_from_store(spark, ledger_store, month), rules.accounts) if ledger_store
            else ledger_area_sums(inputs.ledger, month, rules.accounts))
    loan = loan_area(_month_area(inputs, month, loan_store), month).withColumn("in_loan", F.lit(True))
    heads = (headcount_cumulative_from_store(spark, kpi_store, month) if kpi_store else headcount_cumulative(inputs.kpi, month))
    areas = st.stage(outer_join([sums, loan, heads]), "areas")
    book = report_lines(areas, rules)
    result = book.tall(st.stage(book.wide(), "lines"))
    return SummaryA(areas, rules, result, loan.columns)


def summary_a(inputs: Inputs, month, rules: R.RuleSet) -> DataFrame:
    """fact_monthly_summary rows of variant A for `month` (value as DOUBLE)."""
    return build(inputs, month, rules).result
