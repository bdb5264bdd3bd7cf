"""JOB3, scorecard A: KPI ranks of area sales managers, criteria types,
type and overall scores and ranks (refreshes summary A first)."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areabook.functions.columns import as_months
from areabook.operators.drivers import npl_ratio_a
from areabook.operators.kpi import area_employees, employee_kpi
from areabook.operators.rank import join_rank, rank_by, rank_table
from areabook.operators.scorecard import rank_area_metrics, scores, spread_to_employees
from areabook.plans import rules as R
from areabook.plans import summary_a as SA
from areabook.plans.kpi_store import employee_kpi_from_store
from areabook.plans.staging import Stager
from areabook.sources.inputs import Inputs

COLUMNS = ["month_key", "area_code", "employee_id", "criteria_code", "value", "rank_kpi",
           "criteria_type_name", "type_score", "overall_score", "type_rank", "overall_rank"]


@dataclass
class KpiA:
    summary: SA.SummaryA
    employee_ranks: DataFrame   # KA1
    area_metrics: DataFrame     # KA2 + KA3 (area level)
    level1: DataFrame           # KA1 + KA4
    result: DataFrame


def build(inputs: Inputs, month, rules: R.RuleSet,
          ledger_store: str | None = None, loan_store: str | None = None,
          kpi_store: str | None = None) -> KpiA:
    """`month`: a report month or a list of them; every rank is per month."""
    months = as_months(month)
    st = Stager(inputs.kpi.sparkSession, "kpi_a")

    # the summary refresh, and the per-employee KPI averages with what follows from them, are independent
    def employee_side():
        emp = st.stage(employee_kpi_from_store(inputs.kpi.sparkSession, kpi_store, month, "kpi_code")
                       if kpi_store else employee_kpi(inputs.kpi, month, "kpi_code"), "emp_kpi")
        managers = pool.submit(st.stage, area_employees(emp), "managers")   # counted and spread: read twice
        return rank_by(emp, "value", ["month_key", "criteria_code"], descending=True, out="rank_kpi",
                       stager=st), managers.result()

    with ThreadPoolExecutor(max_workers=2) as pool:
        summary = pool.submit(lambda: SA.build(inputs, month, rules, stager=st, ledger_store=ledger_store,
                                               loan_store=loan_store, kpi_store=kpi_store))
        ka1, employees = employee_side()
        sa = summary.result()

    npl = npl_ratio_a(sa.loan_area).select("month_key", "area_code",
                                           F.lit(R.KPI_A_NPL_CODE).alias("criteria_code"), "value")
    fin_code = F.lit(None).cast("string")
    for code, fin in R.KPI_A_AREA_CRITERIA:
        fin_code = F.when(F.col("fin_id") == fin, F.lit(code)).otherwise(fin_code)
    fins = (sa.result.filter(F.col("fin_id").isin(*[f for _, f in R.KPI_A_AREA_CRITERIA])
                             & (F.col("area_code") != "00") & F.col("month_key").isin(*months))
            .select("month_key", "area_code", fin_code.alias("criteria_code"),
                    F.col("value").cast("double").alias("value")))
    area_metrics = npl.unionByName(fins)   # per area: small, not staged
    ranked = rank_area_metrics(area_metrics, employees, {R.KPI_A_NPL_CODE: ("dense_rank", True)},
                               ("dense_rank", False))
    level1 = ka1.unionByName(spread_to_employees(ranked, employees))
    dim = inputs.dim_criteria   # a stored dimension: the planner broadcasts it by its size
    x = level1.join(dim, "criteria_code")
    x = st.stage(scores(x, ["month_key", "employee_id"], "criteria_type_name"), "scored")
    # both score ranks from one table of distinct scores: by type, and overall (no type)
    kinds = F.array(F.struct(F.lit("type").alias("kind"), F.col("criteria_type_name").alias("type"), F.col("type_score").alias("score")),
                    F.struct(F.lit("overall").alias("kind"), F.lit(None).cast("string").alias("type"), F.col("overall_score").alias("score")))
    ranks = rank_table(x.select("month_key", F.inline(kinds)), "score", ["month_key", "kind", "type"], descending=True, dense=True,
                       out="score_rank", stager=st)
    of_type = ranks.filter("kind = 'type'").select("month_key", F.col("type").alias("criteria_type_name"),
                                                   F.col("score").alias("type_score"), F.col("score_rank").alias("type_rank"))
    overall = ranks.filter("kind = 'overall'").select("month_key", F.col("score").alias("overall_score"),
                                                      F.col("score_rank").alias("overall_rank"))
    x = join_rank(x, of_type, "type_score", ["month_key", "criteria_type_name"], "type_rank")
    x = join_rank(x, overall, "overall_score", ["month_key"], "overall_rank")
    result = x.select(F.col("month_key").cast("int").alias("month_key"), "area_code", "employee_id",
                      "criteria_code", F.col("value").cast("double").alias("value"), F.col("rank_kpi").cast("long"),
                      "criteria_type_name", F.col("type_score").cast("long"),
                      F.col("overall_score").cast("long"), "type_rank", "overall_rank")
    return KpiA(sa, ka1, area_metrics, level1, result)


def kpi_a(inputs: Inputs, month, rules: R.RuleSet) -> DataFrame:
    """fact_monthly_report_kpi_asm rows of variant A for `month` (or months)."""
    return build(inputs, month, rules).result
