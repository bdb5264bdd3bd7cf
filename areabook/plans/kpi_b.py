"""JOB4, scorecard B: level-1 KPI ranks, level-2 group scores (SC, FN) and
the overall score, each ranked (refreshes summary B first)."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areabook.functions.columns import as_months
from areabook.operators.kpi import area_employees, employee_kpi
from areabook.operators.rank import rank_by
from areabook.operators.scorecard import rank_area_metrics, spread_to_employees
from areabook.plans import rules as R
from areabook.plans import summary_b as SB
from areabook.plans.kpi_store import employee_kpi_from_store
from areabook.plans.staging import Stager, union_all
from areabook.sources.inputs import Inputs

COLUMNS = ["month_key", "area_code", "employee_id", "criteria_code", "value", "rank_kpi"]
KEYS = ["month_key", "area_code", "employee_id"]


@dataclass
class KpiB:
    summary: SB.SummaryB
    level1: DataFrame
    level2: DataFrame
    overall: DataFrame
    result: DataFrame


def _out(df: DataFrame) -> DataFrame:
    return df.select(F.col("month_key").cast("int"), "area_code", "employee_id", "criteria_code",
                     F.col("value").cast("double").alias("value"), F.col("rank_kpi").cast("long"))


def build(inputs: Inputs, month, loan_store: str | None = None, tagged_store: str | None = None,
          kpi_store: str | None = None) -> KpiB:
    """`month`: a report month or a list of them; every rank is per month."""
    months = as_months(month)
    st = Stager(inputs.kpi.sparkSession, "kpi_b")

    # the summary refresh, and the per-employee KPI averages with what follows from them, are independent
    def employee_side():
        emp = st.stage(employee_kpi_from_store(inputs.kpi.sparkSession, kpi_store, month, "criteria_code")
                       if kpi_store else employee_kpi(inputs.kpi, month, "criteria_code"), "emp_kpi")
        managers = pool.submit(st.stage, area_employees(emp), "managers")   # counted and spread: read twice
        return rank_by(emp, "value", ["month_key", "criteria_code"], descending=True, out="rank_kpi",
                       stager=st), managers.result()

    with ThreadPoolExecutor(max_workers=2) as pool:
        summary = pool.submit(lambda: SB.build(inputs, month, stager=st, loan_store=loan_store,
                                                 tagged_store=tagged_store, kpi_store=kpi_store))
        kb1, employees = employee_side()
        sb = summary.result()

    v, code, fin = F.col("value").cast("double"), F.lit(None).cast("string"), F.col("fin_id")
    for criterion, line, absolute, _, _ in R.KPI_B_AREA_CRITERIA:
        code = F.when(fin == line, F.lit(criterion)).otherwise(code)
        v = F.when(fin == line, F.abs(F.col("value").cast("double"))).otherwise(v) if absolute else v
    parts = (sb.result.filter(fin.isin(*[line for _, line, *_ in R.KPI_B_AREA_CRITERIA]) & (F.col("area_code") != "00")
                              & F.col("month_key").isin(*months))
             .select("month_key", "area_code", code.alias("criteria_code"), v.alias("value")))
    dim = inputs.dim_criteria_xlsx   # a stored dimension: broadcast by the planner's size check
    area_metrics = parts.join(dim, "criteria_code")   # per area: small, not staged
    methods = {code: (method, asc) for code, _, _, method, asc in R.KPI_B_AREA_CRITERIA}
    ranked = rank_area_metrics(area_metrics, employees, methods, ("dense_rank", False))
    level1 = kb1.unionByName(spread_to_employees(ranked, employees))
    level1 = st.stage(_out(level1), "level1")

    # a criterion scores in every group whose name it contains; the groups are ranked apart, in one table
    groups = F.filter(F.array(*[F.lit(g) for g in R.KPI_B_GROUPS]), lambda g: F.col("criteria_code").contains(g))
    sums = (level1.select(*KEYS, "rank_kpi", F.explode(groups).alias("_group"))
            .groupBy(*KEYS, F.col("_group").alias("criteria_code")).agg(F.sum("rank_kpi").alias("value")))
    level2 = st.stage(_out(rank_by(sums, "value", ["month_key", "criteria_code"], out="rank_kpi", stager=st)), "level2")
    ov = (level2.filter(F.col("criteria_code").isin(*R.KPI_B_GROUPS))
          .groupBy(*KEYS).agg(F.sum("value").alias("value"))
          .withColumn("criteria_code", F.lit(R.KPI_B_OVERALL)))
    overall = _out(rank_by(ov, "value", ["month_key"], out="rank_kpi", stager=st))
    result = union_all([level1, level2, overall])
    return KpiB(sb, level1, level2, overall, result)


def kpi_b(inputs: Inputs, month) -> DataFrame:
    """fact_monthly_report_kpi_asm rows of variant B for `month` (or months)."""
    return build(inputs, month).result
