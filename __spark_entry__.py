"""

``entry(spark)`` runs the flagship query (summary A for the test month) on
a Spark query over the test tables; ``oracle_sql()`` gives the DuckDB SQL for
the same result, written from the report's own formulas over the proxy views
of FIXTURES.md §3. Every value column is DOUBLE, ids and months INT, ranks and
counts BIGINT, on both sides.

Besides one query per operator group, the jobs are also registered as a
two-month backfill (`*_backfill`: one pass over each source; the oracle is the
union of two single-month runs) and run from freshly built monthly stores
(`*_from_stores`; same oracle as the plain job). `run_log` returns what an oracle can
know of the log: jobs, success, order of the times, published rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areabook.functions.columns import round_half_up, scale_millions
from areabook.operators import tree
from areabook.operators.allocate import rule_pools
from areabook.operators.drivers import driver_share, npl_ratio_a
from areabook.operators.rollup import network_totals
from areabook.oracle import kpi_sql as K
from areabook.oracle import proxies
from areabook.oracle import summary_a_sql as A
from areabook.oracle import summary_b_sql as B
from areabook.plans import jobs
from areabook.plans import kpi_a as KA
from areabook.plans import kpi_b as KB
from areabook.plans import rules as R
from areabook.plans import summary_a as SA
from areabook.plans import summary_b as SB
from areabook.plans.staging import Stager, union_all
from areabook.sources import testdata
from areabook.sources.mart import Mart
from areabook.sources.sinks import read_run_log

MONTH = R.TEST_MONTH
RULES = R.PROXY_RULES_A
RATIOS_A = (R.CIR_FIN_A, R.MARGIN_FIN_A, R.CAPITAL_FIN_A, R.PER_HEAD_FIN_A)
# a backfill of several report months in one pass (the ledger is still read once)
BACKFILL_MONTHS = (199806, 199812)

# One build per (session, data folder, job) is shared by the queries that
# read its stages (the stages are durable parquet tables).
_BUILDS: dict[tuple, object] = {}


def _build(spark: SparkSession, sf_dir: str, job: str):
    key = (spark.sparkContext.applicationId, sf_dir, job)
    if key not in _BUILDS:
        inputs = testdata.inputs(spark, sf_dir)
        _BUILDS[key] = {"a": lambda: SA.build(inputs, MONTH, RULES),
                        "a_backfill": lambda: SA.build(inputs, list(BACKFILL_MONTHS), RULES),
                        "b": lambda: SB.build(inputs, MONTH),
                        "b_backfill": lambda: SB.build(inputs, list(BACKFILL_MONTHS)),
                        "ka": lambda: KA.build(inputs, MONTH, RULES),
                        "kb": lambda: KB.build(inputs, MONTH),
                        "ka_backfill": lambda: KA.build(inputs, list(BACKFILL_MONTHS), RULES),
                        "kb_backfill": lambda: KB.build(inputs, list(BACKFILL_MONTHS))}[job]()
    return _BUILDS[key]


def _tall(df: DataFrame) -> DataFrame:
    return df.select(F.col("fin_id").cast("int"), "area_code", F.col("value").cast("double").alias("value"),
                     F.col("month_key").cast("int"))


def _fins(job: str, fins) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark, sf_dir):
        return _tall(_build(spark, sf_dir, job).result.filter(F.col("fin_id").isin(*fins)))
    return q


def _direct(spark, sf_dir, prefix: bool) -> DataFrame:
    rs = _build(spark, sf_dir, "a").rule_sums
    keys = [r.key for r in RULES.accounts if (r.prefix is not None) == prefix]
    v = scale_millions("direct_sum")
    if prefix:
        v = round_half_up(v, 2)
    return (rs.filter(F.col("rule").isin(*keys) & (F.col("n_rows") > 0))
            .select("rule", "area_code", v.cast("double").alias("value")))


def _head_pool(spark, sf_dir) -> DataFrame:
    rp = rule_pools(_build(spark, sf_dir, "a").rule_sums)
    return rp.select("rule", F.col("pool").cast("double").alias("pool"),
                     F.col("company").cast("double").alias("company"))


def _driver(name: str):
    def q(spark, sf_dir):
        return driver_share(_build(spark, sf_dir, "a").loan_area, name)
    return q


def _driver_headcount(spark, sf_dir) -> DataFrame:
    b = _build(spark, sf_dir, "a")
    share = b.shares.filter(F.col("driver") == "headcount").select("month_key", "area_code", "share")
    return b.headcount.join(share, ["month_key", "area_code"]).select(
        "area_code", F.col("headcount").cast("long"), "share")


def _npl_three_way(spark, sf_dir) -> DataFrame:
    return npl_ratio_a(_build(spark, sf_dir, "a").loan_area).select("area_code", "value")


def _kpi_cols(df: DataFrame) -> DataFrame:  # level-1 rows without the month column
    return df.select("area_code", "employee_id", "criteria_code", F.col("value").cast("double"),
                     F.col("rank_kpi").cast("long"))


def _drivers_b(spark, sf_dir) -> DataFrame:
    return _build(spark, sf_dir, "b").drivers.drop("month_key")


_STORES: dict[tuple, dict[str, str]] = {}


def _stores(spark, sf_dir) -> dict[str, str]:
    """Build the monthly stores from the test tables once per session (every
    calendar month up to the report month that has data). Each store reads its source once."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _STORES:
        return _STORES[key]
    from areabook.plans.kpi_store import refresh_kpi_store
    from areabook.plans.ledger_store import refresh_ledger_store
    from areabook.plans.loan_store import refresh_loan_store
    from areabook.plans.tagged_store import refresh_tagged_store
    inputs = testdata.inputs(spark, sf_dir)
    root = Stager(spark, "stores").root

    months = testdata.store_months(spark, sf_dir, MONTH)      # calendar-bounded lists of month keys
    paths = {k: f"{root}/{k}" for k in ("ledger_store", "loan_store", "tagged_store", "kpi_store")}
    stores = [lambda: refresh_ledger_store(inputs.ledger, months["ledger"], RULES.accounts, paths["ledger_store"]),
              lambda: refresh_loan_store(inputs.loan, months["loan"], paths["loan_store"]),
              lambda: refresh_tagged_store(inputs.balance_txn, months["balance_txn"], paths["tagged_store"]),
              lambda: refresh_kpi_store(inputs.kpi, months["kpi"], paths["kpi_store"])]
    with ThreadPoolExecutor(max_workers=len(stores)) as pool:      # independent of each other, side by side
        for done in [pool.submit(store) for store in stores]:
            done.result()
    _STORES[key] = paths
    return paths


def _from_stores(spark, sf_dir, job: str) -> DataFrame:
    """Run a job from the monthly stores instead of the raw history."""
    p = _stores(spark, sf_dir)
    inputs = testdata.inputs(spark, sf_dir)
    a_stores = {k: p[k] for k in ("ledger_store", "loan_store", "kpi_store")}
    b_stores = {k: p[k] for k in ("loan_store", "tagged_store", "kpi_store")}
    if job == "a":
        return _tall(SA.build(inputs, MONTH, RULES, **a_stores).result)
    if job == "b":
        return _tall(SB.build(inputs, MONTH, **b_stores).result)
    if job == "ka":
        return KA.build(inputs, MONTH, RULES, **a_stores).result
    return KB.build(inputs, MONTH, **b_stores).result


def _month_republish(spark, sf_dir) -> DataFrame:
    """Publish summary A of two months into a fresh mart, then one of them again, and read both back:
    the second publish replaces its month (one copy) and leaves the other alone."""
    mart, name = Mart(spark, Stager(spark, "republish").root), "fact_monthly_summary_a"
    mart.publish({name: _build(spark, sf_dir, "a_backfill").result}, BACKFILL_MONTHS)
    mart.publish({name: _build(spark, sf_dir, "a").result}, [MONTH])
    mart.compact()
    return _tall(mart.read(name))


def _scorecard_republish(spark, sf_dir) -> DataFrame:
    """The same for scorecard A and the summary beside it, published together: two months, then one again;
    what the commits replaced is cleared before reading."""
    mart = Mart(spark, Stager(spark, "scorecard_republish").root)
    runs = {"ka_backfill": BACKFILL_MONTHS, "ka": (MONTH,)}
    with ThreadPoolExecutor(max_workers=len(runs)) as pool:        # built side by side, published in order
        built = dict(zip(runs, pool.map(lambda job: _build(spark, sf_dir, job), runs)))
    for job, months in runs.items():
        k = built[job]
        mart.publish({"fact_monthly_summary_a": k.summary.result, "fact_monthly_report_kpi_asm_a": k.result}, months)
    mart.vacuum(dt.timedelta(0))
    return mart.read("fact_monthly_report_kpi_asm_a").select(*KA.COLUMNS)


def _summary_variants(spark, sf_dir) -> DataFrame:
    """Both summaries of a month as one table, published apart and read from one snapshot."""
    mart = Mart(spark, Stager(spark, "variants").root)
    for v in ("a", "b"):
        mart.publish({f"fact_monthly_summary_{v}": _build(spark, sf_dir, v).result}, [MONTH])
    both = mart.variants({"A": "fact_monthly_summary_a", "B": "fact_monthly_summary_b"}, [MONTH])
    return both.select("variant", "fin_id", "area_code", "value", "month_key")


def _run_log(spark, sf_dir) -> DataFrame:
    """Runs scorecard A and returns its two log rows (of the summary it refreshes, and its own), each with
    the rows its table holds for the month."""
    out = Stager(spark, "runlog").root
    jobs.run_kpi_a(spark, testdata.inputs(spark, sf_dir), out, MONTH, RULES)
    made = {"fact_monthly_summary_prc": "fact_monthly_summary_a",
            "fact_monthly_report_kpi_asm_prc_a": "fact_monthly_report_kpi_asm_a"}
    shot = Mart(spark, out).snapshot()
    held = union_all([shot.table(t).groupBy("month_key").agg(F.count(F.lit(1)).alias("published_rows"))
                      .withColumn("procedure_name", F.lit(p)) for p, t in made.items()])
    return read_run_log(spark, f"{out}/log_tracking").join(held, "procedure_name").select(
        "procedure_name", "month_key", "is_successful", "error_log",
        (F.col("end_time") >= F.col("start_time")).alias("ends_after_start"), "published_rows")


def _summary_a_chart(spark, sf_dir) -> DataFrame:
    """Summary A by the production chart of accounts, over a ledger that holds each of its accounts."""
    return _tall(SA.build(testdata.inputs(spark, sf_dir, testdata.chart_account), MONTH, R.CHART_RULES_A).result)


def _rollup_tree(spark, sf_dir) -> DataFrame:
    """The roll-ups of summary A once more, by the report tree as a table of edges."""
    edges = spark.createDataFrame([(p, c) for p, cs in RULES.rollups for c in cs], "parent int, child int")
    return _tall(tree.rollup(_build(spark, sf_dir, "a").result, tree.closure(edges)))


def _network_totals(spark, sf_dir) -> DataFrame:
    return network_totals(_build(spark, sf_dir, "a").result, RATIOS_A)


def _text_operators():
    """The queries module of the text operators, or None where that subpackage is absent."""
    try:
        import areabook.llm.queries
    except ModuleNotFoundError as e:
        if not (e.name or "").startswith("areabook.llm"):
            raise
        return None
    return areabook.llm.queries


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: summary A (ledger allocation, roll-ups, ratios) on sf0.001."""
    return SA.summary_a(testdata.inputs(spark, "/root/testdata/sf0.001"), MONTH, RULES)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    text = _text_operators()
    return _report_queries() | (text.QUERIES if text else {})


def _report_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "ledger_area_totals": lambda s, d: _direct(s, d, False),
        "ledger_prefix_totals": lambda s, d: _direct(s, d, True),
        "head_pool_by_rule": _head_pool,
        "driver_balance_bucket1": _driver("bal_b1"),
        "driver_balance_bucket2": _driver("bal_b2"),
        "driver_balance_bucket2_5": _driver("bal_b2_5"),
        "driver_balance_all": _driver("bal_all"),
        "driver_cards": _driver("cards"),
        "driver_headcount": _driver_headcount,
        "alloc_card_income": _fins("a", (14, 15, 16, 17, 18)),
        "alloc_other_business": _fins("a", (25, 26, 27)),
        "alloc_operating_cost": _fins("a", (29, 30, 31, 32)),
        "alloc_provision": _fins("a", (9,)),
        "funding_cost_lines": _fins("a", (4, 20, 21, 22)),
        "pnl_rollup": _fins("a", (4, 5, 6, 7, 8, 1)),
        "ratio_cir": _fins("a", (R.CIR_FIN_A,)),
        "ratio_margin": _fins("a", (R.MARGIN_FIN_A,)),
        "ratio_capital": _fins("a", (R.CAPITAL_FIN_A,)),
        "ratio_per_head": _fins("a", (R.PER_HEAD_FIN_A,)),
        "summary_a": lambda s, d: _tall(_build(s, d, "a").result),
        "summary_a_backfill": lambda s, d: _tall(_build(s, d, "a_backfill").result),
        "npl_three_way": _npl_three_way,
        "kpi_employee_rank": lambda s, d: _kpi_cols(_build(s, d, "ka").employee_ranks),
        "kpi_a_level1": lambda s, d: _kpi_cols(_build(s, d, "ka").level1),
        "kpi_a": lambda s, d: _build(s, d, "ka").result,
        "drivers_b": _drivers_b,
        "alloc_lines_b": _fins("b", R.B_ALLOC_LINES),
        "funding_lines_b": _fins("b", R.B_FUNDING_LINES),
        "headcount_b": _fins("b", (R.B_HEADCOUNT_FIN,)),
        "ratios_b": _fins("b", (R.B_CIR_FIN, R.B_MARGIN_FIN, R.B_CAPITAL_FIN, R.B_PER_HEAD_FIN)),
        "npl_b": _fins("b", (R.B_NPL_FIN,)),
        "writeoff_b": _fins("b", (R.B_WO_FIN,)),
        "summary_b": lambda s, d: _tall(_build(s, d, "b").result),
        "summary_b_backfill": lambda s, d: _tall(_build(s, d, "b_backfill").result),
        "summary_a_from_stores": lambda s, d: _from_stores(s, d, "a"),
        "summary_b_from_stores": lambda s, d: _from_stores(s, d, "b"),
        "kpi_a_from_stores": lambda s, d: _from_stores(s, d, "ka"),
        "kpi_b_from_stores": lambda s, d: _from_stores(s, d, "kb"),
        "kpi_b_level1": lambda s, d: _build(s, d, "kb").level1,
        "kpi_b_level2": lambda s, d: _build(s, d, "kb").level2,
        "kpi_b_overall": lambda s, d: _build(s, d, "kb").overall,
        "kpi_b": lambda s, d: _build(s, d, "kb").result,
        "kpi_a_backfill": lambda s, d: _build(s, d, "ka_backfill").result,
        "kpi_b_backfill": lambda s, d: _build(s, d, "kb_backfill").result,
        "month_republish": _month_republish,
        "scorecard_republish": _scorecard_republish,
        "run_log": _run_log,
        "summary_variants": _summary_variants,
        "summary_a_chart": _summary_a_chart,
        "rollup_tree": _rollup_tree,
        "network_totals": _network_totals,
        "zero_denominators_b": lambda s, d: SB.zero_denominators(_build(s, d, "b").result),
    }


def _sql_fins(q, table: str, fins) -> str:
    ids = ", ".join(str(f) for f in fins)
    return q(A.out(table) + f" where fin_id in ({ids})")


def oracle_sql() -> dict[str, str]:
    text = _text_operators()
    return _report_oracles() | (text.ORACLES if text else {})


def _report_oracles() -> dict[str, str]:
    m = MONTH
    qa = lambda sel: A.query(m, sel, RULES)
    qb = lambda sel: B.query(m, sel)

    def direct(prefix: bool) -> str:
        parts = []
        for r in RULES.accounts:
            if (r.prefix is not None) != prefix:
                continue
            v = f"cast(sum(amount) * {A.MIL} as {A.ST})"
            if prefix:
                v = f"round({v}, 2)"
            parts.append(f"select '{r.key}' as rule, split_part(analysis_code, '.', 3) as area_code,"
                         f" cast({v} as double) as value from px_ledger where {A.acct_pred(r, 'direct')}"
                         f" and {A.upto(m)} group by split_part(analysis_code, '.', 3)")
        return qa(" union all ".join(parts))

    pools = " union all ".join(
        f"select '{r.key}' as rule,"
        f" (select cast(cast(sum(amount) * {A.MIL} as {A.ST}) as double) from px_ledger"
        f"  where {A.acct_pred(r, 'pool')} and {A.upto(m)} and substring(analysis_code, 1, 4) = 'HEAD') as pool,"
        f" (select cast(cast(sum(amount) * {A.MIL} as {A.ST}) as double) from px_ledger"
        f"  where {A.acct_pred(r, 'direct')} and {A.upto(m)}) as company"
        for r in RULES.accounts)

    def drv(name):
        return qa(f"select area_code, share from drv_{name}")

    kpi_cols = ("select area_code, employee_id, criteria_code, cast(value as double) as value,"
                " cast(rank_kpi as bigint) as rank_kpi from ")
    return {
        "ledger_area_totals": direct(False),
        "ledger_prefix_totals": direct(True),
        "head_pool_by_rule": qa(pools),
        "driver_balance_bucket1": drv("bal_b1"),
        "driver_balance_bucket2": drv("bal_b2"),
        "driver_balance_bucket2_5": drv("bal_b2_5"),
        "driver_balance_all": drv("bal_all"),
        "driver_cards": drv("cards"),
        "driver_headcount": qa("select a.area_code, cast(a.value as bigint) as headcount, d.share"
                               " from a2 a join drv_headcount d on a.area_code = d.area_code"),
        "alloc_card_income": _sql_fins(qa, "summary_a", (14, 15, 16, 17, 18)),
        "alloc_other_business": _sql_fins(qa, "summary_a", (25, 26, 27)),
        "alloc_operating_cost": _sql_fins(qa, "summary_a", (29, 30, 31, 32)),
        "alloc_provision": _sql_fins(qa, "summary_a", (9,)),
        "funding_cost_lines": _sql_fins(qa, "summary_a", (4, 20, 21, 22)),
        "pnl_rollup": _sql_fins(qa, "summary_a", (4, 5, 6, 7, 8, 1)),
        "rollup_tree": _sql_fins(qa, "summary_a", (4, 5, 6, 7, 8, 1)),
        "ratio_cir": _sql_fins(qa, "summary_a", (R.CIR_FIN_A,)),
        "ratio_margin": _sql_fins(qa, "summary_a", (R.MARGIN_FIN_A,)),
        "ratio_capital": _sql_fins(qa, "summary_a", (R.CAPITAL_FIN_A,)),
        "ratio_per_head": _sql_fins(qa, "summary_a", (R.PER_HEAD_FIN_A,)),
        "summary_a": qa(A.out("summary_a")),
        "summary_a_backfill": " union all ".join(
            f"select * from ({A.query(bm, A.out('summary_a'), RULES)})" for bm in BACKFILL_MONTHS),
        "npl_three_way": K.query_a(m, "select area_code, value from npl_a", RULES),
        "kpi_employee_rank": K.query_a(m, kpi_cols + "ka1", RULES),
        "kpi_a_level1": K.query_a(m, kpi_cols + "ka", RULES),
        "kpi_a": K.query_a(m, "select * from kpi_a", RULES),
        "drivers_b": B.drivers(m),
        "alloc_lines_b": _sql_fins(qb, "summary_b", R.B_ALLOC_LINES),
        "funding_lines_b": _sql_fins(qb, "summary_b", R.B_FUNDING_LINES),
        "headcount_b": _sql_fins(qb, "summary_b", (R.B_HEADCOUNT_FIN,)),
        "ratios_b": _sql_fins(qb, "summary_b", (R.B_CIR_FIN, R.B_MARGIN_FIN, R.B_CAPITAL_FIN, R.B_PER_HEAD_FIN)),
        "npl_b": _sql_fins(qb, "summary_b", (R.B_NPL_FIN,)),
        "writeoff_b": _sql_fins(qb, "summary_b", (R.B_WO_FIN,)),
        "summary_b": qb(A.out("summary_b")),
        "summary_a_from_stores": qa(A.out("summary_a")),
        "summary_b_from_stores": qb(A.out("summary_b")),
        "kpi_a_from_stores": K.query_a(m, "select * from kpi_a", RULES),
        "kpi_b_from_stores": K.query_b(m, "kpi_b"),
        "summary_b_backfill": " union all ".join(
            f"select * from ({B.query(bm, A.out('summary_b'))})" for bm in BACKFILL_MONTHS),
        "kpi_b_level1": K.query_b(m, "l1"),
        "kpi_b_level2": K.query_b(m, "l2"),
        "kpi_b_overall": K.query_b(m, "ov"),
        "kpi_b": K.query_b(m, "kpi_b"),
        "kpi_a_backfill": " union all ".join(
            f"select * from ({K.query_a(bm, 'select * from kpi_a', RULES)})" for bm in BACKFILL_MONTHS),
        "kpi_b_backfill": " union all ".join(
            f"select * from ({K.query_b(bm, 'kpi_b')})" for bm in BACKFILL_MONTHS),
        "month_republish": " union all ".join(
            f"select * from ({A.query(bm, A.out('summary_a'), RULES)})" for bm in BACKFILL_MONTHS),
        "scorecard_republish": " union all ".join(
            f"select * from ({K.query_a(bm, 'select * from kpi_a', RULES)})" for bm in BACKFILL_MONTHS),
        "run_log": K.query_a(m, " union all ".join(
            f"select '{job}' as procedure_name, cast({m} as integer) as month_key, true as is_successful,"
            f" cast(null as varchar) as error_log, true as ends_after_start, count(*) as published_rows from {t}"
            for job, t in (("fact_monthly_summary_prc", "summary_a"), ("fact_monthly_report_kpi_asm_prc_a", "kpi_a"))), RULES),
        "summary_variants": f"select 'A' as variant, * from ({qa(A.out('summary_a'))}) union all "
                            f"select 'B' as variant, * from ({qb(A.out('summary_b'))})",
        "summary_a_chart": A.query(m, A.out("summary_a"), R.CHART_RULES_A, proxies.chart_account(R.CHART_ACCOUNTS)),
        "network_totals": qa("select cast(month_key as integer) as month_key, fin_id, cast(sum(value) as double) as company,"
                             " cast(sum(value) filter (where area_code <> '00') as double) as network_only"
                             " from lvl5 group by month_key, fin_id"),
        "zero_denominators_b": qb(
            "select cast(month_key as integer) as month_key, fin_id, count(*) as n_ratios,"
            " count(*) - count(value) as n_zero from summary_b"
            f" where fin_id in ({R.B_CIR_FIN}, {R.B_MARGIN_FIN}, {R.B_CAPITAL_FIN}) group by month_key, fin_id"),
    }
