"""The chart of accounts, held against its own counts and sums, and the quality checks of a run."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from areabook.operators.ledger import month_ranges
from areabook.operators.rollup import network_totals
from areabook.plans import jobs
from areabook.plans import rules as R
from areabook.plans.staging import Stager
from areabook.plans.summary_b import zero_denominators
from areabook.sources.mart import Mart
from areabook.sources.sinks import read_run_log
from tests.helpers import inputs

#: rule: (accounts, sum of the accounts, prefix); the pool of a15 has its own list
CHART = {
    "a14": (3, 2106000090105, None),
    "a17": (1, 719000030002, None),
    "a15": (2, 1404000060124, None),
    "a16": (1, 716000000001, None),
    "a18": (6, 4598000180320, None),
    "a25": (15, 10669088020222, None),
    "a26": (3, 2448000000006, None),
    "a27": (22, 18004168110433, None),
    "a29": (5, 4157000000207, None),
    "a30": (0, 0, "85"),
    "a31": (0, 0, "86"),
    "a32": (0, 0, "87"),
    "a9": (12, 10125400390512, None),
    "a22": (1, 803000000001, None),
    "a21": (4, 3208051000007, None),
    "a20": (2, 1603000000002, None),
    "dt": (32, 24070136080595, None),
}


def test_chart_accounts():
    got = {r.key: (len(r.direct), sum(r.direct), r.prefix) for r in R.CHART_ACCOUNTS}
    assert got == CHART
    own = [r.key for r in R.CHART_ACCOUNTS if r.pool is not None]
    assert own == ["a15"] and 7020000301122 in R.CHART_RULES_A.rule("a15").pool_accounts


def test_month_ranges_merge_adjacent_months(spark):
    months = [y * 100 + m for y in range(1992, 1999) for m in range(1, 13)]
    days = spark.createDataFrame([(dt.datetime(y, m, 28),) for y in range(1991, 2000) for m in (1, 6, 12)], "d timestamp_ntz")
    plan = days.filter(month_ranges("d", months))._jdf.queryExecution().analyzed().toString()
    assert plan.count("d#") and plan.count(" OR ") <= 1     # one range (and the false it starts from)
    got = days.filter(month_ranges("d", months)).count()
    assert got == 7 * 3
    gap = days.filter(month_ranges("d", [199212, 199301, 199806])).collect()
    assert sorted((r.d.year, r.d.month) for r in gap) == [(1992, 12), (1993, 1), (1998, 6)]


def test_network_totals_leave_head_office_out(spark):
    rows = spark.createDataFrame([(14, "00", 5.0, 199812), (14, "01", 2.0, 199812), (10, "01", 9.0, 199812),
                                  (15, "00", 1.0, 199812), (16, "01", None, 199812)],
                                 "fin_id int, area_code string, value double, month_key int")
    got = {r.fin_id: (r.company, r.network_only) for r in network_totals(rows, (10,)).collect()}
    assert got == {14: (7.0, 2.0), 15: (1.0, None), 16: (None, None)}


def _b_inputs(spark):
    # area 02 has a manager, but no line: its ratios divide by zero
    return inputs(spark, loan_rows=[(199812, "01", 1, 100, None, 0, 1), (199812, "02", 1, 100, None, 0, 1)],
                  kpi_rows=[(199812, "01", "E1", "SC01", 1), (199812, "02", "E2", "SC01", 2)],
                  balance_rows=[(199812, "01", f, h, 100) for f in range(1, 21) for h in ("DVML", "HEAD")])


def test_zero_denominators_are_logged_or_fail_a_strict_month(spark):
    out = Stager(spark, "zero").root
    res = jobs.run_summary_b(spark, _b_inputs(spark), out, 199812)
    zero = zero_denominators(res).agg(F.sum("n_zero")).first()[0]
    assert zero > 0 and [r.zero_denominators for r in read_run_log(spark, f"{out}/log_tracking").collect()] == [zero]
    strict = Stager(spark, "strict").root
    with pytest.raises(jobs.ZeroDenominator):
        jobs.run_summary_b(spark, _b_inputs(spark), strict, 199812, strict=True)
    assert Mart(spark, strict).snapshot().entries == []
    assert [r.is_successful for r in read_run_log(spark, f"{strict}/log_tracking").collect()] == [False]


def test_repeated_keys_are_logged_or_fail_a_strict_month(spark):
    out, inp = Stager(spark, "repeats").root, _b_inputs(spark)
    inp.loan, inp.kpi = inp.loan.filter("area_code = '01'"), inp.kpi.filter("area_code = '01'")     # no ratio divides by zero
    inp.balance_txn = inp.balance_txn.unionByName(inp.balance_txn.filter("area_code = '01' and fin_id_lv3 < 3").replace("01", "99", ["area_code"]))
    inp.dim_criteria_xlsx = inp.dim_criteria_xlsx.unionByName(inp.dim_criteria_xlsx.filter("criteria_code = 'FN01'"))
    jobs.run_kpi_b(spark, inp, out, 199812)
    log = {r.procedure_name: r.duplicate_keys for r in read_run_log(spark, f"{out}/log_tracking").collect()}
    assert log == {jobs.SUMMARY_B: 2, jobs.SCORECARD_B: 1}
    for dim, what in ((inp.dim_criteria_xlsx, "criteria"), (inp.dim_criteria_xlsx.distinct(), "head areas")):
        inp.dim_criteria_xlsx, strict = dim, Stager(spark, "repeats").root
        with pytest.raises(jobs.DuplicateKeys, match=what):
            jobs.run_kpi_b(spark, inp, strict, 199812, strict=True)
        assert Mart(spark, strict).snapshot().entries == []


def test_the_chart_of_accounts_is_the_reviewed_one():
    """A second, fixed source beside the rules that both sides read: the lists' digest as reviewed, and their shapes."""
    import hashlib
    lists = "\n".join(f"{r.key}:{r.prefix or ''}:{','.join(map(str, r.direct))}:{','.join(map(str, r.pool or ()))}" for r in R.CHART_ACCOUNTS)
    assert hashlib.sha256(lists.encode()).hexdigest() == "d0be70a8a342c8e8f0e73695a775503f5207662712e8e9612580679d71946601"
    assert len({a for r in R.CHART_ACCOUNTS for a in (*r.direct, *r.pool_accounts)}) == 109
