"""Month publish is idempotent and leaves other months alone; run log rows."""

import pytest
from pyspark.sql import functions as F

from areabook.plans import jobs
from areabook.plans import rules as R
from areabook.plans.staging import Stager
from areabook.sources.mart import Mart
from areabook.sources.sinks import publish_month, read_run_log
from tests.helpers import inputs


def test_republish_replaces_only_its_month(spark):
    root = Stager(spark, "pubtest").root
    m1 = spark.createDataFrame([(1, "01", 1.0, 199811), (1, "02", 2.0, 199812)],
                               "fin_id int, area_code string, value double, month_key int")
    publish_month(m1, f"{root}/t")
    again = spark.createDataFrame([(1, "01", 5.0, 199812)], "fin_id int, area_code string, value double, month_key int")
    publish_month(again, f"{root}/t")
    publish_month(again, f"{root}/t")
    got = sorted((r.month_key, r.area_code, r.value) for r in spark.read.parquet(f"{root}/t").collect())
    assert got == [(199811, "01", 1.0), (199812, "01", 5.0)]


def test_resolve_month_defaults_to_current():
    import datetime as dt
    assert jobs.resolve_month(None, dt.date(2026, 3, 9)) == 202603
    assert jobs.resolve_month(199812) == 199812
    assert jobs.resolve_month([199812, 199806]) == [199806, 199812]


def test_run_log_on_success_and_failure(spark):
    out = Stager(spark, "logtest").root
    inp = inputs(spark, [("1998-03-01", 810000000000, "DVML.01.01.00.000", 5)],
                 [(199801, "01", 1, 100, None, 0, 1)], [(199812, "01", "E1", "S01", 1)])
    jobs.run_summary_a(spark, inp, out, 199812, R.PROXY_RULES_A)
    jobs.run_summary_a(spark, inp, out, 199812, R.PROXY_RULES_A)       # rerun: still one copy of the month
    pub = Mart(spark, out).read("fact_monthly_summary_a")
    assert pub.filter(F.col("fin_id") == 14).count() == 1
    bad = inputs(spark)
    bad.ledger = None                                    # a broken input fails the job
    with pytest.raises(Exception):
        jobs.run_summary_a(spark, bad, out, 199812, R.PROXY_RULES_A)
    log = read_run_log(spark, f"{out}/log_tracking").collect()
    assert sorted(r.is_successful for r in log) == [False, True, True]
    assert all(r.end_time is not None and r.procedure_name == "fact_monthly_summary_prc" for r in log)
    assert [r.error_log is None for r in log if r.is_successful] == [True, True]
