"""Nothing is cut on the way: ids, areas, ratios before ranks, shares, emptied months, settings."""

import datetime as dt
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from areabook.functions.columns import exact_total
from areabook.operators.area_row import Book, percent_ratio
from areabook.operators.rank import rank_by
from areabook.plans import jobs
from areabook.plans import rules as R
from areabook.plans.staging import Stager
from areabook.session import build_session, ensure_checkpoint_dir, is_local
from areabook.sources import schemas, testdata
from areabook.sources.mart import Mart
from areabook.sources.sinks import publish_month, read_run_log
from tests.helpers import inputs

TALL = "fin_id int, area_code string, value double, month_key int"


def test_long_customer_numbers_and_every_nation_stay(spark):
    root = Stager(spark, "cuts").root
    spark.createDataFrame([(123456, 0), (1234567, 1)], "c_custkey long, c_nationkey int").write.parquet(f"{root}/customer.parquet")
    day = dt.datetime(1998, 1, 5)
    spark.createDataFrame([(1, 123456, "F", 10.0, day, "1-URGENT"), (2, 1234567, "F", 20.0, day, "1-URGENT")],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp,"
                          " o_orderpriority string").write.parquet(f"{root}/orders.parquet")
    got = {(r.employee_id, r.area_code) for r in testdata.kpi_facts(spark, root).collect()}
    assert got == {("E123456", "00"), ("E1234567", "01")}
    assert {r.area_code for r in testdata.loan_book(spark, root).collect()} == {"00", "01"}


def test_ratios_that_differ_late_rank_apart(spark):
    rows = spark.createDataFrame([(a, 199812, True, Decimal(n), True, Decimal("100.0")) for a, n in (("01", "0.12345678"), ("02", "0.12345679"))],
                                 "area_code string, month_key int, h8 boolean, v8 decimal(30,8), h7 boolean, v7 decimal(30,8)")
    book = Book(rows)
    book.fins = [8, 7]
    book.put({10: percent_ratio(book.some([7]), book.some([8]), book.some([7]))})
    out = book.tall(book.wide()).filter("fin_id = 10")
    small = out.withColumn("value", F.col("value") / 1000)        # they differ in the 11th decimal
    ranks = {r.area_code: r["rank"] for r in rank_by(small, "value", ["month_key"], dense=True).collect()}
    assert ranks == {"01": 1, "02": 2} and dict(out.dtypes)["value"] == "double"


def test_totals_do_not_depend_on_row_order(spark):
    xs = [0.1, 1e16, -3.3, 7.7, 1e-9, None]
    total = {spark.createDataFrame([(x,) for x in order], "x double").coalesce(1).agg(exact_total("x")).first()[0]
             for order in (xs, xs[::-1], xs[2:] + xs[:2])}
    assert len(total) == 1 and math.isclose(total.pop(), math.fsum(x for x in xs if x is not None), rel_tol=1e-15)


def test_an_emptied_month_is_cleared_and_others_stay(spark):
    path = f"{Stager(spark, 'emptied').root}/t"
    both = spark.createDataFrame([(1, "01", 1.0, 199811), (1, "01", 2.0, 199812)], TALL)
    publish_month(both, path, months=[199811, 199812], schema=schemas.SUMMARY)
    publish_month(both.limit(0), path, months=[199812])
    assert [(r.month_key, r.value) for r in spark.read.parquet(path).collect()] == [(199811, 1.0)]
    assert dict(spark.read.parquet(path).dtypes)["value"] == "double"


def test_scorecard_job_publishes_and_logs_both(spark):
    out = Stager(spark, "card").root
    inp = inputs(spark, [("1998-03-01", 810000000000, "DVML.01.01.00.000", 5)], [(199801, "01", 1, 100, None, 0, 1)],
                 [(199812, "01", "E1", "S01", 1), (199812, "01", "E2", "S01", 2)])
    jobs.run_kpi_a(spark, inp, out, 199812, R.PROXY_RULES_A)
    jobs.run_kpi_a(spark, inp, out, 199811, R.PROXY_RULES_A)
    jobs.run_kpi_b(spark, inp, out, 199812)
    a = Mart(spark, out).read("fact_monthly_report_kpi_asm_a")
    assert a.filter("month_key = 199812").count() == jobs.run_kpi_a(spark, inp, out, 199812, R.PROXY_RULES_A).count()
    assert {f.name: f.dataType for f in a.schema} == {f.name: f.dataType for f in schemas.KPI_A_OUT}
    summary = Mart(spark, out).read("fact_monthly_summary_a")
    assert dict(summary.dtypes)["value"] == "double" and summary.filter("month_key = 199812").count() > 0
    log = [r.procedure_name for r in read_run_log(spark, f"{out}/log_tracking").collect()]
    assert log.count("fact_monthly_report_kpi_asm_prc_a") == log.count("fact_monthly_summary_prc") == 3
    assert log.count("fact_monthly_report_kpi_asm_prc_b") == log.count("fact_monthly_summary_f1_prc") == 1


def test_settings_of_a_running_session_win(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    try:
        assert build_session().conf.get("spark.sql.shuffle.partitions") == "17"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()
    with pytest.raises(ValueError, match="stage-dir"):
        ensure_checkpoint_dir(Session())
    assert is_local("local[8]") and is_local("local") and not is_local("local-cluster[3,2,1024]")
