"""Store refreshes read each source once, and aggregate the ledger by the rules that a row matches."""

import random
import threading

from pyspark.sql import functions as F

import __spark_entry__ as E
from areabook.functions.columns import month_key_of
from areabook.operators.drivers import loan_month_area
from areabook.operators.kpi import headcount_cumulative, headcount_in_month, headcount_monthly_avg
from areabook.operators.ledger import ledger_monthly_sums, ledger_rule_sums
from areabook.plans import kpi_store as K
from areabook.plans import rules as R
from areabook.plans.loan_store import month_area_from_store, refresh_loan_store
from areabook.plans.rules import AccountRule
from areabook.plans.staging import Stager
from areabook.sources import schemas, sinks, testdata
from tests.conftest import SF_SMALL
from tests.helpers import D, code, kpi, ledger


def counted(spark, rows, schema):
    """The rows as a DataFrame, and an accumulator of how many rows were read."""
    seen = spark.sparkContext.accumulator(0)

    def read(row):
        seen.add(1)
        return row
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(read), schema), seen


def test_loan_refresh_reads_the_snapshots_once(spark):
    path = f"{Stager(spark, 'loan-once').root}/loan_store"
    rows = [(199801 + i % 3, random.Random(i).choice(["01", "02", None]), i % 6, D(i), random.Random(i).choice([None, 199712, 199803]),
             D(i) if i % 4 else None, i % 2) for i in range(60)]
    book, seen = counted(spark, rows, schemas.LOAN_BOOK)
    refresh_loan_store(book, [199801, 199802, 199803], path)
    assert seen.value == len(rows)
    want = loan_month_area(spark.createDataFrame(rows, schemas.LOAN_BOOK), 199803)
    got = month_area_from_store(spark, path, 199803).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_store_months_come_from_the_date_column_alone(spark):
    for name, date in (("ledger", month_key_of("transaction_date")), ("balance_txn", F.col("month_key")),
                       ("loan", F.col("kpi_month")), ("kpi", F.col("month_report"))):
        joined = getattr(testdata.inputs(spark, SF_SMALL), name).select(date.alias("m")).distinct()
        got = testdata.months(spark, SF_SMALL, name, R.TEST_MONTH)
        assert {r.m for r in joined.collect() if r.m <= R.TEST_MONTH} <= set(got) and max(got) <= R.TEST_MONTH


def test_rule_sums_keep_three_sums_a_row(spark):
    plan = ledger_rule_sums(testdata.ledger(spark, SF_SMALL), R.TEST_MONTH, R.PROXY_ACCOUNTS)._jdf.queryExecution().executedPlan().toString()
    rows = next(line for line in plan.split("\n") if "partial_sum" in line)
    assert rows.count("partial_sum") == 2 and rows.count("partial_count") == 1


def test_rule_sums_are_the_sums_of_matching_rows(spark):
    rng = random.Random(4)
    rules = [AccountRule("a", (1, 2), pool=(1, 7)), AccountRule("b", (2, 3)), AccountRule("c", (), prefix="85"), AccountRule("d", (99,))]
    rows = [(f"1998-0{rng.randint(1, 3)}-11", rng.choice([1, 2, 3, 4, 7, 85, 8512, 58]), rng.choice([code("01"), code("02", True), code("03"), "HEAD", None]),
             rng.choice([None, 1, 2.5, -4])) for _ in range(300)]

    def hits(r, a, accounts):
        return str(a).startswith(r.prefix) if r.prefix else a in accounts
    want = {}
    for d, a, c, v in rows:
        if not any(hits(r, a, r.direct) or hits(r, a, r.pool_accounts) for r in rules):
            continue
        area = None if c is None else (c.split(".") + ["", ""])[2]
        for r in rules:
            s = want.setdefault((int(d[:4] + d[5:7]), r.key, area), [None, 0, None])
            if hits(r, a, r.direct):
                s[1] += 1
                s[0] = s[0] if v is None else (s[0] or 0) + D(v)
            if c and c.startswith("HEAD") and hits(r, a, r.pool_accounts) and v is not None:
                s[2] = (s[2] or 0) + D(v)
    got = {(r.ym, r.rule, r.area_code): [r.direct_sum, r.n_rows, r.head_sum]
           for r in ledger_monthly_sums(ledger(spark, rows), [199801, 199802, 199803], rules).collect()}
    assert got == want


def kpi_rows(spark, path, table, month):
    return spark.read.parquet(f"{path}/{table}").filter(F.col("ym") == month).count()


def test_bitmaps_are_made_after_the_exchange_and_values_written_once(spark, monkeypatch):
    path = f"{Stager(spark, 'kpi-once').root}/kpi_store"
    # a month, an area and a manager with several codes, without values, without an area, without a manager
    facts = [(199801, "01", "E1", "S01", 1), (199801, "01", "E1", "S02", None), (199801, None, "E2", "S01", 2), (199801, "02", None, "S01", 3),
             (199802, "01", "E3", "S01", 4), (199803, "01", "E1", "S01", 5)]
    staged = []
    monkeypatch.setattr(sinks, "Stager", lambda *a: staged.append(a) or Stager(*a))
    K.refresh_kpi_store(kpi(spark, facts), [199801, 199802, 199803], path)
    assert not staged                            # what is published is not written a second time before
    for months in (199801, [199801, 199802, 199803]):
        for stored, direct in ((K.headcount_cumulative_from_store, headcount_cumulative), (K.headcount_in_month_from_store, headcount_in_month),
                               (K.headcount_monthly_avg_from_store, headcount_monthly_avg)):
            want = direct(kpi(spark, facts), months)
            assert sorted(map(str, stored(spark, path, months).select(want.columns).collect())) == sorted(map(str, want.collect()))
    # a month whose values are gone keeps its bitmaps, a month without rows keeps nothing
    K.refresh_kpi_store(kpi(spark, [(199802, "01", "E3", "S01", None)]), [199802, 199803], path)
    assert [kpi_rows(spark, path, t, 199802) for t in ("bitmaps", "values_kpi_code", "values_criteria_code")] == [1, 0, 0]
    assert [kpi_rows(spark, path, t, 199803) for t in ("bitmaps", "values_kpi_code", "values_criteria_code")] == [0, 0, 0]
    assert kpi_rows(spark, path, "values_kpi_code", 199801) == 3
    rows = spark.createDataFrame([(199801, "01", "E1", 1)], "ym int, area_code string, employee_id string, n long")
    plan = K._bits(rows, K._managers(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_bitmap_construct_agg") < plan.index("Exchange hashpartitioning(ym")


def test_scorecard_republish_builds_side_by_side(spark, monkeypatch):
    both, build = threading.Barrier(2, timeout=120), E._build

    def waits(*args):
        both.wait()                              # breaks if one build waits for the other
        return build(*args)
    monkeypatch.setattr(E, "_build", waits)
    months = {r.month_key: r["count"] for r in E._scorecard_republish(spark, SF_SMALL).groupBy("month_key").count().collect()}
    assert sorted(months) == sorted(E.BACKFILL_MONTHS) and all(months.values())


def test_months_are_written_together(spark):
    path, months = f"{Stager(spark, 'together').root}/t", [199801, 199802, 199803, 199804]
    rows = spark.range(0, 64, 1, 8).select((199801 + F.col("id") % 4).cast("int").alias("ym"), "id")
    sinks.publish_month(rows, path, partition_col="ym", months=months, full=months)
    files = [f.split("/")[-2] for f in spark.read.parquet(path).inputFiles()]
    assert sorted(files) == [f"ym={m}" for m in months]          # not one file a task and month
    assert sorted((r.ym, r.id) for r in spark.read.parquet(path).collect()) == sorted((199801 + i % 4, i) for i in range(64))


def test_store_months_read_each_date_column_once(spark, monkeypatch):
    want = {name: testdata.months(spark, SF_SMALL, name, R.TEST_MONTH) for name in ("ledger", "balance_txn", "loan", "kpi")}
    reads, read = [], testdata._read
    monkeypatch.setattr(testdata, "_read", lambda s, d, name, *cols: reads.append((name, *cols)) or read(s, d, name, *cols))
    assert testdata.store_months(spark, SF_SMALL, R.TEST_MONTH) == want
    assert sorted(reads) == [("lineitem", "l_shipdate"), ("orders", "o_orderdate")]
