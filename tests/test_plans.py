"""Plan checks: one ledger scan with the month bound pushed, no cartesian
products, ranks without a single-partition window over the data."""

from areabook.operators.ledger import ledger_rule_sums
from areabook.operators.rank import rank_by
from areabook.plans import rules as R
from areabook.plans import summary_a as SA
from areabook.sources import testdata
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ledger_scanned_once_with_pushed_month_bound(spark):
    inp = testdata.inputs(spark, SF_SMALL)
    plan = _plan(ledger_rule_sums(inp.ledger, R.TEST_MONTH, R.PROXY_ACCOUNTS))
    assert plan.count("FileScan parquet") == 4          # lineitem, orders, customer, nation: once each
    assert plan.count("lineitem.parquet") == 1
    assert "LessThan(l_shipdate,1999-01-01T00:00)" in plan


def test_no_cartesian_products_in_summary(spark):
    b = SA.build(testdata.inputs(spark, SF_SMALL), R.TEST_MONTH, R.PROXY_RULES_A)
    for df in (SA.report_lines(b.areas, R.PROXY_RULES_A).wide(), b.shares, b.result):
        p = _plan(df)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    # all totals of the report (pools, drivers, income) come from one exchange by month
    assert _plan(SA.report_lines(b.areas, R.PROXY_RULES_A).wide()).count("Exchange ") == 1


def test_rank_plan_has_no_single_partition_exchange_over_rows(spark):
    df = spark.range(0, 1000).selectExpr("id", "cast(id % 37 as double) as v")
    p = _plan(rank_by(df, "v", descending=True))
    # rows were range-partitioned and counted when the key table was staged;
    # the only single-partition step left is the prefix sum over partition totals
    assert p.count("SinglePartition") <= 1


def test_stored_ledger_scan_prunes_and_filters_before_the_aggregate(spark):
    from areabook.plans.staging import Stager
    path = f"{Stager(spark, 'stored-ledger').root}/ledger"
    testdata.ledger(spark, SF_SMALL).write.parquet(path)
    plan = _plan(ledger_rule_sums(spark.read.parquet(path), R.TEST_MONTH, R.PROXY_ACCOUNTS))
    pushed = plan[plan.index("PushedFilters"):].split("\n")[0]
    assert "LessThan(transaction_date" in pushed
    assert plan.count("FileScan parquet") == 1
    # the account filter runs right above the scan, below the partial aggregate (plan text is top-down)
    assert plan.index("partial_sum") < plan.index("INSET") < plan.index("FileScan parquet")
