"""The monthly ledger store gives the same report as the raw ledger, and a
partial refresh (late rows in some months) catches up."""

from pyspark.sql import functions as F

from areabook.functions.columns import month_key_of
from areabook.operators.ledger import ledger_rule_sums
from areabook.plans import rules as R
from areabook.plans import summary_a as SA
from areabook.plans.ledger_store import refresh_ledger_store, rule_sums_from_store
from areabook.plans.staging import Stager
from areabook.sources import testdata
from tests.conftest import SF_SMALL


def _months(df):
    return sorted(r.m for r in df.select(month_key_of("transaction_date").alias("m")).distinct().collect())


def _rows(df):
    return sorted(map(tuple, df.select("month_key", "rule", "area_code", "direct_sum", "n_rows", "head_sum")
                      .collect()), key=str)


def test_store_matches_raw_ledger_and_catches_up(spark):
    path = f"{Stager(spark, 'store').root}/ledger_store"
    full = testdata.ledger(spark, SF_SMALL)
    early = full.filter(F.col("transaction_date") < F.lit("1997-07-01").cast("timestamp_ntz"))
    refresh_ledger_store(early, _months(early), R.PROXY_ACCOUNTS, path)
    late_months = [m for m in _months(full) if m >= 199707]
    refresh_ledger_store(full, late_months, R.PROXY_ACCOUNTS, path)       # only the months that changed
    months = [199706, 199812]
    assert _rows(rule_sums_from_store(spark, path, months)) == _rows(ledger_rule_sums(full, months,
                                                                                      R.PROXY_ACCOUNTS))
    inp = testdata.inputs(spark, SF_SMALL)
    a = SA.build(inp, R.TEST_MONTH, R.PROXY_RULES_A, ledger_store=path).result
    b = SA.build(inp, R.TEST_MONTH, R.PROXY_RULES_A).result
    key = ["fin_id", "area_code", "value"]
    assert sorted(map(tuple, a.select(*key).collect()), key=str) == sorted(map(tuple, b.select(*key).collect()),
                                                                             key=str)
