"""A ledger stored by month and account: same sums, and scans that skip what no rule counts."""

import pytest
from pyspark.sql import functions as F

from areabook.operators.ledger import account_ranges, in_account_ranges, ledger_rule_sums
from areabook.plans import rules as R
from areabook.plans.ledger_layout import read_ledger, store_ledger
from areabook.plans.staging import Stager
from tests.plan_metrics import scanned_rows


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def ledger(spark):
    """200,000 postings over 5,000 accounts, one in fifty of them in a rule, in posting order."""
    codes = R.chart_codes(R.CHART_ACCOUNTS)
    account = F.when(F.col("id") % 50 == 0, F.get(F.array(*[F.lit(c) for c in codes]), (F.col("id") / 50 % len(codes)).cast("int")))
    return spark.range(200_000).select(
        F.date_add(F.lit("1998-01-01").cast("date"), (F.col("id") * 97 % 365).cast("int")).cast("timestamp_ntz").alias("transaction_date"),
        account.otherwise(F.lit(900000000000) + F.col("id") * 7919 % 5000).cast("long").alias("account_code"),
        F.concat(F.when(F.col("id") % 3 == 0, "HEAD").otherwise("DVML"), F.lit(".01.0"), (F.col("id") % 7).cast("string"), F.lit(".00")).alias("analysis_code"),
        (F.col("id") % 1000).cast("decimal(18,2)").alias("amount"))


def test_ranges_hold_every_account_of_the_rules():
    for accounts in (R.CHART_ACCOUNTS, R.PROXY_ACCOUNTS):
        for most in (1, 5, 24, 10_000):
            spans = account_ranges(accounts, most)
            assert len(spans) <= most and all(a <= b for a, b in spans) and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))
            for r in accounts:
                listed = [*r.direct, *r.pool_accounts] + ([int(r.prefix), int(r.prefix + "0"), int(r.prefix + "9" * 10)] if r.prefix else [])
                assert all(any(lo <= a <= hi for lo, hi in spans) for a in listed)


def test_a_stored_ledger_gives_the_same_sums_and_skips_other_accounts(spark, ledger):
    root = Stager(spark, "layout").root
    ledger.write.parquet(f"{root}/posted")
    store_ledger(ledger, f"{root}/stored", row_group=64 << 10, partitions=24)
    posted, stored = spark.read.parquet(f"{root}/posted"), read_ledger(spark, f"{root}/stored", 199806)
    want = ledger_rule_sums(posted, 199806, R.CHART_ACCOUNTS)
    assert rows(ledger_rule_sums(stored, 199806, R.CHART_ACCOUNTS)) == rows(want)
    # the account filter alone: nothing to skip in posting order, nearly everything in the stored one
    counted = lambda df: scanned_rows(df.filter(in_account_ranges(F.col("account_code"), R.CHART_ACCOUNTS)).select("amount"))
    assert counted(posted) == 200_000
    assert counted(read_ledger(spark, f"{root}/stored")) < 40_000
    assert scanned_rows(stored.select("amount")) < 110_000            # folders of later months are not read


def test_a_month_is_replaced_alone(spark, ledger):
    path = f"{Stager(spark, 'layout').root}/stored"
    small = ledger.filter("account_code < 720000000000")
    store_ledger(small, path)
    doubled = small.withColumn("amount", (F.col("amount") * 2).cast("decimal(18,2)"))
    store_ledger(doubled, path, months=[199803])
    march = (F.col("transaction_date") >= "1998-03-01") & (F.col("transaction_date") < "1998-04-01")
    want = small.filter(~march).unionByName(doubled.filter(march))
    assert rows(read_ledger(spark, path).drop("ledger_month")) == rows(want)
