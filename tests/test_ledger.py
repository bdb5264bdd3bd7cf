"""Ledger rule aggregation and column helpers."""

import random

from pyspark.sql import functions as F

from areabook.functions.columns import digits_prefix, month_end_exclusive
from areabook.operators.ledger import ledger_rule_sums
from areabook.plans.rules import AccountRule
from tests.helpers import code, ledger


def _sums(df):
    return {(r.rule, r.area_code): (r.direct_sum, r.n_rows, r.head_sum) for r in df.collect()}


def test_account_in_two_rules_counts_in_both(spark):
    rules = [AccountRule("x", (1, 2)), AccountRule("y", (2, 3))]
    led = ledger(spark, [("1998-05-01", 2, code("01"), 10), ("1998-05-02", 3, code("01"), 5)])
    s = _sums(ledger_rule_sums(led, 199812, rules))
    assert s[("x", "01")][:2] == (10, 1)
    assert s[("y", "01")][:2] == (15, 2)


def test_pool_list_differs_from_direct_list(spark):
    rules = [AccountRule("x", (1, 2), pool=(1,))]
    led = ledger(spark, [("1998-05-01", 1, code("00", True), 7), ("1998-05-01", 2, code("00", True), 100)])
    s = _sums(ledger_rule_sums(led, 199812, rules))
    assert s[("x", "00")] == (107, 2, 7)


def test_month_bound_and_short_analysis_code(spark):
    rules = [AccountRule("x", (1,))]
    led = ledger(spark, [("1998-12-31 23:59:59", 1, "DVML.01", 1), ("1999-01-01", 1, "DVML.01", 100),
                         ("1990-01-01", 1, code("05"), 2)])
    s = _sums(ledger_rule_sums(led, 199812, rules))
    assert s[("x", "")][:2] == (1, 1)          # fewer than 3 parts -> area ''
    assert s[("x", "05")][:2] == (2, 1)        # no lower bound: cumulative from the first row
    assert len(s) == 2


def test_month_end_exclusive_matches_yyyymm_compare(spark):
    df = spark.range(0, 800).select(F.date_add(F.lit("1997-06-01").cast("date"), F.col("id").cast("int"))
                                    .cast("timestamp_ntz").alias("d"))
    for m in (199712, 199801, 199806, 199800, 199813):
        a = df.filter((F.year("d") * 100 + F.month("d")) <= m).count()
        b = df.filter(F.col("d") < month_end_exclusive(m)).count()
        assert a == b, m


def test_digits_prefix_equals_text_prefix(spark):
    rnd = random.Random(1)
    vals = [rnd.choice([85, 850, 8599, 86, 0, 5, 8, 9]) * 10 ** rnd.randint(0, 10) + rnd.randint(0, 9)
            for _ in range(500)] + [-85, 85, 8, 850000000000, 859999999999, 860000000000, 9223372036854775807]
    df = spark.createDataFrame([(v,) for v in vals], "a long")
    for p in ("85", "8", "0", "92"):
        x = df.filter(digits_prefix("a", p)).count()
        y = df.filter(F.left(F.col("a").cast("string"), F.lit(len(p))) == p).count()
        assert x == y, p


def test_report_months_from_and_month_ranges(spark):
    from areabook.functions.columns import report_months_from
    from areabook.operators.ledger import month_ranges
    df = spark.createDataFrame([(199712,), (199801,), (199806,), (199901,)], "ym int")
    got = {r.ym: r.ms for r in df.select("ym", report_months_from("ym", [199806, 199712, 199812]).alias("ms"))
           .collect()}
    assert got == {199712: [199712, 199806, 199812], 199801: [199806, 199812], 199806: [199806, 199812],
                   199901: []}
    days = spark.range(0, 500).select(F.date_add(F.lit("1997-11-15").cast("date"), F.col("id").cast("int"))
                                      .cast("timestamp_ntz").alias("d"))
    want = days.filter((F.year("d") * 100 + F.month("d")).isin(199712, 199801, 199903)).count()
    assert days.filter(month_ranges("d", [199801, 199712, 199903])).count() == want
