"""Properties of the sf0.01 results."""

import os
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF_ORACLE

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_ORACLE), reason="test data not present")


def _by_fin(df):
    out = defaultdict(dict)
    for r in df.collect():
        out[r.fin_id][r.area_code] = r.value
    return out


def test_driver_shares_sum_to_one(spark):
    sa = E._build(spark, SF_ORACLE, "a")
    sums = {r.driver: r.s for r in sa.shares.groupBy("driver").agg(F.sum("share").alias("s")).collect()}
    assert set(sums) == {"bal_b1", "bal_b2", "bal_b2_5", "bal_all", "cards", "headcount"}
    for d, s in sums.items():
        assert s == pytest.approx(1.0, abs=1e-9), d


def test_hierarchy_identities(spark):
    v = _by_fin(E._build(spark, SF_ORACLE, "a").result)
    for area in v[1]:
        parts = [v[f].get(area) for f in (7, 8, 9) if v[f].get(area) is not None]
        assert float(v[1][area]) == pytest.approx(float(sum(map(float, parts))), abs=1e-7)   # stored as DOUBLE beside the ratios
    for area in v[7]:
        parts = [v[f].get(area) for f in (4, 5, 6) if v[f].get(area) is not None]
        assert float(v[7][area]) == pytest.approx(float(sum(map(float, parts))), abs=1e-7)


def test_unrounded_allocation_conserves_the_pool(spark):
    sa = E._build(spark, SF_ORACLE, "a")
    v = _by_fin(sa.result)
    shares = {r.area_code: r.share for r in sa.shares.filter("driver = 'headcount'").collect()}
    pools = {r.rule: r for r in sa.rule_sums.groupBy("rule").agg(
        F.sum("head_sum").alias("p")).collect()}
    from areabook.plans import rules as R
    for line in R.ALLOC_LINES_A:
        if line.driver != "headcount":
            continue
        pool = round(float(pools[line.rule].p) / 1e6, 2)
        areas = [a for a in v[line.fin_id] if a != "00"]
        direct = sum(round(float(r.direct_sum) / 1e6, 2) for r in sa.rule_sums.filter(
            (F.col("rule") == line.rule) & (F.col("n_rows") > 0) & (F.col("area_code") != "00")).collect())
        expect = direct + pool * sum(shares.get(a, 0.0) for a in areas)
        assert float(sum(v[line.fin_id][a] for a in areas)) == pytest.approx(expect, abs=1e-6)


def test_ranks_start_at_one_and_dense_ranks_have_no_gaps(spark):
    ka = E._build(spark, SF_ORACLE, "ka").result
    per_code = defaultdict(set)
    for r in ka.select("criteria_code", "rank_kpi").distinct().collect():
        per_code[r.criteria_code].add(r.rank_kpi)
    for code, ranks in per_code.items():
        assert min(ranks) == 1, code
        if code in ("S04", "F01", "F02", "F03"):           # dense_rank criteria
            assert ranks == set(range(1, max(ranks) + 1)), code
    overall = {r.overall_rank for r in ka.select("overall_rank").distinct().collect()}
    assert overall == set(range(1, max(overall) + 1))
