"""Summary A/B edge cases on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from areabook.plans import rules as R
from areabook.plans import summary_a as SA
from areabook.plans import summary_b as SB
from tests.helpers import code, inputs

A14 = 810000000000
A17 = 810000000003
M = 199812


@pytest.fixture(scope="module")
def built_a(spark):
    led = [("1998-03-01", A14, code("00", True), 1_000_000), ("1998-03-01", A14, code("01"), 10_000_000),
           ("1998-03-01", A14, code("02"), 20_000_000), ("1998-03-01", A14, code("03"), 3_000_000),
           ("1998-03-01", A17, code("01"), 4_000_000)]
    loan = [(199801, "01", 1, 100, None, 0, 1), (199802, "01", 1, 300, None, 0, 1),
            (199801, "02", 1, 200, None, 0, 1), (199802, "02", 2, 50, None, 0, 1)]
    kpi = [(199801, "01", "E1", "S01", 5), (199805, "01", "E2", "S01", None), (199812, "02", "E3", "S01", 1),
           (199812, "02", "E4", "S01", None)]
    return SA.build(inputs(spark, led, loan, kpi), M, R.PROXY_RULES_A)


def _vals(df, fin):
    return {r.area_code: r.value for r in df.filter(F.col("fin_id") == fin).collect()}


def test_driver_share_and_head_office_passthrough(built_a):
    v = _vals(built_a.result, 14)
    # DRV1 averages over the months where bucket 1 exists: 01 -> 200, 02 -> 200: shares 1/2
    assert float(v["01"]) == 10.5 and float(v["02"]) == 20.5
    assert float(v["00"]) == 1.0          # head office keeps its direct amount
    assert v["03"] is None                 # area missing from the driver (Q5)


def test_no_head_rows_gives_null_line(built_a):
    assert _vals(built_a.result, 17) == {"01": None}   # pool NULL (Q6)


def test_headcount_cumulative_counts_null_values(built_a):
    assert {k: int(x) for k, x in _vals(built_a.result, R.HEADCOUNT_FIN_A).items()} == {"01": 2, "02": 2}


def test_rollup_and_ratio_identities(built_a):
    res = built_a.result
    a1, a7, a8, a9 = (_vals(res, f) for f in (1, 7, 8, 9))
    for area, v in a1.items():
        parts = [x.get(area) for x in (a7, a8, a9) if x.get(area) is not None]
        assert v == (sum(parts) if parts else None)     # A1 = A7 + A8 + A9 (NULL when all NULL)


def test_summary_b_drivers_average_over_all_months(spark):
    # B's wo_1 averages over every month of the area (absent bucket = 0): 01 -> 200, 02 -> 100
    bal = [(199803, "01", 1, "DVML", 10), (199803, "02", 1, "DVML", 20), (199803, "00", 1, "HEAD", 30)]
    loan = [(199801, "01", 1, 100, None, 0, 1), (199802, "01", 1, 300, None, 0, 1),
            (199801, "02", 1, 200, None, 0, 1), (199802, "02", 2, 50, None, 0, 1)]
    kpi = [(199812, "01", "E1", "SC01", 5), (199812, "02", "E2", "SC01", 5)]
    b = SB.build(inputs(spark, balance_rows=bal, loan_rows=loan, kpi_rows=kpi), M)
    v = {k: float(x) for k, x in _vals(b.result, 1).items()}
    assert v == pytest.approx({"01": 10 + 30 * 2 / 3, "02": 20 + 30 / 3})
    assert "00" not in v                    # head office has no drivers: dropped (Q7)
    assert _vals(b.result, 7) == {}         # no line-6 head rows: funding lines vanish (Q8)


def test_summary_b_head_pool_fans_out_and_ratio_guard(spark):
    bal = [(199803, "01", 1, "DVML", 10), (199803, "00", 1, "HEAD", 30), (199803, "99", 1, "HEAD", 5),
           (199803, "01", 16, "DVML", -4)]
    loan = [(199801, "01", 1, 100, None, 0, 1)]
    kpi = [(199812, "01", "E1", "SC01", 5)]
    b = SB.build(inputs(spark, balance_rows=bal, loan_rows=loan, kpi_rows=kpi), M)
    rows = b.alloc.filter((F.col("fin_id") == 1) & (F.col("area_code") == "01")).collect()
    assert sorted(float(r.value) for r in rows) == [15.0, 40.0]   # one row per head area (Q9)
    cir = _vals(b.result, R.B_CIR_FIN)
    assert set(cir) == {"01"} and cir["01"] is not None


def test_zero_denominator_is_null(spark):
    # area 01 has only a cost line: CIR divides by TN = 0 -> NULL instead of an error (Q10)
    bal = [(199803, "01", 16, "DVML", -4), (199803, "00", 16, "HEAD", -1)]
    loan = [(199801, "01", 1, 100, None, 0, 1)]
    kpi = [(199812, "01", "E1", "SC01", 5)]
    b = SB.build(inputs(spark, balance_rows=bal, loan_rows=loan, kpi_rows=kpi), M)
    assert _vals(b.result, R.B_CIR_FIN) == {"01": None}


def test_npl_three_way_drops_months_b26_keeps_them(spark):
    from areabook.operators.drivers import loan_area, loan_month_area, npl_ratio_a, npl_ratio_b
    from tests.helpers import loan as mk_loan
    rows = [(199801, "01", 3, 100, 199801, 50, 1),      # bucket 3 and a write-off this year
            (199802, "01", 1, 200, None, 0, 1),         # no bucket 3-5, no write-off
            (199803, "01", 1, 10, 199712, 99, 1)]       # write-off in an earlier year: not counted (Q22)
    la = loan_area(loan_month_area(mk_loan(spark, rows), M), M)
    a = {r.area_code: r.value for r in npl_ratio_a(la).collect()}
    b = {r.area_code: r.value for r in la.select("area_code", npl_ratio_b().alias("value")).collect()}
    assert a["01"] == pytest.approx(1.0)                                  # only 199801 survives
    assert b["01"] == pytest.approx((100 / 3 + 50 / 3) / (310 / 3 + 50 / 3))  # all months, zero-filled


def test_b_headcount_counts_only_values_in_the_month(spark):
    # B21 counts managers with a value in the report month only (Q24); A2 counts all, cumulatively
    bal = [(199803, "01", 1, "DVML", 10), (199803, "00", 1, "HEAD", 30)]
    loan = [(199801, "01", 1, 100, None, 0, 1)]
    kpi = [(199812, "01", "E1", "SC01", 5), (199812, "01", "E2", "SC01", None), (199811, "01", "E3", "SC01", 1),
           (199812, "01", "E1", "SC02", 7)]
    b = SB.build(inputs(spark, balance_rows=bal, loan_rows=loan, kpi_rows=kpi), M)
    assert {k: int(v) for k, v in _vals(b.result, R.B_HEADCOUNT_FIN).items()} == {"01": 1}
    a = SA.build(inputs(spark, kpi_rows=kpi, loan_rows=loan), M, R.PROXY_RULES_A)
    assert {k: int(v) for k, v in _vals(a.result, R.HEADCOUNT_FIN_A).items()} == {"01": 3}
