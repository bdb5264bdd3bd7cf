"""The monthly loan-book store rebuilds the same (month, area) table, and the
same summaries, as the raw snapshots — over several report years."""

from pyspark.sql import functions as F

from areabook.operators.drivers import loan_area, loan_month_area
from areabook.plans import summary_b as SB
from areabook.plans.loan_store import month_area_from_store, refresh_loan_store
from areabook.plans.staging import Stager
from areabook.sources import testdata
from tests.conftest import SF_SMALL
from tests.helpers import loan


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_store_matches_snapshots(spark):
    path = f"{Stager(spark, 'loanstore').root}/loan_store"
    book = testdata.loan_book(spark, SF_SMALL)
    months = sorted(r.kpi_month for r in book.select("kpi_month").distinct().collect())
    refresh_loan_store(book, [m for m in months if m < 199707], path)
    refresh_loan_store(book, [m for m in months if m >= 199707], path)
    refresh_loan_store(book, [199801], path)                               # idempotent re-refresh
    report = [199712, 199806, 199812]
    want = loan_area(loan_month_area(book, report), report)
    got = loan_area(month_area_from_store(spark, path, report), report)
    assert _rows(got) == _rows(want)
    inp = testdata.inputs(spark, SF_SMALL)
    a = SB.build(inp, 199812, loan_store=path).result.select("fin_id", "area_code", "value")
    b = SB.build(inp, 199812).result.select("fin_id", "area_code", "value")
    assert _rows(a) == _rows(b)


def test_store_edge_rows(spark):
    # write-off year before / same as the report year, NULL write-off month, NULL amounts
    rows = [(199801, "01", 3, 100, 199801, 50, 1), (199801, "01", 1, 10, 199712, 99, 1),
            (199802, "01", 1, 200, None, 0, 1), (199803, "02", 2, 5, 199803, None, 2)]
    book = loan(spark, rows)
    path = f"{Stager(spark, 'loanstore2').root}/loan_store"
    refresh_loan_store(book, [199801, 199802, 199803], path)
    for report in ([199812], [199712, 199812]):
        want = loan_month_area(book, report)
        got = month_area_from_store(spark, path, report).select(*want.columns)
        assert _rows(got.withColumn("kpi_month", F.col("kpi_month").cast("int"))) == _rows(want)


def test_tagged_store_matches_history(spark):
    from areabook.operators.tagged import line_area_sums
    from areabook.plans.tagged_store import line_sums_from_store, refresh_tagged_store
    path = f"{Stager(spark, 'taggedstore').root}/tagged"
    bt = testdata.balance_txn(spark, SF_SMALL)
    months = sorted(r.month_key for r in bt.select("month_key").distinct().collect())
    refresh_tagged_store(bt, [m for m in months if m < 199801], path)
    refresh_tagged_store(bt, [m for m in months if m >= 199801], path)
    for report in ([199812], [199712, 199812]):
        assert _rows(line_sums_from_store(spark, path, report)) == _rows(
            line_area_sums(bt, report).select("month_key", "fin_id_lv3", "area_code", "value", "value_head",
                                              "n_head"))


def test_kpi_presence_store_headcounts(spark):
    from areabook.operators.kpi import headcount_cumulative, headcount_in_month, headcount_monthly_avg
    from areabook.plans import kpi_store as K
    from tests.helpers import kpi
    facts = kpi(spark, [(199801, "01", "E1", "S01", 5), (199801, "01", "E1", "S02", None),
                        (199805, "01", "E2", "S01", None), (199812, "01", "E3", "S01", 2),
                        (199812, "02", "E1", "S03", 1), (199712, "02", "E4", "S01", None)])
    path = f"{Stager(spark, 'kpistore').root}/kpi"
    K.refresh_kpi_store(facts, [199712, 199801, 199805], path)
    K.refresh_kpi_store(facts, [199812], path)
    for report in ([199812], [199712, 199805, 199812]):
        assert _rows(K.headcount_cumulative_from_store(spark, path, report)) == \
            _rows(headcount_cumulative(facts, report).select("month_key", "area_code", "headcount"))
        assert _rows(K.headcount_in_month_from_store(spark, path, report)) == \
            _rows(headcount_in_month(facts, report).select("month_key", "area_code", "headcount"))
        assert _rows(K.headcount_monthly_avg_from_store(spark, path, report)) == \
            _rows(headcount_monthly_avg(facts, report).select("month_key", "area_code", "avg_headcount"))
        from areabook.operators.kpi import employee_kpi
        cols = ["month_key", "area_code", "employee_id", "criteria_code", "value"]
        for code in ("kpi_code", "criteria_code"):
            assert _rows(K.employee_kpi_from_store(spark, path, report, code).select(*cols)) == \
                _rows(employee_kpi(facts, report, code).select(*cols))
