"""Late ledger files republish the affected months with the batch result."""

from pyspark.sql import functions as F

from areabook.plans import rules as R
from areabook.plans import summary_a as SA
from areabook.plans import summary_b as SB
from areabook.plans.staging import Stager
from areabook.sources import schemas, testdata
from areabook.sources.mart import Mart
from areabook.sources.sinks import read_run_log
from areabook.streaming.republish import months_to_republish, republish_on_arrival
from tests.conftest import SF_SMALL


def test_months_to_republish():
    assert months_to_republish([199705, 199803], [199612, 199712, 199812]) == [199712, 199812]
    assert months_to_republish([], [199812]) == [] == months_to_republish([None], [199812])


import pytest


@pytest.mark.parametrize("use_store", [False, True])
def test_stream_republishes_to_batch_result(spark, use_store):
    root = Stager(spark, "stream").root
    src, out = f"{root}/ledger", f"{root}/out"
    full = testdata.ledger(spark, SF_SMALL)
    cut = F.col("transaction_date") < F.lit("1998-01-01").cast("timestamp_ntz")
    full.filter(cut).write.parquet(f"{src}/part=1")

    def make_inputs():
        inp = testdata.inputs(spark, SF_SMALL)
        inp.ledger = spark.read.schema(schemas.LEDGER).parquet(src)
        return inp

    store = f"{root}/store" if use_store else None
    republish_on_arrival(spark, src, make_inputs, out, f"{root}/ckpt", [R.TEST_MONTH],
                         ledger_store=store, rules=R.PROXY_RULES_A).awaitTermination()
    full.filter(~cut).write.parquet(f"{src}/part=2")        # late rows arrive
    republish_on_arrival(spark, src, make_inputs, out, f"{root}/ckpt", [R.TEST_MONTH],
                         ledger_store=store, rules=R.PROXY_RULES_A).awaitTermination()
    got = Mart(spark, out).read("fact_monthly_summary_a").filter(F.col("month_key") == R.TEST_MONTH)
    want = SA.build(testdata.inputs(spark, SF_SMALL), R.TEST_MONTH, R.PROXY_RULES_A).result
    key = ["fin_id", "area_code"]
    assert sorted(map(tuple, got.select(*key, "value").collect())) == \
        sorted(map(tuple, want.select(*key, "value").collect()))
    log = read_run_log(spark, f"{out}/log_tracking")
    assert log.count() == 2 and log.filter("is_successful").count() == 2


def test_a_late_loan_snapshot_refreshes_its_store_and_republishes_from_its_month(spark):
    root = Stager(spark, "late").root
    folders = {s: f"{root}/{s}" for s in ("loan", "kpi", "balance_txn")}
    full = testdata.inputs(spark, SF_SMALL)
    reports, late = [199709, 199710, 199711], F.col("kpi_month") == 199710
    full.loan.filter(~late).write.parquet(f"{folders['loan']}/part=1")
    full.kpi.write.parquet(f"{folders['kpi']}/part=1")
    full.balance_txn.write.parquet(f"{folders['balance_txn']}/part=1")

    def make_inputs():
        inp = testdata.inputs(spark, SF_SMALL)
        for name, schema in (("loan", schemas.LOAN_BOOK), ("kpi", schemas.KPI_FACTS), ("balance_txn", schemas.BALANCE_TXN)):
            setattr(inp, name, spark.read.schema(schema).parquet(folders[name]))
        return inp

    stores = {f"{s}_store": f"{root}/stores/{s}" for s in ("loan", "kpi", "tagged")}
    run = lambda: republish_on_arrival(spark, folders, make_inputs, f"{root}/out", f"{root}/ckpt", reports, job="summary_b",
                                       stores=stores).awaitTermination()
    run()
    mart = Mart(spark, f"{root}/out")
    first = {e.month_key: e.version for e in mart.snapshot().entries}
    full.loan.filter(late).write.parquet(f"{folders['loan']}/part=2")
    run()
    then = {e.month_key: e.version for e in mart.snapshot().entries}
    assert then[199709] == first[199709] and then[199710] != first[199710] and then[199711] != first[199711]
    run()                                                               # nothing new: nothing is published
    assert {e.month_key: e.version for e in mart.snapshot().entries} == then
    got = mart.read("fact_monthly_summary_b")
    want = SB.build(full, reports).result
    key = ["month_key", "fin_id", "area_code", "value"]
    assert sorted(map(tuple, got.select(*key).collect()), key=str) == sorted(map(tuple, want.select(*key).collect()), key=str)


def test_sources_and_stores_that_a_job_does_not_read_are_errors(spark):
    for folders, stores in (({"balance_txn": "x"}, {}), ({"ledger": "x"}, {"tagged_store": "y"})):
        with pytest.raises(ValueError):
            republish_on_arrival(spark, folders, None, "out", "ckpt", [199812], rules=R.PROXY_RULES_A, stores=stores)
    with pytest.raises(ValueError, match="rules"):
        republish_on_arrival(spark, "x", None, "out", "ckpt", [199812])
