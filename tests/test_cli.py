"""The command line runs a job (with stores refreshed first) and publishes it."""

from pyspark.sql import functions as F

from areabook.__main__ import main
from areabook.plans import rules as R
from areabook.plans import summary_b as SB
from areabook.plans.staging import Stager
from areabook.sources import testdata
from areabook.sources.mart import Mart
from areabook.sources.sinks import read_run_log
from tests.conftest import SF_SMALL


def test_cli_summary_b_from_refreshed_stores(spark):
    out = Stager(spark, "cli").root
    months = [y * 100 + m for y in range(1995, 1999) for m in range(1, 13)]
    args = ["summary_b", "--testdata", SF_SMALL, "--out", out, "--month", str(R.TEST_MONTH),
            "--loan-store", f"{out}/loan", "--tagged-store", f"{out}/tagged", "--kpi-store", f"{out}/kpi"]
    for m in months:
        args += ["--refresh-stores", str(m)]
    main(args)
    got = Mart(spark, out).read("fact_monthly_summary_b").filter(F.col("month_key") == R.TEST_MONTH)
    want = SB.build(testdata.inputs(spark, SF_SMALL), R.TEST_MONTH).result
    key = ["fin_id", "area_code", "value"]
    assert sorted(map(tuple, got.select(*key).collect()), key=str) == \
        sorted(map(tuple, want.select(*key).collect()), key=str)
    log = read_run_log(spark, f"{out}/log_tracking").collect()
    assert [(r.procedure_name, r.is_successful) for r in log] == [("fact_monthly_summary_f1_prc", True)]
