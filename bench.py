"""Bench: the four report jobs end to end on $BENCH_SF_DIR (default sf0.1).

Prints ONE JSON line: {"metric", "value" (total seconds, sum of the median of
each job), "unit", "queries": {job: median sec}, "sf", ...}. Each job is timed
from reading the parquet tables to the published month (every stage
written once to the checkpoint folder, as in production). Warm: one untimed
run first, then the median of $BENCH_RUNS (default 3) runs."""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from areabook.plans import kpi_a as KA  # noqa: E402
from areabook.plans import kpi_b as KB  # noqa: E402
from areabook.plans import rules as R  # noqa: E402
from areabook.plans import summary_a as SA  # noqa: E402
from areabook.plans import summary_b as SB  # noqa: E402
from areabook.plans.staging import Stager  # noqa: E402
from areabook.session import build_session  # noqa: E402
from areabook.sources import testdata  # noqa: E402
from areabook.sources.mart import Mart  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus, app_name="areabook-bench")
    m = R.TEST_MONTH
    marts = Stager(spark, "bench").root
    jobs = {
        "summary_a": lambda inp: {"fact_monthly_summary_a": SA.build(inp, m, R.PROXY_RULES_A).result},
        "summary_b": lambda inp: {"fact_monthly_summary_b": SB.build(inp, m).result},
        "kpi_a": lambda inp: {"fact_monthly_report_kpi_asm_a": KA.build(inp, m, R.PROXY_RULES_A).result},
        "kpi_b": lambda inp: {"fact_monthly_report_kpi_asm_b": KB.build(inp, m).result},
    }
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name, job in jobs.items():
        samples, mart = [], Mart(spark, f"{marts}/{name}")
        for i in range(runs + 1):
            t = time.perf_counter()
            shot = mart.publish(job(testdata.inputs(spark, sf_dir)), [m])
            dt = time.perf_counter() - t
            if i:
                samples.append(dt)
        rows[name] = sum(e.n_rows for e in shot.entries)
        times[name] = round(statistics.median(samples), 3)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "report_jobs_total_median_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows": rows,
        "sf": float(sf.group(1)) if sf else sf_dir,
        "cpus": cpus,
        "runs": runs,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
