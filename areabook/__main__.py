"""Command line: run one report job, as `CALL <procedure>(month)` did.

    python -m areabook summary_a --tables /data/report --out /data/marts [--month 202401]
    python -m areabook kpi_b --tables ... --out ... --month 202401 --month 202402   (backfill)
    python -m areabook summary_a --testdata /root/testdata/sf0.1 --out /tmp/out --month 199812

Stored tables are read from <tables>/<table name> (see sources/inputs.py);
results are published month by month under <out>/ with a run log in
<out>/log_tracking. Without --month the current month is reported."""

from __future__ import annotations

import argparse

from areabook.plans import jobs
from areabook.plans import rules as R
from areabook.plans.ledger_store import refresh_ledger_store
from areabook.plans.kpi_store import refresh_kpi_store
from areabook.plans.loan_store import refresh_loan_store
from areabook.plans.tagged_store import refresh_tagged_store
from areabook.session import build_session
from areabook.sources import testdata
from areabook.sources.inputs import read_tables

RUNNERS = {"summary_a": jobs.run_summary_a, "summary_b": jobs.run_summary_b,
           "kpi_a": jobs.run_kpi_a, "kpi_b": jobs.run_kpi_b}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="areabook")
    ap.add_argument("job", choices=sorted(RUNNERS))
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--tables", help="folder of the stored input tables")
    src.add_argument("--testdata", help="folder of the TPC-H-like test tables (proxy inputs)")
    ap.add_argument("--out", required=True, help="output folder (published tables and run log)")
    ap.add_argument("--month", type=int, action="append", help="report month yyyymm (repeat for several)")
    ap.add_argument("--ledger-store", help="monthly ledger store to read instead of the raw ledger (A jobs)")
    ap.add_argument("--loan-store", help="monthly loan-book store to read instead of the snapshots")
    ap.add_argument("--tagged-store", help="monthly tagged-ledger store to read instead of balance_txn (B jobs)")
    ap.add_argument("--kpi-store", help="monthly KPI store (headcounts and per-manager sums)")
    ap.add_argument("--refresh-stores", type=int, action="append",
                    help="calendar month yyyymm whose store partitions to recompute first (repeat)")
    ap.add_argument("--stage-dir", help="folder that all executors share, for staged tables (else spark.checkpoint.dir)")
    ap.add_argument("--master", default=None, help="Spark master for local runs, e.g. local[8]")
    args = ap.parse_args(argv)

    spark = build_session(args.master, stage_dir=args.stage_dir)
    if args.testdata:
        inputs, rules = testdata.inputs(spark, args.testdata), R.PROXY_RULES_A
    else:
        inputs, rules = read_tables(spark, args.tables), R.CHART_RULES_A
    # several months: one pass over each source (backfill), then one publish
    month = None if not args.month else (args.month[0] if len(args.month) == 1 else args.month)
    if args.refresh_stores:
        if args.ledger_store:
            refresh_ledger_store(inputs.ledger, args.refresh_stores, rules.accounts, args.ledger_store)
        if args.loan_store:
            refresh_loan_store(inputs.loan, args.refresh_stores, args.loan_store)
        if args.tagged_store:
            refresh_tagged_store(inputs.balance_txn, args.refresh_stores, args.tagged_store)
        if args.kpi_store:
            refresh_kpi_store(inputs.kpi, args.refresh_stores, args.kpi_store)
    kwargs = {"loan_store": args.loan_store}
    if args.job in ("summary_a", "kpi_a"):
        kwargs.update(rules=rules, ledger_store=args.ledger_store)
    else:
        kwargs.update(tagged_store=args.tagged_store)
    kwargs.update(kpi_store=args.kpi_store)
    RUNNERS[args.job](spark, inputs, args.out, month, **kwargs)


if __name__ == "__main__":
    main()
