"""The four report jobs as runnable units: resolve the month, compute every
stage, publish the month's tables in one commit (sources/mart.py), write the run log.

Differences from the source procedures, on purpose: a NULL month replaces the
resolved month (not nothing); start and end are wall-clock times and the end
is set on failure too; a failing summary fails the scorecard that calls it;
each job logs its own name."""

from __future__ import annotations

import datetime as _dt
import traceback
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areabook.operators.scorecard import repeated_codes
from areabook.plans import kpi_a as KA
from areabook.plans import kpi_b as KB
from areabook.plans import rules as R
from areabook.plans import summary_a as SA
from areabook.plans import summary_b as SB
from areabook.functions.columns import as_months
from areabook.sources.inputs import Inputs
from areabook.sources.mart import Mart
from areabook.sources.sinks import append_run_log


def resolve_month(month, today: _dt.date | None = None):
    """yyyymm (or a list of them for a one-pass backfill); the current month
    when none is given."""
    if isinstance(month, (list, tuple)):
        return sorted({int(m) for m in month})
    if month is not None:
        return int(month)
    d = today or _dt.datetime.now(_dt.timezone.utc).date()
    return d.year * 100 + d.month


def run_logged(spark: SparkSession, names: str | tuple[str, ...], log_path: str,
               body: Callable[[], DataFrame], found: dict[str, dict[str, int]] | None = None) -> DataFrame:
    """Runs body and logs one row a name (a scorecard logs the summary it refreshes, then itself): first that the
    run has started, so that a run whose driver dies shows as unfinished, then how it ended, with the data-quality counts
    that body has put into `found` by name."""
    names = (names,) if isinstance(names, str) else names
    run_id, now = uuid.uuid4().hex, lambda: _dt.datetime.now(_dt.timezone.utc)
    start = now()
    append_run_log(spark, log_path, run_id, names, start)
    try:
        out = body()
    except Exception as e:  # log, then fail the run
        why = "".join(traceback.format_exception_only(type(e), e)).strip()
        append_run_log(spark, log_path, run_id, names, start, now(), False, why, found)
        raise
    append_run_log(spark, log_path, run_id, names, start, now(), True, None, found)
    return out


class ZeroDenominator(ArithmeticError):
    """A ratio of variant B divides by zero and the run is strict."""


class DuplicateKeys(ValueError):
    """A table that the run joins by a key repeats it, and the run is strict."""


class _Checks:
    """Data-quality counts of a run by log name; a strict run fails before anything is published."""

    def __init__(self, strict: bool):
        self.strict, self.found = strict, {}

    def _count(self, name: str, what: str, rows: DataFrame, column: str, error: type, says: str) -> None:
        n = int(rows.agg(F.sum(column)).first()[0] or 0)
        self.found.setdefault(name, {})[what] = n
        if self.strict and n:
            raise error(f"{n} {says}")

    def summary_b(self, built: SB.SummaryB) -> None:
        self._count(SUMMARY_B, "zero_denominators", SB.zero_denominators(built.result), "n_zero", ZeroDenominator,
                    "ratios of summary B divide by zero")
        self._count(SUMMARY_B, "duplicate_keys", SB.repeated_heads(built.areas), "repeats", DuplicateKeys,
                    "further head areas of a line in the tagged ledger")

    def criteria(self, name: str, dim: DataFrame) -> None:
        self._count(name, "duplicate_keys", repeated_codes(dim), "repeats", DuplicateKeys, "repeated codes in the criteria dimension")


#: Names in the run log.
SUMMARY_A, SUMMARY_B = "fact_monthly_summary_prc", "fact_monthly_summary_f1_prc"
SCORECARD_A, SCORECARD_B = "fact_monthly_report_kpi_asm_prc_a", "fact_monthly_report_kpi_asm_prc_b"


def _published(spark: SparkSession, out_dir: str, tables: dict[str, DataFrame], month) -> DataFrame:
    """Publishes the tables together; the last one as published."""
    return Mart(spark, out_dir).publish(tables, as_months(month)).table(list(tables)[-1], as_months(month))


def run_summary_a(spark, inputs: Inputs, out_dir: str, month, rules: R.RuleSet, ledger_store: str | None = None,
                  loan_store: str | None = None, kpi_store: str | None = None) -> DataFrame:
    m = resolve_month(month)

    def body():
        res = SA.build(inputs, m, rules, ledger_store=ledger_store, loan_store=loan_store,
                       kpi_store=kpi_store).result
        return _published(spark, out_dir, {"fact_monthly_summary_a": res}, m)
    return run_logged(spark, SUMMARY_A, f"{out_dir}/log_tracking", body)


def run_summary_b(spark, inputs: Inputs, out_dir: str, month=None, loan_store: str | None = None,
                  tagged_store: str | None = None, kpi_store: str | None = None, strict: bool = False) -> DataFrame:
    """`strict`: a ratio with a zero denominator fails the month, as a division error would, and so does a line
    with several head areas."""
    m, checks = resolve_month(month), _Checks(strict)

    def body():
        built = SB.build(inputs, m, loan_store=loan_store, tagged_store=tagged_store, kpi_store=kpi_store)
        checks.summary_b(built)
        return _published(spark, out_dir, {"fact_monthly_summary_b": built.result}, m)
    return run_logged(spark, SUMMARY_B, f"{out_dir}/log_tracking", body, checks.found)


def run_kpi_a(spark, inputs: Inputs, out_dir: str, month, rules: R.RuleSet, ledger_store: str | None = None,
              loan_store: str | None = None, kpi_store: str | None = None, strict: bool = False) -> DataFrame:
    """Both tables are computed first and published together, or neither; `strict`: a criterion listed twice fails the month."""
    m, checks = resolve_month(month), _Checks(strict)

    def body():
        checks.criteria(SCORECARD_A, inputs.dim_criteria)
        k = KA.build(inputs, m, rules, ledger_store=ledger_store, loan_store=loan_store, kpi_store=kpi_store)
        return _published(spark, out_dir, {"fact_monthly_summary_a": k.summary.result, "fact_monthly_report_kpi_asm_a": k.result}, m)
    return run_logged(spark, (SUMMARY_A, SCORECARD_A), f"{out_dir}/log_tracking", body, checks.found)


def run_kpi_b(spark, inputs: Inputs, out_dir: str, month=None, loan_store: str | None = None,
              tagged_store: str | None = None, kpi_store: str | None = None, strict: bool = False) -> DataFrame:
    """Both tables are computed first and published together, or neither; `strict` as for summary B and scorecard A."""
    m, checks = resolve_month(month), _Checks(strict)

    def body():
        checks.criteria(SCORECARD_B, inputs.dim_criteria_xlsx)
        k = KB.build(inputs, m, loan_store=loan_store, tagged_store=tagged_store, kpi_store=kpi_store)
        checks.summary_b(k.summary)
        return _published(spark, out_dir, {"fact_monthly_summary_b": k.summary.result, "fact_monthly_report_kpi_asm_b": k.result}, m)
    return run_logged(spark, (SUMMARY_B, SCORECARD_B), f"{out_dir}/log_tracking", body, checks.found)
