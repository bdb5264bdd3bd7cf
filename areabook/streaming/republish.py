"""Incremental republish: when files of a source arrive late, recompute and
republish the report months they affect.

The report is cumulative (a month covers every row up to its end), so a row of month d, in the ledger, the tagged
ledger, the loan book or the KPI facts, changes every reported month >= d. Structured
Streaming file sources watch the folders of the sources; each micro-batch yields the
distinct (source, month) it touches (a distributed distinct: only a handful of month
keys reach the driver), and foreachBatch refreshes exactly the store months of the sources that were touched, then
re-runs the ordinary batch job for every reported month at or after the earliest touched one and publishes them in
one commit. Replaying a batch after a failure
republishes the same months with the same result, so the sink is idempotent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from areabook.functions.columns import month_key_of
from areabook.plans import jobs
from areabook.plans import rules as R
from areabook.plans.kpi_store import refresh_kpi_store
from areabook.plans.ledger_store import refresh_ledger_store
from areabook.plans.loan_store import refresh_loan_store
from areabook.plans.tagged_store import refresh_tagged_store
from areabook.sources import schemas
from areabook.sources.inputs import Inputs


@dataclass(frozen=True)
class Source:
    """An input table that files arrive for: its schema, the column that dates a row, its store and how to refresh that."""
    schema: T.StructType
    dated: str
    store: str
    refresh: Callable[[Inputs, list[int], str, R.RuleSet | None], None]


SOURCES = {
    "ledger": Source(schemas.LEDGER, "transaction_date", "ledger_store",
                     lambda inp, months, path, rules: refresh_ledger_store(inp.ledger, months, rules.accounts, path)),
    "balance_txn": Source(schemas.BALANCE_TXN, "month_key", "tagged_store",
                          lambda inp, months, path, _: refresh_tagged_store(inp.balance_txn, months, path)),
    "loan": Source(schemas.LOAN_BOOK, "kpi_month", "loan_store", lambda inp, months, path, _: refresh_loan_store(inp.loan, months, path)),
    "kpi": Source(schemas.KPI_FACTS, "month_report", "kpi_store", lambda inp, months, path, _: refresh_kpi_store(inp.kpi, months, path)),
}
#: What each job reads, and the stores it takes.
READS = {"summary_a": ("ledger", "loan", "kpi"), "kpi_a": ("ledger", "loan", "kpi"),
         "summary_b": ("balance_txn", "loan", "kpi"), "kpi_b": ("balance_txn", "loan", "kpi")}


def months_to_republish(touched: Iterable[int], report_months: Iterable[int]) -> list[int]:
    touched = [m for m in touched if m is not None]     # a row without a date counts in no report
    if not touched:
        return []
    first = min(touched)
    return sorted(m for m in set(report_months) if m >= first)


def arrivals(spark: SparkSession, folders: Mapping[str, str]) -> DataFrame:
    """Stream of (source, month_key), one row a row that arrives in any of the folders (source -> folder)."""
    def one(name: str, folder: str) -> DataFrame:
        src = SOURCES[name]
        month = month_key_of(src.dated) if isinstance(src.schema[src.dated].dataType, T.TimestampNTZType) else F.col(src.dated)
        rows = spark.readStream.schema(src.schema).parquet(folder)
        return rows.select(F.lit(name).alias("source"), month.alias("month_key")).filter("month_key is not null")
    return reduce(DataFrame.unionByName, [one(n, f) for n, f in sorted(folders.items())])


def republish_on_arrival(spark: SparkSession, folders: str | Mapping[str, str], make_inputs: Callable[[], Inputs],
                         out_dir: str, checkpoint_location: str, report_months: Iterable[int],
                         job: str = "summary_a", available_now: bool = True,
                         ledger_store: str | None = None,
                         rules: R.RuleSet | None = None, stores: Mapping[str, str] | None = None) -> StreamingQuery:
    """Start the stream over `folders` (source -> folder; a single folder is the ledger's). `make_inputs()` returns the
    batch inputs (which read the same folders), `report_months` the months the report publishes.
    With `stores` (the job's store arguments; `ledger_store` is one of them), each batch first refreshes the store
    months that its rows touched (reading only those months of that source), and the reports read the
    stores instead of the history."""
    runner = {"summary_a": jobs.run_summary_a, "summary_b": jobs.run_summary_b,
              "kpi_a": jobs.run_kpi_a, "kpi_b": jobs.run_kpi_b}[job]
    folders = {"ledger": folders} if isinstance(folders, str) else dict(folders)
    stores = dict(stores or {}) | ({"ledger_store": ledger_store} if ledger_store else {})
    if set(folders) - set(READS[job]):
        raise ValueError(f"{job} does not read {sorted(set(folders) - set(READS[job]))}")
    if set(stores) - {SOURCES[s].store for s in READS[job]}:
        raise ValueError(f"{job} has no {sorted(set(stores) - {SOURCES[s].store for s in READS[job]})}")
    if "ledger" in READS[job] and rules is None:
        raise ValueError("rules (the chart of accounts) are needed by variant A jobs")
    months = sorted(set(report_months))

    def handle(batch: DataFrame, epoch_id: int) -> None:
        hit: dict[str, list[int]] = {}
        for r in batch.distinct().collect():
            hit.setdefault(r.source, []).append(r.month_key)
        for name, touched in hit.items():
            if path := stores.get(SOURCES[name].store):
                SOURCES[name].refresh(make_inputs(), sorted(touched), path, rules)
        again = months_to_republish([m for touched in hit.values() for m in touched], months)
        if again:   # all affected months in one run: each source is read once
            runner(spark, make_inputs(), out_dir, again, **({"rules": rules} if "ledger" in READS[job] else {}), **stores)

    writer = arrivals(spark, folders).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
