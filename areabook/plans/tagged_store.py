"""Monthly store of the tagged ledger (summary B): per (calendar month, line,
area) sums. Same contract as plans.ledger_store: refresh only the changed
months, report from the cumulated monthly sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areabook.functions.columns import as_months
from areabook.operators.tagged import cumulate_line_sums, line_month_sums
from areabook.sources.sinks import publish_month


def refresh_tagged_store(balance_txn: DataFrame, months: Sequence[int], path: str) -> None:
    rows = balance_txn.filter(F.col("month_key").isin(*as_months(months)))
    publish_month(line_month_sums(rows), path, partition_col="ym", months=months)


def line_sums_from_store(spark: SparkSession, path: str, report_months) -> DataFrame:
    return cumulate_line_sums(spark.read.parquet(path), report_months)
