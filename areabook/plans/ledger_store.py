"""Monthly ledger store: per (calendar month, rule, area) partial sums.

A monthly report is cumulative from the first ledger row, so computing it
from the raw ledger re-reads the whole history every month. The store keeps
the rule sums of each calendar month once (a few rows per rule and area);
refreshing it reads only the months that changed, and a report is the
cumulative sum of the store's months (`cumulate_rule_sums`). Partitions are
replaced with a dynamic overwrite, so a refresh is idempotent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from areabook.operators.ledger import cumulate_rule_sums, ledger_monthly_sums
from areabook.plans.rules import AccountRule
from areabook.sources.sinks import publish_month


def refresh_ledger_store(ledger: DataFrame, months: Sequence[int], accounts: Sequence[AccountRule],
                         path: str) -> None:
    """Recompute and replace the store partitions of the listed calendar months."""
    publish_month(ledger_monthly_sums(ledger, months, accounts), path, partition_col="ym", months=months)


def rule_sums_from_store(spark: SparkSession, path: str, report_months) -> DataFrame:
    return cumulate_rule_sums(spark.read.parquet(path), report_months)
