"""A ledger stored for reports: a folder a calendar month, rows by account inside.

A ledger in posting order has every account in every row group, so a scan for the report's hundred accounts reads
all of it. Stored by (month, account) the footers tell which row groups, and the page index which pages, can hold
an account, and a Bloom filter answers for single ones. Rows are range-partitioned by (month, account, date), so a
month or account with a third of all rows is many files, none of them one task's. The month folders let a
late month be replaced alone (`months`), and a report's month bound prunes whole folders.

The reader adds the column ledger_month, which the rule aggregation recognises (operators.ledger)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areabook.functions.columns import as_months, month_key_of
from areabook.operators.ledger import month_ranges
from areabook.sources import schemas

MONTH = "ledger_month"
#: Bytes of a row group: small enough that a month has many, each of a few accounts.
ROW_GROUP = 16 << 20


def store_ledger(ledger: DataFrame, path: str, months: Sequence[int] | None = None, row_group: int = ROW_GROUP,
                 partitions: int | None = None) -> None:
    """Writes the ledger (or replaces the listed months of it). Rows without a date count in no report and are left out."""
    dated = ledger.filter(F.col("transaction_date").isNotNull() if months is None else month_ranges("transaction_date", months))
    rows = dated.select(*schemas.LEDGER.names, month_key_of("transaction_date").alias(MONTH))
    keys = [MONTH, "account_code", "transaction_date"]
    n = [partitions] if partitions else []
    (rows.repartitionByRange(*n, *keys).sortWithinPartitions(*keys)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH)
     .option("parquet.block.size", row_group).option("parquet.bloom.filter.enabled#account_code", "true")
     .option("parquet.bloom.filter.expected.ndv#account_code", "10000").parquet(path))


def read_ledger(spark: SparkSession, path: str, month=None) -> DataFrame:
    """The stored ledger; up to `month` (or the last of several) if one is given: later folders are not listed."""
    rows = spark.read.schema(T.StructType([*schemas.LEDGER.fields, T.StructField(MONTH, T.IntegerType())])).parquet(path)
    return rows if month is None else rows.filter(F.col(MONTH) <= as_months(month)[-1])
