"""Sinks of one table: idempotent month replacement (the monthly stores) and the run log. The report's published
tables, replaced together, are in mart.py."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areabook.plans.staging import Stager
from areabook.sources import files, schemas


def publish_month(df: DataFrame, path: str, partition_col: str = "month_key", months=None,
                  schema: T.StructType | None = None, full: Sequence[int] | None = None) -> None:
    """Replace the months of `df` under `path` (dynamic partition overwrite):
    re-running a month leaves one copy of it and every other month untouched.
    Months listed in `months` that have no rows are emptied, as a delete before
    the insert would; `df` is staged for that, so that it is evaluated once and the months
    found are those written. `full`: the listed months that have rows, where the caller has them from a stage that `df` derives from;
    then nothing is staged here. `schema`: the table's declared types.
    The rows are brought together by month before they are written, a large month in several parts: written as they come, every
    task has a file in every month, and both writing and reading the table cost by files, not by rows."""
    if schema is not None:
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    if months is not None and full is None:
        df = Stager(df.sparkSession, "publish").stage(df, "rows")
    (df.hint("rebalance", F.col(partition_col)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col)
     .parquet(path))
    if months is not None:
        listed = sorted({int(m) for m in months})
        if full is None:
            full = {r[0] for r in df.filter(F.col(partition_col).isin(listed)).select(partition_col).distinct().collect()}
        for m in listed:
            if m not in full:
                files.delete(df.sparkSession, f"{path}/{partition_col}={m}")


def append_run_log(spark: SparkSession, path: str, run_id: str, names: Sequence[str], start: _dt.datetime,
                   end: _dt.datetime | None = None, ok: bool | None = None, error: str | None = None,
                   found: Mapping[str, Mapping[str, int]] | None = None) -> None:
    """Appends one row a name, all in one file: with no `ok` that the run has started, else how it ended. `found`: a
    name's data-quality counts (columns of RUN_LOG)."""
    now = _dt.datetime.now(_dt.timezone.utc)
    rows = [(run_id, name, start, end, ok, error, now, *[(found or {}).get(name, {}).get(c) for c in ("zero_denominators", "duplicate_keys")])
            for name in names]
    spark.createDataFrame(rows, schemas.RUN_LOG).coalesce(1).write.mode("append").parquet(path)


#: error_log of a run that was started and never ended (still running, or its driver died).
UNFINISHED = "not finished"


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """One row a run and name, by RUN_LOG: how it ended, or that it has not."""
    r = F.max_by(F.struct(*[f.name for f in schemas.RUN_LOG.fields if f.name not in ("run_id", "procedure_name")]),
                 F.struct(F.col("is_successful").isNotNull(), "rec_created_dt")).alias("r")
    last = (spark.read.schema(schemas.RUN_LOG).parquet(path).groupBy("run_id", "procedure_name").agg(r)
            .select("run_id", "procedure_name", "r.*"))
    open_ = F.col("is_successful").isNull()
    return last.select(*[F.when(open_, UNFINISHED).otherwise(F.col("error_log")).alias("error_log") if f.name == "error_log"
                         else F.coalesce("is_successful", F.lit(False)).alias("is_successful") if f.name == "is_successful"
                         else F.col(f.name) for f in schemas.RUN_LOG.fields])


def compact_run_log(spark: SparkSession, path: str) -> None:
    """Rewrites the log's files as one: the last row of every run and name. Reading folds rows by run, so the old
    files and the new one may be there together."""
    old = [p for p, _ in files.matching(spark, f"{path}/*.parquet")]
    if len(old) < 2:
        return
    last = F.max_by(F.struct(*schemas.RUN_LOG.names), F.struct(F.col("is_successful").isNotNull(), "rec_created_dt")).alias("r")
    rows = spark.read.schema(schemas.RUN_LOG).parquet(*old).groupBy("run_id", "procedure_name").agg(last).select("r.*")
    rows.coalesce(1).write.mode("append").parquet(path)
    for p in old:
        files.delete(spark, p)
