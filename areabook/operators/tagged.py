"""Tagged-ledger (balance_txn) aggregation for summary B: one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areabook.functions.columns import as_months
from areabook.operators.cumulate import running_sums

HEAD_FLAG = "HEAD"


def line_area_sums(balance_txn: DataFrame, month) -> DataFrame:
    """(month_key, fin_id_lv3, area_code, value, value_head, n_head) cumulative
    to `month`: the area's sum over all rows and over head-office rows, in one
    aggregate. For a list of report months the lines are summed per calendar
    month once, then on from month to month."""
    months = as_months(month)
    rows = balance_txn.filter(F.col("month_key") <= months[-1])
    if len(months) == 1:
        return rows.groupBy(F.lit(months[0]).alias("month_key"), "fin_id_lv3", "area_code").agg(*_aggs())
    return cumulate_line_sums(line_month_sums(rows), months)


def _aggs():
    head = F.col("dvml_head") == HEAD_FLAG
    return [F.sum("amount").alias("value"), F.sum(F.when(head, F.col("amount"))).alias("value_head"),
            F.count_if(head).alias("n_head")]


def line_month_sums(balance_txn: DataFrame) -> DataFrame:
    """(ym, fin_id_lv3, area_code, value, value_head, n_head) per calendar
    month: the partial sums a monthly store keeps."""
    return balance_txn.groupBy(F.col("month_key").alias("ym"), "fin_id_lv3", "area_code").agg(*_aggs())


def cumulate_line_sums(monthly: DataFrame, months) -> DataFrame:
    """Report-month line sums from monthly ones."""
    return running_sums(monthly, "ym", months, ["fin_id_lv3", "area_code"], ["value", "value_head", "n_head"])
