"""Cumulative report months from monthly partial sums.

A report month counts every calendar month up to it. Spreading each monthly row to all later report months makes
N^2/2 rows of N months; here a monthly row goes only to the first report month that counts it, running sums go on from
there, and a key's row is repeated only for the report months in which nothing new came. What is shuffled
is at most one row a key and month; what comes out is the report itself."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areabook.functions.columns import as_months, report_months_from


def running_sums(monthly: DataFrame, ym: str, months, keys: Sequence[str], sums: Sequence[str],
                 total: Callable[[str], Column] = F.sum) -> DataFrame:
    """(month_key, keys..., sums...): for each report month and each key seen by then, the sums of all its rows up to that
    month (NULL where all are NULL). Rows without a month count in none. `total`: another aggregate whose
    results aggregate on (maxima, unions of bitmaps)."""
    months = as_months(months)
    first = F.get(report_months_from(ym, months), F.lit(0)).alias("month_key")
    at = (monthly.filter(F.col(ym) <= months[-1]).groupBy(first, *keys)
          .agg(*[total(c).alias(c) for c in sums]))
    if len(months) == 1:
        return at
    order = Window.partitionBy(*keys).orderBy("month_key")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = at.select("month_key", *keys, *[total(c).over(upto).alias(c) for c in sums],
                    F.lead("month_key").over(order).alias("_next"))
    held = F.filter(F.array(*[F.lit(m) for m in months]),
                    lambda m: (m >= F.col("month_key")) & (F.col("_next").isNull() | (m < F.col("_next"))))
    return run.select(F.explode(held).alias("month_key"), *keys, *sums)
