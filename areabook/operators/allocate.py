"""Head-office pools by account rule, from the rule sums of the areas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areabook.functions.columns import scale_millions


def rule_pools(rule_sums: DataFrame) -> DataFrame:
    """(month_key, rule, pool, company): head-office pool (HEAD rows, pool
    list) and company total (all rows, direct list), scaled to millions. One
    row per rule and month."""
    agg = rule_sums.groupBy("month_key", "rule").agg(F.sum("head_sum").alias("_p"),
                                                    F.sum("direct_sum").alias("_c"))
    return agg.select("month_key", "rule", scale_millions("_p").alias("pool"),
                      scale_millions("_c").alias("company"))
