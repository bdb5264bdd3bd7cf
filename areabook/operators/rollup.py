"""The report's hierarchy, and totals over tall metric rows (fin_id, area_code, value, month_key)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areabook.functions.columns import stage_double


def closure(rollups: Sequence[tuple[int, Sequence[int]]]) -> list[tuple[int, int]]:
    """(ancestor, leaf) pairs of the report's own roll-up tree (a few fixed lines): a parent sums the leaves
    under it, so no level waits for another (exact for decimals). A cycle is an error."""
    children = {p: list(cs) for p, cs in rollups}

    def leaves(n, above=()):
        if n in above:
            raise ValueError(f"the roll-up tree has a cycle: {' -> '.join(map(str, (*above, n)))}")
        return [leaf for c in children[n] for leaf in leaves(c, (*above, n))] if n in children else [n]
    return sorted({(p, leaf) for p in children for leaf in leaves(p)})


def network_totals(rows: DataFrame, ratio_ids: Sequence[int]) -> DataFrame:
    """(month_key, fin_id, company, network_only) of every money line: the total of all areas, and the
    total without head office ('00'), which keeps its own amount beside what areas receive of the pool."""
    v = stage_double("value")
    total = lambda x: F.sum(x).cast("double")
    return (rows.filter(~F.col("fin_id").isin(*ratio_ids)).groupBy("month_key", "fin_id")
            .agg(total(v).alias("company"), total(F.when(F.col("area_code") != "00", v)).alias("network_only")))
