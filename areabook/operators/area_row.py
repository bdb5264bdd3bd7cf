"""Report lines inside the row of their area.

After the scans a report is one row a (month, area) with the area's rule sums, loan-book averages and headcounts.
Every line, roll-up and ratio of an area is an expression over its row; only totals over a month's areas (driver
totals, head-office pools, total income) need other rows, and all of them are windows over one exchange by
month_key. So a report is one keyed plan after its scans, and what is written between is one table of areas.

A `Line` is a line's value and whether the area has it at all: a line that is missing and a line whose value is NULL are
different things in the roll-ups and in the result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areabook.functions.columns import STAGE_TYPE, exact_total, ratio, round_half_up, scale_millions, stage_double, to_stage
from areabook.plans.rules import AllocLine

HEAD_OFFICE = "00"
KEYS = ("month_key", "area_code")


def in_month():
    """Window over all areas of a month."""
    return Window.partitionBy("month_key")


@dataclass(frozen=True)
class Line:
    held: Column
    value: Column


def outer_join(frames: Sequence[DataFrame]) -> DataFrame:
    """One row a (month, area) of all the frames (each has at most one); a NULL area is an area."""
    def two(left: DataFrame, right: DataFrame) -> DataFrame:
        r = right.select(*[F.col(c).alias(f"_r_{c}") if c in KEYS else F.col(c) for c in right.columns])
        on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in KEYS]
        known = F.col("month_key").isNotNull()
        keys = [F.when(known, F.col(k)).otherwise(F.col(f"_r_{k}")).alias(k) for k in KEYS]
        return left.join(r, on, "full").select(*keys, *[c for c in (*left.columns, *right.columns) if c not in KEYS])
    return reduce(two, frames)


def shares(drivers: Mapping[str, tuple[str, bool]]) -> dict[str, Column]:
    """value / total of the month's areas for each driver -> (column, is it an average?)."""
    out = {}
    for name, (col, average) in drivers.items():
        total = exact_total(col, in_month()) if average else F.sum(F.col(col).cast("double")).over(in_month())
        out[name] = ratio(F.col(col), total)
    return out


def pool(column: str) -> Column:
    """Sum of a rule's amounts over the month's areas, scaled to millions."""
    return scale_millions(F.sum(column).over(in_month()))


def allocated(line: AllocLine, rule: int, share: Column) -> Line:
    """direct + share x head-office pool. Head office keeps its direct amount; a missing share or pool gives NULL; rounded
    to cents when the line says so (lines that pre-round round direct and pool instead)."""
    def cents(c):
        return round_half_up(c, 2).cast(STAGE_TYPE) if line.pre_round else c
    direct, head = cents(scale_millions(f"d{rule}")), F.col("area_code") == HEAD_OFFICE
    alloc = direct + share * cents(F.col(f"_pool{rule}"))
    value = (F.when(head, direct).otherwise(round_half_up(alloc, 2)).cast(STAGE_TYPE) if line.post_round
             else stage_double(F.when(head, direct.cast("double")).otherwise(alloc)))
    return Line(F.coalesce(F.col(f"n{rule}"), F.lit(0)) > 0, value)


def added(lines: Sequence[Line]) -> Line:
    """The sum of the lines that the area has, NULLs left out (NULL if all are)."""
    values = [F.when(x.held, x.value) for x in lines]
    held = reduce(lambda a, b: a | b, [x.held for x in lines], F.lit(False))
    some = reduce(lambda a, b: a | b, [v.isNotNull() for v in values], F.lit(False))
    # back to the stage type at every step: a wider sum would lose decimals
    total = reduce(lambda a, b: (a + b).cast(STAGE_TYPE), [F.coalesce(v, F.lit(0).cast(STAGE_TYPE)) for v in values], F.lit(0).cast(STAGE_TYPE))
    return Line(held, to_stage(F.when(some, total)))


class Book:
    """Lines of the area rows of `rows`, kept as columns v<fin> (value) and h<fin> (held)."""

    def __init__(self, rows: DataFrame):
        self.rows, self.fins = rows, []

    def put(self, lines: Mapping[int, Line]) -> None:
        self.rows = self.rows.select("*", *[c for fin, x in lines.items() for c in (
            F.coalesce(x.held, F.lit(False)).alias(f"h{fin}"), x.value.alias(f"v{fin}"))])
        self.fins += list(lines)

    def line(self, fin: int) -> Line:
        return Line(F.col(f"h{fin}"), F.col(f"v{fin}"))

    def some(self, fins: Sequence[int]) -> list[Line]:
        return [self.line(f) for f in fins if f in self.fins]

    def wide(self) -> DataFrame:
        """One row a (month, area) with v<fin> and h<fin> of every line. To be written before it is read line by line: the
        optimiser infers filters for the rows of a generator from all that lies below it, which for a chain of lines
        that refer to lines takes minutes."""
        return self.rows.select(*KEYS, *[F.col(f"{c}{f}") for f in self.fins for c in "hv"])

    def tall(self, wide: DataFrame) -> DataFrame:
        """(fin_id, area_code, value, month_key) of every line that an area has, values as DOUBLE."""
        packed = F.array(*[F.struct(F.lit(f).alias("fin_id"), F.col(f"h{f}").alias("held"),
                                    F.col(f"v{f}").cast("double").alias("value")) for f in self.fins])
        return (wide.select(*KEYS, F.inline(packed)).filter("held")
                .select("fin_id", "area_code", "value", "month_key"))


def percent_ratio(base: Sequence[Line], num: Sequence[Line], den: Sequence[Line]) -> Line:
    """num x 100 / den, 0 where den is 0, for areas with a line in `base`; sums of the listed lines, unrounded
    (scorecards rank it)."""
    n, d = added(num).value, added(den).value
    value = F.when(d == 0, F.lit(0.0)).otherwise(F.try_divide(n.cast("double") * 100, d.cast("double")))
    return Line(added(base).held, value)
