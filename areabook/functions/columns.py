"""Column helpers. Everything here returns a built-in Spark Column expression
(JVM side, inside whole-stage codegen); no Python runs per row.

Numeric policy (chosen so results are exact where the source is exact and
reproducible where it is not):
* money is summed as DECIMAL; the ledger scale 1/1,000,000 is an exact decimal
  multiplication, giving DECIMAL(30,8);
* averages are cast(sum as double) / count of non-null values;
* a share divides by a total of doubles that is added up exactly in two integer limbs, so the
  order in which partitions add up cannot change it; shares and ratios are not rounded;
* a metric value is kept as DECIMAL(30,8) between stages (roll-ups are exact
  and order free) and leaves the engine as DOUBLE;
* rounding to cents goes through DECIMAL(38,10) first so ties round half away
  from zero on the decimal value, never on a binary fraction.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

STAGE_TYPE = "decimal(30,8)"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def area_of(analysis_code="analysis_code") -> Column:
    """Third dotted part of the analysis code ('' when missing, NULL on NULL)."""
    return F.split_part(_c(analysis_code), F.lit("."), F.lit(3))


def is_head(analysis_code="analysis_code") -> Column:
    """Head-office pool rows: the code starts with HEAD (pushes as StringStartsWith)."""
    return _c(analysis_code).startswith("HEAD")


def month_key_of(ts) -> Column:
    """yyyymm of a date or timestamp, as INT."""
    return (F.year(_c(ts)) * 100 + F.month(_c(ts))).cast("int")


def month_end_exclusive(month: int) -> Column:
    """First instant after month `month` (yyyymm), so that
    ``year(d)*100 + month(d) <= month``  <=>  ``d < month_end_exclusive(month)``.
    Written as a literal so the comparison reaches the Parquet scan."""
    y, m = divmod(int(month), 100)
    if m <= 0:
        bound = _dt.date(y, 1, 1)
    elif m >= 12:
        bound = _dt.date(y + 1, 1, 1)
    else:
        bound = _dt.date(y, m + 1, 1)
    return F.lit(bound.isoformat()).cast("timestamp_ntz")


def as_months(month) -> list[int]:
    """A report month or a list of them, as a sorted list of yyyymm ints."""
    if isinstance(month, int):
        return [month]
    return sorted({int(m) for m in month})


def report_months_from(ym, months) -> Column:
    """The report months (of `months`) that a row of month `ym` counts in:
    every report month at or after it (the report is cumulative). Explode it
    to spread monthly partial aggregates to their report months."""
    return F.filter(F.array(*[F.lit(int(m)) for m in as_months(months)]), lambda m: m >= _c(ym))


_LONG_MAX = 2**63 - 1


def digits_prefix(col, prefix: str) -> Column:
    """``left(cast(col as text), len(prefix)) = prefix`` for an integer column,
    as an OR of numeric ranges (exact, pushable, no string per row)."""
    c = _c(col)
    if not prefix.isdigit() or (prefix.startswith("0") and prefix != "0"):
        return F.left(c.cast("string"), F.lit(len(prefix))) == F.lit(prefix)
    if prefix == "0":
        return c == 0
    p = int(prefix)
    ranges = []
    for j in range(0, 20 - len(prefix)):
        lo = p * 10**j
        if lo > _LONG_MAX:
            break
        hi = min((p + 1) * 10**j, _LONG_MAX)
        ranges.append((c >= F.lit(lo)) & (c < F.lit(hi)) if hi < _LONG_MAX
                      else (c >= F.lit(lo)))
    out = ranges[0]
    for r in ranges[1:]:
        out = out | r
    return out


def scale_millions(sum_col) -> Column:
    """sum(amount)/1,000,000 as an exact DECIMAL(30,8). The sum is narrowed to
    DECIMAL(30,2) first so the product keeps all 8 decimals (a wider
    operand would make Spark drop scale digits)."""
    return (_c(sum_col).cast("decimal(30,2)") * F.lit(Decimal("0.000001"))).cast(STAGE_TYPE)


def to_stage(col) -> Column:
    """Metric value as stored between stages."""
    return _c(col).cast(STAGE_TYPE)


def stage_double(col) -> Column:
    """A DOUBLE result as a stage value: x * 10^8 rounded half away from zero,
    then scaled back as an exact decimal. Rounding the binary value this way
    (not its shortest decimal string, which a plain cast uses) gives the same
    8th decimal as other engines' double-to-decimal casts."""
    p = _c(col).cast("double") * F.lit(1e8)
    return (F.round(p, 0).cast("decimal(28,0)") * F.lit(Decimal("0.00000001"))).cast(STAGE_TYPE)


def round_half_up(col, digits: int) -> Column:
    """round(x, digits) half away from zero on the decimal value of x."""
    return F.round(_c(col).cast("decimal(38,10)"), digits)


def avg_of(col) -> Column:
    """Aggregate: average of the non-null values of a DECIMAL/integer column,
    cast(sum as double) / count (NULL when there is none)."""
    return F.sum(_c(col)).cast("double") / F.count(_c(col))


def ratio(num, den) -> Column:
    """num / den in DOUBLE; NULL when den is 0 or NULL."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


#: Weight of the last bit of the lower limb of an exact total.
_LIMB = 2**52


def exact_total(col, over=None) -> Column:
    """Aggregate (or window function over `over`): sum of the non-null doubles that no order of rows can change.
    Each value is split into its whole part and its fraction in units of 2^-52, both integers whose sums are exact; only
    the two totals are doubles again."""
    x = _c(col).cast("double")
    whole = F.floor(x)
    part = F.round((x - whole.cast("double")) * F.lit(float(_LIMB))).cast("long")
    sums = [F.sum(c.cast("decimal(38,0)")) for c in (whole, part)]
    if over is not None:
        sums = [s.over(over) for s in sums]
    return sums[0].cast("double") + sums[1].cast("double") / F.lit(float(_LIMB))


def yyyymm_year_text(col) -> Column:
    """``left(cast(col as varchar), 4)`` of a yyyymm integer."""
    return F.left(_c(col).cast("string"), F.lit(4))
