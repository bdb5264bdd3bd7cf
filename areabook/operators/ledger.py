"""Ledger aggregation by account rule: ONE scan of the ledger for all lines.

Instead of one filtered scan per line and side (30 in the source report), the
ledger is filtered once on the cumulative month bound (pushed to the scan) and
on "matches any rule", each row goes to the rules it matches (most accounts are in
one or two), and a single hash aggregate per (area, rule) computes the direct sum,
the number of matching rows and the head-office sum: three running sums a row and rule, not
three for every rule of the chart. Partial aggregation happens before the shuffle, so the shuffle carries at
most (#map tasks x #areas x #rules) narrow rows whatever the ledger size or key skew. The
result is one row per area with a column triple a rule, or unpivoted to one row per (rule, area)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areabook.functions.columns import (area_of, as_months, digits_prefix, is_head, month_end_exclusive,
                                        month_key_of)
from areabook.operators.cumulate import running_sums
from areabook.plans.rules import AccountRule



def _prefix_col(n: int) -> str:
    return f"_pfx{n}"


def _accounts_predicate(col: Column, accounts: Sequence[int], prefix: str | None,
                        prefix_cols: bool) -> Column:
    if prefix is not None:
        # inside the aggregate the leading digits are a column computed once
        # per row (see _matching_rows); elsewhere an exact numeric-range test
        return F.col(_prefix_col(len(prefix))) == prefix if prefix_cols else digits_prefix(col, prefix)
    if not accounts:
        return F.lit(False)
    return col.isin(*accounts)


def direct_predicate(rule: AccountRule, col: Column | None = None, prefix_cols: bool = False) -> Column:
    return _accounts_predicate(col if col is not None else F.col("account_code"), rule.direct, rule.prefix,
                               prefix_cols)


def pool_predicate(rule: AccountRule, col: Column | None = None, prefix_cols: bool = False) -> Column:
    return _accounts_predicate(col if col is not None else F.col("account_code"), rule.pool_accounts,
                               rule.prefix, prefix_cols)


def account_ranges(accounts: Sequence[AccountRule], most: int = 24) -> list[tuple[int, int]]:
    """At most `most` ranges (both ends included) that hold every account of the rules: listed accounts, and for a prefix every
    account number that begins with it, the nearest ones merged."""
    spans = {(a, a) for r in accounts for a in (*r.direct, *r.pool_accounts)}
    for r in accounts:
        if r.prefix is not None:
            spans |= {(int(r.prefix) * 10**j, (int(r.prefix) + 1) * 10**j - 1) for j in range(19 - len(r.prefix))}
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    while len(out) > most:
        i = min(range(1, len(out)), key=lambda k: out[k][0] - out[k - 1][1])
        out[i - 1:i + 1] = [[out[i - 1][0], out[i][1]]]
    return [(lo, hi) for lo, hi in out]


def in_account_ranges(col: Column, accounts: Sequence[AccountRule]) -> Column:
    """The account lies in one of the rules' ranges: a few comparisons that reach the Parquet scan, where they skip the row groups and
    pages of a ledger stored by account (plans.ledger_layout). A superset of the rules."""
    pred = F.lit(False)
    for lo, hi in account_ranges(accounts):
        pred = pred | (col == lo if lo == hi else (col >= lo) & (col <= hi))
    return pred


def any_rule_predicate(accounts: Sequence[AccountRule], acct: Column) -> Column:
    """"Row matches some rule": one IN list over every listed account plus one
    IN over the leading digits of the prefix rules. It only has to be a
    superset of the rule predicates (the aggregates apply the exact ones), so
    it is kept cheap per row rather than pushable: one range a prefix and length made the filter too large for whole-stage
    codegen and the scan twice as slow. Kept to two
    terms: an OR of per-rule predicates makes constraint inference blow up. For a ledger that is stored by
    account, in_account_ranges is pushed down beside it."""
    listed = sorted({a for r in accounts for a in (*r.direct, *r.pool_accounts)})
    pred = acct.isin(*listed) if listed else F.lit(False)
    by_len: dict[int, set[str]] = {}
    for r in accounts:
        if r.prefix is not None:
            by_len.setdefault(len(r.prefix), set()).add(r.prefix)
    for n, prefixes in sorted(by_len.items()):
        pred = pred | F.left(acct.cast("string"), F.lit(n)).isin(*sorted(prefixes))
    return pred


def _rule_sums(rows: DataFrame, accounts: Sequence[AccountRule], key: Column) -> DataFrame:
    """One row (key, area_code) with the column triples d<i>, n<i>, p<i> of every rule."""
    acct, head, at = F.col("account_code"), F.col("_head"), F.col("_at")
    places = []                                  # 4 x rule + 2 (counts in the pool) + 1 (counts directly)
    for i, r in enumerate(accounts):
        d, p = direct_predicate(r, acct, True), pool_predicate(r, acct, True)
        places.append(F.when(d | p, F.lit(4 * i) + F.when(d, 1).otherwise(0) + F.when(head & p, 2).otherwise(0)))
    hits = rows.select(key, "area_code", "amount", F.explode(F.array(*places)).alias("_at")).filter(at.isNotNull())
    direct, pooled = at.bitwiseAND(F.lit(1)) == 1, at.bitwiseAND(F.lit(2)) == 2
    name = rows.select(key).columns[0]
    tall = hits.groupBy(name, "area_code", F.shiftright(at, 2).alias("_rule")).agg(
        F.sum(F.when(direct, F.col("amount"))).alias("d"), F.count_if(direct).alias("n"),
        F.sum(F.when(pooled, F.col("amount"))).alias("p"))

    def of(i: int, c: str) -> Column:
        return F.max(F.when(F.col("_rule") == i, F.col(c)))
    return tall.groupBy(name, "area_code").agg(*[
        (F.coalesce(of(i, c), F.lit(0).cast("long")) if c == "n" else of(i, c)).alias(f"{c}{i}")
        for i in range(len(accounts)) for c in "dnp"])


def unpivot_rules(wide: DataFrame, accounts: Sequence[AccountRule], key: str = "month_key") -> DataFrame:
    """(key, rule, area_code, direct_sum, n_rows, head_sum) of rows with a column triple a rule."""
    packed = F.array(*[F.struct(F.lit(r.key).alias("rule"), F.col(f"d{i}").alias("direct_sum"),
                                F.col(f"n{i}").alias("n_rows"), F.col(f"p{i}").alias("head_sum"))
                       for i, r in enumerate(accounts)])
    return wide.select(key, "area_code", F.inline(packed)).select(
        key, "rule", "area_code", "direct_sum", "n_rows", "head_sum")


def pivot_rules(tall: DataFrame, accounts: Sequence[AccountRule]) -> DataFrame:
    """The column triples again, one row (month_key, area_code); each rule has at most one row there."""
    return tall.groupBy("month_key", "area_code").agg(*[
        F.max(F.when(F.col("rule") == r.key, F.col(c))).alias(f"{p}{i}")
        for i, r in enumerate(accounts) for p, c in (("d", "direct_sum"), ("n", "n_rows"), ("p", "head_sum"))])


def _matching_rows(ledger: DataFrame, accounts: Sequence[AccountRule], date_filter) -> DataFrame:
    acct = F.col("account_code")
    if "ledger_month" in ledger.columns:         # stored by month and account: skip what no rule counts
        ledger = ledger.filter(in_account_ranges(acct, accounts))
    lengths = sorted({len(r.prefix) for r in accounts if r.prefix is not None})
    return (ledger.filter(date_filter)
            .filter(any_rule_predicate(accounts, acct))
            .select(area_of("analysis_code").alias("area_code"),
                    is_head("analysis_code").alias("_head"),
                    month_key_of("transaction_date").alias("_ym"),
                    *[F.left(acct.cast("string"), F.lit(n)).alias(_prefix_col(n)) for n in lengths],
                    acct, F.col("amount")))


def ledger_area_sums(ledger: DataFrame, month, accounts: Sequence[AccountRule]) -> DataFrame:
    """One row (month_key, area_code) with a column triple d<i>, n<i>, p<i> a rule, for ledger dates up to
    report month `month` (or each of a list of months: the ledger is still read once, aggregated per calendar
    month, and summed on from month to month).

    d: sum(amount) of the area's rows matching the rule's direct list (NULL if the matches carry no amount); n: number of
    such rows (an area appears for a rule only when n > 0, as a grouped sum would); p: sum(amount) of
    head-office rows of the area matching the pool list. Amounts are unscaled DECIMAL sums."""
    months = as_months(month)
    rows = _matching_rows(ledger, accounts, F.col("transaction_date") < month_end_exclusive(months[-1]))
    if len(months) == 1:
        return _rule_sums(rows, accounts, F.lit(months[0]).alias("month_key"))
    monthly = _rule_sums(rows, accounts, F.col("_ym"))
    return running_sums(monthly, "_ym", months, ["area_code"], [f"{p}{i}" for i in range(len(accounts)) for p in "dnp"])


def ledger_rule_sums(ledger: DataFrame, month, accounts: Sequence[AccountRule]) -> DataFrame:
    """(month_key, rule, area_code, direct_sum, n_rows, head_sum): the same, one row a rule."""
    return unpivot_rules(ledger_area_sums(ledger, month, accounts), accounts)


def month_ranges(col: str, months: Sequence[int]) -> Column:
    """Rows of the listed calendar months, as date ranges (pushable). Adjacent months are one range, so
    a store build over years of history stays one small generated method."""
    def before(m):
        return m - 1 if m % 100 > 1 else (m // 100 - 1) * 100 + 12
    spans: list[list[int]] = []                          # [month before the first, last month]
    for m in as_months(months):
        if spans and spans[-1][1] == before(m):
            spans[-1][1] = m
        else:
            spans.append([before(m), m])
    pred = F.lit(False)
    for first, last in spans:
        pred = pred | ((F.col(col) >= month_end_exclusive(first)) & (F.col(col) < month_end_exclusive(last)))
    return pred


def ledger_monthly_sums(ledger: DataFrame, months: Sequence[int], accounts: Sequence[AccountRule]) -> DataFrame:
    """(ym, rule, area_code, direct_sum, n_rows, head_sum) of the listed
    calendar months only: the partial aggregates a monthly store keeps, so a
    report never re-reads the ledger history."""
    rows = _matching_rows(ledger, accounts, month_ranges("transaction_date", months))
    return unpivot_rules(_rule_sums(rows, accounts, F.col("_ym")), accounts, "_ym").withColumnRenamed("_ym", "ym")


def cumulate_rule_sums(monthly: DataFrame, months) -> DataFrame:
    """Report-month rule sums from monthly ones, as the monthly store keeps them."""
    return (running_sums(monthly, "ym", months, ["rule", "area_code"], ["direct_sum", "n_rows", "head_sum"])
            .select("month_key", "rule", "area_code", "direct_sum", "n_rows", "head_sum"))
