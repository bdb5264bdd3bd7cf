"""DuckDB oracle for summary A, written line by line from the report's own
formulas (one filtered ledger subquery per line and side, drivers as grouped
subqueries with `over ()` totals, levels as CTEs) rather than from the Spark
plan, so that the one-scan rewrite is really checked. Casts follow the numeric
policy in areabook.functions.columns."""

from __future__ import annotations

from areabook.plans import rules as R
from areabook.oracle.proxies import TEST_ACCOUNT, proxy_ctes

ST = "decimal(30,8)"
MIL = "cast(0.000001 as decimal(7,6))"


def upto(month: int, col: str = "transaction_date") -> str:
    return f"extract(year from {col})*100 + extract(month from {col}) <= {month}"


def acct_pred(rule: R.AccountRule, side: str) -> str:
    if rule.prefix is not None:
        return f"left(cast(account_code as varchar), {len(rule.prefix)}) = '{rule.prefix}'"
    accts = rule.direct if side == "direct" else rule.pool_accounts
    return "account_code in (" + ", ".join(str(a) for a in accts) + ")"


def millions(expr: str, pre_round: bool) -> str:
    v = f"cast(sum({expr}) * {MIL} as {ST})"
    return f"cast(round({v}, 2) as {ST})" if pre_round else v


def exact_total(expr: str, over: str = "over ()") -> str:
    """Total of doubles that no order of rows can change: whole parts and fractions in units of 2^-52, as integers."""
    whole, part = f"cast(floor({expr}) as hugeint)", f"cast(round(({expr} - floor({expr})) * 4503599627370496) as hugeint)"
    return f"(cast(sum({whole}) {over} as double) + cast(sum({part}) {over} as double) / 4503599627370496)"


def driver_ctes(month: int) -> dict[str, str]:
    def bal(pred):
        where = f"kpi_month <= {month}" + (f" and {pred}" if pred else "")
        return (f"select area_code, avg_dnck / nullif({exact_total('avg_dnck')}, 0) as share from ("
                f" select area_code, cast(sum(dnck) as double) / count(dnck) as avg_dnck from ("
                f"  select kpi_month, area_code, sum(outstanding_principal) as dnck from px_loan"
                f"  where {where} group by kpi_month, area_code) k group by area_code) t")
    return {
        "drv_bal_b1": bal("max_bucket = 1"),
        "drv_bal_b2": bal("max_bucket = 2"),
        "drv_bal_b2_5": bal("max_bucket in (2,3,4,5)"),
        "drv_bal_all": bal(""),
        "drv_cards": (f"select area_code, cast(sum(psdn) as double) / nullif(cast(sum(sum(psdn)) over () as double), 0)"
                      f" as share from px_loan where kpi_month <= {month} and outstanding_principal is not null"
                      f" group by area_code"),
        "drv_headcount": ("select area_code, month_key, cast(value as double) / nullif(cast(sum(value) over"
                          " (partition by fin_id, month_key) as double), 0) as share from a2"),
    }


def alloc_cte(line: R.AllocLine, rule: R.AccountRule, month: int) -> str:
    x = (f"select split_part(analysis_code, '.', 3) as area_code, {millions('amount', line.pre_round)} as value,"
         f" {month} as month_key from px_ledger where {acct_pred(rule, 'direct')} and {upto(month)}"
         f" group by split_part(analysis_code, '.', 3)")
    y = (f"select {millions('amount', line.pre_round)} as value_head, {month} as month_key from px_ledger"
         f" where {acct_pred(rule, 'pool')} and {upto(month)} and substring(analysis_code, 1, 4) = 'HEAD'")
    alloc = "cast(x.value as double) + b.share * cast(y.value_head as double)"
    if line.post_round:
        alloc = f"cast(round(cast({alloc} as decimal(38,10)), 2) as {ST})"
    else:
        alloc = f"cast({alloc} as double)"
    if line.driver == "headcount":
        join = "left join drv_headcount b on x.month_key = b.month_key and x.area_code = b.area_code"
    else:
        join = f"left join drv_{line.driver} b on x.area_code = b.area_code"
    return (f"select {line.fin_id} as fin_id, x.area_code,"
            f" cast(case when x.area_code = '00' then {'cast(x.value as double)' if not line.post_round else 'x.value'}"
            f" else {alloc} end as {ST}) as value, x.month_key"
            f" from ({x}) x join ({y}) y on x.month_key = y.month_key {join}")


def rollup_cte(parent: int, children, source: str, month: int) -> str:
    ids = ", ".join(str(c) for c in children)
    return (f"select {parent} as fin_id, area_code, cast(sum(value) as {ST}) as value, month_key from {source}"
            f" where fin_id in ({ids}) and month_key = {month} group by month_key, area_code")


def ctes(month: int, rules: R.RuleSet) -> dict[str, str]:
    c: dict[str, str] = {}
    c["a2"] = (f"select {R.HEADCOUNT_FIN_A} as fin_id, area_code, cast(count(distinct employee_id) as {ST}) as value,"
               f" {month} as month_key from px_kpi where month_report <= {month} group by area_code")
    c.update(driver_ctes(month))
    names = []
    for line in rules.alloc_lines:
        c[f"l{line.fin_id}"] = alloc_cte(line, rules.rule(line.rule), month)
        names.append(f"l{line.fin_id}")
    c["lines"] = " union all ".join(["select * from a2"] + [f"select * from {n}" for n in names])
    parents = dict(rules.rollups)
    c["a4"] = rollup_cte(4, parents[4], "lines", month)
    company = lambda key: (f"select {millions('amount', False)} as amount from px_ledger"  # noqa: E731
                           f" where {acct_pred(rules.rule(key), 'direct')} and {upto(month)}")
    c["funding_costs"] = " union all ".join(
        f"select {fin} as fin_id, amount from ({company(key)}) x" for fin, key in rules.funding_lines)
    # the head office's part is the whole company's
    c["income_part"] = (f"select area_code, cast(if(area_code = '00', everyone, value) as double)"
                        f" / nullif(cast(everyone + ({company(rules.funding_revenue)}) as double), 0) as part"
                        f" from (select area_code, value, (select sum(value) from a4) as everyone from a4) x")
    c["fund"] = (f"select fin_id, area_code, cast(cast(amount as double) * part as {ST}) as value,"
                 f" {month} as month_key from funding_costs, income_part")
    c["lvl2"] = "select * from lines union all select * from a4 union all select * from fund"
    for p in (5, 6, 8):
        c[f"a{p}"] = rollup_cte(p, parents[p], "lvl2", month)
    c["lvl3"] = "select * from lvl2 union all select * from a5 union all select * from a6 union all select * from a8"
    c["a7"] = rollup_cte(7, parents[7], "lvl3", month)
    c["lvl4"] = "select * from lvl3 union all select * from a7"
    c["a1"] = rollup_cte(1, parents[1], "lvl4", month)
    c["lvl5"] = "select * from lvl4 union all select * from a1"

    # one row an area; a ratio has a row where its leading metric has one
    held = {"profit": (1,), "income": (7,), "costs": (8,), "heads": (R.HEADCOUNT_FIN_A,), "gross": R.MARGIN_DEN_IDS_A}
    c["area_result"] = "select area_code, " + ", ".join(
        f"cast(sum(value) filter (where fin_id in ({', '.join(str(i) for i in f)})) as double) as {name},"
        f" bool_or(fin_id in ({', '.join(str(i) for i in f)})) as has_{name}" for name, f in held.items()
    ) + " from lvl5 group by area_code"
    wanted = ((R.CIR_FIN_A, "income", "costs", "income"), (R.MARGIN_FIN_A, "profit", "profit", "gross"),
              (R.CAPITAL_FIN_A, "profit", "profit", "gross"), (R.PER_HEAD_FIN_A, "heads", "profit", "heads"))
    c["ratios"] = " union all ".join(
        f"select {fin} as fin_id, area_code, if({den} = 0, 0, {num} * 100 / nullif({den}, 0)) as value,"
        f" {month} as month_key from area_result where has_{lead}" for fin, lead, num, den in wanted)
    c["summary_a"] = "select * from lvl5 union all select * from ratios"
    return c


def with_ctes(c: dict[str, str], select: str, account: str = TEST_ACCOUNT) -> str:
    body = ",\n".join(f"{k} AS ({v})" for k, v in c.items())
    return f"WITH {proxy_ctes(account)},\n{body}\n{select}"


def out(table: str) -> str:
    """Final projection of a tall metric table (value as DOUBLE)."""
    return f"select fin_id, area_code, cast(value as double) as value, cast(month_key as integer) as month_key from {table}"


def query(month: int, select: str, rules: R.RuleSet, account: str = TEST_ACCOUNT) -> str:
    return with_ctes(ctes(month, rules), select, account)
