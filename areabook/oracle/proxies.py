"""The report's input tables as SQL views over the test tables (FIXTURES.md
§3). Used only by the DuckDB oracle; the Spark side builds the same tables
with the DataFrame API (areabook.sources.testdata)."""

TEST_ACCOUNT = "cast(80 + l_linenumber as bigint) * 10000000000 + l_partkey % 10"


def chart_account(accounts) -> str:
    """Every account of a chart in turn, by part number (list positions start at 1)."""
    listed = {a for r in accounts for a in r.direct + r.pool_accounts}
    codes = sorted(listed.union(int(r.prefix + "0" * (12 - len(r.prefix))) + 1 for r in accounts if r.prefix))
    return f"cast([{', '.join(str(c) for c in codes)}][l_partkey % {len(codes)} + 1] as bigint)"


_LEDGER = """
px_ledger AS (
  select l_shipdate as transaction_date,
    {account} as account_code,
    concat(case when c_nationkey = 0 then 'HEAD' else 'DVML' end, '.', lpad(cast(n_regionkey as varchar), 2, '0'), '.',
           lpad(cast(c_nationkey as varchar), 2, '0'), '.00.000') as analysis_code,
    cast(case when l_linenumber in (3,5,6,7) then -l_extendedprice else l_extendedprice end as decimal(18,2)) as amount
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
    join nation on c_nationkey = n_nationkey),"""

_FACTS = """
px_loan AS (
  select cast(year(o_orderdate) * 100 + month(o_orderdate) as int) as kpi_month,
    lpad(cast(c_nationkey as varchar), 2, '0') as area_code,
    cast(substring(o_orderpriority, 1, 1) as int) as max_bucket,
    cast(o_totalprice as decimal(18,2)) as outstanding_principal,
    case when o_orderstatus = 'F' then cast(year(o_orderdate) * 100 + month(o_orderdate) as int) end as write_off_month,
    cast(o_totalprice as decimal(18,2)) as write_off_balance_principal,
    cast(1 + o_orderkey % 3 as int) as psdn
  from orders join customer on o_custkey = c_custkey),
px_kpi AS (
  select cast(year(o_orderdate) * 100 + month(o_orderdate) as int) as month_report,
    lpad(cast(c_nationkey as varchar), 2, '0') as area_code,
    concat('E', cast(c_custkey as varchar)) as employee_id,
    concat('S0', cast(1 + o_orderkey % 3 as varchar)) as kpi_code,
    concat('SC0', cast(1 + o_orderkey % 3 as varchar)) as criteria_code,
    case when o_orderstatus <> 'P' then cast(o_totalprice as decimal(18,2)) end as value
  from orders join customer on o_custkey = c_custkey),
px_balance_txn AS (
  select cast(year(l_shipdate) * 100 + month(l_shipdate) as int) as month_key,
    lpad(cast(c_nationkey as varchar), 2, '0') as area_code,
    cast(l_partkey % 20 + 1 as int) as fin_id_lv3,
    case when c_nationkey = 0 then 'HEAD' else 'DVML' end as dvml_head,
    cast(case when l_partkey % 20 + 1 in (7,8,9,12,13,14,15,16,17,18,19,20)
         then -l_extendedprice else l_extendedprice end as decimal(18,2)) as amount
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey),
px_dim_criteria AS (
  select case when n_nationkey < 4 then 'S0' || (n_nationkey + 1) else 'F0' || (n_nationkey - 3) end as criteria_code,
    case when n_nationkey < 4 then 'Scale' else 'Finance' end as criteria_type_name from nation where n_nationkey < 7),
px_dim_criteria_xlsx AS (
  select case when r_regionkey = 0 then 'SC04' else 'FN0' || r_regionkey end as criteria_code from region where r_regionkey < 5)"""


def proxy_ctes(account: str = TEST_ACCOUNT) -> str:
    return _LEDGER.format(account=account) + _FACTS
