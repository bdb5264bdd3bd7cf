"""DuckDB oracle for the two scorecards. A rank is 'rows ahead + 1', read off a ladder of distinct
values (one row a criterion and value, with its number of rows); a dense rank is the step on it."""

from __future__ import annotations

from areabook.oracle import summary_a_sql as A
from areabook.oracle import summary_b_sql as B
from areabook.plans import rules as R


def placed(rows: str, criterion: str, value: str, out: str, ascending: bool, dense: bool = False, where: str = "true") -> str:
    """Rows of a CTE that fit `where` with their place `out` among all of them of the same criterion."""
    order = f"order by {value} " + ("asc nulls last" if ascending else "desc nulls first")
    by = f"partition by {criterion} {order}"
    step = (f"row_number() over ({by})" if dense else
            f"1 + coalesce(sum(n) over ({by} rows between unbounded preceding and 1 preceding), 0)")
    return (f"select r.*, cast(l.place as bigint) as {out} from (select * from {rows} where {where}) r"
            f" join (select {criterion}, {value}, {step} as place from (select {criterion}, {value}, count(*) as n"
            f" from {rows} where {where} group by {criterion}, {value}) d) l"
            f" on r.{criterion} = l.{criterion} and r.{value} is not distinct from l.{value}")


def managers(month: int) -> str:
    return f"select distinct area_code, employee_id from px_kpi where month_report <= {month} and value is not null"


def averages(month: int, code: str) -> str:
    return (f"select area_code, employee_id, {code} as criteria_code, {B.mean('value')} as value from px_kpi"
            f" where month_report <= {month} and value is not null group by area_code, employee_id, {code}")


def ctes_a(month: int, rules: R.RuleSet) -> dict[str, str]:
    late = "max_bucket between 3 and 5"
    gone = f"write_off_month // 100 >= {month // 100}"
    fins = ", ".join(f"('{code}', {fin})" for code, fin in R.KPI_A_AREA_CRITERIA)
    is_npl = f"criteria_code = '{R.KPI_A_NPL_CODE}'"
    return A.ctes(month, rules) | {
        # months count only where the area has both bad debt and write-offs
        "book_months": (f"select area_code, sum(outstanding_principal) as whole,"
                        f" sum(outstanding_principal) filter (where {late}) as bad,"
                        f" sum(write_off_balance_principal) filter (where {gone}) as written_off from px_loan"
                        f" where kpi_month <= {month} group by area_code, kpi_month having bool_or({late}) and bool_or({gone})"),
        "npl_a": (f"select area_code, '{R.KPI_A_NPL_CODE}' as criteria_code, ({B.mean('bad')} + {B.mean('written_off')})"
                  f" / nullif({B.mean('whole')} + {B.mean('written_off')}, 0) as value from book_months group by area_code"),
        "managers": managers(month),
        "own_a": averages(month, "kpi_code"),
        "ka1": placed("own_a", "criteria_code", "value", "rank_kpi", ascending=False),
        "area_a": (f"select area_code, criteria_code, value from npl_a union all"
                   f" select area_code, criteria_code, cast(value as double) from summary_a"
                   f" join (values {fins}) f(criteria_code, fin_id) using (fin_id) where area_code <> '00'"),
        "shared_a": "select area_code, employee_id, criteria_code, value from area_a join managers using (area_code)",
        "ka": ("select * from ka1 union all "
               + placed("shared_a", "criteria_code", "value", "rank_kpi", True, True, is_npl) + " union all "
               + placed("shared_a", "criteria_code", "value", "rank_kpi", False, True, f"not ({is_npl})")),
        "typed": "select * from ka join px_dim_criteria using (criteria_code)",
        "type_scores": ("select employee_id, criteria_type_name, cast(sum(rank_kpi) as bigint) as type_score"
                        " from typed group by employee_id, criteria_type_name"),
        "scores": "select employee_id, 1 as everyone, cast(sum(rank_kpi) as bigint) as overall_score from typed group by employee_id",
        "type_places": placed("type_scores", "criteria_type_name", "type_score", "type_rank", False, True),
        "places": placed("scores", "everyone", "overall_score", "overall_rank", False, True),
        "kpi_a": (f"select cast({month} as integer) as month_key, area_code, employee_id, criteria_code, value, rank_kpi,"
                  f" criteria_type_name, type_score, overall_score, type_rank, overall_rank from typed"
                  f" join type_places using (employee_id, criteria_type_name) join places using (employee_id)"),
    }


def ctes_b(month: int) -> dict[str, str]:
    wanted = ", ".join(f"('{code}', {fin}, {str(absolute).lower()})" for code, fin, absolute, _, _ in R.KPI_B_AREA_CRITERIA)
    alike: dict[tuple[bool, bool], list[str]] = {}
    for code, _, _, method, ascending in R.KPI_B_AREA_CRITERIA:
        alike.setdefault((ascending, method == "dense_rank"), []).append(f"'{code}'")
    shared = [placed("shared_b", "criteria_code", "value", "rank_kpi", up, dense, f"criteria_code in ({', '.join(codes)})")
              for (up, dense), codes in alike.items()]
    groups = ", ".join(f"('{g}')" for g in R.KPI_B_GROUPS)
    return B.ctes(month) | {
        "managers": managers(month),
        "own_b": averages(month, "criteria_code"),
        "shared_b": (f"select area_code, employee_id, criteria_code, if(absolute, abs(cast(value as double)),"
                     f" cast(value as double)) as value from summary_b join (values {wanted}) f(criteria_code, fin_id, absolute)"
                     f" using (fin_id) join px_dim_criteria_xlsx using (criteria_code) join managers using (area_code)"
                     f" where area_code <> '00'"),
        "l1": " union all ".join([placed("own_b", "criteria_code", "value", "rank_kpi", False), *shared]),
        "group_sums": (f"select area_code, employee_id, g as criteria_code, cast(sum(rank_kpi) as double) as value"
                       f" from l1 join (values {groups}) x(g) on contains(criteria_code, g) group by area_code, employee_id, g"),
        "l2": placed("group_sums", "criteria_code", "value", "rank_kpi", True),
        "total_sums": (f"select area_code, employee_id, '{R.KPI_B_OVERALL}' as criteria_code, sum(value) as value from l2"
                       f" group by area_code, employee_id"),
        "ov": placed("total_sums", "criteria_code", "value", "rank_kpi", True),
        "kpi_b": "select * from l1 union all select * from l2 union all select * from ov",
    }


def query_a(month: int, select: str, rules: R.RuleSet) -> str:
    return A.with_ctes(ctes_a(month, rules), select)


def query_b(month: int, table: str) -> str:
    return A.with_ctes(ctes_b(month), f"select cast({month} as integer) as month_key, area_code, employee_id,"
                                      f" criteria_code, value, rank_kpi from {table}")
