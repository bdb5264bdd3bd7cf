"""Scorecard ranking semantics."""

from areabook.operators.scorecard import rank_area_metrics, scores, spread_to_employees
from areabook.plans.staging import Stager


M = 199812


def _emp(spark, rows):
    return spark.createDataFrame([(M, a, e) for a, e in rows], "month_key int, area_code string, employee_id string")


def test_area_metric_ranks_count_managers_and_nulls_first(spark):
    area = spark.createDataFrame(
        [(M, a, c, v) for a, c, v in
         [("01", "F01", 5.0), ("02", "F01", 5.0), ("03", "F01", 1.0), ("04", "F01", None), ("05", "F01", 9.0),
          ("01", "S04", 0.2), ("02", "S04", None), ("03", "S04", 0.1)]],
        "month_key int, area_code string, criteria_code string, value double")
    emp = _emp(spark, [("01", "a"), ("01", "b"), ("02", "c"), ("03", "d"), ("04", "e")])   # 05: no managers
    st = Stager(spark, "t")
    ranked = rank_area_metrics(area, emp, {"S04": ("dense_rank", True)}, ("dense_rank", False))
    got = {(r.criteria_code, r.area_code): r.rank_kpi for r in ranked.collect()}
    # desc puts NULL first (PostgreSQL); area 05 has no manager and does not take a rank
    assert got[("F01", "04")] == 1 and got[("F01", "01")] == 2 and got[("F01", "02")] == 2
    assert got[("F01", "03")] == 3 and ("F01", "05") not in got
    # asc puts NULL last
    assert got[("S04", "03")] == 1 and got[("S04", "01")] == 2 and got[("S04", "02")] == 3
    # rank (with gaps) counts managers: two in area 01 tie at 1, area 02 comes 3rd
    ranked = rank_area_metrics(area.filter("criteria_code = 'S04'"), emp, {"S04": ("rank", True)},
                               ("dense_rank", False))
    got = {r.area_code: r.rank_kpi for r in ranked.collect()}
    assert got == {"03": 1, "01": 2, "02": 4}
    spread = spread_to_employees(ranked, emp).collect()
    assert sorted((r.employee_id, r.rank_kpi) for r in spread) == [("a", 2), ("b", 2), ("c", 4), ("d", 1)]


def test_scores_per_employee_across_areas(spark):
    rows = spark.createDataFrame(
        [("01", "E1", "S01", 1, "Scale"), ("02", "E1", "S01", 3, "Scale"), ("02", "E1", "F01", 2, "Finance"),
         ("01", "E2", "S01", 2, "Scale")],
        "area_code string, employee_id string, criteria_code string, rank_kpi long, criteria_type_name string")
    got = {(r.area_code, r.employee_id, r.criteria_code): (r.type_score, r.overall_score)
           for r in scores(rows, ["employee_id"], "criteria_type_name").collect()}
    # variant A partitions by employee only: E1's two areas add up (Q15)
    assert got[("01", "E1", "S01")] == (4, 6) and got[("02", "E1", "F01")] == (2, 6)
    got_b = {(r.area_code, r.employee_id): r.overall_score
             for r in scores(rows, ["area_code", "employee_id"], "criteria_type_name").collect()}
    assert got_b[("01", "E1")] == 1 and got_b[("02", "E1")] == 5
