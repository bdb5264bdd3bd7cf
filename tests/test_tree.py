"""A report tree as a table: closure, roll-up, cycles, 10^5 nodes."""

import random

import pytest

from areabook.operators import rollup as fixed
from areabook.operators import tree
from areabook.plans import rules as R


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "parent int, child int")


def pairs(df):
    return sorted((r.ancestor, r.leaf) for r in df.collect())


def test_closure_of_the_report_tree(spark):
    e = [(p, c) for p, cs in R.ROLLUPS_A for c in cs]
    assert pairs(tree.closure(edges(spark, e + e[:3] + [(None, 4), (4, None)]))) == fixed.closure(R.ROLLUPS_A)


def test_a_cycle_is_an_error(spark):
    for loop in ([(1, 1)], [(1, 2), (2, 3), (3, 1)], [(0, 1), *[(i, i + 1) for i in range(1, 9)], (9, 4)]):
        with pytest.raises(tree.TreeCycle):
            tree.closure(edges(spark, loop))
    with pytest.raises(ValueError, match="cycle"):
        fixed.closure(((1, (2,)), (2, (1,))))
    assert tree.closure(edges(spark, [])).count() == 0


def test_shared_children_count_once_and_nulls_are_left_out(spark):
    p = tree.closure(edges(spark, [(1, 2), (1, 3), (2, 4), (3, 4), (3, 5)]))
    assert pairs(p) == [(1, 4), (1, 5), (2, 4), (3, 4), (3, 5)]
    rows = spark.createDataFrame([(4, "01", 1.5, 199812), (5, "01", None, 199812), (4, "02", 2.0, 199812), (5, None, None, 199812), (9, "01", 7.0, 199812)],
                                 "fin_id int, area_code string, value double, month_key int")
    got = {(r.fin_id, r.area_code): r.value for r in tree.rollup(rows, p).collect()}
    assert got == {(1, "01"): 1.5, (2, "01"): 1.5, (3, "01"): 1.5, (1, "02"): 2.0, (2, "02"): 2.0, (3, "02"): 2.0, (1, None): None, (3, None): None}


def test_a_tree_of_a_hundred_thousand_nodes(spark):
    rng, n = random.Random(6), 100_000
    parent = [None] + [rng.randrange(i) for i in range(1, n)]
    p = tree.closure(edges(spark, [(parent[i], i) for i in range(1, n)]))
    inner, want = set(parent[1:]), 0
    depth = [0] * n
    for i in range(1, n):
        depth[i] = depth[parent[i]] + 1
        want += depth[i] if i not in inner else 0
    assert p.count() == want and p.filter("ancestor = 0").count() == n - len(inner)
