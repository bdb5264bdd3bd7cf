"""Distributed rank/dense_rank against Spark's window functions."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from areabook.operators.rank import rank_by


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        p = rnd.choice(["a", "b", "c"]) if i % 5 else "a"   # "a" is a hot partition
        v = None if rnd.random() < 0.05 else float(rnd.randint(0, 40))  # many ties
        rows.append((i, p, v))
    return spark.createDataFrame(rows, "id long, p string, v double")


def _window(df, desc, dense, part):
    o = F.col("v").desc_nulls_first() if desc else F.col("v").asc_nulls_last()
    w = (Window.partitionBy("p") if part else Window.partitionBy()).orderBy(o)
    fn = F.dense_rank() if dense else F.rank()
    return {r.id: r.r for r in df.select("id", fn.over(w).alias("r")).collect()}


@pytest.mark.parametrize("desc", [False, True])
@pytest.mark.parametrize("dense", [False, True])
@pytest.mark.parametrize("part", [False, True])
def test_rank_matches_window(spark, data, desc, dense, part):
    got = rank_by(data, "v", ["p"] if part else [], descending=desc, dense=dense, out="r", partitions=5)
    assert got.count() == data.count()
    assert {r.id: r.r for r in got.select("id", "r").collect()} == _window(data, desc, dense, part)


def test_weighted_rank(spark):
    # three areas standing for 2, 3 and 1 employees; ties share the rank
    df = spark.createDataFrame([("x", 1.0, 2), ("y", 1.0, 3), ("z", 5.0, 1)], "a string, v double, n long")
    got = {r.a: r.rk for r in rank_by(df, "v", weight_col="n", out="rk").collect()}
    assert got == {"x": 1, "y": 1, "z": 6}


@pytest.mark.parametrize("desc", [False, True])
@pytest.mark.parametrize("dense", [False, True])
def test_bounded_path_matches(spark, data, desc, dense):
    got = rank_by(data, "v", ["p"], descending=desc, dense=dense, out="r", bounded=True)
    assert {r.id: r.r for r in got.select("id", "r").collect()} == _window(data, desc, dense, True)


def test_weighted_rank_bounded(spark):
    df = spark.createDataFrame([("x", 1.0, 2), ("y", 1.0, 3), ("z", 5.0, 1)], "a string, v double, n long")
    got = {r.a: r.rk for r in rank_by(df, "v", weight_col="n", out="rk", bounded=True).collect()}
    assert got == {"x": 1, "y": 1, "z": 6}
