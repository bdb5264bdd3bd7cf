"""Headcounts from bitmaps: the same as counting managers, with stable numbers and no manager rows read."""

import random

import pytest
from pyspark.sql import functions as F

from areabook.operators.kpi import employee_kpi, headcount_cumulative, headcount_in_month, headcount_monthly_avg
from areabook.plans import kpi_store as K
from areabook.plans.staging import Stager
from tests.helpers import kpi

MONTHS = [199810, 199811, 199812, 199901]


def facts(seed, n=600, managers=60):
    rng = random.Random(seed)
    return [(rng.choice(MONTHS), rng.choice(["01", "02", "03", None]), rng.choice([None, *[f"E{i}" for i in range(managers)]]),
             rng.choice(["S01", "S02"]), rng.choice([None, 1, 2.5])) for _ in range(n)]


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def check(spark, df, path, months):
    for stored, counted in ((K.headcount_cumulative_from_store, headcount_cumulative), (K.headcount_in_month_from_store, headcount_in_month),
                            (K.headcount_monthly_avg_from_store, headcount_monthly_avg)):
        assert rows(stored(spark, path, months)) == rows(counted(df, months)), stored.__name__
    assert rows(K.employee_kpi_from_store(spark, path, months, "kpi_code")) == rows(employee_kpi(df, months, "kpi_code"))


def test_headcounts_from_bitmaps(spark):
    data, path = facts(1), f"{Stager(spark, 'bits').root}/store"
    df = kpi(spark, data)
    K.refresh_kpi_store(df, MONTHS[:2], path)
    before = rows(K._managers(spark, path))
    K.refresh_kpi_store(df, MONTHS[1:], path)
    for months in (MONTHS[-1], MONTHS[1], MONTHS, [199811, 199902]):
        check(spark, df, path, months)
    after = rows(K._managers(spark, path))
    assert set(before) <= set(after) and len(after) == len({r[:2] for r in after})      # numbers are stable and given once
    for area in {r[0] for r in after}:
        assert sorted(r[2] for r in after if r[0] == area) == list(range(1, 1 + sum(r[0] == area for r in after)))
    # a month is replaced: late rows come in, others go
    late = [r for r in data if r[0] != 199811] + [(199811, "02", "LATE", "S01", 7), (199811, "09", "E1", "S01", None)]
    K.refresh_kpi_store(kpi(spark, late), [199811], path)
    check(spark, kpi(spark, late), path, MONTHS)


def test_more_managers_than_a_bucket_holds(spark):
    path = f"{Stager(spark, 'bucket').root}/store"
    df = spark.range(70_000).select(F.lit(199812).alias("month_report"), F.lit("01").alias("area_code"),
                                    F.concat(F.lit("E"), F.col("id").cast("string")).alias("employee_id"), F.lit("S01").alias("kpi_code"),
                                    F.lit("S01").alias("criteria_code"),
                                    F.when(F.col("id") % 2 == 0, F.lit(1)).cast("decimal(18,2)").alias("value"))
    K.refresh_kpi_store(df, [199812], path)
    assert K._bitmaps(spark, path, 199812).count() == 3
    assert [r.headcount for r in K.headcount_cumulative_from_store(spark, path, 199812).collect()] == [70_000]
    assert [r.headcount for r in K.headcount_in_month_from_store(spark, path, 199812).collect()] == [35_000]


@pytest.mark.parametrize("query", [K.headcount_cumulative_from_store, K.headcount_in_month_from_store, K.headcount_monthly_avg_from_store])
def test_headcounts_read_no_manager_rows(spark, query):
    path = f"{Stager(spark, 'reads').root}/store"
    K.refresh_kpi_store(kpi(spark, facts(3)), MONTHS, path)
    read = query(spark, path, 199812).inputFiles()
    assert read and all("/bitmaps/" in f for f in read)
