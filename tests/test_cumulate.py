"""Running sums of report months: results as from spreading every row, and shuffles in proportion to the months."""

import random

from pyspark.sql import functions as F

from areabook.functions.columns import report_months_from
from areabook.operators.cumulate import running_sums
from tests.plan_metrics import shuffled_rows

YEARS = [y * 100 + m for y in range(1994, 1999) for m in range(1, 13)]


def spread(monthly, months):
    return (monthly.select("k", "v", "n", F.explode(report_months_from("ym", months)).alias("month_key"))
            .groupBy("month_key", "k").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).select("month_key", "k", "v", "n"))


def rows_of(df):
    return sorted(map(tuple, df.select("month_key", "k", "v", "n").collect()), key=str)


def test_running_sums_equal_spreading_every_row(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, *YEARS]), rng.choice(["a", "b", None, *"cdefgh"]), rng.choice([None, rng.randrange(-9, 9)]), 1) for _ in range(400)]
    monthly = spark.createDataFrame(rows, "ym int, k string, v long, n long")
    for months in ([199806], [199406, 199612, 199812], YEARS, [199001], [199312, 200001]):
        assert rows_of(running_sums(monthly, "ym", months, ["k"], ["v", "n"])) == rows_of(spread(monthly, months))


def test_a_backfill_shuffles_rows_in_proportion_to_its_months(spark):
    keys = 50
    monthly = spark.range(keys * 60).select((F.col("id") % keys).cast("string").alias("k"), F.lit(1).cast("long").alias("v"),
                                            F.lit(1).cast("long").alias("n"), F.element_at(F.array(*[F.lit(m) for m in YEARS]),
                                                                                           (F.floor(F.col("id") / keys) + 1).cast("int")).alias("ym"))
    run = running_sums(monthly, "ym", YEARS, ["k"], ["v", "n"])
    assert max(shuffled_rows(run)) <= 60 * keys                          # spreading shuffles 30.5 x 60 x keys rows
    assert run.count() == 60 * keys and run.agg(F.max("v")).first()[0] == 60
