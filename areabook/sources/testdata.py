"""Adapter: the report's input tables derived from the TPC-H-like test tables
(definitions in FIXTURES.md §3). Everything is a lazy Spark plan over the
parquet files, so the work grows with the scale factor."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areabook.functions.columns import month_key_of
from areabook.plans import rules
from areabook.sources.inputs import Inputs, LazyInputs


# lineitem x orders is a fact-to-fact join: always a shuffle join on the order
# key, never a broadcast of either side (at small scale the planner's size
# estimate would otherwise broadcast lineitem from a single task). Sort-merge
# spills at any size; AQE turns it into a shuffled hash join when the shuffle
# partitions are small (spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold).
FACT_JOIN = "merge"


_SCANS: dict[tuple, DataFrame] = {}


def _read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _SCANS:   # one file listing / footer read per table and session
        _SCANS[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _SCANS[key].select(*cols)


def _customer_area(spark, sf_dir) -> DataFrame:
    cust = _read(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    # nation: a few hundred bytes on disk; the planner's file-size check broadcasts it
    nation = _read(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    return cust.join(nation, cust.c_nationkey == nation.n_nationkey)


def _area(col) -> F.Column:
    return F.lpad(F.col(col).cast("string"), 2, "0")


def proxy_account() -> F.Column:
    return (80 + F.col("l_linenumber")).cast("bigint") * 10_000_000_000 + F.col("l_partkey") % 10


def chart_account() -> F.Column:
    """Every account of the production chart in turn, by part number."""
    codes = rules.chart_codes(rules.CHART_ACCOUNTS)
    return F.get(F.array(*[F.lit(c) for c in codes]), (F.col("l_partkey") % len(codes)).cast("int")).cast("bigint")


def ledger(spark: SparkSession, sf_dir: str, account=proxy_account) -> DataFrame:
    """fact_txn_month_raw_data: lineitem x orders x customer x nation."""
    price = F.col("l_extendedprice")
    # what is made of a line alone is made before the join: fewer and more alike columns to shuffle
    li = _read(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_linenumber",
               "l_extendedprice", "l_shipdate").select(
        "l_orderkey", F.col("l_shipdate").alias("transaction_date"), account().alias("account_code"),
        F.when(F.col("l_linenumber").isin(3, 5, 6, 7), -price).otherwise(price)
        .cast("decimal(18,2)").alias("amount"))
    orders = _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    oc = orders.join(_customer_area(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
    j = li.join(oc.hint(FACT_JOIN), F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select(
        "transaction_date",
        "account_code",
        F.concat(F.when(F.col("c_nationkey") == 0, "HEAD").otherwise("DVML"), F.lit("."),
                 _area("n_regionkey"), F.lit("."), _area("c_nationkey"), F.lit(".00.000"))
        .alias("analysis_code"),
        "amount",
    )


def _orders_by_area(spark, sf_dir) -> DataFrame:
    orders = _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
                   "o_totalprice", "o_orderdate", "o_orderpriority")
    cust = _read(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    return orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))


def loan_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """th_fact_kpi_month_raw_data: orders x customer, every area."""
    j = _orders_by_area(spark, sf_dir)
    km = month_key_of("o_orderdate")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    return j.select(
        km.alias("kpi_month"),
        _area("c_nationkey").alias("area_code"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("max_bucket"),
        price.alias("outstanding_principal"),
        F.when(F.col("o_orderstatus") == "F", km).alias("write_off_month"),
        price.alias("write_off_balance_principal"),
        (1 + F.col("o_orderkey") % 3).cast("int").alias("psdn"),
    )


def kpi_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """th_kpi_asm_data: one KPI value per order; a third of the values NULL."""
    j = _orders_by_area(spark, sf_dir)
    code = (1 + F.col("o_orderkey") % 3).cast("string")
    return j.select(
        month_key_of("o_orderdate").alias("month_report"),
        _area("c_nationkey").alias("area_code"),
        F.concat(F.lit("E"), F.col("c_custkey").cast("string")).alias("employee_id"),
        F.concat(F.lit("S0"), code).alias("kpi_code"),
        F.concat(F.lit("SC0"), code).alias("criteria_code"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice").cast("decimal(18,2)")).alias("value"),
    )


def balance_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """balance_txn: ledger lines tagged with one of 20 report lines."""
    line = (F.col("l_partkey") % 20 + 1).cast("int")
    price = F.col("l_extendedprice")
    li = _read(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_extendedprice", "l_shipdate").select(
        "l_orderkey", month_key_of("l_shipdate").alias("month_key"), line.alias("fin_id_lv3"),
        F.when(line.isin(7, 8, 9, 12, 13, 14, 15, 16, 17, 18, 19, 20), -price).otherwise(price)
        .cast("decimal(18,2)").alias("amount"))
    orders = _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    cust = _read(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    oc = orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
    j = li.join(oc.hint(FACT_JOIN), F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select(
        "month_key",
        _area("c_nationkey").alias("area_code"),
        "fin_id_lv3",
        F.when(F.col("c_nationkey") == 0, "HEAD").otherwise("DVML").alias("dvml_head"),
        "amount",
    )


#: The table and column that date an input's rows.
_DATED = {"ledger": ("lineitem", "l_shipdate"), "balance_txn": ("lineitem", "l_shipdate"),
          "loan": ("orders", "o_orderdate"), "kpi": ("orders", "o_orderdate")}


def months(spark: SparkSession, sf_dir: str, name: str, last: int) -> list[int]:
    """The calendar months up to `last` of an input, read off its date column before any join. A month none of whose rows
    joins is listed too; a store refresh finds no rows for it and keeps none."""
    table, date = _DATED[name]
    dated = _read(spark, sf_dir, table, date).select(month_key_of(date).alias("m"))
    return sorted(r.m for r in dated.filter(F.col("m") <= last).distinct().collect())


def store_months(spark: SparkSession, sf_dir: str, last: int) -> dict[str, list[int]]:
    """The months of every dated input; inputs dated by one column share one read of it."""
    first = {dated: name for name, dated in _DATED.items()}
    with ThreadPoolExecutor(max_workers=len(first)) as pool:
        found = dict(zip(first, pool.map(lambda name: months(spark, sf_dir, name, last), first.values())))
    return {name: found[dated] for name, dated in _DATED.items()}


def dim_criteria(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The criteria dimension, read off the first seven nations: S01-S04 (Scale), F01-F03 (Finance)."""
    k = F.col("n_nationkey")
    scale = k < 4
    return _read(spark, sf_dir, "nation", "n_nationkey").filter(k < 7).select(
        F.when(scale, F.concat(F.lit("S0"), (k + 1).cast("string")))
        .otherwise(F.concat(F.lit("F0"), (k - 3).cast("string"))).alias("criteria_code"),
        F.when(scale, "Scale").otherwise("Finance").alias("criteria_type_name"))


def dim_criteria_xlsx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spreadsheet's criteria, read off the regions: SC04, FN01-FN04."""
    k = F.col("r_regionkey")
    return _read(spark, sf_dir, "region", "r_regionkey").filter(k < 5).select(
        F.when(k == 0, "SC04").otherwise(F.concat(F.lit("FN0"), k.cast("string"))).alias("criteria_code"))


def inputs(spark: SparkSession, sf_dir: str, account=proxy_account) -> Inputs:
    """The report's inputs over the test tables, each built on first use. `account`: account codes of
    the ledger (proxy_account, or chart_account for the production chart of accounts)."""
    return LazyInputs({
        "ledger": lambda: ledger(spark, sf_dir, account),
        "loan": lambda: loan_book(spark, sf_dir),
        "kpi": lambda: kpi_facts(spark, sf_dir),
        "balance_txn": lambda: balance_txn(spark, sf_dir),
        "dim_criteria": lambda: dim_criteria(spark, sf_dir),
        "dim_criteria_xlsx": lambda: dim_criteria_xlsx(spark, sf_dir),
    })
