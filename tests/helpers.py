"""Hand-made input tables for edge-case tests."""

import datetime as dt
from decimal import Decimal

from areabook.sources import schemas
from areabook.sources.inputs import Inputs


def D(x):
    return None if x is None else Decimal(str(x))


def ledger(spark, rows):
    """rows: (yyyy-mm-dd, account_code, analysis_code, amount)"""
    return spark.createDataFrame(
        [(dt.datetime.fromisoformat(d), a, c, D(v)) for d, a, c, v in rows], schemas.LEDGER)


def loan(spark, rows):
    """rows: (kpi_month, area, bucket, outstanding, write_off_month, wo_balance, psdn)"""
    return spark.createDataFrame([(m, a, b, D(o), w, D(wb), p) for m, a, b, o, w, wb, p in rows],
                                 schemas.LOAN_BOOK)


def kpi(spark, rows):
    """rows: (month_report, area, employee, code, value) -> both code columns"""
    return spark.createDataFrame([(m, a, e, c, c, D(v)) for m, a, e, c, v in rows], schemas.KPI_FACTS)


def balance(spark, rows):
    """rows: (month_key, area, fin_id_lv3, dvml_head, amount)"""
    return spark.createDataFrame([(m, a, f, h, D(v)) for m, a, f, h, v in rows], schemas.BALANCE_TXN)


def code(area, head=False):
    return f"{'HEAD' if head else 'DVML'}.01.{area}.00.000"


def inputs(spark, ledger_rows=(), loan_rows=(), kpi_rows=(), balance_rows=()):
    dim = [("S01", "Scale"), ("S02", "Scale"), ("S03", "Scale"), ("S04", "Scale"),
           ("F01", "Finance"), ("F02", "Finance"), ("F03", "Finance")]
    xlsx = [("SC04",), ("FN01",), ("FN02",), ("FN03",), ("FN04",)]
    return Inputs(ledger=ledger(spark, ledger_rows), loan=loan(spark, loan_rows), kpi=kpi(spark, kpi_rows),
                  balance_txn=balance(spark, balance_rows), dim_criteria=spark.createDataFrame(dim, schemas.DIM_CRITERIA),
                  dim_criteria_xlsx=spark.createDataFrame(xlsx, schemas.DIM_CRITERIA_XLSX))
