"""The input tables of one reporting run, as lazy DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from areabook.sources import schemas


@dataclass
class Inputs:
    ledger: DataFrame | None = None          # fact_txn_month_raw_data
    loan: DataFrame | None = None            # th_fact_kpi_month_raw_data
    kpi: DataFrame | None = None             # th_kpi_asm_data
    balance_txn: DataFrame | None = None     # ledger lines tagged with report line
    dim_criteria: DataFrame | None = None
    dim_criteria_xlsx: DataFrame | None = None


class LazyInputs:
    """Inputs built on first use (a job only pays for the tables it reads)."""

    FIELDS = ("ledger", "loan", "kpi", "balance_txn", "dim_criteria", "dim_criteria_xlsx")

    def __init__(self, factories):
        self.__dict__["_factories"] = factories
        self.__dict__["_values"] = {}

    def __getattr__(self, name):
        if name in LazyInputs.FIELDS:
            values = self.__dict__["_values"]
            if name not in values:
                values[name] = self.__dict__["_factories"][name]()
            return values[name]
        raise AttributeError(name)

    def __setattr__(self, name, value):
        if name not in LazyInputs.FIELDS:
            raise AttributeError(name)
        self.__dict__["_values"][name] = value


def read_tables(spark: SparkSession, base: str, fmt: str = "parquet") -> Inputs:
    """Stored tables under `base/<table>` with the declared schemas. The loan
    book and KPI facts are expected to be partitioned by month, so the
    `<= month` filters prune partitions."""
    def rd(name, schema):
        return spark.read.schema(schema).format(fmt).load(f"{base}/{name}")
    return Inputs(
        ledger=rd("fact_txn_month_raw_data", schemas.LEDGER),
        loan=rd("th_fact_kpi_month_raw_data", schemas.LOAN_BOOK),
        kpi=rd("th_kpi_asm_data", schemas.KPI_FACTS),
        balance_txn=rd("balance_txn", schemas.BALANCE_TXN),
        dim_criteria=rd("dim_criteria", schemas.DIM_CRITERIA),
        dim_criteria_xlsx=rd("dim_criteria_xlsx", schemas.DIM_CRITERIA_XLSX),
    )
