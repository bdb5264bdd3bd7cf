"""The corpus pipeline: documents in, the training mix out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's docs. All but the last return the columns of
documents. Stages work on whole rows: repeated rows, NULLs, empty tables and extra columns
follow the rules of the operator that the stage calls.

1. quality rules: documents that the base rule or the learned list rejects go;
2. SimHash near-dedup: of each component the document of the smallest doc_id stays;
3. benchmark decontamination: contaminated documents go;
4. secret scans: every reported value that is not a widely copied example is replaced;
5. mixing: one row a document with the words that the mix takes of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from areabook.llm import decontaminate, mixing, quality_rules, secrets, simhash
from areabook.llm.common import keep_rows, stager, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    bad = stager(spark, "contaminated").stage(judged.filter("contaminated").select("doc_id", "text_key").distinct(), "keys")
    return keep_rows(docs, bad, "left_anti")


def secret_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", "times", "taken")


STAGES = [("quality rules", quality), ("SimHash near-dedup", near_dedup), ("benchmark decontamination", benchmark_free),
          ("secret scans", secret_free), ("mixing", mixture)]

#: Learned rules, SimHash and the budget fit are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = stager(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = st.stage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
