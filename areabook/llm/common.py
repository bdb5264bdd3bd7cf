"""Shared helpers of the text operators.

Documents are identified by (doc_id, text_key): text_key is a 64-bit hash of the
text, so rows that repeat a doc_id with another text stay apart, repeated rows
share one verdict, and a NULL doc_id is an ordinary (null-safe) key."""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from areabook.plans.staging import Stager

#: Words between ASCII white space, as fixed by the query contracts (a Java regular expression).
WORD = r"[^\x20\x09-\x0D]+"
KEY = ("doc_id", "text_key")


def stager(spark: SparkSession, name: str) -> Stager:
    """Tables that cut lineage, in the cluster's shared checkpoint folder."""
    return Stager(spark, name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only. lower() does that on pure ASCII text and is much faster there."""
    return (F.when(F.length(text) == F.octet_length(text), F.lower(text))
            .otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase)))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def null_safe(left: DataFrame, right: DataFrame, cols) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in cols])


def left_join(left: DataFrame, right: DataFrame, cols) -> DataFrame:
    """Left join on null-safe keys; the keys come from the left side."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in cols else F.col(c) for c in right.columns])
    on = reduce(lambda a, b: a & b, [left[c].eqNullSafe(renamed[f"_r_{c}"]) for c in cols])
    return left.join(renamed, on, "left").drop(*[f"_r_{c}" for c in cols])


def keep_rows(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows of docs whose (doc_id, text) is (left_semi) or is not (left_anti) in keys; all
    columns of docs stay, whatever their names."""
    k = keys.select(F.col("doc_id").alias("_k_id"), F.col("text_key").alias("_k_text"))
    on = docs["doc_id"].eqNullSafe(k["_k_id"]) & (F.xxhash64(docs["text"]) == k["_k_text"])
    return docs.join(k, on, how)
