"""Order-insensitive comparison of a Spark result with DuckDB SQL over the
test parquet tables (the same tables the driver registers as views)."""

import math
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return v


def rows_of(df):
    return [tuple(_norm(x) for x in r) for r in df.collect()]


def compare(df, sql, con):
    s_cols = df.columns
    rel = con.sql(sql)
    d_cols = rel.columns
    assert sorted(s_cols) == sorted(d_cols), (s_cols, d_cols)
    idx = [d_cols.index(c) for c in s_cols]
    d_rows = [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]
    s_rows = rows_of(df)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    return sorted(s_rows, key=key), sorted(d_rows, key=key)
