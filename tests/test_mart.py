"""Publishing several tables is one step: for readers, for processes that die, for later publishes."""

import datetime as dt
import os
import subprocess
import sys

import pytest
from pyspark.sql import types as T

from areabook.plans.staging import Stager
from areabook.sources import files
from areabook.sources.mart import Mart
from areabook.sources.sinks import UNFINISHED, append_run_log, compact_run_log, read_run_log

TABLES = {t: T.StructType([T.StructField("v", T.IntegerType()), T.StructField("month_key", T.IntegerType())]) for t in ("a", "b")}
BOTH = (199811, 199812)


def rows(spark, v, months):
    return spark.createDataFrame([(v, m) for m in months], "v int, month_key int")


def held(shot):
    return [sorted((r.month_key, r.v) for r in shot.table(t).collect()) for t in ("a", "b")]


@pytest.fixture
def mart(spark):
    m = Mart(spark, Stager(spark, "mart").root, TABLES)
    m.publish({t: rows(spark, 1, BOTH) for t in TABLES}, BOTH)
    return m


def test_a_snapshot_is_of_one_commit(spark, mart):
    before = mart.snapshot()
    after = mart.publish({t: rows(spark, 2, (199812,)) for t in TABLES}, (199812,))
    assert held(before) == [[(199811, 1), (199812, 1)]] * 2       # still readable, and unchanged
    assert held(after) == [[(199811, 1), (199812, 2)]] * 2
    assert [r.v for r in after.table("a", [199812]).collect()] == [2] and after.months("b") == list(BOTH)
    assert after.table("a").schema == TABLES["a"]


def test_an_error_in_one_table_publishes_none(spark, mart, monkeypatch):
    write = Mart._write

    def fails(self, table, df, version):
        if table == "b":
            raise OSError("second table")
        return write(self, table, df, version)
    monkeypatch.setattr(Mart, "_write", fails)
    with pytest.raises(OSError):
        mart.publish({t: rows(spark, 2, (199812,)) for t in TABLES}, (199812,))
    monkeypatch.undo()
    with pytest.raises(ValueError, match="199901"):               # rows of a month that is not being published
        mart.publish({"a": rows(spark, 3, (199812, 199901)), "b": rows(spark, 3, (199812,))}, (199812,))
    assert held(mart.snapshot()) == [[(199811, 1), (199812, 1)]] * 2


#: A process that publishes 2 in both tables and is killed at a given point.
CHILD = """
import os, signal, sys
sys.path.insert(0, {repo!r})
from areabook.session import build_session
from areabook.sources.mart import Mart
from tests.test_mart import TABLES, rows
spark = build_session("local[2]", stage_dir={path!r} + "/stage")
at, real = sys.argv[1], getattr(Mart, {{"write": "_write", "commit": "_commit", "done": "_commit"}}[sys.argv[1]])
def dies(self, *args):
    if at == "write" and args[0] == "a":
        return real(self, *args)
    if at != "commit":
        real(self, *args)
    os.kill(os.getpid(), signal.SIGKILL)
setattr(Mart, real.__name__, dies)
Mart(spark, {path!r}, TABLES).publish({{t: rows(spark, 2, (199812,)) for t in TABLES}}, (199812,))
"""


@pytest.mark.parametrize("at, want", [("write", 1), ("commit", 1), ("done", 2)])
def test_a_killed_process_leaves_all_old_or_all_new(spark, mart, at, want):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "SPARK_DRIVER_MEMORY": "1g"}
    path = mart.path.removeprefix("file:")
    child = subprocess.run([sys.executable, "-c", CHILD.format(repo=repo, path=path), at], env=env, capture_output=True, timeout=180)
    assert child.returncode == -9, child.stderr[-2000:]
    assert held(mart.snapshot()) == [[(199811, 1), (199812, want)]] * 2
    versions = lambda: len(files.matching(spark, f"{mart.path}/a/version=*"))
    assert versions() == 2
    assert mart.vacuum() == []                                     # young folders may belong to a running publish
    mart.vacuum(dt.timedelta(0))
    assert versions() == want and held(mart.snapshot()) == [[(199811, 1), (199812, want)]] * 2
    assert held(mart.publish({t: rows(spark, 3, (199812,)) for t in TABLES}, (199812,))) == [[(199811, 1), (199812, 3)]] * 2


def test_emptied_months_vacuum_and_compaction(spark, mart):
    assert held(Mart(spark, mart.path + "-none", TABLES).snapshot()) == [[], []]
    shot = mart.publish({"a": rows(spark, 2, ()), "b": rows(spark, 2, (199811,))}, (199811,))
    assert held(shot) == [[(199812, 1)], [(199811, 2), (199812, 1)]]
    for v in range(3, 6):
        mart.publish({"b": rows(spark, v, (199812,))}, (199812,))
    want = [[(199812, 1)], [(199811, 2), (199812, 5)]]
    mart.vacuum(dt.timedelta(0))
    assert held(mart.snapshot()) == want
    mart.compact()
    assert held(mart.snapshot()) == want and len(files.matching(spark, f"{mart.log}/*.parquet")) == 1
    assert mart.publish({"b": rows(spark, 6, (199812,))}, (199812,)).seq == 6
    both = mart.variants({"B": "b", "A": "a"}).collect()
    assert sorted((r.variant, r.month_key, r.v) for r in both) == [("A", 199812, 1), ("B", 199811, 2), ("B", 199812, 6)]


def test_run_log_shows_unfinished_runs_and_compacts(spark):
    path, t = f"{Stager(spark, 'log').root}/log", dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)
    for run in range(8):
        append_run_log(spark, path, f"r{run}", ("p", "q"), t)
        if run % 4:
            append_run_log(spark, path, f"r{run}", ("p", "q"), t, t, run % 4 < 3, "why" if run % 4 == 3 else None, {"p": {"zero_denominators": run}})
    want = {(f"r{run}", p): (run % 4 in (1, 2), {0: UNFINISHED, 3: "why"}.get(run % 4), run if p == "p" and run % 4 else None)
            for run in range(8) for p in "pq"}

    def log():
        return {(r.run_id, r.procedure_name): (r.is_successful, r.error_log, r.zero_denominators) for r in read_run_log(spark, path).collect()}
    assert log() == want and len(files.matching(spark, f"{path}/*.parquet")) == 14
    compact_run_log(spark, path)
    assert log() == want and len(files.matching(spark, f"{path}/*.parquet")) == 1
    append_run_log(spark, path, "r0", ("p", "q"), t, t, True)      # a run that was open when the log was folded
    assert log() == want | {("r0", p): (True, None, None) for p in "pq"}
