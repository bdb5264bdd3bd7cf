"""Stage helpers for jobs whose later statements read earlier results.

A report level is read by several later levels (roll-ups, ratios, shares,
scalar totals). Re-embedding its plan in every reader makes plans grow
exponentially with depth, and would recompute the scans. Each level is
therefore written once as a parquet table under the cluster's shared
checkpoint folder and read back: lineage is cut, readers see a small leaf
plan, and a lost executor only costs the level being written."""

from __future__ import annotations

import itertools
import os
import sys
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame

from areabook.session import ensure_checkpoint_dir

_TRACE = bool(os.environ.get("AREABOOK_TRACE"))


class Stager:
    """Writes the stages of one job run under <checkpoint dir>/areabook/<run id>/."""

    def __init__(self, spark, job: str):
        self.spark = spark
        base = ensure_checkpoint_dir(spark).rstrip("/")
        self.root = f"{base}/areabook/{job}-{uuid.uuid4().hex[:12]}"
        self._seq = itertools.count(1)

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{next(self._seq):03d}-{name}"
        t = time.perf_counter()
        df.write.mode("overwrite").parquet(path)
        if _TRACE:
            print(f"[stage] {path.rsplit('/', 1)[-1]} {time.perf_counter() - t:.2f}s", file=sys.stderr)
        return self.spark.read.parquet(path)


    def stage_all(self, frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Write independent stages concurrently (one Spark job per thread;
        the scheduler runs them side by side)."""
        with ThreadPoolExecutor(max_workers=max(1, len(frames))) as pool:
            futures = {k: pool.submit(self.stage, df, k) for k, df in frames.items()}
            return {k: f.result() for k, f in futures.items()}


def union_all(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
