"""The published report tables: months of several tables are replaced together or not at all.

A publish writes each table's rows once, to a folder of its own (<out>/<table>/version=<id>/month_key=<m>),
and then appends ONE row to the commit log (<out>/commits). That row, a file of its own that appears by
a rename, names the version of every (table, month) the publish replaces. Readers take a snapshot: for each
(table, month) the version of its last commit. So

* a publish that dies anywhere before the commit row leaves readers with the old months of all its
  tables, after it with the new months of all; there is no state between, nothing to undo and nothing to replay;
* a snapshot stays readable while later publishes go on: files are never overwritten;
* a month without rows is emptied by the same commit (its entry counts 0 rows);
* of two publishes at once the later commit (by sequence number, then version id) holds for all its entries.

Folders that no commit names (publishes that died) and versions that later commits replaced are
removed by `vacuum` once they are older than the time readers may need them for. `compact` folds the log
into one row. What the driver holds is one entry a table and month."""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areabook.sources import files, schemas

MONTH = "month_key"


@dataclass(frozen=True)
class Entry:
    table: str
    month_key: int
    version: str
    n_rows: int
    seq: int


class Snapshot:
    """The tables as of one commit."""

    def __init__(self, mart: Mart, entries: Sequence[Entry]):
        self.mart, self.entries = mart, list(entries)

    @property
    def seq(self) -> int:
        return max((e.seq for e in self.entries), default=0)

    def months(self, table: str) -> list[int]:
        return sorted(e.month_key for e in self.entries if e.table == table and e.n_rows)

    def table(self, table: str, months: Sequence[int] | None = None) -> DataFrame:
        """The table's rows (of the listed months), by its declared schema; a table never published is empty."""
        spark, schema = self.mart.spark, self.mart.schemas[table]
        root = f"{self.mart.path}/{table}"
        paths = [f"{root}/version={e.version}/{MONTH}={e.month_key}" for e in self.entries
                 if e.table == table and e.n_rows and (months is None or e.month_key in months)]
        if not paths:
            return spark.createDataFrame([], schema)
        found = spark.read.schema(T.StructType([*schema.fields, T.StructField("version", T.StringType())])) \
            .option("basePath", root).parquet(*paths)
        return found.select(*[f.name for f in schema.fields])


class Mart:
    """Published tables under one folder; `tables` maps names to declared schemas."""

    def __init__(self, spark: SparkSession, path: str, tables: Mapping[str, T.StructType] | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.schemas = dict(schemas.PUBLISHED if tables is None else tables)
        self.log = f"{self.path}/commits"

    # ---- reading ----------------------------------------------------------------------------------

    def _commits(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(schemas.COMMITS).parquet(self.log)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":     # nothing was ever published
                return None
            raise

    def snapshot(self) -> Snapshot:
        log = self._commits()
        if log is None:
            return Snapshot(self, [])
        e = log.select(F.inline("entries"))
        last = (e.groupBy("table", MONTH).agg(F.max_by(F.struct("version", "n_rows", "seq"), F.struct("seq", "version")).alias("x"))
                .select("table", MONTH, "x.*"))
        return Snapshot(self, [Entry(r.table, r.month_key, r.version, r.n_rows, r.seq) for r in last.collect()])

    def read(self, table: str, months: Sequence[int] | None = None) -> DataFrame:
        return self.snapshot().table(table, months)

    def variants(self, tables: Mapping[str, str], months: Sequence[int] | None = None) -> DataFrame:
        """Tables of one shape as one, under a column `variant` (variant -> table name), from one snapshot."""
        shot, out = self.snapshot(), None
        for variant, table in sorted(tables.items()):
            part = shot.table(table, months).select(F.lit(variant).alias("variant"), "*")
            out = part if out is None else out.unionByName(part)
        return out

    # ---- publishing -------------------------------------------------------------------------------

    def _write(self, table: str, df: DataFrame, version: str) -> DataFrame:
        """Writes the rows of one table; returns what was written."""
        schema, path = self.schemas[table], f"{self.path}/{table}/version={version}"
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
        df.write.partitionBy(MONTH).parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def _commit(self, entries: Sequence[Entry]) -> None:
        row = [([tuple(getattr(e, f.name) for f in schemas.COMMIT_ENTRY.fields) for e in entries], _dt.datetime.now(_dt.timezone.utc))]
        self.spark.createDataFrame(row, schemas.COMMITS).coalesce(1).write.mode("append").parquet(self.log)

    def publish(self, tables: Mapping[str, DataFrame], months: Sequence[int]) -> Snapshot:
        """Replaces the listed months of all the tables in one commit. Rows of other months are an error (nothing is
        published); a listed month without rows is emptied. Each DataFrame is evaluated once."""
        listed, version = sorted({int(m) for m in months}), f"v{uuid.uuid4().hex}"
        seq = self.snapshot().seq + 1
        with ThreadPoolExecutor(max_workers=max(1, len(tables))) as pool:      # independent writes, side by side
            written = dict(zip(tables, pool.map(lambda t: self._write(t, tables[t], version), tables)))
        entries = []
        for table, df in written.items():
            n = {r[0]: r[1] for r in df.groupBy(MONTH).count().collect()}       # from the files' footers
            if stray := [m for m in n if m not in listed]:
                raise ValueError(f"{table}: rows of months {stray} in a publish of {listed}")
            entries += [Entry(table, m, version, n.get(m, 0), seq) for m in listed]
        self._commit(entries)
        return self.snapshot()

    # ---- housekeeping -----------------------------------------------------------------------------

    def vacuum(self, older_than: _dt.timedelta = _dt.timedelta(days=1)) -> list[str]:
        """Deletes version folders that the current snapshot does not use, if they are older than `older_than` (time for running
        publishes and readers). Returns the deleted folders."""
        kept = {f"{e.table}/version={e.version}" for e in self.snapshot().entries if e.n_rows}
        limit = (_dt.datetime.now(_dt.timezone.utc) - older_than).timestamp() * 1000
        gone = []
        for table in self.schemas:
            for folder, modified in files.matching(self.spark, f"{self.path}/{table}/version=*"):
                if "/".join(folder.split("/")[-2:]) not in kept and modified <= limit:
                    files.delete(self.spark, folder)
                    gone.append(folder)
        return gone

    def compact(self) -> None:
        """Folds the commit log into one row. Its entries keep their versions and numbers, so a reader sees the same tables with
        the old files, the new one, or both; commits made meanwhile stay. (A reader that listed the log just before the old files go
        has to read it again.)"""
        old = [p for p, _ in files.matching(self.spark, f"{self.log}/*.parquet")]
        if len(old) < 2:
            return
        e = self.spark.read.schema(schemas.COMMITS).parquet(*old).select(F.inline("entries"))
        last = e.groupBy("table", MONTH).agg(F.max_by(F.struct("version", "n_rows", "seq"), F.struct("seq", "version")).alias("x"))
        self._commit([Entry(r.table, r.month_key, r.x.version, r.x.n_rows, r.x.seq) for r in last.collect()])
        for p in old:
            files.delete(self.spark, p)
