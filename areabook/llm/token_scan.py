"""Token counts of flat, unindexed token files by a separator scan.

A token file is a plain sequence of little-endian 16- or 32-bit ids; documents end with an
end-of-document id and nothing says where. Files are cut into blocks of fixed size; tasks
read a block's bytes and search it for the id as one vector operation. A document that crosses
blocks is stitched by a prefix scan over the blocks of its file: each block's last
separator (a running maximum) and number of separators (a running sum) carry into the
next. The scan has two levels, runs of `SPAN` blocks and then the runs, so a file with a
third of all tokens is not one task.

`write_tokens` makes such files from texts with a public vocabulary, one file a
partition, under a temporary name that is moved into place when it is complete: a task that
is run again replaces its file with the same bytes.

Edge cases: an empty file has no documents; tokens after a file's last separator form a
last document that is not complete; two separators in a row enclose a document of 0 tokens; blocks
with no separator or only separators are ordinary; a NULL or empty text is 0 tokens.
Files whose length is not a whole number of ids raise an error."""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from areabook.llm.common import stager

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Splits texts before merging, as published with the vocabulary (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
EOD = 50_256
BLOCK_TOKENS = 1 << 20
SPAN = 1024


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


_ENCODERS: dict[str, object] = {}


def encoder(vocabulary: str):
    """The vocabulary's encoder, made once a Python worker."""
    if vocabulary not in _ENCODERS:
        import tiktoken
        fs, path = open_fs(vocabulary)
        with fs.open_input_stream(path) as f:
            lines = f.read().split(b"\n")
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        _ENCODERS[vocabulary] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[vocabulary]


def write_tokens(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, eod: int = EOD, dtype: str = "<u2") -> DataFrame:
    """Writes docs(doc_id, text) as token files, one a partition; returns (file, ordinal, doc_id) in the
    order written."""
    def write(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext
        enc = encoder(vocabulary)
        fs, root = open_fs(folder)
        name = f"tokens-{TaskContext.get().partitionId():06d}.bin"
        part = f"{root}/.{name}.{uuid.uuid4().hex}"
        n = 0
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(part) as out:
            for b in batches:
                ids = b.column(0)
                for text in b.column(1):
                    row = enc.encode_ordinary(text.as_py() or "")
                    row.append(eod)
                    out.write(np.array(row, dtype=dtype).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(ids)), pa.array(range(n, n + len(ids)), pa.int64()), ids.cast(pa.int64())],
                    ["file", "ordinal", "doc_id"])
                n += len(ids)
        fs.move(part, f"{root}/{name}")
    return docs.select("doc_id", "text").mapInArrow(write, "file string, ordinal long, doc_id long")


def blocks_of(spark: SparkSession, folder: str, dtype: str, block_tokens: int) -> DataFrame:
    """(file, path, block, first token, tokens) of all blocks; only names and lengths are listed."""
    size = np.dtype(dtype).itemsize
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder)
             .select(F.element_at(F.split("path", "/"), -1).alias("file"), "path", F.col("length").alias("bytes")))
    tokens = F.when(F.col("bytes") % size == 0, F.floor(F.col("bytes") / size)).otherwise(
        F.raise_error(F.concat(F.lit("not a whole number of ids: "), F.col("path"))).cast("long"))
    return (files.withColumn("tokens", tokens).filter("tokens > 0")
            .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("tokens") - 1) / block_tokens))))
            .select("file", "path", "block", (F.col("block") * block_tokens).alias("at"), F.least(
                F.lit(block_tokens).cast("long"), F.col("tokens") - F.col("block") * block_tokens).alias("n")))


def _search(eod: int, dtype: str):
    def run(batches):
        size = np.dtype(dtype).itemsize
        for b in batches:
            found = []
            for path, at, n in zip(*(b.column(i).to_pylist() for i in (1, 3, 4))):
                fs, p = open_fs(path)
                with fs.open_input_file(p) as f:
                    f.seek(at * size)
                    ids = np.frombuffer(f.read(n * size), dtype=dtype)
                if len(ids) != n:
                    raise OSError(f"{path}: {len(ids)} of {n} tokens at {at}")
                found.append(np.flatnonzero(ids == eod) + at)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(3), b.column(4),
                                              pa.array(found, pa.list_(pa.int64()))], ["file", "block", "at", "n", "seps"])
    return run


def scan(spark: SparkSession, folder: str, eod: int = EOD, dtype: str = "<u2", block_tokens: int = BLOCK_TOKENS,
         span: int = SPAN) -> DataFrame:
    """(file, ordinal, start, n_tokens, complete) of every document in the token files of a folder."""
    st = stager(spark, "token-scan")
    todo = blocks_of(spark, folder, dtype, block_tokens).repartition("file", "block")
    found = st.stage(todo.mapInArrow(_search(eod, dtype), "file string, block long, at long, n long, seps array<long>"), "blocks")
    # two-level prefix scan: last separator before the block, separators before the block
    s = found.select("file", "block", "at", "n", F.floor(F.col("block") / span).alias("run"), F.size("seps").cast("long").alias("k"),
                     F.array_max("seps").alias("last"))
    before = lambda *p: Window.partitionBy(*p[:-1]).orderBy(p[-1]).rowsBetween(Window.unboundedPreceding, -1)
    runs = (s.groupBy("file", "run").agg(F.sum("k").alias("k"), F.max("last").alias("last"))
            .select("file", "run", F.sum("k").over(before("file", "run")).alias("run_k"),
                    F.max("last").over(before("file", "run")).alias("run_last")))
    inner = s.select("file", "block", "run", F.sum("k").over(before("file", "run", "block")).alias("in_k"),
                     F.max("last").over(before("file", "run", "block")).alias("in_last"))
    carry = inner.join(runs, ["file", "run"]).select(
        "file", "block", (F.coalesce("run_k", F.lit(0)) + F.coalesce("in_k", F.lit(0))).alias("ordinal0"),
        F.coalesce(F.greatest("run_last", "in_last"), F.lit(-1)).alias("last0"))
    whole = (found.join(carry, ["file", "block"])
             .select("file", "ordinal0", "last0", "seps", F.posexplode("seps").alias("i", "sep"))
             .withColumn("start", F.when(F.col("i") == 0, F.col("last0")).otherwise(F.get("seps", F.col("i") - 1)) + 1)
             .select("file", (F.col("ordinal0") + F.col("i")).alias("ordinal"), "start",
                     (F.col("sep") - F.col("start")).alias("n_tokens"), F.lit(True).alias("complete")))
    ends = (s.groupBy("file").agg(F.max(F.col("at") + F.col("n")).alias("end"), F.max("last").alias("last"), F.sum("k").alias("k"))
            .withColumn("start", F.coalesce(F.col("last") + 1, F.lit(0))).filter("end > start")
            .select("file", F.col("k").alias("ordinal"), "start", (F.col("end") - F.col("start")).alias("n_tokens"),
                    F.lit(False).alias("complete")))
    return whole.unionByName(ends)
