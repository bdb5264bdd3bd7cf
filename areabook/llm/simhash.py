"""SimHash near-duplicates by the generalised pigeonhole principle.

A document's 64-bit fingerprint has bit b set when over half of its three-word shingles'
hashes have it. Two fingerprints link at `k` or fewer differing bits. Linking works on distinct
fingerprints:

1. bit statistics over all fingerprints: how often each bit and each pair of bits is set,
   as 64 x 64 sums made within tasks;
2. correlated bits are grouped into m partitions (m = 1 .. k+1). If partition i may differ in t_i
   bits (-1: skipped) and the t_i sum to k - m + 1, any two fingerprints within k bits are
   within t_i on some partition. Dynamic programming over the partitions allots the t_i
   at least cost: probes written plus candidates to verify, estimated from the exact number of equal
   pairs a partition and its bits' disagreement rates; the cheapest m wins;
3. probe: every fingerprint writes its key a partition and the keys up to t_i bits away;
   equal keys meet in a join whose condition verifies the whole distance, so only links leave it;
4. keys shared by more than `bucket_rows` entries are not joined: their fingerprints write all
   values within ceil(k/2) bits of their whole 64 bits instead. Two fingerprints within
   k bits share one, and no value is shared by more than the few that are that near, so
   dense groups cost linear work and lose no link between components;
5. links become components by star joins.

Edge cases: NULL or empty texts have fingerprint zero, linked like any other; fewer than
three words are one shingle; repeated rows share a fingerprint; a NULL doc_id is in a
component but never names one unless all its members are NULL (then NULL); an empty
table gives an empty result; other columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areabook.llm.common import keep_rows, stager
from areabook.llm.components import connected

BITS = 64
SHINGLE = 3
MAX_DISTANCE = 2
SEED = 42
BUCKET_ROWS = 256
#: Cost of writing one probe key, in verified candidates.
PROBE_COST = 8.0


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    words = (text or "").encode().lower().split()     # bytes: only A-Z change, only ASCII white space cuts
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    n = max(1, len(words) - shingle + 1)
    h = np.fromiter((xxhash.xxh64_intdigest(p, seed) for p in parts), dtype=np.uint64, count=n)
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, n, 1 << 14):                    # very long texts in bounded pieces
        bits = np.unpackbits(h[i:i + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprint_column(shingle: int = SHINGLE):
    @F.pandas_udf("long")
    def fp(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))
    return fp


def _bits(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_sums(fps: DataFrame) -> np.ndarray:
    """64 x 64 counts of fingerprints with both bits set (4,096 numbers reach the driver)."""
    def sums(batches):
        total = np.zeros((BITS, BITS), dtype=np.int64)
        for b in batches:
            x = _bits(b.column(0).to_numpy()).astype(np.float32)
            total += (x.T @ x).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(range(BITS * BITS), pa.int32()), pa.array(total.ravel())], ["at", "n"])
    got = fps.select("fp").mapInArrow(sums, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BITS * BITS)
    for r in got:
        out[r["at"]] = r["n"]
    return out.reshape(BITS, BITS)


def group_bits(sums: np.ndarray, n: int, m: int) -> list[list[int]]:
    """m partitions of near-equal width; each bit joins the open one it correlates with most."""
    p = np.diag(sums) / max(1, n)
    cov = sums / max(1, n) - np.outer(p, p)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    width = -(-BITS // m)
    groups: list[list[int]] = []
    free = list(np.argsort(-corr.sum(axis=1), kind="stable"))
    for g in range(m):
        size = min(width, len(free) - (m - g - 1))
        own = [free.pop(0)]
        while len(own) < size:
            nxt = max(free, key=lambda b: (corr[b, own].mean(), -b))
            free.remove(nxt)
            own.append(nxt)
        groups.append(sorted(int(b) for b in own))
    return groups


def _near(d: np.ndarray, most: int) -> list[float]:
    """P(at most e of the bits differ), e = 0 .. most, for independent disagreement rates d."""
    q = np.zeros(most + 1)
    q[0] = 1.0
    for x in d:
        q[1:] = q[1:] * (1 - x) + q[:-1] * x
        q[0] *= 1 - x
    return list(np.cumsum(q))


def allot(groups: list[list[int]], equal: list[float], sums: np.ndarray, n: int, k: int) -> tuple[float, list[int]]:
    """(cost, thresholds) of least estimated cost; equal: exact pairs of fingerprints alike on each partition."""
    p = np.diag(sums) / max(1, n)
    d = 2 * p * (1 - p)
    pairs = n * (n - 1) / 2
    costs = []
    for g, eq in zip(groups, equal):
        near = _near(d[g], k)
        lift = max(1.0, eq / max(pairs * near[0], 1e-12)) if eq else 1.0
        row = [0.0]
        for t in range(k + 1):
            probes = sum(comb(len(g), e) for e in range(t + 1))
            row.append(n * probes * PROBE_COST + min(pairs, pairs * near[t] * min(lift, 1 / max(near[t], 1e-12))))
        costs.append(row)
    units = k + 1                                     # sum of (t_i + 1)
    best = [(0.0, [])] + [(float("inf"), [])] * units
    for row in costs:
        best = [min(((best[u - t][0] + row[t], best[u - t][1] + [t - 1]) for t in range(u + 1)), key=lambda x: x[0])
                for u in range(units + 1)]
    return best[units]


def part_key(fp: Column, group: list[int]) -> Column:
    """The fingerprint with all bits outside the group cleared."""
    mask = sum(1 << b for b in group)
    return fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >= 1 << 63 else mask).cast("long"))


def _flips(group: list[int], t: int) -> list[int]:
    masks = [sum(1 << b for b in c) for e in range(t + 1) for c in combinations(group, e)]
    return [x - (1 << 64) if x >= 1 << 63 else x for x in masks]


def _probes(part: int, group: list[int], t: int) -> Column:
    """All (part, key, own) entries of a fingerprint on one partition; own marks its exact key."""
    key = part_key(F.col("fp"), group)
    return F.transform(F.array(*[F.lit(x) for x in _flips(group, t)]), lambda x: F.struct(
        F.lit(part).alias("part"), key.bitwiseXOR(x).alias("key"), (x == 0).alias("own")))


def plan_partitions(fps: DataFrame, n: int, k: int) -> list[tuple[list[int], int]]:
    """[(bits, threshold)] of the partitions in use."""
    sums = bit_sums(fps)
    options = {m: group_bits(sums, n, m) for m in range(1, k + 2)}
    flat = [(m, i, g) for m, gs in options.items() for i, g in enumerate(gs)]
    keys = F.array(*[F.struct(F.lit(j).alias("part"), part_key(F.col("fp"), g).alias("key")) for j, (_, _, g) in enumerate(flat)])
    same = (fps.select(F.explode(keys).alias("x")).groupBy("x.part", "x.key").agg(F.count("*").alias("c"))
            .groupBy("part").agg(F.sum(F.col("c") * (F.col("c") - 1) / 2).alias("pairs")).collect())   # a row a partition
    equal = {r.part: float(r.pairs) for r in same}
    best = None
    for m, groups in options.items():
        eq = [equal.get(j, 0.0) for j, (mm, _, _) in enumerate(flat) if mm == m]
        cost, t = allot(groups, eq, sums, n, k)
        if best is None or cost < best[0]:
            best = (cost, [(g, x) for g, x in zip(groups, t) if x >= 0])
    return best[1]


def _hub_links(fps: DataFrame, k: int) -> DataFrame:
    """Links between fingerprints within k bits through shared values: a star a value."""
    far = -(-k // 2)
    masks = np.array(_flips(list(range(BITS)), far), dtype=np.int64)
    radius = np.array([bin(int(x) & (2**64 - 1)).count("1") for x in masks], dtype=np.int8)

    def balls(batches):
        for b in batches:
            v = b.column(0).to_numpy()
            for i in range(0, len(v), 1024):
                own = v[i:i + 1024]
                hub = (own[:, None] ^ masks[None, :]).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(hub), pa.array(np.repeat(own, len(masks))),
                                                  pa.array(np.tile(radius, len(own)))], ["hub", "fp", "r"])
    hubs = fps.mapInArrow(balls, "hub long, fp long, r byte")
    # members within floor(k/2) of the value are all within k of each other; those further only of these
    near = F.when(F.col("r") <= k // 2, F.col("fp"))
    centre = hubs.groupBy("hub").agg(F.min(near).alias("c"), F.count("*").alias("n")).filter("n > 1 and c is not null")
    return (hubs.join(centre, "hub").filter(F.col("fp") != F.col("c"))
            .filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("c"))) <= k)
            .select(F.col("fp").alias("a"), F.col("c").alias("b")).distinct())


def links(fps: DataFrame, k: int = MAX_DISTANCE, bucket_rows: int = BUCKET_ROWS, st=None) -> DataFrame:
    """(a, b) links between distinct fingerprints fp whose components are those of all pairs within k bits."""
    n = fps.count()
    if n < 2:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    parts = plan_partitions(fps, n, k)
    entries = [_probes(j, group, t) for j, (group, t) in enumerate(parts)]
    e = fps.select("fp", F.explode(F.concat(*entries)).alias("x")).select("fp", "x.*")
    e = st.stage(e, "entries")
    sizes = (e.groupBy("part", "key").agg(F.count("*").alias("rows"), F.max("own").alias("indexed"))
             .filter("rows > 1 and indexed").select("part", "key", "rows"))
    met = st.stage(e.join(sizes, ["part", "key"]), "met")
    cold, hot = met.filter(F.col("rows") <= bucket_rows), met.filter(F.col("rows") > bucket_rows)
    a = cold.filter("own").select("part", "key", F.col("fp").alias("a"))
    b = cold.select("part", "key", F.col("fp").alias("b"))
    differ = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    near = a.join(b, ["part", "key"]).filter((F.col("a") != F.col("b")) & (differ <= k)).select("a", "b")
    dense = hot.select("fp").distinct()
    return near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct() \
               .unionByName(_hub_links(dense, k))


def classes(docs: DataFrame, k: int = MAX_DISTANCE, shingle: int = SHINGLE, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row a document: doc_id, text_key, fp (long), fingerprint (hex), component_id."""
    st = stager(docs.sparkSession, "simhash")
    base = st.stage(docs.select("doc_id", F.xxhash64("text").alias("text_key"),
                                fingerprint_column(shingle)("text").alias("fp")), "fingerprints")
    fps = st.stage(base.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    found = st.stage(links(fps.select("fp"), k, bucket_rows, st), "pairs")
    roots = st.stage(connected(found, st), "roots")
    linked = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = linked.select("fp", "root").join(least, "root").select("fp", "root", "component_id")
    return base.join(named, "fp").select("doc_id", "text_key", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                                         "root", "component_id")


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """docs with one document of each component: that of the smallest doc_id (NULL last), of differing
    texts with that id the one of the least text_key, of repeated rows one. All columns stay."""
    st = stager(docs.sparkSession, "simhash-keep")
    c = st.stage(classes(docs, **options).select("doc_id", "text_key", "root"), "classes")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    first = c.groupBy("root").agg(F.min(order).alias("x")).select("x.doc_id", "x.text_key").distinct()
    kept = keep_rows(docs, st.stage(first, "first"), "left_semi")
    repeated = st.stage(c.groupBy("doc_id", "text_key").agg(F.count("*").alias("n")).filter("n > 1"), "repeated")
    if repeated.isEmpty():
        return kept
    return (keep_rows(kept, repeated, "left_anti")
            .unionByName(keep_rows(kept, repeated, "left_semi").dropDuplicates(["doc_id", "text"])))
