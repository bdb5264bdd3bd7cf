"""Mixing sources to target weights by subset-sum budget fitting.

Sizes are words. Sources in code point order (NULL last) weigh 1, 2, 3, repeating; they
share the total of all sizes by weight, no source above `max_epochs` times its size, the
excess reshared by weight (solved in closed form: targets are min(cap, lambda * weight)).
A target of t words from a source of S words takes every document floor(t / S) times and,
for the remaining budget, a subset:

* documents are counted by exact length (a histogram a source, pre-aggregated);
* the same share of every length is taken: each length gets its whole number of documents, and the fractions are
  rounded by a systematic sample over the lengths in order (a seeded start, then one more document wherever the running
  fraction passes a whole number). So every length's chance is its fraction, and as neighbours in the order are
  alike, what is missing or too much in words is less than the longest document;
* a bounded-knapsack dynamic programme over the documents still available, in the same seeded order, comes as near to that
  rest as they allow: the same way for sources of every size;
* the chosen count of each (source, length) picks documents by a seeded hash. Hash
  buckets of about `bucket_rows` documents are taken whole up to the count; only the documents of the bucket at
  the cut are ranked, repeated rows as one with a count. Where the cut falls among repeated rows (one
  document a length at most), they are counted by the task that read them, so not even that group is one task.

Edge cases: NULL or empty texts have size 0 and taken 0; NULL doc_id and source are
ordinary values; ties of the hash fall to doc_id and text; repeated rows count each; an
empty table gives an empty result; other columns are ignored."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from areabook.llm.common import WORD, left_join, stager

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = 20240601
BUCKET_ROWS = 512


def source_targets(sources: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, source_size); one row a source goes through the windows."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    k = (F.row_number().over(by_name) - 1) % len(weights)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), k + 1)
    s = sources.withColumn("w", w).withColumn("cap", (F.col("source_size") * max_epochs).cast("double"))
    # water level: sources in order of cap / weight reach their caps first
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum(F.col("source_size").cast("double")).over(everything)
             - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(rest)
    s = s.withColumn("level", level).withColumn("open", F.col("level") <= F.col("cap") / F.col("w"))
    # the first open source fixes the level of all that follow
    final = F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return s.withColumn("final", final).select(
        "source", "source_size", F.when(F.col("final").isNull(), F.col("cap"))
        .otherwise(F.least("cap", F.col("final") * F.col("w"))).alias("target"))


def _bits(x: int, top: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(np.frombuffer(x.to_bytes(top // 8 + 1, "little"), dtype=np.uint8), bitorder="little"))


def fit_budget(lengths, counts, budget: int, seed: int = SEED) -> np.ndarray:
    """Copies of each length (at most its count) whose sum is as near to budget as the method gets: the same share of
    every length, then an exact bounded knapsack on the rest, which is below the longest length."""
    lengths, counts = np.asarray(lengths, dtype=np.int64), np.asarray(counts, dtype=np.int64)
    total = int((lengths * counts).sum())
    if total <= budget or total == 0:
        return counts.copy()
    budget = int(budget)
    take = np.array([int(c) * budget // total for c in counts], dtype=np.int64)
    rng = np.random.default_rng([seed, total % (1 << 32)])
    by_length = np.argsort(lengths, kind="stable")
    # running fractions times the total (exact integers), from a seeded start
    carried = int(rng.integers(total))
    for i in by_length:
        carried += int(counts[i]) * budget % total
        if carried >= total:
            take[i] += 1
            carried -= total
    rest = budget - int((lengths * take).sum())
    if rest < 0:                                   # too much: the shortest document that makes room goes back
        taken = by_length[take[by_length] > 0]
        enough = taken[lengths[taken] >= -rest]
        i = enough[0] if len(enough) else taken[-1]
        take[i] -= 1
        rest += int(lengths[i])
    order = rng.permutation(len(lengths))
    # one bit a reachable sum; a sum may pass the rest by one document, to come nearest from either side
    left = counts - take
    top = min(rest + int(lengths[left > 0].max(initial=0)), 2 * rest)
    if rest <= 0:
        return take
    mask, reach = (1 << (top + 1)) - 1, 1
    via = np.full(top + 1, -1, dtype=np.int64)     # the item that first reached a sum
    items = []
    for i in order:
        length, n, step = int(lengths[i]), int(left[i]), 1
        n = min(n, top // length) if length else 0
        while n > 0 and not (reach >> rest) & 1:
            k = min(step, n)
            new = (reach << (k * length)) & mask & ~reach
            items.append((i, k))
            if new:
                via[_bits(new, top)] = len(items) - 1
                reach |= new
            n, step = n - k, step * 2
    sums = _bits(reach, top)
    s = int(sums[np.argmin(np.abs(sums - rest))])
    while s > 0:
        i, k = items[via[s]]
        take[i] += k
        s -= k * int(lengths[i])
    return take


def _plan(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("size").reset_index(drop=True)
    size, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
    epochs = int(target // size) if size else 0
    budget = int(round(target)) - epochs * size
    group["epochs"] = epochs
    group["extra"] = fit_budget(group["size"], group["n"], max(0, budget)) if size else 0
    return group[["source", "size", "n", "source_size", "target", "epochs", "extra"]]


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
        bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row a document: doc_id, text_key, size, source, source_size, target, times, taken."""
    st = stager(docs.sparkSession, "mixing")
    text = F.coalesce(F.col("text"), F.lit(""))
    # part: the task that read the row, fixed by writing it
    sized = st.stage(docs.select(
        "doc_id", F.xxhash64("text").alias("text_key"), "source",
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), "doc_id", "text").alias("h"), F.spark_partition_id().alias("part")), "sizes")
    hist = st.stage(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "lengths")
    per_source = hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = source_targets(per_source, weights, max_epochs)
    plan = st.stage(left_join(hist, targets, ["source"]).groupBy("source").applyInPandas(
        _plan, "source string, size long, n long, source_size long, target double, epochs long, extra long"), "plan")
    keyed = left_join(sized, plan, ["source", "size"])
    # buckets of the seeded hash, from the exact count of the length
    n_buckets = F.ceil(F.col("n") / F.lit(float(bucket_rows)))
    keyed = keyed.withColumn("bucket", F.floor(F.shiftrightunsigned("h", 33) * n_buckets / F.lit(float(1 << 31))).cast("int"))
    some = keyed.filter("extra > 0 and extra < n")
    bucket, one = ["source", "size", "bucket"], ["source", "size", "bucket", "h", "doc_id", "text_key"]
    cum = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (some.groupBy(*bucket, "extra").agg(F.count("*").alias("in_bucket"))
               .withColumn("room", F.col("extra") - F.coalesce(F.sum("in_bucket").over(cum), F.lit(0))).drop("extra"))
    buckets = st.stage(buckets, "buckets")
    # the bucket at the cut: one row a document, with how many of its repeated rows are taken
    cut = buckets.filter("room > 0 and room < in_bucket").select(*bucket, F.col("room").alias("cut_room"))
    at_cut = left_join(some, cut, bucket).filter("cut_room is not null")
    order = Window.partitionBy(*bucket).orderBy("h", "doc_id", "text_key").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (at_cut.groupBy(*one, "cut_room").agg(F.count("*").alias("copies"))
              .withColumn("copies_taken", F.greatest(F.lit(0), F.least("copies", F.col("cut_room") - F.coalesce(F.sum("copies").over(order), F.lit(0)))))
              .drop("cut_room"))
    ranked = st.stage(ranked, "cut")
    # a document of which some repeated rows are taken and some are not: counted on from task to task
    split = ranked.filter("copies_taken > 0 and copies_taken < copies")
    by_task = Window.partitionBy(*one).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (left_join(some, split, one).filter("copies_taken is not null").groupBy(*one, "part", "copies_taken").agg(F.count("*").alias("here"))
             .withColumn("left", F.col("copies_taken") - F.coalesce(F.sum("here").over(by_task), F.lit(0)))
             .select(*one, "part", "left"))
    rows = left_join(left_join(left_join(keyed, buckets, bucket), ranked, one), parts, [*one, "part"])
    partly = F.col("left").isNotNull()
    in_task = F.row_number().over(Window.partitionBy(*one, "part").orderBy(F.lit(1)))
    more = (F.when(F.col("extra") <= 0, 0).when(F.col("extra") >= F.col("n"), 1)
            .when(F.col("room") >= F.col("in_bucket"), 1).when(F.col("room") <= 0, 0)
            .otherwise((F.col("copies_taken") >= F.col("copies")).cast("int")))
    settled = rows.filter(~partly).withColumn("more", more)
    counted = rows.filter(partly).withColumn("more", (in_task <= F.col("left")).cast("int"))
    chosen = settled.unionByName(counted)
    times = F.least(F.col("epochs") + F.col("more"), F.lit(max_epochs)).cast("long")
    return chosen.select("doc_id", "text_key", "size", "source", "source_size", "target", times.alias("times"),
                         (times * F.col("size")).alias("taken"))
