"""Benchmark decontamination by a prefix-filtered set join (built-in functions only).

A benchmark item is cut into windows of `window` consecutive words (an item of fewer
words, but not none, is one window). A window is a set of five-word shingles with their
offsets. A document holds the window when enough of its shingles (all, at the default
containment of 1) stand at the right places. The join:

1. every position of every document whose shingle occurs in the benchmark is written
   once (a third pass over the text is never needed), with one row a document for its length;
2. shingles are ordered by their frequency in that whole corpus; only the
   n - ceil(t n) + 1 rarest shingles of a window (its prefix) can produce candidates;
3. a candidate's start follows from the shingle's offset; starts before the first word or
   windows that run past the last word are dropped (length and positional bounds);
4. the remaining candidates are verified shingle by shingle; per item, the share of its
   windows found inside one item-sized stretch of the document is reported too.

The benchmark's distinct shingles are broadcast in blocks of at most `block_shingles`
rows of two numbers, so what is broadcast is bounded whatever the benchmark's size.

Edge cases: NULL or empty texts have no words (n_words 0, not contaminated); an item
without words never matches; repeated documents get the same verdict each, repeated items
count once; a NULL item_id counts as an item named ''; other columns are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areabook.llm.common import KEY, ascii_lower, left_join, stager

#: Words after A-Z are lower-cased (fixed by the contract).
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
SHINGLE = 5
BLOCK_SHINGLES = 1_000_000


def item_words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(f"({ITEM_WORD})"), F.lit(1))


def _shingle(words: Column, at: Column, width: int) -> Column:
    """64-bit hash of `width` words from position `at`; NULL past the end."""
    return F.when(at + width <= F.size(words),
                  F.xxhash64(F.lit(width), *[F.get(words, at + k) for k in range(width)]))


def benchmark_windows(bench: DataFrame, window: int, shingle: int):
    """(window_shingles, item_windows): distinct windows as (wid, len, width, n_sh, off, sid),
    and where items hold them as (wid, item, idx, n_windows)."""
    items = (bench.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                          item_words(F.col("text")).alias("w"))
             .filter(F.size("w") > 0).distinct())
    cut = (items.withColumn("len", F.least(F.lit(window), F.size("w")))
           .withColumn("n_windows", F.size("w") - F.col("len") + 1)
           .select("item", "len", "n_windows", "w", F.explode(F.sequence(F.lit(0), F.col("n_windows") - 1)).alias("idx"))
           .select("item", "len", "n_windows", "idx", F.expr("slice(w, idx + 1, len)").alias("w"))
           .withColumn("wid", F.xxhash64("w")))
    per_width = F.lit(None).cast("long")
    for k in range(1, shingle + 1):
        per_width = F.when(F.col("width") == k, _shingle(F.col("w"), F.col("off"), k)).otherwise(per_width)
    shingles = (cut.select("wid", "w", "len").dropDuplicates(["wid"])
                .withColumn("width", F.least(F.lit(shingle), F.col("len")))
                .withColumn("n_sh", F.col("len") - F.col("width") + 1)
                .withColumn("off", F.explode(F.sequence(F.lit(0), F.col("n_sh") - 1)))
                .select("wid", "len", "width", "n_sh", "off", per_width.alias("sid")))
    return shingles, cut.select("wid", "item", "idx", "n_windows").distinct()


def _matches(docs: DataFrame, sids: DataFrame, widths: list[int], blocks: int) -> DataFrame:
    """One row a document (pos -1, its length) and one a position whose shingle is in sids."""
    base = docs.select("doc_id", F.xxhash64("text").alias("text_key"),
                       F.coalesce(item_words(F.col("text")), F.array().cast("array<string>")).alias("w"))
    at = base.select("doc_id", "text_key", F.size("w").alias("n_words"), "w",
                     F.explode(F.sequence(F.lit(-1), F.size("w") - 1)).alias("pos"))
    cols = ["doc_id", "text_key", "n_words", "pos"]
    hashed = [at.select(*cols, F.when(F.col("pos") >= 0, _shingle(F.col("w"), F.col("pos"), k)).alias("sid"))
              for k in widths]
    out = None
    for b in range(blocks):
        known = F.broadcast(sids.filter(F.pmod("sid", F.lit(blocks)) == b).select(F.col("sid").alias("known")))
        for i, h in enumerate(hashed):
            first = b == 0 and i == 0
            part = (h.join(known, h["sid"] == known["known"], "left" if first else "inner")
                    .filter((F.col("pos") < 0) | F.col("known").isNotNull()).select(*cols, "known"))
            out = part if out is None else out.unionByName(part)
    return out.withColumnRenamed("known", "sid")


def find(docs: DataFrame, bench: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
         containment: float = 1.0, block_shingles: int = BLOCK_SHINGLES) -> dict[str, DataFrame]:
    """documents: (doc_id, text_key, n_words) a row of docs; occurrences: (doc_id, text_key, start, len, wid)."""
    spark = docs.sparkSession
    st = stager(spark, "decontaminate")
    ws, where = benchmark_windows(bench, window, shingle)
    ws, where = st.stage(ws, "window_shingles"), st.stage(where, "item_windows")
    sids = ws.select("sid").distinct()
    widths = sorted(r.width for r in ws.select("width").distinct().collect())  # at most `shingle` numbers
    blocks = max(1, -(-sids.count() // block_shingles))
    m = st.stage(_matches(docs, sids, widths or [shingle], blocks), "matches")
    documents = m.filter("pos < 0").select(*KEY, "n_words")
    m = m.filter("pos >= 0")

    seen = m.groupBy("sid").agg(F.count("*").alias("freq"))
    need = F.ceil(F.col("n_sh") * F.lit(float(containment)) - 1e-9)
    rare = Window.partitionBy("wid").orderBy("freq", "off")
    prefix = (ws.join(seen, "sid", "left").withColumn("freq", F.coalesce("freq", F.lit(0)))
              .withColumn("rn", F.row_number().over(rare))
              .filter((F.col("rn") <= F.col("n_sh") - need + 1) & (F.col("freq") > 0))
              .select("wid", "len", "off", "sid"))
    cand = (m.join(prefix, "sid").withColumn("start", F.col("pos") - F.col("off"))
            .filter((F.col("start") >= 0) & (F.col("start") + F.col("len") <= F.col("n_words")))
            .select(*KEY, "start", "wid").distinct())
    parts = cand.join(ws, "wid").withColumn("pos", F.col("start") + F.col("off"))
    held = m.select(*[F.col(c).alias(f"_m_{c}") for c in (*KEY, "pos", "sid")])
    on = (parts["doc_id"].eqNullSafe(held["_m_doc_id"]) & (parts["text_key"] == held["_m_text_key"])
          & (parts["pos"] == held["_m_pos"]) & (parts["sid"] == held["_m_sid"]))
    occ = (parts.join(held, on, "left_semi")
           .groupBy(*KEY, "start", "wid", "len", "n_sh").agg(F.count("*").alias("n"))
           .filter(F.col("n") >= need).select(*KEY, "start", "len", "wid"))
    return {"documents": documents, "occurrences": st.stage(occ, "occurrences"), "item_windows": where}


def decontaminate(docs: DataFrame, bench: DataFrame, min_share: float = 0.05, **options) -> DataFrame:
    """One row a document: doc_id, text_key, n_words, n_hit (words inside any occurrence), n_items,
    items_sha256, contaminated (n_hit > 0 and n_hit >= min_share * n_words), containment (the
    largest share of one item's windows found in one item-sized stretch)."""
    found = find(docs, bench, **options)
    occ = found["occurrences"]
    span = occ.select(*KEY, "start", (F.col("start") + F.col("len")).alias("end"))
    before = Window.partitionBy(*KEY).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    covered = (span.withColumn("done", F.coalesce(F.max("end").over(before), F.lit(0)))
               .groupBy(*KEY)
               .agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "done"))).cast("long").alias("n_hit")))
    by_item = occ.join(found["item_windows"], "wid")
    share = (by_item.groupBy(*KEY, "item", "n_windows", (F.col("start") - F.col("idx")).alias("at"))
             .agg(F.countDistinct("idx").alias("n"))
             .groupBy(*KEY, "item").agg(F.max(F.col("n") / F.col("n_windows")).alias("share"))
             .groupBy(*KEY).agg(F.sort_array(F.collect_set("item")).alias("items"),
                                F.max("share").alias("containment")))
    out = left_join(left_join(found["documents"], covered, KEY), share, KEY)
    n_hit = F.coalesce("n_hit", F.lit(0))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        *KEY, F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"), F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit >= F.col("n_words") * F.lit(min_share))).alias("contaminated"),
        F.coalesce("containment", F.lit(0.0)).alias("containment"))
