"""Secret scan with corpus-wide ownership frequency (built-in functions only).

Every whole text is scanned once for candidate spans: three base kinds with fixed
patterns, and long opaque tokens that no base span covers whole. Positions are code points, from the
running lengths of the pieces between matches (a window within a document's matches).
Candidate values travel as SHA-256 hashes. Each value is counted over the corpus by
distinct owners and repositories (source, and source with language, here), and by distinct texts that hold
it. A value that does not look random (digits and many distinct characters) is a widely copied example if
`example_owners` hold it. One that does is rarely written twice by chance: it is an example if `random_spread`
independent places hold it (owners or distinct texts, whichever are fewer: forks of one text are one place), or
`wide_owners` owners whatever their texts; a live-looking credential if at most `live_spread` places do (its owner's, or
a fork's); any other value is shared. None of this depends on how many owners the corpus has.
Base spans are always reported; opaque tokens that are no examples when they look
random, when they reach beyond a base span that they overlap (then the whole token is
reported beside it), or when their value is a base credential elsewhere.

Counting pre-aggregates by (value, owner, repository), so a value with a third of all
spans costs one row a task; spans meet their value's class in an ordinary join.

Edge cases: NULL or empty texts have no spans; repeated rows get the same result each and
count once a repository; a NULL source or language is the owner or repository named ''; NULL
doc_id is an ordinary key; other columns are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areabook.llm.common import KEY, left_join, stager

#: Patterns of the query contract (fixed values).
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex")
#: The method's own kind: a run of 20 or more token characters with digits and letters.
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Owners of an example that looks ordinary; independent places, or owners, of one that looks random; places of a live credential.
EXAMPLE_OWNERS, RANDOM_SPREAD, WIDE_OWNERS, LIVE_SPREAD = 4, 12, 100, 2


def _found(text: Column, pattern: str, kind: str, rank: int, hint: Column | None, group: int = 0) -> Column:
    """Array of (kind, rank, i, gap, len, value) of all matches; gap is the text before each match."""
    p = F.lit(pattern)
    whole, gaps = F.regexp_extract_all(text, p, F.lit(0)), F.split(text, pattern, -1)
    values = F.regexp_extract_all(text, p, F.lit(group))
    some = F.regexp_like(text, p) if hint is None else hint & F.regexp_like(text, p)
    rows = F.transform(F.arrays_zip(whole.alias("m"), gaps.alias("g"), values.alias("v")), lambda z, i: F.struct(
        F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), i.alias("i"), F.length(z["g"]).alias("gap"),
        F.length(z["m"]).alias("len"), z["v"].alias("value")))
    return F.when(some, F.filter(rows, lambda x: x["value"].isNotNull()))


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, owner, repo, kind, rank, start, end, vlen, value, random, mixed): all matches
    that pass their kind's length rule, once a distinct document and repository."""
    t = F.col("text")
    low = F.lower(t)
    hinted = None
    for h in ASSIGN_HINTS:
        hinted = low.contains(h) if hinted is None else hinted | low.contains(h)
    owner, lang = F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit(""))
    base = docs.select("doc_id", F.xxhash64("text").alias("text_key"), owner.alias("owner"),
                       F.concat_ws("/", owner, lang).alias("repo"), "text")
    found = F.array(_found(t, ASSIGN, "assign", 0, hinted, 2),
                    _found(t, ACCESS, "access", 1, t.contains("AKIA")),
                    _found(t, HEX, "hex", 2, None), _found(t, TOKEN, "token", 3, None))
    rows = (base.select(*KEY, "owner", "repo", F.explode(F.flatten(F.filter(found, lambda a: a.isNotNull()))).alias("x"))
            .select(*KEY, "owner", "repo", "x.*").distinct())
    at = Window.partitionBy(*KEY, "owner", "repo", "kind").orderBy("i")
    rows = (rows.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(at))
            .withColumn("start", F.col("end") - F.col("len")).withColumn("vlen", F.length("value")))
    chars = F.array_distinct(F.split("value", ""))
    digit, letter = F.regexp_like("value", F.lit("[0-9]")), F.regexp_like("value", F.lit("[A-Za-z]"))
    passes = ((F.col("kind") == "assign") & (F.col("vlen") >= 12) | (F.col("kind") == "access") & (F.col("len") >= 18)
              | (F.col("kind") == "hex") | (F.col("kind") == "token") & digit & letter)
    return rows.filter(passes).select(
        *KEY, "owner", "repo", "kind", "rank", "start", "end", "vlen", F.sha2("value", 256).alias("value"),
        (digit & (F.size(chars) >= 8)).alias("random"))


def ownership(cand: DataFrame, example_owners: int = EXAMPLE_OWNERS, random_spread: int = RANDOM_SPREAD,
              wide_owners: int = WIDE_OWNERS, live_spread: int = LIVE_SPREAD) -> DataFrame:
    """(value, owners, repos, texts, based, random, class) a candidate value; class example, live or shared."""
    flags = [F.max("based").alias("based"), F.max("random").alias("random")]
    n = (cand.groupBy("value", "owner", "repo").agg(F.max(F.col("rank") < 3).alias("based"), F.max("random").alias("random"))
         .groupBy("value", "owner").agg(F.count("*").alias("repos"), *flags)
         .groupBy("value").agg(F.count("*").alias("owners"), F.sum("repos").alias("repos"), *flags))
    # distinct texts first: a value with a third of all spans costs one row a task and text, whoever holds it
    texts = cand.select("value", "text_key").distinct().groupBy("value").agg(F.count("*").alias("texts"))
    spread = F.least("owners", "texts")
    return n.join(texts, "value").select(
        "value", "owners", "repos", "texts", "based", "random",
        F.when(~F.col("random"), F.when(F.col("owners") >= example_owners, "example").otherwise("shared"))
        .when((spread >= random_spread) | (F.col("owners") >= wide_owners), "example")
        .when(spread <= live_spread, "live").otherwise("shared").alias("class"))


def spans(docs: DataFrame, **options) -> DataFrame:
    """All reported spans: (doc_id, text_key, kind, rank, start, end, vlen, value, class, owners, repos, texts)."""
    st = stager(docs.sparkSession, "secrets")
    cand = st.stage(candidates(docs), "candidates")
    own = ownership(cand, **options)
    one = cand.drop("owner", "repo", "random").distinct()
    # an opaque token inside a base span says nothing new; one that reaches beyond it does
    order = Window.partitionBy(*KEY).orderBy("start", "rank")
    base_end, base_start = F.when(F.col("rank") < 3, F.col("end")), F.when(F.col("rank") < 3, F.col("start"))
    one = (one.withColumn("_before", F.coalesce(F.max(base_end).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1)))
           .withColumn("_after", F.min(base_start).over(order.rowsBetween(1, Window.unboundedFollowing))))
    one = one.filter((F.col("rank") < 3) | (F.col("_before") < F.col("end")))
    meets = (F.col("_before") > F.col("start")) | F.coalesce(F.col("_after") < F.col("end"), F.lit(False))
    one = one.withColumn("_meets", meets).drop("_before", "_after")
    out = one.join(own, "value")
    added = (F.col("class") != "example") & (F.col("random") | F.col("based") | F.col("_meets"))
    return out.filter((F.col("rank") < 3) | added).select(
        *KEY, "kind", "rank", "start", "end", "vlen", "value", "class", "owners", "repos", "texts")


def scan(docs: DataFrame, **options) -> DataFrame:
    """One row a document: doc_id, text_key, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example."""
    found = spans(docs, **options)
    place = F.concat_ws(":", "kind", "start", "end")
    per = (found.groupBy(*KEY).agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in KINDS],
        F.count(F.when(F.col("class") == "live", 1)).alias("n_live"),
        F.count(F.when(F.col("class") == "example", 1)).alias("n_example"),
        F.array_sort(F.collect_list(F.struct("start", "rank", "end", place.alias("at")))).alias("all")))
    join = lambda a: F.concat_ws(",", F.transform(a, lambda x: x["at"]))
    per = per.select(*KEY, *[f"n_{k}" for k in KINDS], "n_live", "n_example", join(F.col("all")).alias("spans"),
                     join(F.filter("all", lambda x: x["rank"] < 3)).alias("base"))
    out = left_join(docs.select("doc_id", F.xxhash64("text").alias("text_key")), per, KEY)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select(*KEY, *[zero(f"n_{k}") for k in KINDS],
                      F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
                      F.coalesce("spans", F.lit("")).alias("spans"), zero("n_live"), zero("n_example"))


def redact(docs: DataFrame, mark: str = "[SECRET]", **options) -> DataFrame:
    """docs with every reported value that is not a widely copied example replaced by `mark` (of an
    assignment only the value); n_chars follows where the column exists. All columns stay."""
    found = spans(docs, **options).filter(F.col("class") != "example")
    value = found.select(*KEY, F.when(F.col("kind") == "assign", F.col("end") - F.col("vlen"))
                         .otherwise(F.col("start")).alias("a"), F.col("end").alias("b"))
    # overlapping values become one span: a new one starts where none before reaches
    order = Window.partitionBy(*KEY).orderBy("a", "b")
    reach = F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    merged = (value.withColumn("new", (F.coalesce(reach, F.lit(-1)) < F.col("a")).cast("int"))
              .withColumn("g", F.sum("new").over(order))
              .groupBy(*KEY, "g").agg(F.min("a").alias("a"), F.max("b").alias("b"))
              .groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("_cut")))
    k = merged.select(F.col("doc_id").alias("_k_id"), F.col("text_key").alias("_k_text"), "_cut")
    on = docs["doc_id"].eqNullSafe(k["_k_id"]) & (F.xxhash64(docs["text"]) == k["_k_text"])
    parts = F.transform("_cut", lambda s, i: F.concat(F.substring(
        docs["text"], F.when(i == 0, 1).otherwise(F.get("_cut", i - 1)["b"].cast("int") + 1),
        (s["a"] - F.when(i == 0, 0).otherwise(F.get("_cut", i - 1)["b"])).cast("int")), F.lit(mark)))
    tail = F.substring(docs["text"], F.element_at("_cut", -1)["b"].cast("int") + 1, F.length(docs["text"]))
    text = F.when(F.col("_cut").isNull(), docs["text"]).otherwise(F.concat(F.concat_ws("", parts), tail))
    # the spans grow with the corpus: never a broadcast
    out = docs.join(k.hint("merge"), on, "left").withColumn("_text", text)
    changed = F.col("_cut").isNotNull()
    cols = [F.col("_text").alias("text") if c == "text"
            else F.when(changed, F.length("_text").cast(t)).otherwise(docs[c]).alias(c) if c == "n_chars"
            else docs[c] for c, t in docs.dtypes]
    return out.select(*cols)
