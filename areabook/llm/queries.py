"""Queries of the text operators over the test tables, and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from areabook.llm import (chat, conversation_repair, decontaminate, hard_negatives, license_scan, mixing, pii, quality_rules, rlz_dedup,
                          secrets, simhash, token_scan, url_filter)
from areabook.llm.common import left_join, stager, table

#: Key of the pseudonyms where the session sets none (tests, the check).
PII_KEY_SETTING, PII_TEST_KEY = "spark.areabook.pii.key", "areabook test key"


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get(PII_KEY_SETTING, PII_TEST_KEY)
    return pii.pseudonymise(table(spark, sf_dir, "documents"), key)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key", "containment")


def page_labels(pages: DataFrame, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """labels(doc_id, quality, toxic) as outcomes of the pages whose article has the text of a labelled document."""
    bad = (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    judged = labels.groupBy("doc_id").agg(F.max(bad.cast("int")).alias("bad"))
    texts = docs.select("doc_id", url_filter.text_print(F.col("text")).alias("print"))
    known = texts.join(judged, "doc_id").groupBy("print").agg(F.max("bad").alias("bad"))
    shown = pages.select("page_id", url_filter.text_print(url_filter.article_text(F.col("html"))).alias("print"))
    return shown.join(known, "print").select("page_id", "bad")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.filter_urls(pages, page_labels(pages, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all documents as token files, then counts them from the files alone."""
    st = stager(spark, "tokens")
    folder = f"{st.root}/files"
    written = st.stage(token_scan.write_tokens(table(spark, sf_dir, "documents"), folder), "order")
    counted = token_scan.scan(spark, folder)
    return written.join(counted, ["file", "ordinal"]).select("doc_id", "file", "ordinal", "start", "n_tokens", "complete")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rlz_dedup.dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "times")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents")).drop("text_key")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


#: The conversation that the contract adds (fixed value).
EXTRA_CHAT = [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]


def chat_nodes(conversations: DataFrame) -> DataFrame:
    """conversations(conv_id, turn, role, text) as reply trees: each row answers the one before it."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    n = F.row_number().over(order)
    return (conversations.select("conv_id", "turn", "role", "text").withColumn("node", n.cast("long"))
            .select(F.col("conv_id").alias("tree"), "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
                    "role", "text", F.lit(0.0).alias("score")))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame(EXTRA_CHAT, "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    back = chat.read_back(chat.format_trees(chat_nodes(rows)))
    said = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    loss = F.concat_ws("", "loss_text")
    return back.select(F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(said, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
                       F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("text_key")


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("detections")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose vec_id is divisible by 7 are mislabelled on purpose; anchors are those divisible by 50."""
    rows = hard_negatives.usable(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"), "embedding")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", label.alias("label"), hard_negatives.quantise(F.col("embedding")).alias("vector"))
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations, repaired; a conversation that lost all its rows is empty."""
    rows = table(spark, sf_dir, "conversations")
    done = conversation_repair.repair(conversation_repair.damage(rows))
    out = left_join(rows.select("conv_id").distinct(), done, ["conv_id"])
    return out.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in conversation_repair.FACTS],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_pii, op2_decontaminate, op3_url_filter, op4_token_counts, op5_substring_dedup, op6_mixing,
                                   op7_secret_scan, op8_simhash, op9_chat_format, op10_quality_rules,
                                   op11_license_scan, op12_hard_negatives, op13_conversation_repair, pipeline)}

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_SPACE_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_ITEM_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

def _cell(cell: str, cost: str, edit: str) -> str:
    """A cell of the repair programme is its cost in nine digits and its audit, so text order is (cost, audit)."""
    return f"lpad(cast(cast({cell}[:9] as integer) + {cost} as varchar), 9, '0') || {cell}[10:] || '{edit}'"


def _repair_sql() -> str:
    """Rows one by one through the states 0 start, 1 system, 2 user, 3 assistant, Inserts after every step."""
    keep = lambda s, p: f"case when symbol = '{s}' and not gone then {_cell(p, 'late', 'K')} end"
    role = lambda p: f"case when not gone then {_cell(p, 'late + 2', 'R')} end"
    drop = lambda p: _cell(p, "3", "D")
    to_user = ", ".join(f"{keep('u', p)}, {role(p)}" for p in ("c0", "c1", "c3"))
    ins = lambda p: _cell(p, "2", "I")
    pos = "turn nulls first, role, text"
    return rf"""
with recursive bits(k) as (select unnest(range(8))),
src as (select conv_id, turn, coalesce(role, ' ') role, coalesce(text, ' ') text,
  coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') k from conversations),
fate as (select *, xor(list_reduce(list_transform(string_split(k, ''), lambda z: cast(ascii(z) as bigint)),
  lambda crc, z: list_reduce(range(8), lambda x, i: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end, xor(crc, z)),
  4294967295), 4294967295) % 20 f from src),
hurt as (select conv_id, turn, case when f = 4 then 'user' else role end role,
  case when f = 1 then '' when f = 2 then translate(text, '.!?', '') else text end text,
  unnest(range(case when f = 0 then 0 when f = 3 then 2 else 1 end)) c from fate),
seq as (select *, row_number() over (partition by conv_id order by {pos}) r,
  lag(role) over (partition by conv_id order by {pos}) before, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) said
  from hurt),
place as (select *, row_number() over (partition by conv_id, role, text order by r) nth from seq),
row as (select *, said = '' blank, said <> '' and nth > 1 again,
  said <> '' and nth = 1 and right(said, 1) not in ('.', '!', '?') cut, role[1:1] symbol from place),
fact as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps,
  count(*) filter (where blank) blank, count(*) filter (where again) duplicate, count(*) filter (where cut) truncated,
  count(*) filter (where before is not null and before[1:1] || symbol not in ('su', 'ua', 'au')) illegal, count(*) n from row group by conv_id),
run as (select conv_id, 0::bigint r, '000000000' c0, null::varchar c1, '000000002I' c2, '000000004II' c3 from fact
  union all
  select conv_id, r, c0, c1, least(c2, {ins('c0')}, {ins('c1')}, {ins('c3')}),
    least(c3, {ins('c2')}, {ins(f"(least(c2, {ins('c0')}, {ins('c1')}))")}) from (
    select p.conv_id, w.r, {drop('c0')} c0, least({drop('c1')}, {keep('s', 'c0')}) c1,
      least({drop('c2')}, {to_user}) c2, least({drop('c3')}, {keep('a', 'c2')}, {role('c2')}) c3
    from run p join (select *, blank or again gone, case when cut then 1 else 0 end late from row) w
      on p.conv_id is not distinct from w.conv_id and w.r = p.r + 1)),
last as (select f.*, least(c0, c3) x from fact f join run on f.conv_id is not distinct from run.conv_id and r = n),
edit as (select conv_id, x[10:] audit, unnest(string_split(x[10:], '')) e, generate_subscripts(string_split(x[10:], ''), 1) i from last),
made as (select conv_id, e, i, sum(case when e <> 'I' then 1 else 0 end) over (partition by conv_id order by i) r,
  sum(case when e <> 'D' then 1 else 0 end) over (partition by conv_id order by i) m,
  sum(case when e <> 'D' then 1 else 0 end) over (partition by conv_id) % 2 odd from edit),
said as (select a.conv_id, string_agg(case when e = 'K' then w.role when (m + odd) % 2 = 1 then 'user' else 'assistant' end || ':' ||
    case when e = 'I' then '' else w.text end, chr(10) order by i) t
  from made a left join row w on a.conv_id is not distinct from w.conv_id and a.r = w.r where e <> 'D' group by a.conv_id)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cast(x[:9] as bigint), 0) as cost,
  coalesce(x[10:], '') as audit, sha256(coalesce(t, '')) as repaired_sha256
from (select distinct conv_id from conversations) o left join last on o.conv_id is not distinct from last.conv_id
left join said on o.conv_id is not distinct from said.conv_id"""


#: DuckDB SQL of the queries that SQL can express (the others: tests/llm holds them against plain Python).
ORACLES: dict[str, str] = {
    "op2_decontaminate": f"""
with item as (select coalesce(cast(item_id as varchar), '') item, {_ITEM_WORDS} w from benchmark),
cut as (select item, w, least(13, len(w)) n, unnest(range(1, len(w) - least(13, len(w)) + 2)) i from item where len(w) > 0),
gram as (select distinct item, n, w[i:i + n - 1] g from cut),
doc as (select doc_id, row_number() over () r, {_ITEM_WORDS} w from documents),
size as (select distinct n from gram),
spot as (select r, w, n, unnest(range(1, len(w) - n + 2)) i from doc, size where len(w) >= n),
met as (select r, i, spot.n, item from spot join gram on spot.n = gram.n and w[i:i + spot.n - 1] = g),
hit as (select r, count(*) n_hit from (select distinct r, unnest(range(i, i + n)) p from met) group by r),
held as (select r, count(*) n_items, string_agg(item, ',' order by item) items from (select distinct r, item from met) group by r)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from doc left join hit using (r) left join held using (r)""",
    "op5_substring_dedup": f"""
with doc as (select doc_id, row_number() over () r, {_SPACE_WORDS} w from documents),
spot as (select doc_id, r, i, w[i:i + 12] g from (select doc_id, r, w, unnest(range(1, len(w) - 11)) i from doc where len(w) >= 13)),
low as (select g, min(doc_id) least_id from spot group by g),
gone as (select distinct r, unnest(range(i, i + 13)) p from spot join low using (g) where least_id < doc_id),
word as (select r, unnest(w) x, generate_subscripts(w, 1) p from doc),
kept as (select r, string_agg(x, ' ' order by p) t from word anti join gone using (r, p) group by r),
n as (select r, count(*) n_removed from gone group by r)
select doc_id, len(w) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from doc left join kept using (r) left join n using (r)""",
    "op9_chat_format": r"""
with row as (select conv_id, turn, coalesce(role, '') role, coalesce(text, '') text, role r0, text t0 from conversations
  union all select -7, 0, 'user', x, 'user', x from (select '\### Assistant: </turn> ok' x)
  union all select -7, 1, 'assistant', x, 'assistant', x from (select '\### Assistant: </turn> ok' x)),
said as (select conv_id, count(*) n_turns,
  string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, r0 nulls first, t0 nulls first) said,
  coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn nulls first, r0 nulls first, t0 nulls first), '') loss,
  sum(18 + length(replace(replace(role, '\', '\b'), '<', '\l')) + length(replace(replace(text, '\', '\b'), '<', '\l'))) f
  from row group by conv_id)
select conv_id, n_turns, sha256(said) as turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256,
  cast(f as bigint) as formatted_chars from said""",
    "op12_hard_negatives": """
with fit as (select row_number() over () rid, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
  list_transform(embedding, lambda x: floor(256 * cast(x as double))) v from embeddings
  where label is not null and embedding is not null
  and coalesce(list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x))), true)),
pair as (select a.rid a, a.vec_id anchor_id, a.label = b.label same, b.rid r, b.vec_id, cast(list_inner_product(a.v, b.v) as bigint) s
  from fit a, fit b where a.vec_id % 50 = 0 and a.rid <> b.rid),
pos as (select a, anchor_id, vec_id positive_id, s positive_score, row_number() over (partition by a order by s desc, vec_id nulls last, r) nth
  from pair where same qualify nth <= 5)
select anchor_id, positive_id, cast(row_number() over (partition by a, nth order by s desc, vec_id nulls last, r) as integer) as "rank",
  vec_id as negative_id, positive_score, s as negative_score
from pos join (select a, r, vec_id, s from pair where not same) using (a)
where 50 * positive_score <= 100 * s and 100 * s <= 95 * positive_score qualify "rank" <= 3""",
    "op13_conversation_repair": _repair_sql(),
}
