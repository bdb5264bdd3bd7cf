"""Licence scan by ordered signature rules (built-in functions only).

Texts are normalised to words (A-Z in lower case, all other ASCII characters separate). A document's
distinct words are intersected with the rules' keywords; only rules whose keyword is there run,
and a text with no keyword is never searched. For the search each word carries its number ("mit#4 license#5"),
so a match shows where it starts and ends, in one pass a rule over the whole text.

Rules come in tiers (identifier, grant, name, mention). A match that lies inside a match of a better tier, or inside a
longer one of its own tier, is suppressed; of equal intervals the rule that comes first stays. In
the order of (start, longest first, tier, rule) a match is suppressed exactly if the furthest end so far of its
tier and the better ones reaches its own end, so one pass settles a document. The pass goes over
blocks of matches, so that its arrays are not copied once a match.

What is found is a list of detections a document; nothing is shuffled.

Edge cases: NULL or empty texts have no words and no detections; matches of one rule do not overlap (leftmost first);
repeated rows, NULL ids and ties are ordinary rows; an empty table gives an empty result; other columns are
ignored by `scan` and kept by `detect`."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areabook.llm import license_rules
from areabook.llm.common import ascii_lower

#: Words after A-Z are lower-cased, and the phrases with their labels (fixed by the contract).
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Matches a block of the suppression pass.
BLOCK = 256


def pattern(rule: str) -> str:
    """A rule's pattern over numbered words: each blank also takes the number before it."""
    gap = "#[0-9]+ "
    p = rule.replace(" ?", "\0").replace(" ", gap).replace("\0", f"(?:{gap})?")
    return " " + re.sub(r"<(\d+)>", rf"(?:{gap}[^ #]+){{0,\1}}", p) + "#[0-9]+"


def _rule_table(rules) -> Column:
    return F.array(*[F.struct(F.lit(tier).alias("tier"), F.lit(i).alias("rule"), F.lit(label).alias("label"),
                              F.lit(keyword).alias("keyword"), F.lit(pattern(p)).alias("pattern"))
                     for i, (tier, label, keyword, p) in enumerate(rules)])


def _places(marked: Column, regex: Column) -> Column:
    """(start, end) in words of every match; end exclusive."""
    return F.transform(F.regexp_extract_all(marked, regex, F.lit(0)), lambda m: F.struct(
        F.regexp_extract(m, "#([0-9]+)", 1).cast("int").alias("start"),
        (F.regexp_extract(m, "#([0-9]+)$", 1).cast("int") + 1).alias("end")))


def _unsuppressed(found: Column, tiers: int) -> Column:
    """The detections that no better or longer one contains; `found` is sorted by (start, -end, tier, rule)."""
    def step(state, x):
        hidden = F.get(state["reach"], x["tier"]) >= x["end"]
        reach = F.transform(state["reach"], lambda r, t: F.when((t >= x["tier"]) & (r < x["end"]), x["end"]).otherwise(r))
        return F.struct(reach.alias("reach"), F.when(hidden, state["kept"]).otherwise(
            F.concat(state["kept"], F.array(x))).alias("kept"))

    none = F.filter(found, lambda x: F.lit(False))
    start = F.struct(F.array_repeat(F.lit(0), tiers).alias("reach"), none.alias("kept"))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(found) - 1) / BLOCK).cast("int")),
                         lambda i: F.slice(found, i * BLOCK + 1, F.lit(BLOCK)))
    # the last block's result joins those before it only in the next step: each is copied by reference, not match by match
    whole = F.aggregate(blocks, F.struct(start.alias("last"), F.array(none).alias("done")), lambda s, b: F.struct(
        F.aggregate(b, F.struct(s["last"]["reach"].alias("reach"), none.alias("kept")), step).alias("last"),
        F.concat(s["done"], F.array(s["last"]["kept"])).alias("done")),
        lambda s: F.flatten(F.concat(s["done"], F.array(s["last"]["kept"]))))
    return F.when(F.size(found) > 0, whole).otherwise(found)


def detect(docs: DataFrame, rules=None, text: str = "text") -> DataFrame:
    """docs with `_scan`: n_words, base (label, start, end of the phrases) and detections (start, end, tier, rule, label,
    keyword of the rules that no other detection hides), in the order of their starts."""
    rules = license_rules.rules() if rules is None else list(rules)
    keywords = sorted({k for _, _, k, _ in rules} | {p.split()[0] for p, _ in PHRASES})
    base = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(pattern(p)).alias("pattern")) for p, label in PHRASES])
    words = F.regexp_extract_all(ascii_lower(F.coalesce(F.col(text), F.lit(""))), F.lit(f"({WORD})"), F.lit(1))
    met = F.array_intersect(F.col("_words"), F.array(*[F.lit(k) for k in keywords]))
    marked = F.concat(F.lit(" "), F.array_join(F.transform("_words", lambda w, i: F.concat(w, F.lit("#"), i)), " "))
    found = F.flatten(F.transform(F.filter(_rule_table(rules), lambda r: F.array_contains("_keys", r["keyword"])), lambda r: F.transform(
        _places(F.col("_marked"), r["pattern"]), lambda p: F.struct(
            p["start"].alias("start"), (-p["end"]).alias("order"), r["tier"].alias("tier"), r["rule"].alias("rule"),
            r["label"].alias("label"), p["end"].alias("end")))))
    phrases = F.flatten(F.transform(base, lambda r: F.transform(_places(F.col("_marked"), r["pattern"]), lambda p: F.struct(
        r["label"].alias("label"), p["start"].alias("start"), p["end"].alias("end")))))
    some = F.size("_keys") > 0
    tiers = 1 + max((t for t, *_ in rules), default=0)
    return (docs.withColumn("_words", words).withColumn("_n", F.size("_words").cast("long")).withColumn("_keys", met)
            .withColumn("_marked", F.when(some, marked)).drop("_words")
            .withColumn("_found", F.when(some, F.array_sort(found))).withColumn("_base", F.when(some, phrases))
            .withColumn("_kept", F.when(some, _unsuppressed(F.col("_found"), tiers)))
            .withColumn("_scan", F.struct(F.col("_n").alias("n_words"), F.coalesce("_base", F.array()).alias("base"),
                                          F.coalesce("_kept", F.array()).alias("detections")))
            .drop("_n", "_keys", "_marked", "_found", "_base", "_kept"))


def scan(docs: DataFrame, rules=None) -> DataFrame:
    """One row a document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score (the weight of the best
    tier detected, a phrase counting as a mention), n_detections, detections (label, tier, start, end)."""
    s = detect(docs.select("doc_id", "text"), rules)
    base, kept = F.col("_scan.base"), F.col("_scan.detections")
    labels = lambda a: F.transform(a, lambda x: x["label"])
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    starts = F.transform(base, lambda x: x["start"].cast("long"))
    weights = F.array(*[F.lit(w) for _, w in license_rules.TIERS])
    hit = F.transform(kept, lambda x: F.get(weights, x["tier"]))
    mention = F.when(F.size(base) > 0, F.lit(license_rules.TIERS[-1][1])).otherwise(0.0)
    return s.select("doc_id", F.col("_scan.n_words").alias("n_words"), F.size(base).cast("long").alias("n_base"),
                    F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                    joined(labels(base)).alias("base_labels"), joined(F.concat(labels(base), labels(kept))).alias("labels"),
                    F.greatest(mention, F.coalesce(F.array_max(hit), F.lit(0.0))).alias("score"),
                    F.size(kept).cast("long").alias("n_detections"),
                    F.transform(kept, lambda x: F.struct(x["label"].alias("label"), x["tier"].alias("tier"),
                                                         x["start"].alias("start"), x["end"].alias("end"))).alias("detections"))
