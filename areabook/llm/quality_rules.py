"""Quality rules: a learned decision list over text statistics.

Base rule: fewer than 20 words, or more than 30 % of the words in repeated eight-word
windows, fails. The rest is judged by an ordered list of threshold conjunctions learned
by sequential covering from labelled documents: a rule is grown on two thirds of the
sample by adding the condition of largest information gain, pruned on the last third by
dropping final conditions that do not help, kept if precise enough there, and what it
covers leaves the sample. The list is emitted as one ordered conditional expression.

The classifier is fitted on at most `SAMPLE_ROWS` labelled rows, those of the smallest
seeded hash of doc_id (reruns agree); statistics and verdicts cover all documents. Only
that bounded sample reaches the driver, as numbers.

Edge cases: NULL or empty texts have no words and fail the base rule; repeated documents
get the same verdict each; labels that repeat count once, the lowest quality wins; labels
with a NULL doc_id or quality are ignored; without usable labels the learned list is empty
and only the base rule decides; other columns are ignored."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areabook.llm.textstats import text_stats

SAMPLE_ROWS = 20_000
SEED = 7
MIN_WORDS, MAX_REPEAT = 20, 30
MAX_RULES, MAX_CONDITIONS, MIN_COVER, MIN_PRECISION, CUTS = 12, 4, 5, 0.95, 48


def features() -> dict[str, Column]:
    """Statistics that rules test, from the columns of text_stats."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    b = F.greatest(F.col("n_bytes"), F.lit(1)).cast("double")
    lines = F.greatest(F.col("n_lines"), F.lit(1)).cast("double")
    return {"words": F.col("n_words").cast("double"), "word_length": F.col("word_chars") / n,
            "symbols_per_word": F.col("n_symbols") / n, "bars_per_word": F.col("n_bars") / n,
            "bangs_per_word": F.col("n_bangs") / n, "upper_share": F.col("n_upper") / b,
            "digit_share": F.col("n_digits") / b, "stops_per_word": F.col("n_stops") / n,
            "dup_line_share": F.col("n_dup_lines") / lines, "repeat_share": F.col("n_repeat_words") / n,
            "distinct_share": F.col("n_distinct") / n, "words_per_line": F.col("n_words") / lines}


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def mask(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.cut if self.above else x[self.feature] <= self.cut

    def column(self) -> Column:
        f = features()[self.feature]
        return f > F.lit(self.cut) if self.above else f <= F.lit(self.cut)


Rule = tuple[Condition, ...]


def covers(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    return reduce(np.logical_and, (c.mask(x) for c in rule), np.ones(n, dtype=bool))


def _grow(x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Adds conditions until no good document is covered or nothing gains."""
    rule, inside = [], np.ones(len(bad), dtype=bool)
    while len(rule) < MAX_CONDITIONS:
        p0, n0 = (bad & inside).sum(), (~bad & inside).sum()
        if p0 == 0 or n0 == 0:
            break
        base, best = np.log2(p0 / (p0 + n0)), (0.0, None)
        for name, v in x.items():
            inner = v[inside]
            for cut in np.unique(np.quantile(inner, np.linspace(0, 1, CUTS + 1)[1:-1])):
                for above in (True, False):
                    got = (inner > cut) if above else (inner <= cut)
                    p = (bad[inside] & got).sum()
                    if p < MIN_COVER:
                        continue
                    gain = p * (np.log2(p / got.sum()) - base)
                    if gain > best[0] + 1e-9:
                        best = (gain, Condition(name, above, float(cut)))
        if best[1] is None:
            break
        c = _centred(best[1], x[best[1].feature][inside], bad[inside])
        rule.append(c)
        inside &= c.mask(x)
    return tuple(rule)


def _centred(c: Condition, v: np.ndarray, bad: np.ndarray) -> Condition:
    """The cut moved midway between what it leaves out and nearly all bad documents it covers."""
    sign = 1.0 if c.above else -1.0
    v, cut = sign * v, sign * c.cut
    out, hit = v[v <= cut] if c.above else v[v < cut], v[bad & ((v > cut) if c.above else (v >= cut))]
    if not len(out) or not len(hit):
        return c
    low, high = out.max(), np.quantile(hit, 0.03)
    return Condition(c.feature, c.above, float(sign * (low + high) / 2)) if high > low else c


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    def worth(r: Rule) -> float:
        c = covers(r, x, len(bad))
        return ((bad & c).sum() - (~bad & c).sum()) / max(1, c.sum())
    options = [rule[:k] for k in range(1, len(rule) + 1)]
    return max(options, key=lambda r: (worth(r), -len(r))) if options else rule


def learn(x: dict[str, np.ndarray], bad: np.ndarray, fold: np.ndarray) -> list[Rule]:
    """Decision list for bad documents; fold 0 prunes, the others grow."""
    rules: list[Rule] = []
    left = np.ones(len(bad), dtype=bool)
    while len(rules) < MAX_RULES:
        grow, prune = left & (fold != 0), left & (fold == 0)
        if (bad & grow).sum() < MIN_COVER:
            break
        part = lambda m: {k: v[m] for k, v in x.items()}
        rule = _grow(part(grow), bad[grow])
        if not rule:
            break
        rule = _prune(rule, part(prune), bad[prune])
        hit = covers(rule, x, len(bad)) & left
        held = hit & (fold == 0)
        precise = (bad & hit).sum() >= MIN_PRECISION * hit.sum() and (bad & held).sum() >= MIN_PRECISION * held.sum()
        if not precise or (bad & hit).sum() < MIN_COVER:
            break
        rules.append(rule)
        left &= ~hit
    return rules


def with_stats(docs: DataFrame) -> DataFrame:
    """docs(text, ..) with the columns of text_stats."""
    return docs.withColumn("_s", text_stats("text")).select(*docs.columns, "_s.*")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = SEED) -> list[Rule]:
    """The decision list learned from docs(doc_id, text) with labels(doc_id, quality)."""
    sample = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
              .groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(sample_rows))   # the documented bound
    ids = sample.select(F.col("doc_id").alias("_id"), "quality")
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("_id"))
    names = list(features())
    got = (with_stats(rows.select("doc_id", "text", "quality")).filter(~base_failed())
           .select("doc_id", "quality", *[c.alias(f"f_{k}") for k, c in features().items()])
           .dropDuplicates(["doc_id"] + [f"f_{k}" for k in names])
           .orderBy("doc_id", *[f"f_{k}" for k in names]).limit(2 * sample_rows).toPandas())
    if got.empty:
        return []
    x = {k: got[f"f_{k}"].to_numpy(dtype=float) for k in names}
    fold = np.array([(int(i) * 2654435761 + seed) % 2**32 % 3 for i in got["doc_id"]])
    return learn(x, got["quality"].to_numpy() == 0, fold)


def rule_number(rules: list[Rule]) -> Column:
    """Ordered conditional expression: the number of the first rule that fits, NULL for none."""
    out = None
    for i, rule in enumerate(rules):
        cond = reduce(lambda a, b: a & b, (c.column() for c in rule))
        out = F.when(cond, i) if out is None else out.when(cond, i)
    return F.lit(None).cast("int") if out is None else out


def judge(docs: DataFrame, labels: DataFrame, rules: list[Rule] | None = None, **options) -> DataFrame:
    """One row a document: doc_id, text_key, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, rule (number of the rejecting rule), kept."""
    rules = fit(docs, labels, **options) if rules is None else rules
    s = with_stats(docs.select("doc_id", "text")).withColumn("base_failed", base_failed()).withColumn("rule", rule_number(rules))
    return s.select("doc_id", F.xxhash64("text").alias("text_key"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", "base_failed", "rule", (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"))


def keep(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that pass; all columns of docs, whatever their names."""
    rules = fit(docs, labels, **options)
    s = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), text_stats(docs["text"]).alias("_s"))
    verdict = s.select("_row", "_s.*").filter(~base_failed() & rule_number(rules).isNull())
    return verdict.select("_row.*")
