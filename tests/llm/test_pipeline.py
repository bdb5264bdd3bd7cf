"""The pipeline's rows against plain Python, stage by stage."""

import os
from collections import Counter, defaultdict

import duckdb
import pytest

import corpus_pipeline
from areabook.llm import quality_rules, textstats
from areabook.llm.common import table
from tests.conftest import SF_ORACLE as SF
from tests.llm import brute

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def features(text):
    s = dict(zip([x.split()[0] for x in textstats.STATS.split(", ")], textstats.stats_of(text)))
    n, b, lines = max(1, s["n_words"]), max(1, s["n_bytes"]), max(1, s["n_lines"])
    return {"words": s["n_words"], "word_length": s["word_chars"] / n, "symbols_per_word": s["n_symbols"] / n,
            "bars_per_word": s["n_bars"] / n, "bangs_per_word": s["n_bangs"] / n, "upper_share": s["n_upper"] / b,
            "digit_share": s["n_digits"] / b, "stops_per_word": s["n_stops"] / n, "dup_line_share": s["n_dup_lines"] / lines,
            "repeat_share": s["n_repeat_words"] / n, "distinct_share": s["n_distinct"] / n, "words_per_line": s["n_words"] / lines}


def test_run(spark):
    con = duckdb.connect()
    docs = con.sql(f"select doc_id, text, source from read_parquet('{SF}/documents.parquet')").fetchall()
    bench = con.sql(f"select item_id, text from read_parquet('{SF}/benchmark.parquet')").fetchall()
    rules = quality_rules.fit(table(spark, SF, "documents"), table(spark, SF, "labels"))

    def rejected(t):
        f = features(t)
        return any(all(f[c.feature] > c.cut if c.above else f[c.feature] <= c.cut for c in r) for r in rules)
    docs = [d for d in docs if not brute.quality_base(d[1])[5] and not rejected(d[1])]
    first = {r[2] for r in brute.simhash_components([d[:2] for d in docs])}
    docs = [d for d in docs if d[0] in first]
    bad = {r[0] for r in brute.decontaminate([d[:2] for d in docs], bench) if r[5]}
    docs = [d for d in docs if d[0] not in bad]
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == {d for d, _, _ in docs}
    # redacted values are single words here or end one, so sizes stay those of the texts
    size = defaultdict(int)
    taken = Counter()
    for d, t, s in docs:
        assert abs(got[d]["size"] - len(brute.words(t))) <= 0
        size[s] += got[d]["size"]
        taken[s] += got[d].taken
    want = brute.mix_targets(docs)
    for s, (n, target) in want.items():
        assert n == size[s] and abs(taken[s] - target) <= max(3, 0.002 * target)
