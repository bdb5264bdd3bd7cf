"""Licence scan, hard negatives and conversation repair against plain Python, and their edge cases."""

import itertools
import random
import re

import pytest

from areabook.llm import conversation_repair as repair
from areabook.llm import hard_negatives as hard
from areabook.llm import license_rules, license_scan
from areabook.llm import queries as Q
from tests.conftest import SF_ORACLE as SF
from tests.llm import brute


def key(r):
    return tuple((x is None, str(x)) for x in r)


def same(got, want):
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, want), key=key)


# ---- licences ------------------------------------------------------------------------------------

NOTICES = ("This file: SPDX-License-Identifier: GPL-2.0-only.", "Licensed under the Apache License, Version 2.0.", "MIT License",
           "Permission is hereby granted, free of charge, to any person obtaining a copy of it", "cc-by 4.0", "CC BY-NC-SA 4.0",
           "the GNU General Public License, version 3", "All rights reserved.", "(c) 2020; © 2021 copyright © 2022", "GPLv3 or later",
           "Creative Commons Attribution-NonCommercial-ShareAlike 4.0", "http://creativecommons.org/licenses/by-sa/3.0/", "mit und", "cc", "by")


def test_rules_are_gated_by_a_word_of_every_match():
    rules = license_rules.rules()
    assert len(rules) > 300 and len(set(rules)) == len(rules)
    assert [t for t, *_ in rules] == sorted(t for t, *_ in rules)
    for _, _, keyword, pattern in rules:
        must = re.sub(r"<\d+>", "", pattern)
        while (less := re.sub(r"\([^()]*\)\?", "", must)) != must:
            must = less
        assert keyword in must.split(), pattern


def test_licenses_against_every_pair_of_matches(spark):
    rng = random.Random(7)
    texts = [" ".join(rng.choices(NOTICES + ("word", "x9", "é"), k=rng.randrange(30))) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rules = license_rules.rules()
    for r in license_scan.scan(docs).collect():
        want = brute.license_detections(texts[r.doc_id], rules)
        assert [(d.start, -d.end, d.tier, d.label) for d in r.detections] == [(s, e, t, lab) for s, e, t, _, lab in want]


def test_license_base_and_labels(spark):
    import duckdb
    docs = duckdb.sql(f"select doc_id, text from read_parquet('{SF}/documents.parquet')").fetchall()
    got = Q.op11_license_scan(spark, SF).collect()
    cols = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    same([[r[c] for c in cols] for r in got], brute.license_base(docs))
    rules, text = license_rules.rules(), dict(docs)
    for r in got:
        found = brute.license_detections(text[r.doc_id], rules)
        assert set(r.labels.split(",")) - {""} == {x[-1] for x in found} | (set(r.base_labels.split(",")) - {""})
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_license_edges(spark):
    rows = [(None, None, 1), (1, "", 1), (1, "All Rights\nRESERVED", 2), (1, "All Rights\nRESERVED", 2), (2, "all rights reserved " * 20000, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _scan int")
    got = license_scan.scan(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "labels", "n_detections").collect()
    same(got, [(None, 0, 0, None, None, "", 0), (1, 0, 0, None, None, "", 0), (1, 3, 1, 0, 0, "reserved", 1), (1, 3, 1, 0, 0, "reserved", 1),
               (2, 60000, 20000, 0, 59997, "reserved", 20000)])
    assert license_scan.scan(docs.limit(0)).count() == 0
    one = license_scan.scan(docs, [(0, "only", "rights", "rights reserved")]).filter("doc_id = 1 and n_base = 1").first()
    assert one.labels == "only,reserved" and one.score == 1.0


# ---- hard negatives ------------------------------------------------------------------------------

def vectors(seed, n, width, span=300):
    rng = random.Random(seed)
    centres = [[rng.randrange(-span, span) for _ in range(width)] for _ in range(4)]
    near = lambda c: [x + rng.randrange(-40, 40) for x in c]
    return [(i, rng.randrange(3), near(rng.choice(centres))) for i in range(n)]


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, label int, vector array<long>, rid int").repartition(3)
    from pyspark.sql import functions as F
    return hard.mine(df, F.col("vec_id") % 10 == 0, **options).collect()


@pytest.mark.parametrize("width", [3, 24])
def test_hard_negatives_against_all_pairs(spark, width):
    rows = vectors(width, 260, width)
    for options in ({}, {"block_rows": 16, "anchor_rows": 3}, {"positives": 2, "negatives": 9, "low": 0, "high": 100}):
        small = {k: v for k, v in options.items() if "rows" not in k}
        same(mined(spark, [(*r, 0) for r in rows], **options), brute.hard_negatives(rows, lambda v: v % 10 == 0, **small))


def test_hard_negative_edges(spark):
    rows = vectors(5, 60, 6) + [(None, 1, [5] * 6), (10, 2, [9] * 6), (10, 2, [9] * 6), (70, 1, []), (80, 1, [3]), (90, 0, [0] * 6), (100, 9, [400] * 6)]
    want = brute.hard_negatives(rows, lambda v: v % 10 == 0)
    got = mined(spark, [(*r, 1) for r in rows])
    # repeated rows are told apart by reading order only, which no result column shows
    same(got, want)
    assert mined(spark, []) == []
    from pyspark.sql import functions as F
    raw = [(1, None, [1.0]), (2, 1, None), (3, 1, [None]), (4, 1, [float("nan")]), (5, 1, [float("inf")]), (6, 1, [0.5, -0.001]), (7, 1, [])]
    df = spark.createDataFrame(raw, "vec_id long, label int, e array<double>")
    assert [(r.vec_id, r.q) for r in hard.usable(df, "e").select("vec_id", hard.quantise(F.col("e")).alias("q")).collect()] == [(6, [128, -1]), (7, [])]


def test_bounds_hold_and_prune(monkeypatch):
    import numpy as np
    rows = vectors(11, 400, 64, 2000)
    v = np.array([r[2] for r in rows])
    means, devs = hard.summaries(v)
    pack = lambda lab: {"x_" + k: w for k, w in {
        "n": 400, "width": 64, "ids": np.arange(400).tobytes(), "nulls": np.zeros(400, bool).tobytes(), "rids": np.arange(400).tobytes(),
        "labels": lab.tobytes(), "vectors": v.astype(np.int32).tobytes(), "means": means.tobytes(), "devs": devs.tobytes(), "extra": None}.items()}
    b, every = hard.Block(pack(np.zeros(400, np.int64)), "x_").prepare(), np.arange(400)
    spread = []
    for level in range(len(hard.WIDTHS)):
        low, _, high = (np.stack(x) for x in zip(*[hard.bounds(b, i, b, level, every) for i in every]))
        assert (low <= v @ v.T).all() and (v @ v.T <= high).all()
        spread.append((high - low).mean())
    assert spread == sorted(spread, reverse=True)
    # vectors whose neighbouring components go together: most pairs are never scored
    smooth = np.cumsum(np.random.default_rng(5).integers(-60, 60, (400, 64)), axis=1)
    v, (means, devs) = smooth, hard.summaries(smooth)
    b = hard.Block(pack(np.zeros(400, np.int64)), "x_").prepare()
    scored, plain = [], hard.exact
    monkeypatch.setattr(hard, "exact", lambda a, i, b, rows: scored.append(len(rows)) or plain(a, i, b, rows))
    got = list(hard.best_positives(b, b, 5))
    assert sum(scored) < 0.4 * 400 * 400
    s = v @ v.T
    np.fill_diagonal(s, -10**12)
    assert [x for _, _, x in got] == np.sort(s, axis=1)[:, :-6:-1].ravel().tolist()


# ---- conversation repair -------------------------------------------------------------------------

def full_cyk(codes):
    """Every span, every split point."""
    n = len(codes)
    cell = {(i, i + 1): repair.terminal(c) for i, c in enumerate(codes)}
    for size in range(2, n + 1):
        for i in range(n - size + 1):
            out = {}
            for m in range(i + 1, i + size):
                for k, v in repair.join(cell[i, m], cell[m, i + size]).items():
                    repair._least(out, k, v)
            cell[i, i + size] = out
    return cell[0, n]


def test_one_split_a_span_is_exact():
    alphabet = "dsuaxSUAX"
    for n in (1, 2, 3):
        for codes in map("".join, itertools.product(alphabet, repeat=n)):
            assert repair.parse(codes) == full_cyk(codes)
    rng = random.Random(3)
    for _ in range(60):
        codes = "".join(rng.choices(alphabet, k=rng.randrange(4, 24)))
        assert repair.parse(codes) == full_cyk(codes)
        spans, at = repair._Spans(), 0
        while at < len(codes):
            step = rng.randrange(1, 6)
            spans.add(at, codes[at:at + step])
            at += step
        cost, audit, borders = spans.close()
        assert (cost, audit) == repair.best(full_cyk(codes))[:2]
        places = [p for p, _, _ in borders] + [len(codes)]
        assert audit == "".join(repair.parse(codes[a:b])[p, q][1] for a, b, (_, p, q) in zip(places, places[1:], borders))


def chats(seed, n, roles=("user", "assistant", "system", "tool", "", None)):
    rng = random.Random(seed)
    said = ["Yes.", "no", "Why?", " \n", "", None, "Oh! ", "é ü.", "a\nb"]
    return [(rng.choice([None, *range(n // 6)]), rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(said)) for _ in range(n)]


def repaired(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, n int, code string")
    return {r.conv_id: tuple(r)[1:] for r in repair.repair(df, **options).collect()}


@pytest.mark.parametrize("chunk", [3, 1024])
def test_repair_against_a_search_from_left_to_right(spark, chunk):
    rows = chats(1, 300) + chats(2, 200, ("user", "assistant", "assistant", "system"))
    rows += [(1000, t, ("user", "assistant")[t % 2], f"Line {t}.") for t in range(400)] + [(1001, 5, "user", "same.")] * 500
    assert repaired(spark, rows, chunk=chunk) == brute.repair(rows)


def test_repair_edges(spark):
    assert repaired(spark, []) == {}
    got = repaired(spark, [(1, None, None, None), (2, 0, "user", "x" * 300_000 + "."), (2, 1, "assistant", "\n"), (None, 7, "user", "Hi.")])
    assert got[1][:-1] == (0, 1, 0, 0, 0, 3, "D")
    assert got[2][:-1] == (0, 1, 0, 0, 0, 5, "KDI") and got[2][-1] == brute.sha("user:" + "x" * 300_000 + ".\nassistant:")
    assert got[None][:-1] == (0, 0, 0, 0, 0, 2, "KI") and got[None][-1] == brute.sha("user:Hi.\nassistant:")


def test_damage(spark):
    import zlib
    rows = chats(4, 400)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = []
    for conv, turn, role, text in rows:
        space = lambda x: " " if x is None else str(x)
        fate, role, text = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20, space(role), space(text)
        if fate:
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            want += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    same(repair.damage(df).collect(), want)
