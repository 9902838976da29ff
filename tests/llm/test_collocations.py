"""Operator 12 against brute force: counts within pieces, cuts, dropped parts, exact scores."""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm import cases
from tremorgrid.llm import collocations
from tremorgrid.llm.collocations import MiningConfig


def brute(rows, cfg):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", cases.lower(text)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for size in range(1, cfg.longest + 1):
                counts.setdefault(lang, Counter()).update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        long = {p: a for p, a in f.items() if len(p) > 1 and a >= cfg.least}
        inside = {q for p, a in long.items() for k in range(2, len(p)) for q in (p[i : i + k] for i in range(len(p) - k + 1)) if 100 * a >= cfg.share * f[q]}
        scored = []
        for p, a in long.items():
            if p not in inside:
                score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, rank, p.decode(), -a, l, r, totals[lang], -score) for rank, (score, a, p, l, r) in enumerate(sorted(scored)[: cfg.top], 1)]
    return sorted(out)


def mined(docs, cfg=MiningConfig()):
    return sorted(tuple(r) for r in collocations.collocations(docs, cfg).collect())


def test_words_and_places():
    words, places = collocations.occurrences(pa.array(["A b,c\td..é f\x1fg", "", " ", "x", "y\nz"], pa.large_string()).slice(0))
    assert words.to_pylist() == ["a", "b", "c", "d", "é", "f\x1fg", "x", "y", "z"]
    steps = [int(b - a) for a, b in zip(places, places[1:])]
    assert [s == 1 for s in steps] == [True, False, True, False, True, False, False, False] and min(steps) >= 1


def test_all_lengths_against_brute_force(spark):
    docs = cases.sample(spark).select("text", "lang").union(cases.rows(spark).select("text", F.lit(None).cast("string").alias("lang")))
    rows = [tuple(r) for r in docs.collect()]
    for cfg in (MiningConfig(), MiningConfig(longest=2, least=3, top=50), MiningConfig(longest=4, least=2, share=80, top=100_000, block_bytes=50_000)):
        got = mined(docs.repartition(5), cfg)
        assert got == brute(rows, cfg) and got


def test_parts_go_and_ties_are_ordered(spark):
    text = "p q r. " * 10 + "p q. " * 10 + "a a a a a a a a a a a a. " + "é z, " * 10 + "z y, " * 10
    cfg = MiningConfig()
    got = mined(spark.createDataFrame([(text, None), (text.upper(), "en")], "text string, lang string"), cfg)
    assert got == brute([(text, None), (text.upper(), "en")], cfg)
    assert {r[2] for r in got if r[0] == "und"} >= {"p q r", "a a a", "é z", "z y"} and ("q r") not in {r[2] for r in got}
    assert ("p q") not in {r[2] for r in got}  # half of its occurrences lie in the longer one


def test_products_beyond_64_bits_are_exact(spark):
    a, l, r = 3_000_000_019, 3_000_000_021, 3_000_000_777
    row = spark.createDataFrame([(a, [l, a], [r, a])], "f long, heads array<long>, tails array<long>")
    got = row.select(collocations._cuts(2).alias("c")).first().c
    assert (got.score, got.k, got.l, got.r) == (10**6 * a * a // (l * r), 1, l, r)


def test_empty_table_and_clashing_names(spark):
    assert collocations.collocations(cases.empty(spark)).count() == 0
    odd = spark.createDataFrame([("a b " * 20, "x", 1, "k", 2, 3)], "text string, lang string, block int, payload string, n int, id int")
    assert mined(odd) == brute([("a b " * 20, "x")], MiningConfig())
