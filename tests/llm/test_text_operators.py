"""Operators 2, 3, 5, 8, 9 and 10 against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm import cases
from tremorgrid.llm import byte_bpe, decontamination, quality_model, repetition, simhash, text, token_counts
from tremorgrid.llm.queries import QUERIES
from tremorgrid.llm.tables import remainder

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def both(spark):
    return [(r.doc_id, r.text) for part in (cases.rows(spark), cases.sample(spark)) for r in part.collect()]


def union(spark):
    return cases.rows(spark).select("doc_id", "text").union(cases.sample(spark).select("doc_id", "text"))


# --- helpers -----------------------------------------------------------------------------------------------------


def test_xxh64_equals_the_library():
    rng = random.Random(1)
    parts = [bytes(rng.randrange(256) for _ in range(n)) for n in [*range(0, 140), 1000]]
    data = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.array([len(p) for p in parts])
    got = text.xxh64(data, np.cumsum(sizes) - sizes, sizes)
    assert got.tolist() == [xxhash.xxh64_intdigest(p, 42) for p in parts]


def test_segments_join_to_the_text_and_keep_pretokens_whole():
    import regex

    pattern = regex.compile(public_tokenizers.PATTERN)
    rng = random.Random(2)
    alphabet = [" ", " ", "\n", "\t", "a", "B", "1", "'s", "<", "|", "é", " ", " ", "\x1f", "\x1c", "\x85", "!"]
    all_texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(30))) for _ in range(3000)] + [t or "" for _, t in cases.texts()]
    parts, bounds = text.segments(pa.array(all_texts, pa.large_string()))
    parts = parts.to_pylist()
    for k, t in enumerate(all_texts):
        own = parts[bounds[k] : bounds[k + 1]]
        assert "".join(own) == t
        assert [m for p in own for m in pattern.findall(p)] == pattern.findall(t)


# --- 2: simhash --------------------------------------------------------------------------------------------------


def fingerprint(t, width=4):
    w = cases.lower(t)
    w = cases.words(w)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, radius=4):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def test_simhash_components(spark):
    data = both(spark)
    fps = [fingerprint(t) for _, t in data]
    roots = brute_components(fps)
    least = {r: min((d for (d, _), q in zip(data, roots) if q == r and d is not None), default=None) for r in roots}
    want = sorted(((d, f"{f:016x}", least[r]) for (d, _), f, r in zip(data, fps, roots)), key=repr)
    assert cases.ordered(simhash.near_duplicates(union(spark)), "doc_id", "fingerprint", "component_id") == want
    assert simhash.near_duplicates(cases.empty(spark)).count() == 0


@pytest.mark.parametrize("leaf", [1 << 20, 500])
def test_links_find_chains_and_dense_groups(spark, monkeypatch, leaf):
    monkeypatch.setattr(simhash, "LEAF_VARIANTS", leaf)
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(150)}
    chain = rng.getrandbits(64)
    for _ in range(25):  # each four bits from the one before
        for b in rng.sample(range(64), 4):
            chain ^= 1 << b
        fps.add(chain)
    centre = rng.getrandbits(64)
    fps |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(3))) for _ in range(120)}
    far = rng.getrandbits(64)
    fps |= {far, far ^ 0b11111}  # five bits: no link
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"))
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    roots = brute_components(fps)
    want = {}
    for r in set(roots):
        group = [s for s, q in zip(signed, roots) if q == r]
        if len(group) > 1:
            want |= {s: min(group) for s in group}
    assert got == want


def test_one_of_each_keeps_columns(spark):
    kept = simhash.one_of_each(cases.rows(spark))
    assert kept.columns == cases.rows(spark).columns
    roots = brute_components([fingerprint(t) for _, t in cases.texts()])
    assert kept.count() == len(set(roots))  # rows of one id and different texts are different rows


# --- 3: byte-level BPE -------------------------------------------------------------------------------------------


def test_byte_bpe_round_trip(spark):
    import tiktoken

    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(RANKS), special_tokens={})
    want = []
    for d, t in both(spark):
        ids = plain.encode_ordinary(t or "")
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    got = byte_bpe.encode(union(spark), RANKS, public_tokenizers.PATTERN)
    assert cases.ordered(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    back = byte_bpe.decode(byte_bpe.encode(cases.rows(spark), RANKS, public_tokenizers.PATTERN), RANKS)
    assert sorted(bytes(r.decoded) for r in back.collect()) == sorted((t or "").encode() for _, t in cases.texts())
    assert byte_bpe.encode(cases.empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0


# --- 5: token counts ---------------------------------------------------------------------------------------------


def test_token_counts(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    want = [(d, len((t or "").encode()), n, n > 512) for d, t in both(spark) for n in [len(plain.encode(t or "", add_special_tokens=False))]]
    assert cases.ordered(token_counts.token_counts(union(spark), path), "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=repr)
    assert token_counts.token_counts(cases.empty(spark), path).count() == 0


# --- 8: decontamination ------------------------------------------------------------------------------------------

PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_hits(docs, items, size=10):
    windows = {}
    for item, t in items:
        w = PLAIN.findall(cases.lower(t))
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for d, t in docs:
        w, hit, found = PLAIN.findall(cases.lower(t)), set(), set()
        for s in sizes:
            for i in range(len(w) - s + 1):
                if (own := windows.get(tuple(w[i : i + s]))) is not None:
                    hit |= set(range(i, i + s))
                    found |= own
        out.append((d, len(w), len(hit), sorted(x for x in found if x is not None)))
    return sorted(out, key=repr)


def test_contamination(spark):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"
    items = [(1, passage), (2, passage), (2, "epsilon zeta"), (3, None), (4, ""), (5, "café 東京"), (6, "lazy"), (None, passage), (7, "w0 w1 w4 w9 w16 w25 w36"),
             (8, " ".join(["the cat sat on the mat and"] * 4))]
    extra = [(100, f"start {passage} {passage.upper()}! end"), (101, passage.replace(" ", "...")), (102, passage[:60]), (103, "epsilon, ZETA"), (100, f"start {passage} {passage.upper()}! end")]
    bench = spark.createDataFrame(items, "item_id long, text string").union(spark.read.parquet(f"{cases.SF}/benchmark.parquet").select("item_id", "text"))
    docs = union(spark).union(spark.createDataFrame(extra, "doc_id long, text string"))
    want = brute_hits(both(spark) + extra, [(r.item_id, r.text) for r in bench.collect()])
    got = decontamination.contamination(docs, bench).withColumn("item_ids", F.array_sort("item_ids"))
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in got.collect()), key=repr) == want
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contamination(cases.rows(spark), nothing).where("n_hit > 0").count() == 0
    assert decontamination.contamination(cases.empty(spark), bench).count() == 0
    clean = decontamination.clean_of(docs, bench)
    assert clean.count() == sum(h == 0 for _, _, h, _ in want)


# --- 9: quality rules --------------------------------------------------------------------------------------------


def brute_repetition(t):
    w = cases.words(t)
    lines = [x for x in (t or "").split("\n") if cases.WORDS.search(x)]
    seen = {}
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i : i + 5]), []).append(i)
    repeat = {k for v in seen.values() if len(v) > 1 for i in v for k in range(i, i + 5)}
    symbols = sum(c in "#*$%&|<>" for c in t or "")
    failed = len(w) < 10 or 100 * len(repeat) > 20 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(repeat), failed


def test_quality_rules_base(spark):
    want = sorted(((d, *brute_repetition(t)) for d, t in both(spark)), key=repr)
    got = repetition.quality_rules(union(spark))
    assert cases.ordered(got, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == want
    assert got.where("base_failed and kept").count() == 0
    assert repetition.quality_rules(cases.empty(spark)).count() == 0


@pytest.mark.parametrize("seed", range(40))
def test_repeat_lengths(seed):
    rng = random.Random(seed)
    parts = [[rng.randrange(rng.choice([1, 2, 3, 30])) for _ in range(rng.randrange(1, 60))] for _ in range(rng.randrange(1, 6))]
    if seed % 3 == 0:
        parts.append(parts[0] + [99] + parts[0])
    want = []
    for p in parts:
        for i in range(len(p)):
            best = 0
            for j in range(len(p)):
                n = 0
                while i != j and max(i, j) + n < len(p) and p[i + n] == p[j + n]:
                    n += 1
                best = max(best, n)
            want.append(best)
    codes, bounds = np.array([x for p in parts for x in p]), np.cumsum([0, *map(len, parts)])
    assert repetition.repeat_lengths(codes, bounds).tolist() == want
    short = repetition.repeat_lengths(codes, bounds, depth=8)  # told apart up to eight words
    assert short.tolist() == [min(x, 8) for x in want]


def test_repeats_longer_than_1024_words_have_their_length():
    codes = np.tile(np.arange(1500), 2)
    assert repetition.repeat_lengths(codes, np.array([0, 3000])).max() == 1500


def test_quality_rules_method_verdict(spark):
    rng = random.Random(5)
    fresh = lambda n: " ".join(f"{rng.getrandbits(40):x}" for _ in range(n))
    block = fresh(120)
    rows = [(1, fresh(2000)), (2, f"{fresh(800)} {block} {fresh(800)} {block}"), (3, fresh(40) + " " + block[:80])]
    got = {r.doc_id: r for r in repetition.quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].kept and got[3].kept
    assert not got[2].base_failed and not got[2].kept and got[2].longest_repeat == 120 and got[2].covered_words == 240


# --- 10: quality model -------------------------------------------------------------------------------------------


def test_quality_model_learns_and_takes_odd_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    known = labels.where(remainder(F.col("doc_id"), 4) != 2).select("doc_id", F.col("quality").alias("label"))
    scores = quality_model.quality_scores(docs, known)
    held = scores.join(labels.where(remainder(F.col("doc_id"), 4) == 2), "doc_id").select("score", "quality").collect()
    good, bad = ([r.score for r in held if r.quality == q] for q in (1, 0))
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    assert auc > 0.9
    odd = quality_model.quality_scores(cases.rows(spark), known.limit(50)).collect()
    assert len(odd) == len(cases.texts()) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in odd)
    assert quality_model.quality_scores(cases.empty(spark), known.limit(0)).count() == 0


def test_training_separates_and_repeats():
    cfg = quality_model.QualityConfig(buckets=8, width=3, epochs=40, rate=0.5)
    rows = [(1, np.array([0, 1], np.int32), np.array([1, 1], np.float32)), (0, np.array([2, 3], np.int32), np.array([1, 3], np.float32))]
    odds, bias = quality_model.train(rows, cfg)
    assert (odds[[0, 1]] + bias > 0).all() and (odds[[2, 3]] + bias < 0).all()
    assert np.allclose(quality_model.train(rows, cfg)[0], odds)


def brute_features(text, cfg):
    """Hashed features of all words and repeats, one by one."""
    words, found, mask = cases.words(text), Counter(), (1 << 64) - 1
    for k, word in enumerate(words):
        raw = word.encode()
        found[xxhash.xxh64_intdigest(raw, 1) % cfg.buckets] += 1
        marked = b"<" + raw + b">"
        for start in range(len(marked)):
            rolled = 0
            for n, byte in enumerate(marked[start : start + cfg.longest], 1):
                rolled = (rolled + byte + 1) * 0x9E3779B185EBCA87 & mask
                rolled ^= rolled >> 29
                if n >= cfg.shortest:
                    found[((rolled * 0xC2B2AE3D27D4EB4F & mask) >> 40) % cfg.buckets] += 1
        found[cfg.buckets] += k > 0 and words[k - 1] == word
    return +found


def test_quality_features_and_scores_against_brute_force(spark):
    cfg = quality_model.QualityConfig(buckets=4096, epochs=3, max_labelled=30)
    rows = [(i, t) for i, t in cases.texts() if len(t or "") < 20_000] + [(r.doc_id + 50, r.text) for r in cases.sample(spark).where("doc_id < 60").collect()] + [(20, "so so so good good"), (20, "another of that id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    marks = [(i, i % 2) for i in [*range(1, 17), 20, *range(50, 110)]] + [(20, 1), (None, 1), (5, None), (6, 3), (900, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, label int")
    got = quality_model.labelled_features(docs, labels.where("doc_id is not null and label in (0, 1)"), cfg)
    own = [dict(zip(ids.tolist(), counts.astype(int).tolist())) for _, ids, counts in got]
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append(t)
    pairs = [(y, dict(brute_features(t, cfg))) for i, y in marks if i is not None and y in (0, 1) for t in texts.get(i, [])]
    assert 0 < len(got) <= cfg.max_labelled and all((y, f) in pairs for (y, _, _), f in zip(got, own))
    odds, bias = quality_model.train(got, cfg)
    positive = sum(y for y, _, _ in got)
    prior = np.log((positive + 1) / (len(got) - positive + 1))
    want = []
    for i, t in rows:
        f = brute_features(t, cfg)
        heard = sum(f.values())
        logit = (bias * heard + sum(n * float(odds[k]) for k, n in f.items()) + cfg.prior_features * prior) / max(1, heard + cfg.prior_features)
        want.append((i, round(1 / (1 + np.exp(-logit)), 6)))
    scored = quality_model.quality_scores(docs, labels, cfg)
    assert sorted(((r.doc_id, round(r.score, 6)) for r in scored.collect()), key=repr) == sorted(want, key=repr)


def test_quality_texts_are_not_shuffled(spark, monkeypatch):
    plans, limit = [], type(spark.range(1)).limit
    monkeypatch.setattr(type(spark.range(1)), "limit", lambda df, n: plans.append(df._jdf.queryExecution().toString()) or limit(df, n))
    QUERIES["op10_quality_model"](spark, cases.SF)
    assert plans and not any("SortMergeJoin" in p or "hashpartitioning" in p for p in plans)
