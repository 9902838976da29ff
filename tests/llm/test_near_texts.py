"""Near-duplicates by Jaccard similarity against all pairs of shingle sets."""

from __future__ import annotations

import random

import pytest

from tests.llm import cases
from tremorgrid import session
from tremorgrid.llm import near_texts


def shingles(text, width=5):
    w = cases.words(cases.lower(text))
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def similar_components(texts, similarity=0.8):
    sets = [shingles(t) for t in texts]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if min(len(sets[i]), len(sets[j])) >= similarity * max(len(sets[i]), len(sets[j])) and jaccard(sets[i], sets[j]) >= similarity:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(sets))]


def edited(rng, words, share):
    """``words`` with single words replaced until the similarity to the original has fallen to ``share``."""
    out, base = list(words), shingles(" ".join(words))
    while True:
        last = list(out)
        out[rng.randrange(len(out))] = f"new{rng.getrandbits(30)}"
        if jaccard(base, shingles(" ".join(out))) < share:
            return last


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(11)
    texts, pairs = [], []
    for share in (0.8, 0.85, 0.9):
        for _ in range(100):
            words = [f"w{rng.getrandbits(12)}" for _ in range(rng.randrange(120, 400))]  # one edit leaves more than 0.9
            pairs.append((share, len(texts)))
            texts += [" ".join(words), " ".join(edited(rng, words, share))]
            assert texts[-1] != texts[-2]
    return texts, pairs


def test_recall_of_planted_pairs(spark, planted):
    texts, pairs = planted
    rows = near_texts.sketches(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    keys = {r.doc_id: r.set_key for r in rows.collect()}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {(r.a, r.b) for r in near_texts.similar_sets(docs, rows.select("set_key", "bands").distinct()).collect()}
    of_key = {k: d for d, k in keys.items()}
    for a, b in found:  # nothing below the similarity
        assert jaccard(shingles(texts[of_key[a]]), shingles(texts[of_key[b]])) >= 0.8
    recall = {s: sum(tuple(sorted((keys[i], keys[i + 1]))) in found for t, i in pairs if t == s) / 100 for s in (0.8, 0.85, 0.9)}
    print(recall)
    assert recall[0.8] >= 0.85 and recall[0.85] >= 0.95 and recall[0.9] >= 0.98, recall


@pytest.mark.parametrize("leaf", [1 << 20, 300])
def test_groups_of_copies_keep_one(spark, monkeypatch, leaf):
    monkeypatch.setattr(near_texts, "LEAF_VARIANTS", leaf)
    rng = random.Random(5)
    texts = []
    for size in (2, 7, 150):
        words = [f"w{rng.getrandbits(14)}" for _ in range(200)]
        texts += [" ".join(words)] + [" ".join(edited(rng, words, 0.93)) for _ in range(size)] + [" ".join(words).upper()] * size
    texts += [" ".join(f"w{rng.getrandbits(14)}" for _ in range(60)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    roots = similar_components(texts)
    want = sorted(min(i for i, r in enumerate(roots) if r == q) for q in set(roots))
    assert sorted(r.doc_id for r in near_texts.one_of_each(docs).collect()) == want


def test_sample_and_odd_rows(spark):
    sample = cases.sample(spark)
    texts = [(r.doc_id, r.text) for r in sample.collect()]
    roots = similar_components([t for _, t in texts])
    want = sorted(min(d for (d, _), r in zip(texts, roots) if r == q) for q in set(roots))
    assert sorted(r.doc_id for r in near_texts.one_of_each(sample).collect()) == want
    odd = near_texts.one_of_each(cases.rows(spark))
    assert odd.columns == cases.rows(spark).columns
    assert odd.count() == len(set(similar_components([t for _, t in cases.texts()])))
    assert near_texts.one_of_each(cases.empty(spark)).count() == 0


def test_columns_of_any_name(spark):
    names = ["near_row", "near_copy", "set_key", "one", "a", "none"]
    docs = spark.createDataFrame([(1, "a b c d e f", *names), (2, "A b c d e f", *names), (None, None, *names), (None, None, *names)],
                                 f"doc_id long, text string, {', '.join(f'{n} string' for n in names)}")
    got = near_texts.one_of_each(docs)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect()), key=repr) == [(1, "a b c d e f", *names), (None, None, *names)]


@pytest.mark.parametrize("leaf", [1 << 20, 3])
def test_no_link_at_the_threshold_is_left_out(spark, monkeypatch, leaf):
    """Pairs of exactly 0.8, also short ones and those that share a bucket with a third text, and a wide group of near copies."""
    monkeypatch.setattr(near_texts, "LEAF_VARIANTS", leaf)
    rng = random.Random(3)
    new = lambda n: [f"w{rng.getrandbits(40)}" for _ in range(n)]
    texts = []
    for n in (8, 13, 24, 44, 104):  # n - 4 shingles, a quarter more: similarity 0.8
        for _ in range(12):
            base = new(n)
            texts += [" ".join(base), " ".join(base + new((n - 4) // 4))]
    shared = new(30)
    for _ in range(30):  # one passage in many texts, every other one nearly a copy of the one before
        base = shared + new(40)
        texts += [" ".join(base), " ".join(base + new(10))]
    group = new(200)
    texts += [" ".join(edited(rng, group, 0.87)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    roots = similar_components(texts)
    want = sorted(min(i for i, r in enumerate(roots) if r == q) for q in set(roots))
    assert sorted(r.doc_id for r in near_texts.one_of_each(docs).collect()) == want


def test_only_the_result_stays_in_the_shared_folder(spark):
    """Sketches, buckets, shingle sets and links go as soon as nothing reads them any more."""
    before = set(session.folders(spark, session.shared_dir(spark)))
    texts = [f"a b c d e f g h i j {k // 2}" for k in range(40)]
    got = near_texts.one_of_each(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    left = set(session.folders(spark, session.shared_dir(spark))) - before
    assert [name.rsplit("-", 1)[0] for name in left] == ["stays"]
    assert got.count() == len(set(similar_components(texts)))


def test_only_sets_of_candidates_are_shuffled(spark):
    rng = random.Random(17)
    texts = [" ".join(f"w{rng.getrandbits(20)}" for _ in range(12)) for _ in range(300)] + ["", None, "one"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    keys = sorted({r.set_key for r in near_texts.shingle_sets(docs).collect()})
    nodes = spark.createDataFrame([(k,) for k in keys[::10]], "set_key long")
    bits = near_texts._bits(nodes)
    found = {r.set_key for r in near_texts.shingle_sets(docs, bits=bits).collect()}
    assert set(keys[::10]) <= found and len(found) < len(keys) / 4
    assert {r.set_key for r in near_texts._stored_sets(nodes, docs, 5, "doc_id", "text").collect()} == set(keys[::10])
    assert near_texts.shingle_sets(docs, bits=near_texts._bits(nodes.limit(0))).count() == 0


def test_simhash_balls_propose_pairs_and_the_join_adds_the_rest(spark, monkeypatch):
    """The stage takes its first links from fingerprints; what differs in more bits is still linked, what is not similar is not."""
    import corpus_pipeline
    from tremorgrid.llm import simhash

    rng, seen = random.Random(29), []
    texts = []
    for share in (0.98, 0.8):
        for _ in range(15):
            words = [f"w{rng.getrandbits(14)}" for _ in range(rng.randrange(600, 900))]
            texts += [" ".join(words), " ".join(edited(rng, words, share))]
    words = [f"w{rng.getrandbits(14)}" for _ in range(12)]
    texts += [" ".join(words), " ".join(words * 2), " ".join(words * 3)]  # alike in shingles, or nearly
    docs = spark.createDataFrame([(k, t, len(t)) for k, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    rows = near_texts.sketches(docs).collect()
    want = {r.doc_id: r.fp for r in simhash.fingerprints(docs, width=5).collect()}
    assert {r.doc_id: r.fp for r in rows} == want
    bits = lambda a, b: ((want[a] ^ want[b]) & (2**64 - 1)).bit_count()
    key, whole = {r.doc_id: r.set_key for r in rows}, near_texts.ball_verified

    def spied(*args, **options):
        seen.append(whole(*args, **options).collect())
        return whole(*args, **options)

    monkeypatch.setattr(near_texts, "ball_verified", spied)
    got = sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    roots = similar_components(texts)
    assert got == sorted(min(i for i, r in enumerate(roots) if r == q) for q in set(roots))
    close = {tuple(sorted((key[i], key[i + 1]))) for i in range(0, 60, 2) if bits(i, i + 1) <= near_texts.RADIUS}
    far = sum(bits(i, i + 1) > near_texts.RADIUS for i in range(0, 60, 2))
    assert len(seen) == 1 and close <= {(r.a, r.b) for r in seen[0]} and len(close) >= 8 and far >= 8, (len(close), far)
