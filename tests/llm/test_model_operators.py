"""Operators 1, 4, 6 and 7 and the pipeline against brute force."""

from __future__ import annotations

import hashlib
import math
import re
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import cases
from tests.llm.test_near_texts import similar_components
from tests.llm.test_text_operators import brute_hits, brute_repetition
from tremorgrid.llm import byte_bpe, decontamination, language, language_model, pii, repetition, simhash, training_order
from tremorgrid.llm.queries import QUERIES
from tremorgrid.llm.tables import remainder

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def union(spark):
    return cases.rows(spark).select("doc_id", "text").union(cases.sample(spark).select("doc_id", "text"))


def plain_encoding():
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(RANKS), special_tokens={})


# --- 1: language -------------------------------------------------------------------------------------------------


def test_language_of_documents_and_pages(spark):
    found = QUERIES["op1_language"](spark, cases.SF).collect()
    docs = {r.doc_id: r.lang for r in cases.sample(spark).collect()}
    assert len(found) == len(docs) + spark.read.parquet(f"{cases.SF}/pages.parquet").count()
    assert np.mean([r.lang == docs[r.doc_id] for r in found if r.doc_id is not None]) > 0.97
    pages = [r for r in found if r.page_id is not None]
    assert np.mean([r.lang == r.declared for r in pages if r.declared]) > 0.8
    assert all(0 < r.probability <= 1 for r in found)


def test_fusion_equals_brute_force(spark):
    cfg = language.LanguageConfig()
    labelled = cases.sample(spark).select("text", "lang")
    rows = language.page_rows(spark.createDataFrame([
        (1, "https://a.site.de/x", "<html lang='de'><body>und der</body></html>"), (2, "https://a.site.de/y", "<html><p>ver und ist</p>"),
        (3, "https://b.site.de/z", None), (4, None, "the and <script>if (a<b) und der</script>"), (5, "http://c.site.com", "<HTML LANG=\"fr-CA\">le"),
        (5, "http://c.site.com", "<HTML LANG=\"fr-CA\">le"), (None, "", ""), (6, "nonsense", "<<<<")], "page_id long, url string, html string"))
    names, model = language.text_model(labelled, cfg)
    texts = language.text_evidence(rows, names, model, cfg).collect()
    share = [np.exp(np.array(r.says) - max(r.says)) / np.exp(np.array(r.says) - max(r.says)).sum() for r in texts]
    n = {}
    for r, p in zip(texts, share):
        for key in (("host", r.host), ("site", r.site, r.suffix), ("suffix", r.suffix), "all", ("declared", r.declared)):
            n[key] = n.get(key, 0) + p
    every = (n["all"] + 1 / len(names)) / (n["all"].sum() + 1)
    down = lambda c, p: (c + cfg.prior_weight * p) / (c.sum() + cfg.prior_weight)
    want = []
    for r, p in zip(texts, share):
        prior = down(np.maximum(n[("host", r.host)] - p, 0), down(n[("site", r.site, r.suffix)], down(n[("suffix", r.suffix)], every)))
        logs = np.array(r.says) + np.log(prior)
        if r.declared:
            logs += np.log((np.maximum(n[("declared", r.declared)] - p, 0) + cfg.declared_weight * every) / every)
        post = np.exp(logs - logs.max()) / np.exp(logs - logs.max()).sum()
        want.append((r.page_id, r.host, r.declared, names[int(post.argmax())], round(float(post.max()), 9)))
    got = [(r.page_id, r.host, r.declared, r.lang, round(r.probability, 9)) for r in language.identified(rows, labelled).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {r.declared for r in texts} == {"de", "fr", ""} and {r.suffix for r in texts} >= {"de", "com", ""}


def test_host_prior_and_declaration_decide_short_texts(spark):
    labelled = spark.createDataFrame([("the and of with that", "en"), ("und der die mit ist", "de")], "text string, lang string")
    german = [(i, f"http://host.example.org/{i}", "<html lang=de>und der die mit und der die ist</html>") for i in range(40)]
    rows = language.page_rows(spark.createDataFrame([*german, (100, "http://host.example.org/x", "<html>xyz</html>"), (101, "http://else.example.net/", "<html lang=de>xyz</html>"),
                                                     (102, "http://else.example.net/", "the and of with that " * 4)], "page_id long, url string, html string"))
    got = {r.page_id: r.lang for r in language.identified(rows, labelled).collect()}
    assert got[100] == "de" and got[101] == "de" and got[102] == "en"


def test_language_takes_odd_rows(spark):
    rows = language.document_rows(cases.rows(spark))
    assert language.identified(rows, cases.rows(spark).select("text", "lang")).count() == len(cases.texts())
    assert language.identified(language.document_rows(cases.empty(spark)), cases.sample(spark).select("text", "lang")).count() == 0
    assert language.identified(rows, cases.empty(spark).select("text", "lang")).where("lang is not null").count() == 0
    with pytest.raises(ValueError):
        language.text_model(cases.sample(spark).select("text", "lang"), language.LanguageConfig(max_languages=2))


# --- 4: language model -------------------------------------------------------------------------------------------


def test_lm_base_scores(spark):
    data = [(r.doc_id, r.text) for r in union(spark).collect()]
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in data]
    counts = Counter(w for (_, t), h in zip(data, held) if not h for w in [*cases.words(cases.lower(t)), None])
    n, v = sum(counts.values()), len(counts)
    want = []
    for (d, t), h in zip(data, held):
        tokens = [*cases.words(cases.lower(t)), None]
        want.append((d, h, len(tokens), sum(counts[w] > 0 for w in tokens), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens), 5)))
    cfg = language_model.LMConfig(chunk_bytes=1 << 18)  # several chunks
    got = language_model.lm_scores(union(spark), cfg, held_out=remainder(F.col("doc_id"), 7) == 2).collect()
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert language_model.lm_scores(cases.empty(spark)).count() == 0
    only_held = language_model.lm_scores(cases.rows(spark), held_out=F.lit(True)).collect()
    assert len(only_held) == len(cases.texts()) and all(r.train_tokens == 0 and r.n_known == 0 for r in only_held)


def test_lm_beats_its_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    row = language_model.lm_scores(docs, held_out=remainder(F.col("doc_id"), 7) == 2).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert row.s > row.b


def test_lm_probabilities_sum_to_one():
    cfg = language_model.LMConfig()
    rng = np.random.default_rng(1)
    model = language_model.Softmaxes([rng.normal(size=(cfg.class_rows, cfg.classes)).astype(np.float32), rng.normal(size=(cfg.place_rows, cfg.slots)).astype(np.float32)], cfg)
    before = np.array([37, 5, 900])
    every = np.arange(cfg.classes * cfg.slots)
    tokens = np.concatenate([np.concatenate([before, [p]]) for p in every])
    edges = np.arange(0, len(tokens) + 1, 4)
    logs = model.log_probability(language_model._features(tokens, edges, cfg), tokens)
    assert np.exp(logs[3::4]).sum() == pytest.approx(1, abs=1e-4)


def test_lm_step_follows_the_gradient():
    cfg = language_model.LMConfig(rate=0.01)
    shapes = [(cfg.class_rows, cfg.classes), (cfg.place_rows, cfg.slots)]
    model = language_model.Softmaxes([np.zeros(s, np.float32) for s in shapes], cfg)
    rng = np.random.default_rng(2)
    tokens, edges = rng.integers(0, 40, 500), np.array([0, 200, 500])
    features = language_model._features(tokens, edges, cfg)
    before = model.log_probability(features, tokens).sum()
    for _ in range(5):
        model.step(features, tokens)
    assert model.log_probability(features, tokens).sum() > before


# --- 6: training order -------------------------------------------------------------------------------------------


def test_lm_learns_from_the_third_word_before():
    cfg = language_model.LMConfig()
    rng = np.random.default_rng(4)
    model = language_model.Softmaxes([np.zeros((cfg.class_rows, cfg.classes), np.float32), np.zeros((cfg.place_rows, cfg.slots), np.float32)], cfg)
    texts = rng.integers(0, 30, (4000, 4))
    texts[:, 3] = (7 * texts[:, 0] + 3) % 30  # told by the third word before alone
    tokens, edges = texts.ravel(), np.arange(0, 16001, 4)
    features = language_model._features(tokens, edges, cfg)
    for _ in range(20):
        model.step(features, tokens)
    assert model.log_probability(features, tokens)[3::4].mean() > np.log(0.5)
    one, other = (language_model._features(np.array([x, 2, 3, 4]), np.array([0, 4]), cfg) for x in (7, 8))
    assert sum(f[3] != g[3] for f, g in zip(one, other)) == 2  # the three-word n-gram and the skip


def test_lm_run_sums():
    rng = np.random.default_rng(6)
    values, at, heads = rng.normal(size=(50, 32)).astype(np.float32), rng.integers(0, 50, 300), np.array([0, 1, 2, 150, 151, 299])
    np.testing.assert_allclose(language_model._run_sums(values, at, heads), np.add.reduceat(values[at], heads, axis=0), rtol=1e-4, atol=1e-4)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 16, 17, 1000, 4097])
def test_permutation(n):
    for key in (1, 99):
        p = training_order.permuted(np.arange(n), n, key)
        assert sorted(p.tolist()) == list(range(n))
        assert (training_order.permuted(p, n, key, back=True) == np.arange(n)).all()
    if n > 100:
        assert (training_order.permuted(np.arange(n), n, 1) != training_order.permuted(np.arange(n), n, 99)).mean() > 0.9


def test_shards_hold_every_sequence(spark):
    core, length, end = plain_encoding(), 64, 50256
    manifest, folder, layout = training_order.write_training_order(union(spark), RANKS, public_tokenizers.PATTERN, end, key=5, length=length, shard_bytes=10_000)
    want = Counter()
    for r in union(spark).collect():
        ids = [*core.encode_ordinary(r.text or ""), end]
        for k in range(0, len(ids), length):
            own = ids[k : k + length]
            want[(r.doc_id, k // length, len(own), tuple(own + [end] * (length - len(own))))] += 1
    stored = {r.slot: tuple(r.ids) for r in training_order.read_slots(spark, folder, layout).collect()}
    rows = manifest.collect()
    hashed = {r.slot: r.sha256 for r in training_order.read_slots(spark, folder, layout, hashes=True).collect()}
    assert hashed == {s: hashlib.sha256(np.array(x, "<u2").tobytes()).hexdigest() for s, x in stored.items()}
    assert sorted(r.slot for r in rows) == list(range(layout["sequences"])) == sorted(stored)
    assert Counter((r.doc_id, r.seq, r.n_tokens, stored[r.slot]) for r in rows) == want
    assert layout["shards"] > 3
    files = {int(re.search(r"shard=(\d+)", str(p))[1]): p for p in Path(folder.removeprefix("file:")).glob("shard=*/part-*")}
    assert sorted(files) == list(range(layout["shards"]))
    for r in rows[:50]:  # a record is where the layout says
        raw = files[r.shard].read_bytes()
        assert len(raw) % layout["stride"] == 0
        assert tuple(np.frombuffer(raw[r.byte_offset : r.byte_offset + 2 * length], "<u2").tolist()) == stored[r.slot]
    first, last = layout["slots_per_shard"] - 3, layout["slots_per_shard"] + 5  # reading resumes inside a shard
    assert {r.slot: tuple(r.ids) for r in training_order.read_slots(spark, folder, layout, first, last).collect()} == {s: stored[s] for s in range(first, last)}
    empty, _, none = training_order.write_training_order(cases.empty(spark), RANKS, public_tokenizers.PATTERN, end, key=5)
    assert empty.count() == 0 and none["shards"] == 0


# --- 7: personal data --------------------------------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits)))
    return total % 10 == 0


def brute_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")) or kind == "card" and 14 <= len(digits) <= 19 and luhn(digits)
                    or kind == "phone" and 10 <= len(digits) <= 15):
                out.append((m.start(), k, m.end(), kind))
    return sorted(out)


ODD = [
    "a@b.c%x@d.e, a@b, @x.y a@b..c x@y.z@w.v", "1.2.3.4.5.6.7.8 001.002.003.255 256.1.1.1 1.2.3.4567 0000000001.1.1.1", "4111-1111 1111-1111 4111  1111 1111 1111",
    "+1 (555) 010-9999) +12 +1..2 ++49 30 1234567-8 +1234567890123456", "é🙂 jo@ex.org 🙂+44 20 7946 0958.", "4111111111111111 5500005555555559 41111111111111111111",
    "1 2 3 4 5 6 7 8 9 0 " * 500, "x" * 2000 + "@" + "y" * 2000, "9" * 3000, "." * 1000 + "a.b@c.d", "+1 " * 1000, "10.0.0.1" * 50, "4 2 2 2 2 2 2 2 2 2 2 2 2 2"]


def test_base_spans(spark):
    docs = union(spark).union(spark.createDataFrame(list(enumerate(ODD, 1000)), "doc_id long, text string"))
    want = sorted(((r.doc_id, brute_spans(r.text)) for r in docs.collect()), key=repr)
    got = pii.personal_data(docs).collect()
    assert sorted(((r.doc_id, [(s.start, s.rank - 1, s.end, s.kind) for s in r.spans if s.base]) for r in got), key=repr) == want
    assert pii.personal_data(cases.empty(spark)).count() == 0


def test_patterns_find_unseen_identifiers(spark):
    seeds = [(i, f"Some words first. Please write to user{i}@mail.example.com when done, item {i}7b of it.") for i in range(30)]
    cards = [(100 + i, f"was charged on card {n} last week") for i, n in enumerate(["4111111111111111", "5500005555555559", "340000000000009", "6011000000000004", "30000000000004"])]
    unseen = [(200, "He said: please write to jane(at)mail-example7, she answers."), (201, "was charged on card XXXX-1234-9876 last week"), (202, "room 12345 of building 98765a is closed"),
              (203, "again jane(at)mail-example7 in another place")]
    rows = spark.createDataFrame([*seeds, *cards, *unseen], "doc_id long, text string")
    got = {r.doc_id: [(s.kind, unseen_text[s.start : s.end]) for s in r.spans if not s.base] for r in pii.personal_data(rows).collect()
           for unseen_text in [dict([*seeds, *cards, *unseen])[r.doc_id]]}
    assert got[200] == [("email", "jane(at)mail-example7")] and got[203] == got[200]
    assert got[201] == [("card", "XXXX-1234-9876")]
    assert not got[202] and not any(got[i] for i, _ in seeds)


def test_patterns_see_words_beside_other_numbers(spark):
    seeds = [(i, f"user {i} phone +1 555 010 {i}77 {'abcdefghijkl'[i % 12]}") for i in range(10, 40)]
    long, far = "x7" * 40, "555-0100-" + "8" * 3
    unseen = [(200, "user 12 phone 555-0100-77 7"), (201, f"user 12 phone {long}"), (202, f"{'w' * 3000} 55 phone {far}")]
    rows = spark.createDataFrame([*seeds, *unseen], "doc_id long, text string")
    got = {r.doc_id: [s for s in r.spans if not s.base] for r in pii.personal_data(rows).collect()}
    texts = dict(unseen)
    assert [[texts[i][s.start : s.end] for s in got[i]] for i in texts] == [["555-0100-77"], [long], [far]]
    assert all(s.kind == "phone" for i in texts for s in got[i]) and not any(got[i] for i, _ in seeds)


def test_bootstrap_runs_until_nothing_is_added(spark):
    names = ["alpha", "bravo", "carol", "delta", "eagle", "frost"]
    rows = [f"alpha holds a{'bcdefghijklmnopqrstuvwxyz'[i]}@mail.example.com" for i in range(25)]
    rows += [f"{names[level + k]} holds {names[level]}-{i}zz9" for level in range(5) for k in (0, 1) for i in range(6)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: [s.kind for s in r.spans if not s.base] for r in pii.personal_data(docs, pii.Bootstrap(unknown=0.1)).collect()}
    assert all(got[i] == ["email"] for i in range(25, len(rows)))


def test_masked_texts(spark):
    docs = cases.rows(spark).union(spark.createDataFrame([(1000 + i, t, *[None] * 10) for i, t in enumerate(ODD)], cases.SCHEMA))
    got = pii.masked(docs)
    assert got.columns == docs.columns and got.count() == docs.count()
    spans = {(r.doc_id, r.text_key): [s for s in r.spans] for r in pii.personal_data(docs).collect()}
    keys = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("k")).collect()
    assert sorted((r.text or "" for r in got.collect())) == sorted(mask(r.text, spans[(r.doc_id, r.k)]) or "" for r in keys)


def test_masked_keeps_columns_of_any_name(spark):
    names = ["_text_key", "masked_key", "masked_spans", "masked_of", "masked_id", "masked_blocks", "spans", "start"]
    docs = spark.createDataFrame([(1, "to a@b.cd", *names), (None, None, *names)], f"doc_id long, text string, {', '.join(f'{n} string' for n in names)}")
    got = {r.doc_id: r for r in pii.masked(docs).collect()}
    assert got[1].text == "to [EMAIL]" and got[None].text is None
    assert all(tuple(r)[2:] == tuple(names) for r in got.values())


def test_filters_keep_columns_of_any_name(spark):
    names = ["_text_key", "simhash_key", "simhash_copy", "simhash_stay_id", "clean_key", "clean_hit_id", "_stay_key", "_copy"]
    item = " ".join(f"w{k}" for k in range(12))
    docs = spark.createDataFrame([(1, "one two three four five six", *names), (2, "one two three four five six", *names), (3, item, *names), (None, None, *names)],
                                 f"doc_id long, text string, {', '.join(f'{n} string' for n in names)}")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    clean, one = decontamination.clean_of(docs, items), simhash.one_of_each(docs, width=5)
    assert clean.columns == one.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {1, 2, None} and {r.doc_id for r in one.collect()} == {1, 3, None}
    assert all(tuple(r)[2:] == tuple(names) for df in (clean, one) for r in df.collect())


def test_language_rows_with_nulls_stay(spark):
    labelled = spark.createDataFrame([("the and of with that", "en"), ("und der die mit ist", "de")], "text string, lang string")
    rows = spark.createDataFrame([(1, None, "und der", None, None, None, None), (2, None, None, None, "h", None, "de"), (None, None, "the", "en", None, None, None)],
                                 "doc_id long, page_id long, text string, declared string, host string, site string, suffix string")
    got = {r.doc_id: r for r in language.identified(rows, labelled).collect()}
    assert set(got) == {1, 2, None} and got[1].host == "" and got[1].lang == "de"


def test_masked_pieces_beyond_one_block(spark):
    text = ("é🙂" * 3000 + " a@b.cd ") * 3 + "x" * pii.BLOCK + " 10.0.0.1"
    docs = spark.createDataFrame([(1, text), (2, "a@b.cd"), (3, "y" * (2 * pii.BLOCK) + " a@b.cd")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.masked(docs).collect()}
    assert got == {1: text.replace("a@b.cd", "[EMAIL]").replace("10.0.0.1", "[IP]"), 2: "[EMAIL]", 3: "y" * (2 * pii.BLOCK) + " [EMAIL]"}


def test_time_is_linear_in_the_matches_of_a_text(spark):
    def seconds(n):
        text = " ".join(f"mail a{i}@b.com" if i % 9 == 0 else f"id{i}" for i in range(n))
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        start = time.time()
        assert pii.matches(docs).where("kind = 'candidate'").count() >= n
        return time.time() - start

    seconds(1000)
    few, many = min(seconds(16_000) for _ in range(2)), seconds(128_000)
    assert many < 16 * few + 4, (few, many)


def test_no_text_is_split_for_each_match(spark):
    plan = pii.matches(cases.sample(spark))._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if line.lstrip(" +-:").startswith("Generate"):
            assert line.count("lambdafunction") <= 5, "one plain renaming for each kind"
    bodies = re.findall(r"lambdafunction\((.*?), lambda", plan)
    assert bodies and not any("split(" in b or "regexp_extract_all(" in b for b in bodies)


def mask(text, spans):
    if text is None:
        return None
    out, at, merged = "", 0, []
    for s in spans:
        if merged and merged[-1][1] > s.start:
            merged[-1][1] = max(merged[-1][1], s.end)
        else:
            merged.append([s.start, s.end, s.kind])
    for a, b, kind in merged:
        out, at = out + text[at:a] + f"[{kind.upper()}]", b
    return out + text[at:]


# --- pipeline ----------------------------------------------------------------------------------------------------


def test_pipeline_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in cases.sample(spark).collect()]
    rules = repetition.RepetitionRules()

    def kept(text):
        n, *_, failed = brute_repetition(text)
        words = cases.words(text)
        codes = {w: k for k, w in enumerate(dict.fromkeys(words))}
        lengths = repetition.repeat_lengths(np.array([codes[w] for w in words]), np.array([0, len(words)])) if words else np.zeros(0, int)
        return not failed and repetition.covered(lengths, rules.span_words).sum() <= rules.max_covered * n and lengths.max(initial=0) <= rules.max_longest

    docs = [x for x in docs if kept(x[1])]
    roots = similar_components([t for _, t in docs])
    docs = [min((x for x, q in zip(docs, roots) if q == r), key=lambda x: x[0]) for r in sorted(set(roots))]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{cases.SF}/benchmark.parquet").collect()]
    hits = {d: h for d, _, h, _ in brute_hits(docs, items)}
    docs = sorted(x for x in docs if not hits[x[0]])
    spans = {r.doc_id: r.spans for r in pii.personal_data(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    core, want = plain_encoding(), []
    for d, t in docs:
        ids = core.encode_ordinary(mask(t, spans[d]))
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()))
    got = corpus_pipeline.run(spark, cases.SF)
    assert cases.ordered(got, "doc_id", "n_tokens", "ids_sha256") == sorted(want, key=repr)


def test_stages_take_odd_rows(spark):
    for docs in (cases.rows(spark), cases.empty(spark)):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, cases.SF)
            assert k == len(corpus_pipeline.STAGES) - 1 or out.columns == docs.columns
            assert out.count() <= docs.count()


# --- round 3 -----------------------------------------------------------------------------------------------------


def _plain_step(tables, seen, first, features, tokens, cfg):
    """One update of both softmaxes as written down, row by row of the tables."""
    model = language_model.Softmaxes(tables, cfg)
    classes, slots = tokens // cfg.slots, tokens % cfg.slots
    for table, weight, rows, target in zip(tables, seen, model._rows(features, classes), (classes, slots)):
        z = sum(table[r].astype(np.float64) for r in rows)
        p = np.exp(z - z.max(axis=1, keepdims=True))
        error = p / p.sum(axis=1, keepdims=True)
        error[np.arange(len(tokens)), target] -= 1
        gradient = np.zeros(table.shape)
        for r in rows:
            np.add.at(gradient, r.astype(np.int64), error)
        weight += (gradient ** 2).mean(axis=1)
        table -= first * gradient / np.sqrt(weight)[:, None]


def test_lm_step_in_blocks_is_the_plain_step():
    cfg = language_model.LMConfig()
    rng = np.random.default_rng(8)
    shapes = [(cfg.class_rows, cfg.classes), (cfg.place_rows, cfg.slots)]
    model = language_model.Softmaxes([np.zeros(s, np.float32) for s in shapes], cfg)
    plain, seen = [np.zeros(s) for s in shapes], [np.full(s[0], 1e-2) for s in shapes]
    for size in (5000, 1, 7001):  # more than two blocks, one token, fewer and more than before
        tokens = (rng.zipf(1.4, size) * 37 % (cfg.classes * cfg.slots)).astype(np.int64)
        edges = np.unique(np.concatenate([[0, size], rng.integers(0, size, 20)]))
        features = language_model._features(tokens, edges, cfg)
        model.step(features, tokens)
        _plain_step(plain, seen, cfg.rate, features, tokens, cfg)
        for table, want in zip(model.tables, plain):
            np.testing.assert_allclose(table, want, atol=2e-3)
    logs = model.log_probability(features, tokens)
    again = [model.log_probability([f[a : a + 1] for f in features], tokens[a : a + 1])[0] for a in range(0, size, 500)]
    assert logs[::500].tolist() == again


def test_lm_learning_looks_at_the_chosen_texts_alone():
    """Features of the texts of one round are the same without the others, which cost nothing."""
    cfg = language_model.LMConfig()
    rng = np.random.default_rng(9)
    edges = np.array([0, 1, 50, 50 + 3, 200, 201, 400])
    tokens, chosen = rng.integers(0, 900, 400), np.array([True, False, True, True, False, True])
    own, bounds = language_model._texts_tokens(tokens, edges, chosen)
    picked = np.flatnonzero(np.repeat(chosen, np.diff(edges)))
    assert (own == tokens[picked]).all() and bounds.tolist() == [0, 1, 4, 151, 350]
    for part, whole in zip(language_model._features(own, bounds, cfg), language_model._features(tokens, edges, cfg)):
        assert (part == whole[picked]).all()


def test_training_order_gives_memory_back(monkeypatch):
    """A worker that has encoded its texts keeps no buffers for the stages that follow."""
    import pyarrow as pa
    import pyspark

    released = []

    class Pool:
        def release_unused(self):
            released.append(pa.total_allocated_bytes())

    class Frame:
        def mapInArrow(self, run, schema):
            return run

    monkeypatch.setattr(pyspark, "TaskContext", type("Task", (), {"get": staticmethod(lambda: type("Part", (), {"partitionId": lambda self: 7})())}))
    monkeypatch.setattr(pa, "default_memory_pool", Pool)
    run = training_order.sequences(Frame(), RANKS, public_tokenizers.PATTERN, 8, 50256)
    before, used, rows = pa.total_allocated_bytes(), [], 0
    for batch in run(iter([pa.RecordBatch.from_pydict({"doc_id": pa.array([1, None, 3]), "text": pa.array(["one two " * 9000, None, ""])})])):
        used.append(pa.total_allocated_bytes())
        rows, part, place = rows + len(batch), batch.column("part").to_pylist(), batch.column("place").to_pylist()
        batch = None
    assert set(part) == {7} and place == list(range(rows)) and rows > 1000
    assert len(released) == 1 and released[0] - before < (used[0] - before) / 4
