"""Operator 11 against brute force: base places, merged diagonals, odd rows."""

from __future__ import annotations

import re

from tests.llm import cases
from tremorgrid.llm import licenses
from tremorgrid.llm.queries import QUERIES

WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
MIT = licenses.NOTICES[0][0]


def plain_words(text):
    return WORDS.findall(cases.lower(text))


def brute_places(text):
    words = plain_words(text)
    phrases = [(plain_words(p), label) for p, label in licenses.BASE]
    return sorted((i, label) for p, label in phrases for i in range(len(words)) if words[i : i + len(p)] == p)


def licensed():
    notice = MIT.split()
    changed = [*notice[:20], "really", "and", "truly", *notice[20:30], "x", *notice[31:]]
    return [
        (100, "Released under the MIT License. under the mit license under the mit license"), (101, "CC BY-NC cc by nc, cc by"),
        (102, "pre " + MIT), (103, "pre " + " ".join(changed) + " post"), (104, " ".join(notice[:20])), (105, MIT + " " + MIT.upper() + " " + MIT),
        (106, "GNU General Public License, version 3. gnu general public license version 2"), (107, "gnu general public license version"),
        (108, "apache license version 2 " * 500), (109, "of the software " * 2000), (110, "the Apache License, Version 2.0 under the İ MIT License"),
        (111, "under the mit licenseé")]


def test_places_of_base_phrases(spark):
    rows = cases.texts() + licensed()
    docs = spark.createDataFrame(rows, "doc_id long, text string").union(cases.sample(spark).select("doc_id", "text"))
    every = rows + [(r.doc_id, r.text) for r in cases.sample(spark).collect()]
    got = sorted(((r.doc_id, r.n_words, [tuple(p) for p in r.places]) for r in licenses.license_scan(docs).collect()), key=repr)
    assert got == sorted(((i, len(plain_words(t)), brute_places(t)) for i, t in every), key=repr)


def test_spans_survive_insertions(spark):
    found = {r.doc_id: r for r in licenses.license_scan(spark.createDataFrame(licensed(), "doc_id long, text string")).collect()}
    spans = lambda i: [(s.start, s.end, s.label) for s in found[i].spans]
    size = len(plain_words(MIT))
    assert spans(102) == [(1, 1 + size, "mit")] and found[102].score == 1.0
    assert spans(103) == [(1, 1 + size + 3, "mit")] and 0.8 <= found[103].spans[0].cover < 1
    assert spans(104) == [] and 0 < found[104].score < 0.6
    assert spans(105) == [(0, size, "mit"), (size, 2 * size, "mit"), (2 * size, 3 * size, "mit")]
    assert spans(106) == [(0, 6, "gpl-3"), (6, 12, "gpl-2")] and spans(107) == []
    assert len(found[108].places) == 500 and spans(109) == [] and found[109].score < 0.2


def test_odd_rows_and_an_empty_table(spark):
    assert licenses.license_scan(cases.empty(spark)).count() == 0
    got = licenses.license_scan(cases.rows(spark)).collect()
    assert len(got) == len(cases.texts()) and all(r.places == [] and r.score == 0.0 for r in got)
    try:
        licenses.license_scan(cases.rows(spark), notices=[("two words", "x")])
        raise AssertionError("a short template is refused")
    except ValueError:
        pass


def test_query_keeps_every_row(spark):
    got = QUERIES["op11_license_scan"](spark, cases.SF)
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    want = {r.doc_id: brute_places(r.text) for r in cases.sample(spark).collect()}
    for r in got.collect():
        places = want[r.doc_id]
        assert (r.n_base, r.first_word, r.last_word) == (len(places), min(places)[0] if places else None, max(places)[0] if places else None)
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1


def test_plan_has_one_join_of_grams_and_no_python(spark):
    plan = licenses.gram_hits(cases.sample(spark))._jdf.queryExecution().toString()
    assert "Exchange hashpartitioning" not in plan and "Python" not in plan and "Pandas" not in plan
    for line in plan.splitlines():
        assert not re.search(r"lambdafunction\([^\n]*split\(", line)
