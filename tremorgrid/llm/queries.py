"""Registered queries of the pipeline operators, over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tremorgrid.llm import byte_bpe, collocations, decontamination, language, language_model, licenses, pii, quality_model, repetition, simhash, token_counts, training_order, whitening
from tremorgrid.llm.tables import remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all pages and, with their source as the host, all documents."""
    docs = table(spark, sf_dir, "documents")
    rows = language.page_rows(table(spark, sf_dir, "pages")).unionByName(language.document_rows(docs))
    return language.identified(rows, docs.select("text", "lang"))


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, radius=4)
    return found.select("doc_id", "fingerprint", "component_id")


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, with_ids=False)
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query
def op4_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_model.lm_scores(docs, held_out=remainder(F.col("doc_id"), 7) == 2)


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


@query
def op6_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sequence with its slot and place, and a hash of its ids as read back from the shards."""
    manifest, folder, layout = training_order.write_training_order(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
        end_id=50256, key=20240607, length=256)
    if not layout["sequences"]:
        return manifest.withColumn("ids_sha256", F.lit(""))
    stored = training_order.read_slots(spark, folder, layout, hashes=True).withColumnRenamed("sha256", "ids_sha256")
    return manifest.join(stored, "slot").select("doc_id", "seq", "n_tokens", "slot", "shard", "byte_offset", "ids_sha256")


@query
def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
    base = F.filter("spans", lambda s: s.base)
    of_kind = lambda k: F.filter(base, lambda s: s.kind == k)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    ids = F.array_sort(F.transform("item_ids", lambda i: i.cast("string")))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.quality_rules(table(spark, sf_dir, "documents"))


@query
def op10_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    marked = labels.where(remainder(F.col("doc_id"), 4) != 2).select("doc_id", F.col("quality").alias("label"))
    scored = quality_model.quality_scores(docs, marked, threshold=0.7)
    return scored.withColumn("held_out", remainder(F.col("doc_id"), 4) == 2).select("doc_id", "held_out", "score", "predicted")


@query
def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.license_scan(table(spark, sf_dir, "documents"))
    named = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min("places.start").alias("first_word"),
        F.array_max("places.start").alias("last_word"), named(F.col("places.label")).alias("base_labels"),
        named(F.concat("places.label", "spans.label")).alias("labels"), "score")


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"), components=16)


ORACLES["op8_decontamination"] = r"""
with d as (
  select row_number() over () as rid, doc_id,
         [x for x in regexp_split_to_array(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' ') if x <> ''] as w
  from documents),
b as (
  select item_id,
         [x for x in regexp_split_to_array(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' ') if x <> ''] as w
  from benchmark),
items as (
  select distinct item_id, least(10, len(w)) as size, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') as win
  from (select item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) as i from b where len(w) > 0)),
sizes as (select distinct size from items),
spots as (
  select rid, size, i, array_to_string(w[i : i + size - 1], ' ') as win
  from (select rid, size, w, unnest(generate_series(1, len(w) - size + 1)) as i from d, sizes where len(w) >= size)),
met as (select s.rid, s.i, s.size, items.item_id from spots s join items on s.win = items.win and s.size = items.size),
hits as (select rid, count(distinct p) as n_hit from (select rid, unnest(generate_series(i, i + size - 1)) as p from met) group by rid),
named as (
  select rid, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids
  from met group by rid)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(h.n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n.n_items, 0) as bigint) as n_items, sha256(coalesce(n.ids, '')) as items_sha256, coalesce(h.n_hit, 0) > 0 as contaminated
from d left join hits h on h.rid = d.rid left join named n on n.rid = d.rid
"""

_TEMPLATES = ", ".join(
    f"({n}, '{label}', {is_base}, '{text}')" for n, (text, label, is_base) in
    enumerate([(*x, "true") for x in licenses.BASE] + [(*x, "false") for x in licenses.NOTICES]))
_WORDS = r"""[x for x in regexp_split_to_array(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' ') if x <> '']"""
ORACLES["op11_license_scan"] = f"""
with d as (select row_number() over () as rid, doc_id, {_WORDS} as w from documents),
t as (select template, label, is_base, {_WORDS} as w from (values {_TEMPLATES}) v(template, label, is_base, text)),
tg as (
  select template, label, is_base, len(w) as size, not is_base and len(w) >= 16 as wide, i - 1 as t_at, array_to_string(w[i : i + 2], ' ') as gram
  from (select *, unnest(generate_series(1, len(w) - 2)) as i from t)),
dg as (
  select rid, i - 1 as place, array_to_string(w[i : i + 2], ' ') as gram
  from (select rid, w, unnest(generate_series(1, len(w) - 2)) as i from d where len(w) >= 3)),
hits as (select rid, template, label, is_base, size, wide, t_at, place, place - t_at as diagonal from dg join tg using (gram)),
votes as (select rid, template, label, is_base, size, wide, diagonal, count(*) as votes from hits group by all),
near as (
  select v.rid, v.template, v.diagonal, h.t_at, h.place
  from votes v join hits h on h.rid = v.rid and h.template = v.template and abs(h.diagonal - v.diagonal) <= case when v.wide then 6 else 0 end),
extent as (
  select rid, template, diagonal, min(place) as first, max(place) + 3 as past,
         count(distinct at_word) as covered, count(distinct word) as met
  from (select *, t_at + unnest([0, 1, 2]) as at_word, place + unnest([0, 1, 2]) as word from near) group by all),
ranked as (
  select v.*, e.first, e.past, e.covered, e.met,
         row_number() over (partition by v.rid, v.template order by e.covered desc, v.votes desc, v.diagonal) as r
  from votes v join extent e using (rid, template, diagonal)),
best as (
  select a.* from ranked a
  where not a.wide or not exists (
    select 1 from ranked b where b.rid = a.rid and b.template = a.template and abs(b.diagonal - a.diagonal) <= 6 and b.r < a.r)),
spans as (
  select rid, label, is_base, first, covered / size::double as cover, met / (past - first)::double as dense,
         case when wide then covered / size::double >= 0.8 and met / (past - first)::double >= 0.7 else covered = size end as holds
  from best),
of_row as (
  select rid, count(*) filter (holds and is_base) as n_base, min(first) filter (holds and is_base) as first_word,
         max(first) filter (holds and is_base) as last_word,
         string_agg(distinct label, ',' order by label) filter (holds and is_base) as base_labels,
         string_agg(distinct label, ',' order by label) filter (holds) as labels, max(cover * dense) as score
  from spans group by rid)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(n_base, 0) as bigint) as n_base, cast(first_word as bigint) as first_word,
       cast(last_word as bigint) as last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0.0) as score
from d left join of_row o on o.rid = d.rid
"""

ORACLES["op12_collocations"] = r"""
with pieces as (
  select lang, row_number() over () as pid, [x for x in regexp_split_to_array(piece, '[ \t]+') if x <> ''] as w
  from (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents)),
totals as (select lang, sum(len(w)) as n from pieces group by lang),
grams as (
  select lang, size, array_to_string(w[i : i + size - 1], ' ') as phrase, w[i : i + size - 1] as words, count(*) as f
  from (select *, unnest(generate_series(1, len(w) - size + 1)) as i from pieces, (values (1), (2), (3)) s(size) where len(w) >= size)
  group by all),
candidates as (select * from grams where size > 1 and f >= 10),
cuts as (
  select c.lang, c.size, c.phrase, c.words, c.f as a, a.f as l, b.f as r, k,
         (1000000::hugeint * c.f * c.f) // (a.f::hugeint * b.f) as score
  from (select *, unnest(generate_series(1, size - 1)) as k from candidates) c
  join grams a on a.lang = c.lang and a.words = c.words[1 : k] join grams b on b.lang = c.lang and b.words = c.words[k + 1 : c.size]),
lowest as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1),
kept as (
  select * from lowest x where not exists (
    select 1 from candidates y where y.lang = x.lang and y.size > x.size and 100 * y.f >= 50 * x.a
      and (y.words[1 : x.size] = x.words or y.words[2 : x.size + 1] = x.words)))
select lang, cast(rank as bigint) as rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r, cast(n as bigint) as n, cast(score as bigint) as score
from (select k.*, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept k) join totals using (lang)
where rank <= 2000
"""
