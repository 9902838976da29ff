"""Language identification by Bayesian evidence fusion.

Evidence of a row: the likelihood of its text under each language (hashed
character n-grams, counted over labelled texts), the language its markup
declares, and where it comes from. The place gives a prior smoothed down a
hierarchy: all rows, address suffix, site, host. Each level is a Dirichlet
prior of the next, from expected counts of the text evidence, and a row's own
share is taken out of its host's. All counts are grouped aggregations.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tremorgrid.llm.text import row_sums, slices, space_words, subwords, texts_of
from tremorgrid.session import materialize


SLICE = 3 << 20  # bytes of text at a time: character n-grams take many times their text


@dataclass(frozen=True)
class LanguageConfig:
    buckets: int = 1 << 15
    shortest: int = 1
    longest: int = 3
    smoothing: float = 0.5  # added to each bucket's count
    temper: float = 0.05  # n-grams of a word overlap: each counts for so much of an independent one
    prior_weight: float = 20.0  # expected rows that a level of the hierarchy is worth to the next
    declared_weight: float = 20.0
    max_languages: int = 256  # the model has this many times ``buckets`` numbers at most


def plain_text(html: Column) -> Column:
    """The text of a page without scripts, styles, comments and tags."""
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    text = F.regexp_replace(text, r"<[^<>]*+>", " ")
    text = F.regexp_replace(text, r"&(?:[a-z]{2,8}|#[0-9]{1,7});", " ")
    return text


def page_rows(pages: DataFrame) -> DataFrame:
    """Rows for ``identified`` from web pages (page_id, url, html)."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*+://(?:[^/@?#]*+@)?([^/:?#]+)", 1))
    labels = F.split(host, "\\.")
    return pages.select(
        F.lit(None).cast("long").alias("doc_id"), F.col("page_id").cast("long"), plain_text(F.coalesce("html", F.lit(""))).alias("text"),
        F.lower(F.regexp_extract(F.coalesce("html", F.lit("")), r"(?i)<html\b[^<>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", 1)).alias("declared"),
        host.alias("host"), F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - 1), 2), ".").alias("site"), F.element_at(labels, -1).alias("suffix"))


def document_rows(docs: DataFrame) -> DataFrame:
    """Rows for ``identified`` from plain documents: the source stands for the host, nothing is declared."""
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), F.lit(None).cast("long").alias("page_id"), F.col("text").cast("string"), F.lit("").alias("declared"),
                       F.concat(F.lit("source:"), source).alias("host"), F.lit("source:").alias("site"), F.lit("").alias("suffix"))


def text_model(labelled: DataFrame, cfg: LanguageConfig) -> tuple[list[str], np.ndarray]:
    """(languages, log probability of each bucket in each of them), counted over all labelled texts."""
    names = [r.lang for r in labelled.select("lang").where("lang is not null").distinct().orderBy("lang").limit(cfg.max_languages + 1).collect()]
    if len(names) > cfg.max_languages:
        raise ValueError(f"more than {cfg.max_languages} languages are labelled")
    number = {x: k for k, x in enumerate(names)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_cpu_count(1)
        sums = np.zeros((max(1, len(names)), cfg.buckets), dtype=np.int64)
        for part in slices(batches, "text", SLICE):
            words, bounds = space_words(texts_of(part, "text"))
            if not len(words):
                continue
            coded = words.dictionary_encode()
            features, edges = subwords(pa.concat_arrays([coded.dictionary]), cfg.buckets, cfg.shortest, cfg.longest)
            langs = np.repeat([number[x] for x in part.column("lang").to_pylist()], np.diff(bounds))
            codes, n = coded.indices.to_numpy(zero_copy_only=False), len(coded.dictionary)
            for k in np.unique(langs):
                times = np.bincount(codes[langs == k], minlength=n)
                sums[k] += np.bincount(features, weights=np.repeat(times, np.diff(edges)), minlength=cfg.buckets).astype(np.int64)
        for k, row in enumerate(sums):
            where = np.flatnonzero(row)
            if len(where):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(where), k)), pa.array(where), pa.array(row[where])], names=["lang", "bucket", "n"])

    counts = labelled.where("lang is not null").select("text", "lang").mapInArrow(count, "lang long, bucket long, n long")
    got = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()  # at most max_languages x buckets rows
    table = np.full((max(1, len(names)), cfg.buckets), cfg.smoothing)
    table[got.column("lang").to_numpy(), got.column("bucket").to_numpy()] += got.column("n").to_numpy()
    return names, np.log(table / table.sum(axis=1, keepdims=True))


def text_evidence(rows: DataFrame, names: list[str], model: np.ndarray, cfg: LanguageConfig) -> DataFrame:
    """``rows`` without texts, with ``says``: the tempered log likelihood of the text for each language."""
    shared = rows.sparkSession.sparkContext.broadcast(model.astype(np.float32))
    keep = ["doc_id", "page_id", "declared", "host", "site", "suffix"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_cpu_count(1)
        for part in slices(batches, "text", SLICE):
            words, bounds = space_words(texts_of(part, "text"))
            says = np.zeros((len(part), len(names)))
            if len(words):
                coded = words.dictionary_encode()
                features, edges = subwords(pa.concat_arrays([coded.dictionary]), cfg.buckets, cfg.shortest, cfg.longest)
                codes = coded.indices.to_numpy(zero_copy_only=False)
                for k in range(len(names)):
                    word = row_sums(shared.value[k][features].astype(np.float64), edges)
                    says[:, k] = cfg.temper * row_sums(word[codes], bounds)
            flat = pa.array(says.ravel())
            lists = pa.ListArray.from_arrays(pa.array((np.arange(len(part) + 1) * len(names)).astype(np.int32)), flat)
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), lists], names=[*keep, "says"])

    schema = "doc_id long, page_id long, declared string, host string, site string, suffix string, says array<double>"
    return rows.select(*keep, "text").mapInArrow(run, schema)


def _shares(logs: Column) -> Column:
    """Probabilities from logarithms."""
    top = F.array_max(logs)
    grown = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(grown, lambda x: x / F.aggregate(grown, F.lit(0.0), lambda a, y: a + y))


def identified(rows: DataFrame, labelled: DataFrame, cfg: LanguageConfig = LanguageConfig()) -> DataFrame:
    """(doc_id, page_id, host, declared, text_lang, lang, probability), one row per input row.

    ``rows``: doc_id, page_id, text, declared, host, site, suffix, as made by
    ``page_rows`` or ``document_rows``. ``labelled``: text, lang. Null and empty
    texts, and rows without a declaration or address (empty or null, returned as
    empty), rest on what is left of the evidence; without any labelled text ``lang`` is null. Ties go to the
    language first in the alphabet. Rows with equal or null ids stay apart.
    """
    names, model = text_model(labelled, cfg)
    if not names:
        return rows.select("doc_id", "page_id", "host", "declared", *(F.lit(None).cast("string").alias(c) for c in ("text_lang", "lang")), F.lit(None).cast("double").alias("probability"))
    rows = rows.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in ("host", "site", "suffix", "declared")})
    texts = text_evidence(rows, names, model, cfg)
    known = materialize(texts.withColumn("share", _shares(F.col("says"))), "language_text")
    n = range(len(names))
    zeros = F.array(*[F.lit(0.0) for _ in n])

    def sums(column: str) -> Column:
        return F.array(*[F.sum(F.col(column)[k]) for k in n])

    hosts = materialize(known.groupBy("host", "site", "suffix").agg(sums("share").alias("n")), "language_hosts")
    sites = hosts.groupBy("site", "suffix").agg(sums("n").alias("n_site"))
    suffixes = sites.groupBy("suffix").agg(sums("n_site").alias("n_suffix"))
    whole = hosts.agg(sums("n").alias("n")).first().n  # one number per language
    every = F.array(*[F.lit((float(x or 0) + 1 / len(names)) / (sum(float(y or 0) for y in whole) + 1)) for x in whole])

    def smoothed(counts: Column, prior: Column) -> Column:
        total = F.aggregate(counts, F.lit(0.0), lambda a, y: a + y)
        return F.zip_with(counts, prior, lambda c, p: (c + cfg.prior_weight * p) / (total + cfg.prior_weight))

    suffixes = suffixes.select("suffix", smoothed(F.col("n_suffix"), every).alias("p_suffix"))
    sites = sites.join(suffixes, "suffix").select("site", "suffix", smoothed(F.col("n_site"), F.col("p_suffix")).alias("p_site"))
    priors = hosts.join(sites, ["site", "suffix"]).select("host", "site", "suffix", "n", "p_site")
    says = known.groupBy("declared").agg(sums("share").alias("n_declared"))
    own = F.zip_with("n", "share", lambda a, b: F.greatest(a - b, F.lit(0.0)))
    seen = F.zip_with("n_declared", "share", lambda a, b: F.greatest(a - b, F.lit(0.0)))
    fused = known.join(priors, ["host", "site", "suffix"]).join(says, "declared")
    fused = fused.withColumn("p_host", smoothed(own, F.col("p_site"))).withColumn(
        # how much likelier the declaration is in a language than in all rows; nothing declared says nothing
        "p_declared", F.when(F.col("declared") == "", zeros).otherwise(F.zip_with(
            F.zip_with(seen, every, lambda c, p: c + cfg.declared_weight * p), every, lambda c, p: F.log(c / p))))
    logs = F.zip_with(F.zip_with("says", "p_host", lambda a, p: a + F.log(p)), "p_declared", lambda a, p: a + p)
    fused = fused.withColumn("posterior", _shares(logs))
    name = F.array(*[F.lit(x) for x in names])
    best = lambda c: F.element_at(name, F.array_position(c, F.array_max(c)).cast("int"))
    return fused.select("doc_id", "page_id", "host", "declared", best(F.col("share")).alias("text_lang"), best(F.col("posterior")).alias("lang"),
                        F.array_max("posterior").alias("probability"))
