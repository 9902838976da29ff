"""Quality classifier: supervised subword embeddings.

A text is the average of learned vectors of its hashed words and character
n-grams, and of one more for each word that repeats the word before it; a
softmax over the classes follows. Vectors and softmax are trained
together by stochastic gradient descent in numpy on a bounded sample of
labelled rows. Averaging is linear, so for scoring each hashed feature reduces
to one number per class, and a text's score is read off its distinct words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tremorgrid.llm.tables import documents
from tremorgrid.llm.text import row_sums, slices, space_words, subwords, texts_of
from tremorgrid.session import small_side


@dataclass(frozen=True)
class QualityConfig:
    buckets: int = 1 << 16
    shortest: int = 3  # character n-grams, in bytes, with one mark at each end of a word
    longest: int = 5
    width: int = 10  # of a vector
    epochs: int = 12
    rate: float = 0.3
    max_labelled: int = 4000  # documented bound of the training sample
    prior_features: int = 40  # a text leans to the prior as if it had so many more features that say just that
    seed: int = 7


def _rows(batches: Iterator[pa.RecordBatch], cfg: QualityConfig):
    """(slice, its distinct words' features and bounds, each text's word codes and bounds)."""
    for part in slices(batches, "text"):
        words, bounds = space_words(texts_of(part, "text"))
        coded = words.dictionary_encode()
        features, edges = subwords(pa.concat_arrays([coded.dictionary]), cfg.buckets, cfg.shortest, cfg.longest) if len(words) else (np.zeros(0, np.int64), np.zeros(1, np.int64))
        yield part, features, edges, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), bounds


def _repeats(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Words of each text that repeat the word before."""
    same = np.zeros(len(codes), dtype=np.int64)
    same[1:] = codes[1:] == codes[:-1]
    same[bounds[:-1][bounds[:-1] < len(codes)]] = 0
    return row_sums(same, bounds)


def labelled_features(docs: DataFrame, labels: DataFrame, cfg: QualityConfig) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Label, features and their counts of at most ``cfg.max_labelled`` labelled rows, those first in a hash order of the id.

    The ids are chosen from the labels alone; no text moves but theirs, and only
    as features (at most two numbers for each hashed feature).
    """
    order = F.xxhash64(F.col("doc_id"), F.lit(cfg.seed))
    chosen = labels.select("doc_id", "label").orderBy(order, "doc_id", "label").limit(cfg.max_labelled)
    sample = docs.join(small_side(chosen, cfg.max_labelled), "doc_id").select("doc_id", "text", "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, features, edges, codes, bounds in _rows(batches, cfg):
            found, counts = [], []
            for a, b, again in zip(bounds[:-1], bounds[1:], _repeats(codes, bounds)):
                own, times = np.unique(codes[a:b], return_counts=True)
                spans = np.concatenate([features[edges[w] : edges[w + 1]] for w in own]) if len(own) else np.zeros(0, np.int64)
                weight = np.repeat(times, edges[own + 1] - edges[own]) if len(own) else np.zeros(0, np.int64)
                ids, where = np.unique(spans, return_inverse=True)
                sums = np.bincount(where, weights=weight, minlength=len(ids))
                if again:
                    ids, sums = np.append(ids, cfg.buckets), np.append(sums, again)
                found.append(ids.astype(np.int32).tobytes())
                counts.append(sums.astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), pa.array(found, pa.binary()), pa.array(counts, pa.binary())],
                                             names=["doc_id", "label", "ids", "counts"])

    found = sample.mapInArrow(run, "doc_id long, label int, ids binary, counts binary")
    # an id may stand for many texts: the bound holds for rows
    got = found.orderBy(order, "doc_id", "label", "ids", "counts").limit(cfg.max_labelled).toArrow().to_pylist()
    got.sort(key=lambda r: (r["doc_id"], r["label"], r["ids"], r["counts"]))
    return [(r["label"], np.frombuffer(r["ids"], np.int32), np.frombuffer(r["counts"], np.float32)) for r in got]


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], cfg: QualityConfig) -> tuple[np.ndarray, float]:
    """(log odds of label 1 per hashed feature, bias). Without both labels: zeros and the smoothed prior.

    The last feature stands for repeated words.
    """
    positive = sum(r[0] for r in rows)
    if not 0 < positive < len(rows):
        return np.zeros(cfg.buckets + 1, dtype=np.float32), float(np.log((positive + 1) / (len(rows) - positive + 1)))
    rng = np.random.default_rng(cfg.seed)
    vectors = rng.uniform(-1 / cfg.width, 1 / cfg.width, (cfg.buckets + 1, cfg.width)).astype(np.float32)
    weights, bias = np.zeros((cfg.width, 2), dtype=np.float32), np.zeros(2, dtype=np.float32)
    steps, at = cfg.epochs * len(rows), 0
    for _ in range(cfg.epochs):
        for k in rng.permutation(len(rows)):
            label, ids, counts = rows[k]
            share = counts / max(1.0, float(counts.sum()))
            rate, at = cfg.rate * (1 - at / steps), at + 1
            hidden = share @ vectors[ids] if len(ids) else np.zeros(cfg.width, np.float32)
            score = hidden @ weights + bias
            p = np.exp(score - score.max())
            error = p / p.sum()
            error[label] -= 1
            back = weights @ error
            weights -= rate * np.outer(hidden, error)
            bias -= rate * error
            if len(ids):
                # each feature moves by its share of the text, scaled so that a whole text moves by one unit
                vectors[ids] -= rate * np.sqrt(len(ids)) * share[:, None] * back[None, :]
    odds = weights[:, 1] - weights[:, 0]
    return (vectors @ odds).astype(np.float32), float(bias[1] - bias[0])


def quality_scores(docs: DataFrame, labels: DataFrame, cfg: QualityConfig = QualityConfig(), threshold: float = 0.7,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted), one row per input row; whole texts are scored.

    ``labels``: doc_id and label (0 or 1) of the rows of ``docs`` to learn from;
    null and other labels are left out, rows labelled twice count twice, a label
    holds for every row with its id. Texts that are null or empty get the
    prior's score, and short ones lean to it. Rows with equal or null ids stay
    apart; other columns are ignored. The model is one float per bucket, so what
    is shipped to the tasks has a fixed size.
    """
    known = labels.where("doc_id is not null and label in (0, 1)").select(F.col("doc_id").cast("long"), F.col("label").cast("int"))
    rows = labelled_features(documents(docs, id_col, text_col), known, cfg)
    odds, bias = train(rows, cfg)
    positive = sum(r[0] for r in rows)
    prior = float(np.log((positive + 1) / (len(rows) - positive + 1)))
    model = docs.sparkSession.sparkContext.broadcast(odds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_cpu_count(1)
        for part, features, edges, codes, bounds in _rows(batches, cfg):
            total = row_sums(model.value[features].astype(np.float64), edges)
            n = np.diff(edges)
            again = _repeats(codes, bounds)
            said = row_sums(total[codes], bounds) + again * float(model.value[-1])
            heard = row_sums(n[codes], bounds) + again
            logit = (bias * heard + said + cfg.prior_features * prior) / np.maximum(1, heard + cfg.prior_features)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(1 / (1 + np.exp(-logit)))], names=["doc_id", "score"])

    scored = documents(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
