"""Operator 13 against numpy: rank-one updates, combined spectra, whitening of whole tables, odd rows."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from tests.llm import cases
from tremorgrid.llm import whitening
from tremorgrid.llm.queries import QUERIES

VECTORS = f"{cases.SF}/embeddings.parquet"


def held(values, basis, matrix):
    scale = max(1.0, np.abs(matrix).max())
    assert np.abs(basis.T @ basis - np.eye(len(matrix))).max() < 1e-11
    assert np.abs(basis @ np.diag(values) @ basis.T - matrix).max() < 1e-11 * scale
    assert (np.diff(values) >= 0).all()


def test_rank_one_updates_with_deflation():
    rng = np.random.default_rng(3)
    for d in (1, 2, 7, 40):
        for kind in range(4):
            values = np.sort(rng.integers(0, 4, d).astype(float) if kind % 2 else rng.exponential(size=d) * 10.0 ** rng.integers(-6, 6, d))
            basis, _ = np.linalg.qr(rng.normal(size=(d, d)))
            matrix = basis @ np.diag(values) @ basis.T
            for step in range(30):
                vector = rng.normal(size=d) * 10.0 ** rng.integers(-4, 3)
                if kind >= 2:
                    vector = basis[:, rng.integers(d)] * 3.0 if step % 2 else np.zeros(d)
                rho = float(rng.exponential())
                values, basis = whitening.rank_one(values, basis, vector, rho)
                matrix = matrix + rho * np.outer(vector, vector)
                held(values, basis, matrix)


def test_spectra_of_tasks_are_those_of_all(spark):
    rng = np.random.default_rng(5)
    data = [([int(v) + whitening.OFFSET for v in row],) for row in rng.integers(-50, 50, (200, 6)) * [1, 1, 2, 9, 0, 1]]
    fit = spark.createDataFrame(data, "x array<long>").repartition(19)
    one = whitening.combined(whitening.spectra(fit, 6), 19, whitening._merged_spectra, whitening.SPECTRUM).collect()
    assert len(one) == 1 and one[0].n == 200
    x = np.array([r[0] for r in data]) - whitening.OFFSET
    assert np.allclose(np.frombuffer(one[0]["mean"]), x.mean(axis=0))
    held(np.frombuffer(one[0]["values"]), np.frombuffer(one[0].basis).reshape(6, 6), (x - x.mean(axis=0)).T @ (x - x.mean(axis=0)))


def brute(vectors, k):
    """{row number: (x, whitened)}, n, S, explained"""
    kept = [(i, v) for i, v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    xs = [tuple(math.floor(64 * c) + 1_000_000 for c in v) for _, v in kept]
    fit = np.array(sorted(set(xs)))
    centred = fit - fit.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(fit))
    values, vectors = values[::-1], vectors[:, ::-1]
    whitened = (np.array(xs) - fit.mean(axis=0)) @ vectors[:, :k] / np.sqrt(values[:k])
    return [i for i, _ in kept], xs, whitened, len(fit), [int(s) for s in fit.sum(axis=0)], values / values.sum()


def test_whole_table_against_numpy(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(VECTORS).collect()]
    odd = [(9001, None), (9002, [None] + [0.5] * 63), (9003, [math.nan] * 64), (9004, [math.inf] * 64), (9005, []), (9006, [1.0, 2.0]), rows[0], (None, rows[1][1])]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("x", F.lit("clash")).withColumn("component", F.lit(9)).repartition(7)
    got = whitening.whitened(table).collect()
    ids, xs, want, n, sums, explained = brute([r for r in rows + odd if r[1] is None or len(r[1]) == 64], 16)
    assert len(got) == 16 * len(ids) and {r.n for r in got} == {n}
    flip = {}
    by_id = {i: (x, w) for i, x, w in zip(ids, xs, want)}
    for r in got:
        x, w = by_id[r.vec_id]
        assert r.deviation == sum((n * a - s) ** 2 for a, s in zip(x, sums))
        expected = w[r.component - 1]
        if abs(expected) > 1e-3:
            assert flip.setdefault(r.component, math.copysign(1, expected * r.whitened)) * r.whitened * expected > 0
        assert abs(abs(r.whitened) - abs(expected)) < 1e-8
        assert abs(r.explained - explained[r.component - 1]) < 1e-9 and 0 <= r.identity_error < 1e-9


def test_few_vectors_and_degenerate_tables(spark):
    make = lambda data: spark.createDataFrame(data, "vec_id long, embedding array<double>")
    assert whitening.whitened(make([])).count() == 0
    assert whitening.whitened(make([(1, None)])).count() == 0
    assert whitening.whitened(make([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    flat = whitening.whitened(make([(i, [float(i), 2.0 * i, 7.0]) for i in range(5)])).collect()
    assert [r.component for r in flat] == [1] * 5 and abs(flat[0].explained - 1) < 1e-12
    huge = whitening.whitened(make([(1, [1e300, 0.0]), (2, [0.0, 1e10]), (3, [0.0, 0.0])])).collect()
    assert {r.vec_id for r in huge} == {1, 2, 3} and any(r.deviation is None for r in huge)


def test_query_columns(spark):
    got = QUERIES["op13_whitening"](spark, cases.SF)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
