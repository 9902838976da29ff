"""Embedding whitening by incremental eigendecomposition.

Entries become integers, so counts, sums and deviations are exact. The
covariance is taken over the distinct vectors. Each task keeps the mean and the
spectrum (eigenvalues and eigenvectors of the scatter) of the vectors it has
seen. A new vector changes the scatter by one symmetric term of rank one, made
of its difference from the mean; the new eigenvalues are the roots of a secular
equation, with terms deflated that are negligible or share a pole. Spectra of
tasks are combined the same way, one rank-one update for each component of the
smaller one and one for the distance of the means, in groups of a few until one
is left. Last, Rayleigh-Ritz: the covariance is accumulated once over all
vectors in the found basis, and its small eigenproblem turns the basis to
double precision.

What is sent around has the size of one spectrum (dimension squared).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tremorgrid.session import materialize

SCALE, OFFSET = 64, 1_000_000
FAN_IN = 16  # spectra that one task combines
EPS = np.finfo(float).eps
SPECTRUM = "part long, n long, mean binary, values binary, basis binary"


def secular_roots(poles: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """(closest pole of each root, root minus that pole) of 1 + rho * sum z_j^2 / (poles_j - x) = 0.

    ``poles`` ascend and differ, no z is zero, rho > 0: root i lies between
    pole i and the next one (the last one below the last pole plus rho |z|^2).
    Roots are sought as distances from the closer pole, which keeps differences
    from the poles exact. Halving and steps of a rational model alternate inside a bracket.
    """
    n, w = len(poles), rho * z * z
    upper = np.append(poles[1:], poles[-1] + w.sum())
    width = upper - poles
    gaps = poles[None, :] - poles[:, None]  # pole j seen from pole i
    middle = 1 + (w[None, :] / (gaps - width[:, None] / 2)).sum(axis=1)
    near = np.arange(n) + ((middle < 0) & (np.arange(n) < n - 1))
    right = near > np.arange(n)
    shifted = poles[None, :] - poles[near][:, None]
    low, high = np.where(right, -width / 2, 0.0), np.where(right, 0.0, np.where(np.arange(n) < n - 1, width / 2, width))
    x = (low + high) / 2
    below = np.arange(n)[None, :] <= np.arange(n)[:, None]
    todo = np.arange(n)
    for _ in range(100):
        own, at = shifted[todo], x[todo]
        share = w[None, :] / (own - at[:, None])
        value = 1 + share.sum(axis=1)
        slope = share / (own - at[:, None])
        low[todo], high[todo] = np.where(value < 0, at, low[todo]), np.where(value < 0, high[todo], at)
        # model of two poles, those on both sides of the root: c + s / (p - x) + t / (q - x)
        p = shifted[todo, todo] - at
        q = np.where(todo < n - 1, shifted[todo, np.minimum(todo + 1, n - 1)], shifted[todo, todo] + width[todo]) - at
        s, t = (slope * below[todo]).sum(axis=1) * p * p, (slope * ~below[todo]).sum(axis=1) * q * q
        c = value - s / p - np.where(t != 0, t / q, 0.0)
        a2, a1, a0 = c, -(c * (p + q) + s + t), c * p * q + s * q + t * p
        root = np.sqrt(np.maximum(a1 * a1 - 4 * a2 * a0, 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(a1 <= 0, 2 * a0 / (-a1 + root), (-a1 - root) / (2 * a2))
        new = at + step
        inside = np.isfinite(new) & (new > low[todo]) & (new < high[todo])
        new = np.where(inside, new, (low[todo] + high[todo]) / 2)
        x[todo] = new
        done = (np.abs(new - at) <= 4 * EPS * np.abs(new)) | (high[todo] - low[todo] <= 4 * EPS * np.abs(new)) | (np.abs(value) <= 8 * EPS * n * (1 + np.abs(share).sum(axis=1)))
        x[todo[done]] = np.where(np.abs(value[done]) <= 8 * EPS * n * (1 + np.abs(share[done]).sum(axis=1)), at[done], new[done])
        todo = todo[~done]
        if not len(todo):
            break
    return near, x


def rank_one(values: np.ndarray, basis: np.ndarray, vector: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of basis diag(values) basis^T + rho vector vector^T; values ascend."""
    z = vector @ basis
    length = rho * float(z @ z)
    if length == 0:
        return values, basis
    values, basis = values.copy(), basis.copy()
    tiny = 8 * EPS * max(abs(values[-1]), abs(values[0]), length)
    moved = np.flatnonzero(rho * np.abs(z) * np.sqrt(float(z @ z)) > tiny)  # others keep value and vector
    if len(moved) > 1 and np.diff(values[moved]).min() <= tiny:
        kept = [moved[0]]
        for i in moved[1:]:  # equal poles: turn the pair so that one of them is left alone
            j = kept[-1]
            if values[i] - values[j] <= tiny:
                r = np.hypot(z[i], z[j])
                c, s = z[i] / r, z[j] / r
                basis[:, [j, i]] = np.column_stack([c * basis[:, j] - s * basis[:, i], s * basis[:, j] + c * basis[:, i]])
                z[i], z[j] = r, 0.0
                kept[-1] = i
            else:
                kept.append(i)
        moved = np.array(kept)
    if not len(moved):
        return values, basis
    poles, weights = values[moved], z[moved]
    near, x = secular_roots(poles, weights, rho)
    to_root = (poles[None, :] - poles[near][:, None]) - x[:, None]  # pole j minus root i
    # weights that have the found roots exactly: they keep the vectors orthogonal
    n = len(poles)
    ahead = -to_root  # root i minus pole j
    before = np.arange(n - 1)[:, None] < np.arange(n)[None, :]
    other = np.arange(n - 1)[:, None] + ~before
    exact = ahead[-1] * np.prod(ahead[:-1] / (poles[other] - poles[None, :]), axis=0)
    weights = np.sqrt(np.maximum(exact, 0) / rho) * np.sign(weights)
    vectors = weights[None, :] / to_root
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    basis[:, moved] = basis[:, moved] @ vectors.T
    values[moved] = poles[near] + x
    order = np.argsort(values, kind="stable")
    return values[order], basis[:, order]


def added(state: tuple[int, np.ndarray, np.ndarray, np.ndarray], n: int, mean: np.ndarray, values: np.ndarray, vectors: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """``state`` (n, mean, eigenvalues and eigenvectors of the scatter) with ``n`` more vectors of a mean and a scatter.

    One rank-one update for each of ``values`` and one for the distance of the means.
    """
    m, centre, spectrum, basis = state
    apart = mean - centre
    for value, vector in zip(values, vectors.T):
        if value > 0:
            spectrum, basis = rank_one(spectrum, basis, vector, float(value))
    spectrum, basis = rank_one(spectrum, basis, apart, m * n / (m + n))
    return m + n, centre + apart * (n / (m + n)), spectrum, basis


def _lists(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size) - OFFSET


def _spectrum_row(part: int, state) -> pa.RecordBatch:
    n, mean, values, basis = state
    return pa.RecordBatch.from_pydict({"part": pa.array([part]), "n": pa.array([n]), "mean": pa.array([mean.tobytes()], pa.binary()),
                                       "values": pa.array([values.tobytes()], pa.binary()), "basis": pa.array([np.ascontiguousarray(basis).tobytes()], pa.binary())})


def spectra(fit: DataFrame, size: int) -> DataFrame:
    """The spectrum of each task's vectors, updated vector by vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        state = None
        for batch in batches:
            for x in _lists(batch.column("x"), size).astype(np.float64):
                none = np.zeros(0), np.zeros((size, 0))
                state = (1, x, np.zeros(size), np.eye(size)) if state is None else added(state, 1, x, *none)
        if state is not None:
            yield _spectrum_row(TaskContext.get().partitionId(), state)

    return fit.select("x").mapInArrow(run, SPECTRUM)


def combined(parts: DataFrame, n: int, merge, schema: str) -> DataFrame:
    """One row of rows numbered ``part`` below ``n``: ``FAN_IN`` at a time are merged by one task."""
    while n > 1:
        n = -(-n // FAN_IN)
        parts = parts.withColumn("part", F.expr(f"part div {FAN_IN}")).groupBy("part").applyInArrow(merge, schema)
    return parts


def _merged_spectra(group: pa.Table) -> pa.Table:
    rows = sorted(group.to_pylist(), key=lambda r: (-r["n"], r["mean"]))
    states = [(r["n"], np.frombuffer(r["mean"]), np.frombuffer(r["values"]), np.frombuffer(r["basis"])) for r in rows]
    states = [(n, mean, values, basis.reshape(len(mean), len(mean))) for n, mean, values, basis in states]
    state = states[0]
    for other in states[1:]:
        state = added(state, *other)
    return pa.Table.from_batches([_spectrum_row(rows[0]["part"], state)])


def _merged_products(group: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(x.as_py()) for x in group.column("products")], axis=0)
    return pa.table({"part": group.column("part")[:1], "products": pa.array([total.tobytes()], pa.binary())})


def products(fit: DataFrame, size: int, n: int, centre: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Sum over all vectors of (1, y) (1, y)^T, where y is the centred vector in ``basis``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros((basis.shape[1] + 1,) * 2)
        for batch in batches:
            y = (_lists(batch.column("x"), size) - centre) @ basis
            y = np.column_stack([np.ones(len(y)), y])
            total += y.T @ y
        yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()]), "products": pa.array([total.tobytes()], pa.binary())})

    schema = "part long, products binary"
    one = combined(fit.select("x").mapInArrow(run, schema), fit.rdd.getNumPartitions(), _merged_products, schema).first()
    return np.frombuffer(one.products).reshape(basis.shape[1] + 1, -1)


def exact_sums(fit: DataFrame, size: int) -> tuple[int, list[int]]:
    """(number of vectors, sum of each dimension without OFFSET), in whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * size
        for batch in batches:
            x = _lists(batch.column("x"), size)
            n += len(x)
            # halves of 32 bits: their sums stay within 64
            total = [t + (int(a) << 32) + int(b) for t, a, b in zip(total, (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0))]
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, size), pa.int32()), pa.array([n, *total], pa.decimal128(38, 0))], names=["dim", "total"])

    rows = fit.select("x").mapInArrow(run, "dim int, total decimal(38,0)").groupBy("dim").agg(F.sum("total").alias("total")).collect()  # one for each dimension
    by_dim = {r.dim: int(r.total) for r in rows}
    return by_dim.get(-1, 0), [by_dim.get(k, 0) for k in range(size)]


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """((vec_id, x) of the rows that take part, their dimension)."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    sound = rows.where("v is not null and size(v) > 0 and forall(v, c -> c is not null and not isnan(c) and abs(c) < double('Infinity'))")
    common = sound.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if common is None:
        return sound.select("vec_id", F.expr("cast(array() as array<long>)").alias("x")), 0
    limit = float(1 << 50)
    x = F.transform("v", lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(limit)), F.lit(-limit))).cast("long") + OFFSET)
    return sound.where(F.size("v") == common["size"]).select("vec_id", x.alias("x")), common["size"]


def whitened(vectors: DataFrame, components: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each vector and component.

    A row whose vector is null, empty or holds null or non-finite entries is
    left out, and so are vectors of another dimension than the commonest (of
    equally common ones the largest). Repeated rows each have their result but
    count once in the fit. Entries are limited to 2^44 in size; a deviation
    beyond 64 bits is null. Components without variance (below 1e-12 of the
    largest) are not returned, so fewer than two distinct vectors give no row.
    Other columns are ignored.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows, size = integer_vectors(vectors, id_col, vector_col)
    nothing = vectors.sparkSession.createDataFrame([], schema)
    if not size:
        return nothing
    fit = materialize(rows.select("x").distinct(), "whitening_fit")
    n, sums = exact_sums(fit, size)
    if n < 2:
        return nothing
    centre = np.array([s / n for s in sums])
    first = combined(spectra(fit, size), fit.rdd.getNumPartitions(), _merged_spectra, SPECTRUM).first()
    basis, _ = np.linalg.qr(np.frombuffer(first.basis).reshape(size, size))
    ritz, turn = np.linalg.eigh(products(fit, size, n, centre, basis)[1:, 1:] / n)
    ritz, basis = ritz[::-1], (basis @ turn)[:, ::-1]
    kept = int((ritz > 1e-12 * max(ritz[0], 0)).sum()) if ritz[0] > 0 else 0
    k = min(components, kept)
    if not k:
        return nothing
    project, explained = basis[:, :k] / np.sqrt(ritz[:k]), ritz[:k] / ritz.sum()
    seen = products(fit, size, n, centre, project) / n
    error = float(np.abs(seen[1:, 1:] - np.outer(seen[0, 1:], seen[0, 1:]) - np.eye(k)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in schema.split(", ")]
        for batch in batches:
            x = _lists(batch.column("x"), size)
            y = (x - centre) @ project
            largest = max([abs(n * int(v) - s) for edge in (x.min(axis=0), x.max(axis=0)) for v, s in zip(edge, sums)], default=0) if len(x) else 0
            if largest * largest * size < 1 << 63:
                deviation = pa.array(((n * x - np.array(sums, dtype=np.int64)) ** 2).sum(axis=1))
            else:
                whole = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
                deviation = pa.array([v if v < 1 << 63 else None for v in whole], pa.int64())
            owner = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(owner), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(owner), n)),
                deviation.take(owner), pa.array(y.ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(owner), error))], names=names)

    return rows.mapInArrow(run, schema)
