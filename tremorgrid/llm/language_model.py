"""LM scoring with a hashed maximum-entropy model.

The next word's probability is factored: class, then cell or word in the class,
then the word in its cell. The first two are softmaxes over sums of hashed
feature rows (n-grams of the words before, and skips); the last is the smoothed
share of the word in its cell. Frequent words have a place of their own in a
class; every other word belongs to the cell of its first and last letters.

Words are counted through chunks: a chunk's distinct words are shuffled by
hash, counted once for the corpus, and the counts go back to the chunk. The
softmaxes are trained in rounds over disjoint parts of the training texts: each
task makes gradient updates on its texts, and the updates are averaged. Scoring
works on chunks in numpy batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tremorgrid.llm.byte_bpe import pack, unpack
from tremorgrid.llm.tables import input_partitions
from tremorgrid.llm.text import joined, ragged, row_sums, slices, space_words, texts_of, xxh64
from tremorgrid.session import materialize


@dataclass(frozen=True)
class LMConfig:
    classes: int = 32
    cells: int = 8  # of each class, for words without a place of their own
    places: int = 24  # of each class, for frequent words; the end of a text has the first one
    class_rows: int = 1 << 14  # hashed feature rows of the first softmax
    place_rows: int = 1 << 16  # and of the second
    rounds: int = 2
    batch: int = 8192
    rate: float = 0.15
    chunk_bytes: int = 3 << 20

    @property
    def slots(self) -> int:
        return self.cells + self.places


CHUNK = [np.int32, np.int32, np.int64, np.int64, np.uint8, np.uint8, np.int32, np.int32, np.uint8]
CACHED = 1024  # tokens whose rows are summed at once
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def chunked(docs: DataFrame, cfg: LMConfig) -> DataFrame:
    """(chunk, payload): positions, distinct words in order of hash with their training counts, rows' ids and flags."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pa.set_cpu_count(1)
        chunk = TaskContext.get().partitionId() << 32
        for part in slices(batches, "text", cfg.chunk_bytes):
            words, bounds = space_words(pc.ascii_lower(texts_of(part, "text")))
            coded = words.dictionary_encode()
            data, starts, lengths = joined(pa.concat_arrays([coded.dictionary]))
            codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            hashes = xxh64(data, starts, lengths)
            order = np.argsort(hashes)
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order))
            codes = rank[codes]
            held = part.column("held_out").to_numpy(zero_copy_only=False)
            learned = np.bincount(codes[np.repeat(~held, np.diff(bounds))], minlength=len(order))
            frequent = np.argsort(-np.bincount(codes, minlength=len(order)), kind="stable")
            small = np.empty_like(frequent)
            small[frequent] = np.arange(len(frequent))
            ids = part.column("doc_id")
            blob = pack(small[codes].astype(np.int32), frequent.astype(np.int32), bounds.astype(np.int64), pc.fill_null(ids, 0).to_numpy(zero_copy_only=False),
                        ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8), held.astype(np.uint8),
                        lengths[order].astype(np.int32), learned.astype(np.int32), data[ragged(starts[order], lengths[order])])
            yield pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([int((~held).sum())]), pa.array([blob], pa.binary())], names=["chunk", "texts", "payload"])
            chunk += 1

    return docs.select("doc_id", "text", "held_out").mapInArrow(run, "chunk long, texts long, payload binary")


def cells_of(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, cfg: LMConfig) -> np.ndarray:
    """Class * cells + cell of each word: the class from its last bytes, the cell from its first ones."""
    if not len(starts):
        return np.zeros(0, np.int64)
    two = np.minimum(lengths, 3)
    tail = xxh64(data, starts + lengths - two, two, 11) % np.uint64(cfg.classes)
    head = xxh64(data, starts, np.minimum(lengths, 2), 12) % np.uint64(cfg.cells)
    return (tail * np.uint64(cfg.cells) + head).astype(np.int64)


def _shares(chunks: DataFrame, n: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, payload in zip(batch.column("chunk").to_pylist(), batch.column("payload")):
                *_, lengths, learned, data = unpack(payload.as_py(), CHUNK)
                hashes = xxh64(data, np.cumsum(lengths.astype(np.int64)) - lengths, lengths.astype(np.int64))  # cheaper than shipping them
                share = ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)
                cuts = np.r_[0, np.flatnonzero(np.diff(share)) + 1, len(share)]
                edge = np.append(np.cumsum(lengths.astype(np.int64)) - lengths, len(data))
                for a, b in zip(cuts[:-1], cuts[1:]):
                    if b > a:
                        yield pa.RecordBatch.from_arrays([
                            pa.array([share[a]]), pa.array([chunk]),
                            pa.array([pack(lengths[a:b], learned[a:b], data[edge[a] : edge[b]])], pa.binary())], names=["share", "chunk", "payload"])

    return chunks.mapInArrow(run, "share long, chunk long, payload binary")


def counted(chunks: DataFrame, n: int, cfg: LMConfig) -> DataFrame:
    """(chunk, share, counts, head): for each chunk's words of a share the corpus count; and one row per share
    (chunk -1) with the share's sums by cell and its most frequent words."""
    most = cfg.classes * cfg.places

    def run(group: pa.Table) -> pa.Table:
        share = group.column("share")[0].as_py()
        got = [unpack(p.as_py(), [np.int32, np.int32, np.uint8]) for p in group.column("payload")]
        lengths = np.concatenate([x[0] for x in got]).astype(np.int64)
        data = np.concatenate([x[2] for x in got])
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        words = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        coded = words.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        totals = np.bincount(codes, weights=np.concatenate([x[1] for x in got])).astype(np.int64)
        spans = np.concatenate([[0], np.cumsum([len(x[0]) for x in got])])
        out = [pack(totals[codes[a:b]]) for a, b in zip(spans[:-1], spans[1:])]
        known = np.flatnonzero(totals > 0)
        distinct = coded.dictionary.take(pa.array(known))
        own, starts, sizes = joined(distinct.cast(pa.large_string()))
        cell = cells_of(own, starts, sizes, cfg)
        k = cfg.classes * cfg.cells
        sums = np.concatenate([np.bincount(cell, weights=totals[known], minlength=k), np.bincount(cell, minlength=k)]).astype(np.int64)
        hashes = xxh64(own, starts, sizes)
        top = np.lexsort((hashes, -totals[known]))[:most]
        head = [{"hash": int(h), "n": int(c), "cell": int(x)} for h, c, x in zip(hashes[top].view(np.int64), totals[known][top], cell[top])]
        rows = len(out)
        return pa.table({"chunk": pa.array([*group.column("chunk").to_pylist(), -1], pa.int64()), "share": pa.array([share] * (rows + 1), pa.int64()),
                         "counts": pa.array([*out, b""], pa.binary()), "sums": pa.array([None] * rows + [sums.tolist()], pa.list_(pa.int64())),
                         "head": pa.array([None] * rows + [head], pa.list_(pa.struct([("hash", pa.int64()), ("n", pa.int64()), ("cell", pa.int64())])))})

    schema = "chunk long, share long, counts binary, sums array<bigint>, head array<struct<hash:bigint,n:bigint,cell:bigint>>"
    return _shares(chunks, n).groupBy("share").applyInArrow(run, schema)


@dataclass
class Vocabulary:
    """Sums over the training tokens; its size depends on LMConfig only."""

    tokens: int
    distinct: int
    texts: int
    hashes: np.ndarray  # of the frequent words, ascending
    places: np.ndarray  # their class * slots + slot
    cell_tokens: np.ndarray  # of the other words, by cell
    cell_words: np.ndarray


def vocabulary(counts: DataFrame, texts: int, cfg: LMConfig) -> Vocabulary:
    whole = counts.where("chunk = -1")
    sums = np.zeros(2 * cfg.classes * cfg.cells, dtype=np.int64)
    for r in whole.select(F.posexplode("sums").alias("k", "x")).groupBy("k").agg(F.sum("x").alias("x")).collect():  # one row per cell
        sums[r.k] = r.x
    tokens, words = sums.reshape(2, -1)
    total, distinct = int(tokens.sum()), int(words.sum())
    top = whole.select(F.explode("head").alias("h")).select("h.*").orderBy(F.desc("n"), "hash").limit(cfg.classes * cfg.places - 1).collect()
    hashes = np.array([r.hash for r in top], dtype=np.int64).view(np.uint64)
    rank = np.arange(1, len(top) + 1)  # place 0 is the end of a text
    places = rank % cfg.classes * cfg.slots + cfg.cells + rank // cfg.classes
    for r in top:
        tokens[r.cell] -= r.n
        words[r.cell] -= 1
    order = np.argsort(hashes)
    return Vocabulary(total + texts, distinct + (texts > 0), texts, hashes[order], places[order], tokens, words)


def _chunk_tokens(payload: bytes, vocab: Vocabulary, cfg: LMConfig):
    """(places of all tokens, word number of each or -1 for an end, cells of the words, token bounds, ids, missing, held)."""
    positions, frequent, bounds, ids, missing, held, lengths, _, data = unpack(payload, CHUNK)
    lengths = lengths.astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    cell, hashes = cells_of(data, starts, lengths, cfg), xxh64(data, starts, lengths)
    place = cell // cfg.cells * cfg.slots + cell % cfg.cells
    if len(vocab.hashes) and len(hashes):
        at = np.minimum(np.searchsorted(vocab.hashes, hashes), len(vocab.hashes) - 1)
        place = np.where(vocab.hashes[at] == hashes, vocab.places[at], place)
    edges = bounds + np.arange(len(bounds))
    code = np.full(int(edges[-1]), -1, dtype=np.int64)
    spots = np.ones(len(code), dtype=bool)
    spots[edges[1:] - 1] = False
    code[spots] = frequent[positions]
    tokens = np.full(len(code), cfg.cells, dtype=np.int64)  # an end: class 0, first place
    tokens[spots] = place[code[spots]]
    return tokens, code, cell, edges, ids, missing, held


def _texts_tokens(tokens: np.ndarray, edges: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of the ``chosen`` texts alone, and their bounds."""
    sizes = np.diff(edges)
    return tokens[np.repeat(chosen, sizes)], np.concatenate([[0], np.cumsum(sizes[chosen])])


def _features(tokens: np.ndarray, edges: np.ndarray, cfg: LMConfig) -> list[np.ndarray]:
    """Hashed features of each token: bias, n-grams of the one, two and three words before, and the second and third before alone (skips)."""
    start = np.repeat(edges[:-1], np.diff(edges))
    inside = np.arange(len(tokens)) - start
    before = []
    for k in (1, 2, 3):
        x = np.zeros(len(tokens), dtype=np.uint64)
        x[k:] = tokens[:-k].astype(np.uint64) + np.uint64(1)
        x[inside < k] = 0
        before.append(x)
    with np.errstate(over="ignore"):
        two = before[1] * np.uint64(1 << 20) + before[0]
        kinds = [np.zeros(len(tokens), np.uint64), before[0], two, before[2] * np.uint64(1 << 40) + two, before[1], before[2]]
        return [_scramble(x * np.uint64(8) + np.uint64(k)) for k, x in enumerate(kinds)]


def _scramble(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x + _MIX[0]) * _MIX[1]
        x = (x ^ (x >> np.uint64(31))) * _MIX[2]
        return x ^ (x >> np.uint64(29))


def _run_sums(values: np.ndarray, at: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Sums of ``values[at]`` over the runs that begin at ``heads``; most runs have one row and are only copied."""
    sizes = np.diff(np.append(heads, len(at)))
    out = values.take(at[heads], axis=0)
    for n in range(2, 9):  # as reduceat adds: the first number and the sum of the others
        own = np.flatnonzero(sizes == n)
        rest = [values.take(at[heads[own] + k], axis=0) for k in range(1, n)]
        if n > 4:  # four numbers and more are added in pairs
            rest[:4] = [(rest[0] + rest[1]) + (rest[2] + rest[3])]
        for more in rest[1:]:
            rest[0] += more
        out[own] += rest[0]
    many = sizes > 8
    if many.any():
        ends = np.cumsum(sizes[many])
        # two numbers at a time: reduceat pays for each run and column
        out[many] = np.add.reduceat(values.take(at[np.repeat(many, sizes)], axis=0).view(np.complex64), ends - sizes[many], axis=0).view(np.float32)
    return out


def _greatest(z: np.ndarray) -> np.ndarray:
    """The greatest number of each row, as a column: halves of the rows are compared whole."""
    while z.shape[1] % 2 == 0 and z.shape[1] > 8:
        z = np.maximum(z[:, : z.shape[1] // 2], z[:, z.shape[1] // 2 :])
    most = z[:, 0].copy()
    for k in range(1, z.shape[1]):
        np.maximum(most, z[:, k], out=most)
    return most[:, None]


class Softmaxes:
    """Two tables of feature rows; ``step`` makes one update, ``log_probability`` scores."""

    def __init__(self, tables: list[np.ndarray], cfg: LMConfig, seen: list[np.ndarray] | None = None):
        self.tables, self.cfg = tables, cfg
        self.seen = seen or [np.full(len(t), 1e-2, dtype=np.float32) for t in tables]
        self._held: dict[tuple, np.ndarray] = {}

    def _space(self, name: str, rows: int, width: int) -> np.ndarray:
        """Memory that all batches use again: fresh pages cost more than the sums written to them."""
        held = self._held.get((name, width))
        if held is None or len(held) < rows:
            held = self._held[name, width] = np.empty((rows, width), dtype=np.float32)
        return held[:rows]

    def _rows(self, features: list[np.ndarray], classes: np.ndarray) -> list[np.ndarray]:
        """Rows of both tables, a line for each feature; the tables' sizes are powers of two, up to 2^16."""
        small, large = (np.uint64(65 - int(n).bit_length()) for n in (self.cfg.class_rows, self.cfg.place_rows))
        own = _scramble(classes.astype(np.uint64))
        first, second = (np.empty((len(features), len(classes)), dtype=np.uint16) for _ in range(2))
        with np.errstate(over="ignore"):
            for k, f in enumerate(features):
                first[k] = f >> small
                second[k] = ((f ^ own) * _MIX[2]) >> large
        return [first, second]

    def _exponentials(self, table: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(exponentials of every token's sums over ``rows``, their sum by token), valid until the next call; blocks of tokens
        stay in the processor's cache."""
        n, width = rows.shape[1], table.shape[1]
        out, total, spare = self._space("sums", n, width), self._space("total", n, 1), self._space("row", CACHED, width)
        for a in range(0, len(out), CACHED):
            z, at = out[a : a + CACHED], rows[:, a : a + CACHED].astype(np.intp)
            row = spare[: len(z)]
            table.take(at[1], axis=0, out=z, mode="clip")  # unlike "raise", it writes to ``out`` directly
            z += table[at[0, 0]] if (at[0] == at[0, 0]).all() else table.take(at[0], axis=0, out=row, mode="clip")  # the bias may have one row
            for own in at[2:]:
                z += table.take(own, axis=0, out=row, mode="clip")
            z -= _greatest(z)
            np.exp(z, out=z)
            z.sum(axis=1, keepdims=True, out=total[a : a + CACHED])
        return out, total

    def log_probability(self, features: list[np.ndarray], tokens: np.ndarray) -> np.ndarray:
        out = np.empty(len(tokens), dtype=np.float64)
        for a in range(0, len(tokens), self.cfg.batch):
            own = tokens[a : a + self.cfg.batch]
            classes, slots = own // self.cfg.slots, own % self.cfg.slots
            each, p = np.arange(len(own)), []
            for table, rows, target in zip(self.tables, self._rows([f[a : a + self.cfg.batch] for f in features], classes), (classes, slots)):
                z, total = self._exponentials(table, rows)
                p.append(z[each, target] / total[:, 0])  # only the token's own share
            out[a : a + self.cfg.batch] = np.log(np.maximum(p[0], 1e-30)) + np.log(np.maximum(p[1], 1e-30))
        return out

    def step(self, features: list[np.ndarray], tokens: np.ndarray) -> None:
        classes = tokens // self.cfg.slots
        each = np.arange(len(tokens))
        for table, seen, rows, target in zip(self.tables, self.seen, self._rows(features, classes), (classes, tokens % self.cfg.slots)):
            error, total = self._exponentials(table, rows)
            error /= total
            error[each, target] -= 1
            flat = rows.T.ravel()
            order = np.argsort(flat, kind="stable")
            ranked = flat[order]
            heads = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
            gradient = _run_sums(error, order // len(rows), heads)
            touched = ranked[heads].astype(np.int64)
            spare = self._space("row", CACHED, table.shape[1])
            for a in range(0, len(touched), CACHED):
                own, moved = touched[a : a + CACHED], gradient[a : a + CACHED]
                row = spare[: len(own)]
                so_far = seen[own] + np.multiply(moved, moved, out=row).mean(axis=1)
                seen[own] = so_far
                moved *= (self.cfg.rate / np.sqrt(so_far))[:, None]
                table.take(own, axis=0, out=row, mode="clip")
                table[own] = np.subtract(row, moved, out=row)


BLOCK = 1024


def train(chunks: DataFrame, vocab: Vocabulary, cfg: LMConfig) -> list[np.ndarray]:
    """Feature rows after ``cfg.rounds`` rounds; every training text is used in exactly one of them."""
    spark = chunks.sparkSession
    shapes = [(cfg.class_rows, cfg.classes), (cfg.place_rows, cfg.slots)]
    tables = [np.zeros(s, dtype=np.float32) for s in shapes]
    for turn in range(cfg.rounds):
        state = spark.sparkContext.broadcast((tables, vocab))

        def learn(batches: Iterator[pa.RecordBatch], turn=turn, state=state) -> Iterator[pa.RecordBatch]:
            before, words = state.value
            model, worked = Softmaxes([t.copy() for t in before], cfg), False
            for batch in batches:
                for payload in batch.column("payload"):
                    tokens, _, _, edges, _, _, held = _chunk_tokens(payload.as_py(), words, cfg)
                    chosen = (held == 0) & (np.arange(len(held)) % cfg.rounds == turn)
                    tokens, edges = _texts_tokens(tokens, edges, chosen)  # features never look beyond a text
                    features = _features(tokens, edges, cfg)
                    for a in range(0, len(tokens), cfg.batch):
                        model.step([f[a : a + cfg.batch] for f in features], tokens[a : a + cfg.batch])
                        worked = True
            if worked:
                block = 0
                for new, old, seen in zip(model.tables, before, model.seen):
                    for a in range(0, len(new), BLOCK):
                        moved = (new[a : a + BLOCK] - old[a : a + BLOCK]).astype(np.float16)
                        yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([moved.tobytes()], pa.binary()), pa.array([(seen[a : a + BLOCK] - 1e-2).astype(np.float32).tobytes()], pa.binary())],
                                                         names=["block", "moved", "weight"])
                        block += 1

        def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, list[np.ndarray]] = {}  # the blocks of one share: bounded by the model's size
            for batch in batches:
                for block, moved, weight in zip(batch.column("block").to_pylist(), batch.column("moved"), batch.column("weight")):
                    w = np.sqrt(np.maximum(np.frombuffer(weight.as_py(), np.float32), 0)).astype(np.float64)
                    d = np.frombuffer(moved.as_py(), np.float16).reshape(len(w), -1).astype(np.float64)
                    own = sums.setdefault(block, [np.zeros(d.shape), np.zeros(len(w))])
                    own[0] += d * w[:, None]
                    own[1] += w
            for block, (d, w) in sums.items():
                mean = d / np.maximum(w, 1e-12)[:, None]
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([mean.astype(np.float32).tobytes()], pa.binary())], names=["block", "moved"])

        updates = chunks.select("payload").mapInArrow(learn, "block long, moved binary, weight binary").repartition(16, "block")
        blocks = updates.mapInArrow(average, "block long, moved binary").toArrow()  # the model: a fixed number of blocks
        tables = [t.copy() for t in tables]
        flat = [(t, a) for t in tables for a in range(0, len(t), BLOCK)]
        for block, moved in zip(blocks.column("block").to_pylist(), blocks.column("moved")):
            t, a = flat[block]
            t[a : a + BLOCK] += np.frombuffer(moved.as_py(), np.float32).reshape(-1, t.shape[1])
    return tables


def lm_scores(docs: DataFrame, cfg: LMConfig = LMConfig(), id_col: str = "doc_id", text_col: str = "text", held_out=None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per input row.

    ``held_out``: a boolean column, true for rows that are scored but not
    learned from (null: false). Tokens are the lower-cased words and one end.
    ``base_score`` is that of a smoothed unigram model, ``score`` the model's,
    both log10. Null and empty texts have the end alone. Rows with equal or null
    ids stay apart and are learned from as often as they occur; without any
    training row all words are unknown. Other columns are ignored.
    """
    held = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), held.alias("held_out"))
    n = max(8, 2 * input_partitions(rows))
    chunks = materialize(chunked(rows, cfg), "lm_chunks")
    counts = materialize(counted(chunks, n, cfg), "lm_counts")
    texts = chunks.agg(F.sum("texts")).first()[0] or 0
    vocab = vocabulary(counts, texts, cfg)
    tables = train(chunks, vocab, cfg)
    state = docs.sparkSession.sparkContext.broadcast((tables, vocab))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        tables, vocab = state.value
        model, out = Softmaxes(tables, cfg), []
        parts = sorted(zip(right.column("share").to_pylist(), right.column("counts")), key=lambda x: x[0])
        count = np.concatenate([unpack(p.as_py(), [np.int64])[0] for _, p in parts]) if parts else np.zeros(0, np.int64)
        for payload in left.column("payload"):
            tokens, code, cell, edges, ids, missing, held = _chunk_tokens(payload.as_py(), vocab, cfg)
            c = np.where(code >= 0, np.append(count, 0)[code], vocab.texts)
            base = np.log10((c + 1) / (vocab.tokens + vocab.distinct + 1))
            logp = model.log_probability(_features(tokens, edges, cfg), tokens) / np.log(10)
            rare = np.flatnonzero((code >= 0) & (tokens % cfg.slots < cfg.cells))
            own = cell[code[rare]]
            logp[rare] += np.log10((c[rare] + 1) / (vocab.cell_tokens[own] + vocab.cell_words[own] + 1))
            size = np.diff(edges)
            out.append(pa.table({
                "doc_id": pa.array(ids, mask=missing.astype(bool)), "held_out": pa.array(held.astype(bool)), "n_tokens": pa.array(size),
                "n_known": pa.array(row_sums((c > 0).astype(np.int64), edges)), "train_tokens": pa.array(np.full(len(size), vocab.tokens)),
                "base_score": pa.array(_exact_sums(base, edges)), "score": pa.array(_exact_sums(logp, edges))}))
        return pa.concat_tables(out) if out else EMPTY

    return chunks.select("chunk", "payload").groupBy("chunk").cogroup(counts.where("chunk >= 0").select("chunk", "share", "counts").groupBy("chunk")).applyInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _exact_sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Each text's sum on its own: no rounding carried over from other texts (every text has a token)."""
    return np.add.reduceat(values, edges[:-1]) if len(edges) > 1 else np.zeros(0)


EMPTY = pa.table({"doc_id": pa.array([], pa.int64()), "held_out": pa.array([], pa.bool_()), "n_tokens": pa.array([], pa.int64()), "n_known": pa.array([], pa.int64()),
                  "train_tokens": pa.array([], pa.int64()), "base_score": pa.array([], pa.float64()), "score": pa.array([], pa.float64())})
