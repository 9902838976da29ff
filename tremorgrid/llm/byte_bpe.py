"""Byte-level BPE: every distinct pre-token of the corpus is encoded once.

A task turns its texts into chunks: the chunk's distinct pre-tokens, and for
every position the number of its pre-token (the exploded form, one integer a
row). The distinct pre-tokens are shuffled by their hash; in each share every
distinct one is encoded once and its ids go back to the chunks that hold it.
There ids are put together by position. A pre-token goes through the shuffle at
most once per chunk, so no frequent word makes a share large.

Decoding joins ids with the table of token bytes (one row per token, bounded by
the vocabulary).
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F

from tremorgrid.llm.tables import input_partitions, text_key
from tremorgrid.llm.text import joined, ragged, segments, slices, texts_of, xxh64

CHUNK_BYTES = 12 << 20
SHARES_PER_PARTITION = 2
CHUNKS = "chunk long, payload binary"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def byte_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all tokens in order of id, n + 1 bounds)."""
    by_id = sorted((i, t) for t, i in ranks.items())
    lengths = np.zeros(by_id[-1][0] + 1, dtype=np.int64)
    lengths[[i for i, _ in by_id]] = [len(t) for _, t in by_id]
    return np.frombuffer(b"".join(t for _, t in by_id), dtype=np.uint8), np.concatenate([[0], np.cumsum(lengths)])


def pack(*arrays: np.ndarray) -> bytes:
    """Integers and bytes, each plane of equal byte places compressed for itself."""
    press, out = zstandard.ZstdCompressor(level=1), []
    for a in arrays:
        planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T) if len(a) else np.zeros((a.itemsize, 0), np.uint8)
        body = [press.compress(p.tobytes()) for p in planes]
        out += [np.array([len(a), a.itemsize, *map(len, body)], dtype="<i8").tobytes(), *body]
    return b"".join(out)


def unpack(data: bytes, dtypes: list) -> list[np.ndarray]:
    press, at, out = zstandard.ZstdDecompressor(), 0, []
    for dtype in map(np.dtype, dtypes):
        n, width = np.frombuffer(data, "<i8", 2, at)
        sizes = np.frombuffer(data, "<i8", width, at + 16)
        at += 16 + 8 * int(width)
        planes = np.empty((width, n), dtype=np.uint8)
        for k, size in enumerate(sizes):
            planes[k] = np.frombuffer(press.decompress(data[at : at + size], max_output_size=int(n)), np.uint8)
            at += int(size)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(dtype))
    return out


def pretokens(texts: pa.Array, pattern) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct pre-tokens, number of the pre-token at each position, each text's bounds).

    The pattern is run once on every distinct segment between safe cuts.
    """
    pieces, bounds = segments(texts)
    coded = pieces.dictionary_encode()
    numbers: dict[str, int] = {}
    flat, sizes = array("i"), array("i")
    for piece in coded.dictionary:
        found = pattern.findall(piece.as_py())
        sizes.append(len(found))
        flat.extend([numbers.setdefault(x, len(numbers)) for x in found])
    flat, sizes = np.frombuffer(flat, np.int32) if flat else np.zeros(0, np.int32), np.array(sizes, dtype=np.int64)
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    counts = sizes[codes]
    positions = flat[ragged((np.cumsum(sizes) - sizes)[codes], counts)] if len(codes) else np.zeros(0, np.int32)
    return list(numbers), positions, np.concatenate([[0], np.cumsum(counts)])[bounds]


def _chunk(part: pa.RecordBatch, cut) -> bytes:
    """The payload of one slice: positions, distinct pre-tokens in order of their hash, and the rows' ids and keys."""
    words, positions, bounds = pretokens(texts_of(part, "text"), cut)
    words = pa.array(words, pa.large_string())
    data, starts, lengths = joined(words)
    order = np.argsort(xxh64(data, starts, lengths))
    rank = np.empty(len(order), dtype=np.int32)
    rank[order] = np.arange(len(order))
    positions = rank[positions]
    frequent = np.argsort(-np.bincount(positions, minlength=len(order)), kind="stable")  # small numbers for frequent ones
    small = np.empty(len(order), dtype=np.int32)
    small[frequent] = np.arange(len(frequent))
    ids = part.column("doc_id")
    return pack(small[positions], frequent.astype(np.int32), bounds.astype(np.int64),
                pc.fill_null(ids, 0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8),
                part.column("text_key").to_numpy(zero_copy_only=False), lengths[order].astype(np.int32),
                data[ragged(starts[order], lengths[order])])


def chunked(docs: DataFrame, pattern: str) -> DataFrame:
    """(chunk, payload) of every slice of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex
        from pyspark import TaskContext

        pa.set_cpu_count(1)
        cut, chunk = regex.compile(pattern), TaskContext.get().partitionId() << 32
        for part in slices(batches, "text", CHUNK_BYTES):
            yield pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([_chunk(part, cut)], pa.binary())], names=["chunk", "payload"])
            chunk += 1

    rows = docs.withColumn("text_key", text_key(F.col("text")))
    return rows.select("doc_id", "text", "text_key").mapInArrow(run, CHUNKS)


PAYLOAD = [np.int32, np.int32, np.int64, np.int64, np.uint8, np.int64, np.int32, np.uint8]


def shares(chunks: DataFrame, n: int) -> DataFrame:
    """(share, chunk, payload): a chunk's distinct pre-tokens, split by hash into ``n`` shares."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, payload in zip(batch.column("chunk").to_pylist(), batch.column("payload")):
                *_, lengths, data = unpack(payload.as_py(), PAYLOAD)
                edge = np.cumsum(lengths.astype(np.int64)) - lengths
                hashes = xxh64(data, edge, lengths.astype(np.int64))  # cheaper to compute again than to ship
                share = ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)  # hashes ascend, shares too
                cuts = np.r_[0, np.flatnonzero(np.diff(share)) + 1, len(share)]
                edge = np.append(edge, len(data))
                for a, b in zip(cuts[:-1], cuts[1:]):
                    if b > a:
                        yield pa.RecordBatch.from_arrays([
                            pa.array([share[a]]), pa.array([chunk]), pa.array([pack(lengths[a:b], data[edge[a] : edge[b]])], pa.binary())],
                            names=["share", "chunk", "payload"])

    return chunks.mapInArrow(run, "share long, chunk long, payload binary")


def encoded_shares(parts: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(chunk, share, ids): for each chunk's pre-tokens of a share, the number of ids of each and all ids."""

    def run(group: pa.Table) -> pa.Table:
        import tiktoken

        core = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=_ranks(ranks_path), special_tokens={})
        numbers: dict[bytes, int] = {}
        ids: list[list[int]] = []
        chunks, out = [], []
        for chunk, payload in zip(group.column("chunk").to_pylist(), group.column("payload")):
            lengths, data = unpack(payload.as_py(), [np.int32, np.uint8])
            raw, ends = data.tobytes(), np.cumsum(lengths).tolist()
            own = []
            for a, b in zip([0, *ends], ends):
                word = raw[a:b]
                k = numbers.get(word)
                if k is None:
                    k = numbers[word] = len(ids)
                    ids.append(core.encode_ordinary(word.decode()))
                own.append(k)
            found = [ids[k] for k in own]
            flat = np.fromiter((i for x in found for i in x), dtype=np.int32)
            chunks.append(chunk)
            out.append(pack(np.array([len(x) for x in found], dtype=np.int32), flat))
        share = group.column("share")[0].as_py()
        return pa.table({"chunk": pa.array(chunks, pa.int64()), "share": pa.array([share] * len(chunks), pa.int64()), "ids": pa.array(out, pa.binary())})

    return parts.groupBy("share").applyInArrow(run, "chunk long, share long, ids binary")


_RANKS: dict[str, dict[bytes, int]] = {}


def _ranks(path: str) -> dict[bytes, int]:
    """A worker reads the rank file once."""
    if path not in _RANKS:
        _RANKS[path] = load_ranks(path)
    return _RANKS[path]


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """(doc_id, text_key, n_tokens, ids_sha256, decoded_sha256, decoded_bytes[, ids]), one row per input row.

    ids: the text's token ids, as tiktoken gives them without special tokens.
    ``ids_sha256`` is over little-endian unsigned 32-bit integers, and
    ``decoded_sha256`` over the bytes that the ids decode to. Null counts as
    the empty text, which has no ids. Rows with equal or null ids stay apart;
    other columns are ignored; an empty table gives an empty result.
    """
    table = byte_table(load_ranks(ranks_path))
    shared = docs.sparkSession.sparkContext.broadcast(table)
    n = max(8, SHARES_PER_PARTITION * input_partitions(docs))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    n_out = max(8, input_partitions(docs))
    chunks = chunked(rows, pattern).repartition(n_out, "chunk")  # one exchange, read twice
    ids = encoded_shares(shares(chunks, n), ranks_path, pattern)

    def assemble(left: pa.Table, right: pa.Table) -> pa.Table:
        names = [*OUT, "ids"] if with_ids else OUT
        parts = sorted(zip(right.column("share").to_pylist(), right.column("ids")), key=lambda x: x[0])
        got = [unpack(p.as_py(), [np.int32, np.int32]) for _, p in parts]
        sizes = np.concatenate([x[0] for x in got]).astype(np.int64) if got else np.zeros(0, np.int64)
        flat = np.concatenate([x[1] for x in got]) if got else np.zeros(0, np.int32)
        starts = np.cumsum(sizes) - sizes
        tables = []
        for payload in left.column("payload"):
            positions, frequent, bounds, doc_ids, missing, keys, *_ = unpack(payload.as_py(), PAYLOAD)
            code = frequent[positions]
            tokens = flat[ragged(starts[code], sizes[code])]
            edges = np.concatenate([[0], np.cumsum(sizes[code])])[bounds]
            rows, data, place = [], *shared.value
            for k, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
                own = tokens[a:b].astype("<u4")
                decoded = data[ragged(place[own], place[own + 1] - place[own])].tobytes()
                row = (None if missing[k] else int(doc_ids[k]), int(keys[k]), b - a, hashlib.sha256(own.tobytes()).hexdigest(),
                       hashlib.sha256(decoded).hexdigest(), len(decoded))
                rows.append((*row, own.astype(np.int32)) if with_ids else row)
            columns = list(zip(*rows)) if rows else [()] * len(names)
            tables.append(pa.table([pa.array(c, t) for c, t in zip(columns, TYPES)], names=names))
        return pa.concat_tables(tables) if tables else pa.table([pa.array([], t) for t in TYPES[: len(names)]], names=names)

    schema = "doc_id long, text_key long, n_tokens long, ids_sha256 string, decoded_sha256 string, decoded_bytes long" + ", ids array<int>" * with_ids
    return chunks.groupBy("chunk").cogroup(ids.groupBy("chunk")).applyInArrow(assemble, schema)


OUT = ["doc_id", "text_key", "n_tokens", "ids_sha256", "decoded_sha256", "decoded_bytes"]
TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int32())]


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded`` (binary): its ids joined with the table of token bytes.

    Null ids decode to null, no ids to no bytes; an id outside the table raises.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(byte_table(load_ranks(ranks_path)))

    @F.pandas_udf("binary")
    def bytes_of(column):
        data, place = shared.value
        return column.map(lambda ids: None if ids is None else data[ragged(place[ids], place[np.asarray(ids) + 1] - place[ids])].tobytes() if len(ids) else b"")

    return encoded.withColumn("decoded", bytes_of(F.col(ids_col)))
