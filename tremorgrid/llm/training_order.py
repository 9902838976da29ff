"""Token ids in training order, as binary shards of fixed stride.

Texts become sequences of a fixed number of ids. Sequence i of n goes to slot
P(i), where P is a keyed Feistel permutation of the next power of four, walked
along its cycle until it falls below n: a permutation of 0..n-1 that needs no
shuffle to compute and no table to invert. Slots are cut into ranges; each range is one
partition, sorted by slot and written as one shard. A record is the ids as
little-endian unsigned 16-bit integers and one end byte, so slot s lies at byte
(s mod slots per shard) * stride of shard s div slots per shard: reading can
start or resume anywhere.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tremorgrid.llm.byte_bpe import _ranks
from tremorgrid.llm.tables import input_partitions
from tremorgrid.llm.text import ragged, segments, slices, texts_of
from tremorgrid.session import scratch_path, small_side

ROUNDS = 6
KNOWN_PIECES = 200_000  # pieces whose ids a task keeps at hand
SEQUENCES = "part long, place long, doc_id long, seq int, n_tokens int, record binary"


def _mixed(x: np.ndarray, key: int, turn: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x + np.uint64((key * 0x9E3779B97F4A7C15 + turn * 0xD1B54A32D192ED03) & (2**64 - 1))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, n: int, key: int, back: bool = False) -> np.ndarray:
    """P(index) for indices below ``n`` (``back``: the inverse)."""
    half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    turns = range(ROUNDS)[:: -1 if back else 1]
    x = np.asarray(index).astype(np.uint64).copy()
    out, todo = x.copy(), np.arange(len(x))
    while len(todo):
        left, right = x >> np.uint64(half), x & low
        for turn in turns:
            if back:
                left, right = right ^ (_mixed(left, key, turn) & low), left
            else:
                left, right = right, left ^ (_mixed(right, key, turn) & low)
        x = (left << np.uint64(half)) | right
        done = x < np.uint64(n)
        out[todo[done]] = x[done]
        x, todo = x[~done], todo[~done]
    return out.astype(np.int64)


def slot_of(index: Column, n: int, key: int) -> Column:
    @F.arrow_udf("long")
    def slots(column: pa.Array) -> pa.Array:
        return pa.array(permuted(column.to_numpy(zero_copy_only=False), n, key))

    return slots(index)


def sequences(docs: DataFrame, ranks_path: str, pattern: str, length: int, end_id: int) -> DataFrame:
    """Sequences of ``length`` ids: a text's ids and one end, the last sequence filled up with ends."""
    if end_id >= 1 << 16:
        raise ValueError("ids are stored in 16 bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken
        from pyspark import TaskContext

        pa.set_cpu_count(1)
        part, place = TaskContext.get().partitionId(), 0
        known: dict[str, bytes] = {}
        core = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=_ranks(ranks_path), special_tokens={})

        def of_slice(batch: pa.RecordBatch) -> pa.RecordBatch:
            pieces, bounds = segments(texts_of(batch, "text"))
            coded = pieces.dictionary_encode()
            positions = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            found = []
            for piece in coded.dictionary.to_pylist():
                ids = known.get(piece)
                if ids is None:
                    ids = array("H", core.encode_ordinary(piece)).tobytes()  # unlike lists, not looked through for cycles
                    if len(known) < KNOWN_PIECES:  # a slice may fill it alone: what is frequent stays
                        known[piece] = ids
                found.append(ids)
            sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 2
            flat = np.frombuffer(b"".join(found), dtype=np.uint16)
            tokens = flat[ragged((np.cumsum(sizes) - sizes)[positions], sizes[positions])] if len(positions) else np.zeros(0, np.uint16)
            edges = np.concatenate([[0], np.cumsum(sizes[positions])])[bounds] if len(positions) else np.zeros(len(bounds), np.int64)
            n_ids = np.diff(edges)
            n_seq = n_ids // length + 1
            first = (np.cumsum(n_seq) - n_seq) * length
            out = np.full(int(n_seq.sum()) * length, end_id, dtype="<u2")
            out[ragged(first, n_ids)] = tokens
            owner = np.repeat(np.arange(len(n_seq)), n_seq)
            seq = np.arange(len(owner)) - np.repeat(np.cumsum(n_seq) - n_seq, n_seq)
            used = np.minimum(n_ids[owner] + 1 - seq * length, length)
            records = pa.Array.from_buffers(pa.binary(), len(owner), [None, pa.py_buffer((np.arange(len(owner) + 1) * (2 * length)).astype(np.int32)), pa.py_buffer(out)])
            return pa.RecordBatch.from_arrays([
                pa.array(np.full(len(owner), part)), pa.array(np.arange(place, place + len(owner))), batch.column("doc_id").take(pa.array(owner)),
                pa.array(seq.astype(np.int32)), pa.array(used.astype(np.int32)), records], names=[x.split()[0] for x in SEQUENCES.split(", ")])

        for batch in slices(batches, "text"):
            found = of_slice(batch)
            place += len(found)
            yield found
        batch = found = None
        known.clear()
        pa.default_memory_pool().release_unused()  # the worker stays, beside those of the stages that follow

    return docs.mapInArrow(run, SEQUENCES)


def write_training_order(docs: DataFrame, ranks_path: str, pattern: str, end_id: int, key: int, length: int = 256,
                         shard_bytes: int = 16 << 20, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> tuple[DataFrame, str, dict]:
    """Writes the shards; returns (manifest, folder of the shards, layout).

    manifest: doc_id, seq, n_tokens, slot, shard, byte_offset, one row per
    sequence. Null and empty texts have one sequence that holds the end alone.
    Rows with equal or null ids have sequences of their own; other columns are
    ignored; an empty table has no shard. Spark's writer commits the shards, so
    a lost or repeated task leaves no partial file.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    parts, base = input_partitions(rows), path or scratch_path(spark, "training_order")
    sequences(rows, ranks_path, pattern, length, end_id).write.option("compression", "zstd").parquet(f"{base}/sequences")
    found = spark.read.parquet(f"{base}/sequences")
    sizes = found.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes.select("part", before.alias("before"), "n").write.parquet(f"{base}/offsets")  # one row per task
    offsets = spark.read.parquet(f"{base}/offsets")
    n = offsets.agg(F.sum("n")).first()[0] or 0
    stride = 2 * length + 1
    per_shard = max(1, shard_bytes // stride)
    layout = {"sequences": n, "length": length, "stride": stride, "slots_per_shard": per_shard, "shards": -(-n // per_shard), "key": key}
    placed = (
        found.join(small_side(offsets, parts), "part").withColumn("slot", slot_of(F.col("before") + F.col("place"), n, key))
        .withColumn("shard", F.expr(f"cast(slot div {per_shard} as int)"))
        .withColumn("byte_offset", F.expr(f"slot % {per_shard} * {stride}"))
    )
    folder = f"{base}/shards"
    if n:
        (placed.select("shard", "slot", F.col("record").cast("string").alias("value")).repartitionById(layout["shards"], F.col("shard"))
         .sortWithinPartitions("shard", "slot").select("shard", "value").write.partitionBy("shard").option("lineSep", "\n").text(folder))
    return placed.select("doc_id", "seq", "n_tokens", "slot", "shard", "byte_offset"), folder, layout


def read_slots(spark: SparkSession, folder: str, layout: dict, first: int = 0, last: int | None = None, hashes: bool = False) -> DataFrame:
    """(slot, ids), or with ``hashes`` (slot, sha256), of the slots from ``first`` up to before ``last``; only the shards that hold them are opened.

    ``sha256`` is over the record's bytes.
    """
    last = layout["sequences"] if last is None else last
    per, stride, length = layout["slots_per_shard"], layout["stride"], layout["length"]
    files = spark.read.format("binaryFile").load(folder)  # ``shard`` comes from the folder names
    files = files.where((F.col("shard") >= first // per) & (F.col("shard") <= max(first, last - 1) // per)).select("shard", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content")):
                raw = np.frombuffer(content.as_buffer(), np.uint8).reshape(-1, stride)
                slot = np.arange(len(raw)) + shard * per
                inside = np.flatnonzero((slot >= first) & (slot < last))
                if hashes:  # row by row, without a copy of the shard
                    found = pa.array([hashlib.sha256(raw[k, :-1]).hexdigest() for k in inside], pa.string())
                else:
                    ids = np.ascontiguousarray(raw[inside, :-1]).view("<u2").astype(np.int32)
                    found = pa.ListArray.from_arrays(pa.array((np.arange(len(ids) + 1) * length).astype(np.int32)), pa.array(ids.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(slot[inside]), found], names=["slot", "sha256" if hashes else "ids"])

    return files.mapInArrow(run, "slot long, sha256 string" if hashes else "slot long, ids array<int>")
