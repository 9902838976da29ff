"""Benchmark decontamination as a prefix-filtered set join.

The sets are windows of consecutive words of benchmark items and windows of the
same length of documents; their elements are word shingles. A document window
counts only if it contains the whole item window, so one shingle of the item
window is a sufficient prefix: the one that is rarest among the documents.
Documents are joined on that shingle alone; its place in the item window gives
the one possible start in the document (positional bound), which must lie
inside the text together with its end (length bound). What is left is verified
word by word.

Which document shingles can occur in the benchmark is told by a bit table of
fixed size, so only their occurrences leave the scan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tremorgrid.llm.tables import documents, free_name, text_key
from tremorgrid.llm.text import alphanumeric_words, joined, shingle_rows, slices, texts_of, xxh64
from tremorgrid.session import materialize

WINDOW = 10
SHINGLE = 5
TABLE_BITS = 24  # of the bit table: 2 MB, whatever the size of the benchmark

ITEM_SCHEMA = "item_id long, words array<string>"
SCAN_SCHEMA = ("rid long, doc_id long, text_key long, n_words long, "
               "found array<struct<pos:int,width:int,token:long,lead:int,near:string>>")


def item_windows(items: DataFrame, window: int, shingle: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(distinct windows with their tokens, windows of each item).

    windows: wid, size, words, tokens (position inside, width, token); owners: wid, item_id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            words, bounds = alphanumeric_words(texts_of(part, "text"))
            lists = pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), words.cast(pa.string()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists.cast(pa.list_(pa.string()))], names=["item_id", "words"])

    texts = documents(items, id_col, text_col).mapInArrow(run, ITEM_SCHEMA).where(F.size("words") > 0)
    cut = texts.select("item_id", F.explode(F.expr(
        f"transform(sequence(1, greatest(1, size(words) - {window - 1})), i -> slice(words, i, {window}))")).alias("w"))
    owners = cut.select(F.array_join("w", " ").alias("words"), "item_id").distinct()
    windows = (
        owners.select("words").distinct()
        .withColumn("wid", F.xxhash64("words"))
        .withColumn("w", F.split("words", " "))
        .withColumn("size", F.size("w"))
        .withColumn("tokens", F.expr(
            f"transform(sequence(0, greatest(0, size - {shingle})), i -> struct(i as pos, least({shingle}, size) as width, "
            f"xxhash64(array_join(slice(w, i + 1, {shingle}), ' ')) as token))"))
        .drop("w")
    )
    return windows, owners


def _bits(tokens: np.ndarray, size: int) -> np.ndarray:
    table = np.zeros(size >> 3, dtype=np.uint8)
    slot = tokens.view(np.uint64) >> np.uint64(64 - TABLE_BITS)
    np.bitwise_or.at(table, (slot >> np.uint64(3)).astype(np.int64), np.uint8(1) << (slot & np.uint64(7)).astype(np.uint8))
    return table


def bit_table(tokens: DataFrame) -> np.ndarray:
    """Bits of all tokens; each task returns one table of the same fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, some = np.zeros(1 << (TABLE_BITS - 3), dtype=np.uint8), False
        for batch in batches:
            table |= _bits(batch.column("token").to_numpy(zero_copy_only=False).copy(), 1 << TABLE_BITS)
            some |= batch.num_rows > 0
        if some:
            where = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(table[where].astype(np.int64))], names=["place", "byte"])

    merged = tokens.mapInArrow(run, "place long, byte long").groupBy("place").agg(F.bit_or("byte").alias("byte"))
    table = np.zeros(1 << (TABLE_BITS - 3), dtype=np.uint8)
    got = merged.toArrow()  # at most 2^21 places
    table[got.column("place").to_numpy()] = got.column("byte").to_numpy()
    return table


def _occurrences(batch: pa.RecordBatch, widths: list[int], window: int, table: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(words of each text, its possible benchmark shingles with the words around them)."""
    words, bounds = alphanumeric_words(texts_of(batch, "text"))
    data, starts, lengths = joined(words)
    at, row, wide, token = [], [], [], []
    for width in widths:
        first, rows = shingle_rows(bounds, width)
        for a in range(0, len(first), 1 << 18):
            begin = first[a : a + (1 << 18)]
            end = begin + width - 1
            hashes = xxh64(data, starts[begin], starts[end] + lengths[end] - starts[begin])
            slot = hashes >> np.uint64(64 - TABLE_BITS)
            hit = np.flatnonzero((table[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1)
            at.append(begin[hit])
            row.append(rows[a : a + (1 << 18)][hit])
            wide.append(np.full(len(hit), width, dtype=np.int32))
            token.append(hashes[hit].view(np.int64))
    at, row, wide, token = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (at, row, wide, token))
    order = np.argsort(row, kind="stable")
    at, row, wide, token = at[order], row[order], wide[order], token[order]
    low = np.maximum(at - (window - wide), bounds[:-1][row])  # words that a window around the shingle can reach
    high = np.minimum(at + window, bounds[1:][row])
    raw = data.tobytes()
    near = [raw[s:e] for s, e in zip(starts[low].tolist(), (starts[high - 1] + lengths[high - 1]).tolist())] if len(at) else []
    entries = pa.StructArray.from_arrays([
        pa.array((at - bounds[:-1][row]).astype(np.int32)), pa.array(wide.astype(np.int32)), pa.array(token.astype(np.int64)),
        pa.array((at - low).astype(np.int32)), pa.array(near, pa.binary()).cast(pa.string())], names=["pos", "width", "token", "lead", "near"])
    offsets = np.searchsorted(row, np.arange(len(batch) + 1)).astype(np.int32)
    return np.diff(bounds), pa.ListArray.from_arrays(pa.array(offsets), entries)


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
                  id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(rid, doc_id, text_key, n_words, n_hit, n_items, item_ids), one row per input row.

    A window is ``window`` consecutive words of an item; an item of fewer words
    is one window. Documents and items that are null or empty have no words; an
    empty benchmark hits nothing. Items with the same id count once, a null
    item id is left out of ``item_ids``. ``rid`` numbers the rows, so equal rows
    and equal or null ids stay apart. Other columns are ignored.
    """
    windows, owners = item_windows(items, window, shingle, item_id_col, item_text_col)
    windows, owners = materialize(windows, "windows"), materialize(owners, "owners")
    tokens = windows.select("wid", "size", "words", F.explode("tokens").alias("t")).select("wid", "size", "words", "t.*")
    widths = sorted(r.width for r in tokens.select("width").distinct().collect())  # at most ``shingle`` numbers
    table = bit_table(tokens.select("token"))
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pa.set_cpu_count(1)
        rid = TaskContext.get().partitionId() << 33
        for part in slices(batches, "text"):
            n_words, found = _occurrences(part, widths, window, shared.value)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(rid, rid + len(part))), part.column("doc_id"), part.column("text_key"), pa.array(n_words.astype(np.int64)), found],
                names=["rid", "doc_id", "text_key", "n_words", "found"])
            rid += len(part)

    rows = documents(docs, id_col, text_col).withColumn("text_key", text_key(F.col("text")))
    scanned = materialize(rows.mapInArrow(scan, SCAN_SCHEMA), "scanned")
    seen = scanned.where(F.size("found") > 0).select("rid", "n_words", F.explode("found").alias("f")).select("rid", "n_words", "f.*")
    often = seen.groupBy("token", "width").agg(F.count(F.lit(1)).alias("n"))
    rank = Window.partitionBy("wid").orderBy("n", "pos")
    prefixes = (
        tokens.join(often, ["token", "width"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
        .withColumn("r", F.row_number().over(rank)).where("r = 1 and n > 0")
        .select("token", "width", "wid", "size", "words", F.col("pos").alias("inside"))
    )
    met = (
        seen.join(prefixes, ["token", "width"])
        .withColumn("start", F.col("pos") - F.col("inside"))
        .where("start >= 0 and start + size <= n_words and inside <= lead")
        .where("array_join(slice(split(near, ' '), lead - inside + 1, size), ' ') = words")
        .select("rid", "start", "size", "wid", "words")
    )
    met = materialize(met, "verified")
    spans = met.groupBy("rid").agg(F.collect_set(F.struct("start", "size")).alias("spans")).select(
        "rid", F.expr("cast(size(array_distinct(flatten(transform(spans, s -> sequence(s.start, s.start + s.size - 1))))) as long)").alias("n_hit"))
    named = met.select("rid", "words").distinct().join(owners, "words").groupBy("rid").agg(F.collect_set("item_id").alias("item_ids"))
    return (
        scanned.select("rid", "doc_id", "text_key", "n_words").join(spans, "rid", "left").join(named, "rid", "left")
        .select("rid", "doc_id", "text_key", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
                F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"))
    )


def clean_of(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark window; all columns are kept."""
    hit = contamination(docs, items, id_col=id_col, text_col=text_col, **options).where("n_hit > 0")
    key, hit_id, hit_key = (free_name(docs, n) for n in ("clean_key", "clean_hit_id", "clean_hit_key"))
    hit = hit.select(F.col("doc_id").alias(hit_id), F.col("text_key").alias(hit_key)).distinct()
    keyed = docs.withColumn(key, text_key(F.col(text_col).cast("string")))
    return keyed.join(hit, (F.col(key) == F.col(hit_key)) & F.col(id_col).cast("long").eqNullSafe(F.col(hit_id)), "left_anti").drop(key)
