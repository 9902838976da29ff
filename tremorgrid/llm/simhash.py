"""SimHash near-duplicates by meeting in the middle.

Two fingerprints that differ in at most r bits (r even) share a variant within
r/2 bits of both, and fingerprints that share such a variant differ in at most
r bits. So every fingerprint emits all variants within r/2, variants are
shuffled, and whatever meets is linked. Only distinct fingerprints take part.

A variant's leading bits are the shuffle key. A fingerprint is sent once to
each key that one of its variants can have, and the variants with that key are
written out where they arrive: the same buckets as if each variant had been
sent, for about a hundredth of the bytes. The number of leading bits follows
the number of fingerprints, so a task's share stays the same at any size. A
key whose variants are too many is halved on further bits, again and again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tremorgrid.llm.tables import documents, free_name, text_key
from tremorgrid.llm.text import joined, shingle_rows, slices, space_words, texts_of, xxh64
from tremorgrid.session import materialize

SHINGLE_BLOCK = 1 << 17
LEAF_VARIANTS = 1 << 20
KEY_VARIANTS = 1 << 22
FINGERPRINTS = "doc_id long, text_key long, fp long"


def _fingerprints(texts: pa.Array, width: int) -> np.ndarray:
    words, bounds = space_words(pc.ascii_lower(texts))
    data, starts, lengths = joined(words)
    counts = np.diff(bounds)
    out = np.zeros(len(counts), dtype=np.uint64)
    few = np.flatnonzero((counts > 0) & (counts < width))  # one shingle: the whole sequence
    last = bounds[1:][few] - 1
    out[few] = xxh64(data, starts[bounds[:-1][few]], starts[last] + lengths[last] - starts[bounds[:-1][few]])
    first, rows = shingle_rows(bounds, width)
    votes = np.zeros((len(counts), 64), dtype=np.int64)
    for a in range(0, len(first), SHINGLE_BLOCK):
        at, row = first[a : a + SHINGLE_BLOCK], rows[a : a + SHINGLE_BLOCK]
        end = at + width - 1
        hashes = xxh64(data, starts[at], starts[end] + lengths[end] - starts[at])
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        heads = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        votes[row[heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int64)
    many = np.flatnonzero(counts >= width)
    over = 2 * votes[many] > (counts[many] - width + 1)[:, None]
    out[many] = np.packbits(over, axis=1, bitorder="little").view("<u8").ravel()
    return out.view(np.int64)


def fingerprints(docs: DataFrame, width: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, fp) of every row: a 64-bit SimHash of lower-cased word shingles, repeats included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_cpu_count(1)
        for part in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_key"), pa.array(_fingerprints(texts_of(part, "text"), width))],
                names=["doc_id", "text_key", "fp"])

    rows = documents(docs, id_col, text_col)
    return rows.withColumn("text_key", text_key(F.col("text"))).mapInArrow(run, FINGERPRINTS)


def _ball(bits: int, radius: int) -> np.ndarray:
    """All masks of at most ``radius`` of the low ``bits`` bits."""
    masks = [0]
    for size in range(1, radius + 1):
        masks += [sum(1 << b for b in chosen) for chosen in combinations(range(bits), size)]
    return np.array(masks, dtype=np.uint64)


def _ball_size(bits: int, radius: int) -> int:
    return sum(math.comb(bits, k) for k in range(radius + 1))


def _meet(fps: np.ndarray, spare: np.ndarray, chosen: np.ndarray, bits: int, radius: int, found: list) -> None:
    """Pairs (first of a bucket, other) among the variants that agree on all but the low ``bits`` bits.

    ``spare``: how many of the low bits each chosen fingerprint may still change.
    """
    if len(chosen) < 2:
        return
    sizes = [int((spare == k).sum()) for k in range(int(spare.max()) + 1)]
    if bits and sum(n * _ball_size(bits, k) for k, n in enumerate(sizes)) > LEAF_VARIANTS:
        bit = (fps[chosen] >> np.uint64(bits - 1)) & np.uint64(1)
        for side in (0, 1):
            left = spare - (bit != side)
            stay = left >= 0
            _meet(fps, left[stay], chosen[stay], bits - 1, radius, found)
        return
    low = np.uint64((1 << bits) - 1)
    variants, owners = [], []
    for k, n in enumerate(sizes):
        if n:
            own = chosen[spare == k]
            masks = _ball(bits, k)
            variants.append(((fps[own] & low)[:, None] ^ masks[None, :]).ravel())
            owners.append(np.repeat(own, len(masks)))
    variant, owner = np.concatenate(variants), np.concatenate(owners)
    order = np.argsort(variant)
    variant, owner = variant[order], owner[order]
    again = np.flatnonzero(variant[1:] == variant[:-1]) + 1
    if not len(again):
        return
    head = np.arange(len(variant))
    head[again] = 0
    head = np.maximum.accumulate(head)[again]
    a, b = owner[head], owner[again]
    near = np.bitwise_count(fps[a] ^ fps[b]) <= radius  # holds for all that meet; verified all the same
    pairs = np.unique(np.minimum(a, b)[near] * len(fps) + np.maximum(a, b)[near])
    found.append(pairs)


def _smallest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of 0..n-1 is connected to."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def links(distinct: DataFrame, radius: int = 4) -> DataFrame:
    """Edges (a, b), b < a, over distinct fingerprints ``fp`` whose components are those of all links.

    Within one key, what is connected there is returned as a star on its
    smallest fingerprint, so the number of edges is linear in the fingerprints
    and no group is expanded into pairs.
    """
    if radius % 2 or radius < 2:
        raise ValueError("an even radius is needed: variants go half the way from either side")
    half = radius // 2
    n = distinct.count()
    key_bits = min(32, max(4, math.ceil(math.log2(max(1, n * _ball_size(64, half) / KEY_VARIANTS)))))
    masks = _ball(key_bits, half)
    spots = F.array(*[F.struct(F.lit(int(m)).alias("mask"), F.lit(half - int(m).bit_count()).alias("spare")) for m in masks])
    sent = (
        distinct.select("fp", F.explode(spots).alias("spot"))
        .select((F.shiftrightunsigned("fp", 64 - key_bits).bitwiseXOR(F.col("spot.mask"))).alias("key"), "fp", "spot.spare")
    )

    def meet(group: pa.Table) -> pa.Table:
        fps = group.column("fp").to_numpy().view(np.uint64)
        spare = group.column("spare").to_numpy().astype(np.int64)
        order = np.argsort(fps.view(np.int64))
        fps, spare, found = fps[order], spare[order], []
        _meet(fps, spare, np.arange(len(fps)), 64 - key_bits, radius, found)
        pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64)
        label = _smallest(len(fps), pairs // max(1, len(fps)), pairs % max(1, len(fps)))
        moved = np.flatnonzero(label != np.arange(len(fps)))
        whole = fps.view(np.int64)
        return pa.table({"a": pa.array(whole[moved]), "b": pa.array(whole[label[moved]])})

    return sent.groupBy("key").applyInArrow(meet, "a long, b long").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node reachable.

    Large-star and small-star rounds: every round is an aggregation and a join,
    its result a stored table. Ends when a round changes nothing.
    """

    def star(e: DataFrame, both: bool) -> DataFrame:
        near = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if both:
            near = near.union(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        met = near.join(least, "u")
        if both:
            out = met.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = met.where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.where("a != b").distinct()

    def state(e: DataFrame) -> tuple:
        row = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()
        return tuple(row)

    current = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "links")
    was = state(current)
    for _ in range(max_rounds if was[0] else 0):
        current = materialize(star(star(current, True), False), "stars")
        now = state(current)
        if now == was:
            break
        was = now
    else:
        if was[0]:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(current.select(F.col("b"), F.col("b")).distinct())


def rooted_fingerprints(rows: DataFrame, radius: int) -> DataFrame:
    """(fp, root, one) of every distinct fingerprint: its component's root, and its first row: the smallest id,
    null ids last, then by a hash of the text. Equal fingerprints are combined before the shuffle."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("one")
    by_fp = materialize(rows.groupBy("fp").agg(first), "distinct_fingerprints")
    roots = components(links(by_fp.select("fp"), radius))
    return by_fp.join(roots, by_fp.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "one")


def near_duplicates(docs: DataFrame, width: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, fp, fingerprint, component_id), one row per input row.

    ``component_id`` is the smallest doc_id among rows whose fingerprints are
    connected by links of at most ``radius`` bits. Null and empty texts have
    fingerprint zero and are linked like any other. Rows with a null id belong
    to a component but never name it (null if no row of it has an id). Equal
    rows and rows with the same id stay apart; other columns are ignored; an
    empty table gives an empty result.
    """
    rows = materialize(fingerprints(docs, width, id_col, text_col), "fingerprints")
    rooted = rooted_fingerprints(rows, radius)
    named = rooted.groupBy("root").agg(F.min("one.doc_id").alias("component_id"))
    by_fp_named = rooted.join(named, "root").select("fp", "component_id")
    return rows.join(by_fp_named, "fp").select(
        "doc_id", "text_key", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, width: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row with the smallest id stays
    (null ids last, then by a hash of the text); of equal rows one. All columns are kept."""
    rows = materialize(fingerprints(docs, width, id_col, text_col), "fingerprints")
    first = rooted_fingerprints(rows, radius).groupBy("root").agg(F.min("one").alias("one"))
    key, copy, stay_id, stay_key = (free_name(docs, n) for n in ("simhash_key", "simhash_copy", "simhash_stay_id", "simhash_stay_key"))
    stay = first.select(F.col("one.doc_id").alias(stay_id), F.col("one.text_key").alias(stay_key))
    keyed = docs.withColumn(key, text_key(F.col(text_col).cast("string")))
    met = keyed.join(stay, (F.col(key) == F.col(stay_key)) & F.col(id_col).cast("long").eqNullSafe(F.col(stay_id)), "left_semi")
    order = Window.partitionBy(key, id_col).orderBy(F.lit(1))
    return met.withColumn(copy, F.row_number().over(order)).where(F.col(copy) == 1).drop(key, copy)
