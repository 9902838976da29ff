"""Near-duplicates by Jaccard similarity: SimHash balls first, then an exact join of shingle sets on their rarest shingles.

Texts whose SimHash fingerprints are linked by balls of a few bits are proposed
as pairs and verified on their shingle sets. That joins most near copies at
once; similar texts whose fingerprints differ more are found by the join, which
leaves out no link and only forms pairs that are not connected yet.

All shingles have one order, the common ones last. Of two sets of similarity
``s`` or more each holds one of the other's first n - ceil(s n) + 1 shingles
among its own first ones (n: its size), so sets that share none of these keys
need no look. What is known of the common shingles decides how many sets meet,
never which pairs are found: any order gives the same result.

Sets that share a key are a candidate pair if the number of keys they share and
the shingles behind their keys can add up to the overlap that the similarity
asks for. Both bounds hold for every similar pair; candidates are verified on
their whole shingle sets. Texts of equal shingle sets are combined first. In a
bucket of many sets all are first held against one of them, and pairs are only
formed between different components of these links: large groups of near copies
stay linear in their size, and no link between components is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tremorgrid.llm.simhash import _fingerprints, components, links as ball_links
from tremorgrid.llm.tables import documents, free_name, text_key
from tremorgrid.llm.text import joined, ragged, shingle_rows, slices, space_words, texts_of, xxh64
from tremorgrid.session import materialize, remove_path, scratch_path, scratch_scope

SLICE = 1 << 20
COUNTED = 1 << 21  # shingles that are counted at once
COMMON_OF_TASK, COMMON = 1 << 14, 1 << 18  # the most frequent shingles of such a count, and of all
LISTED = np.int64(1 << 62)  # keys of common shingles begin here
WORDS = 1 << 18  # of 64 bits: which sets are to be verified
TURNS = 6  # of holding the sets of large buckets against one of them
LEAF_VARIANTS = 1 << 11  # pairs that a bucket may form at once; larger ones meet one member first
RADIUS = 4  # differing bits of fingerprints that propose a pair
SKETCHES = "doc_id long, text_key long, set_key long, fp long, bands struct<size:int,keys:array<bigint>>"


def _mixed(x: np.ndarray, turn: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x + np.uint64((turn * 0x9E3779B97F4A7C15 + 0xD1B54A32D192ED03) & (2**64 - 1))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))


def _sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the distinct shingles of every text, sorted; fewer words than ``width`` are one shingle."""
    words, bounds = space_words(pc.ascii_lower(texts))
    data, starts, lengths = joined(words)
    counts = np.diff(bounds)
    few = np.flatnonzero((counts > 0) & (counts < width))
    first, rows = shingle_rows(bounds, width)
    at, row = np.concatenate([bounds[:-1][few], first]), np.concatenate([few, rows])
    end = np.concatenate([bounds[1:][few] - 1, first + width - 1])
    hashes = xxh64(data, starts[at], starts[end] + lengths[end] - starts[at])
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    return hashes[new], np.searchsorted(row[new], np.arange(len(counts) + 1))


def _set_keys(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_mixed(hashes, 97), dtype=np.uint64)])
    return (sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64)


def common_shingles(docs: DataFrame, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Shingles that many texts share, the most frequent last: at most ``COMMON``, whatever the size of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_cpu_count(1)
        held, size = [], 0

        def most() -> pa.RecordBatch:
            shingles, n = np.unique(np.concatenate(held), return_counts=True)
            often = np.flatnonzero(n > 1)
            often = often[np.argsort(-n[often], kind="stable")[:COMMON_OF_TASK]]
            return pa.RecordBatch.from_arrays([pa.array(shingles[often].view(np.int64)), pa.array(n[often])], names=["shingle", "n"])

        for part in slices(batches, "text", SLICE):
            held.append(_sets(texts_of(part, "text"), width)[0])
            size += len(held[-1])
            if size >= COUNTED:
                yield most()
                held, size = [], 0
        if size:
            yield most()

    counts = documents(docs, id_col, text_col).select("text").mapInArrow(run, "shingle long, n long")
    top = counts.groupBy("shingle").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "shingle").limit(COMMON)
    return top.toArrow().column("shingle").to_numpy()[::-1].view(np.uint64)


def _least(size: Column, similarity: float) -> Column:
    """The least overlap with a similar set that a set's own size asks for."""
    return F.ceil(size * F.lit(similarity) - F.lit(1e-9))


def _first(hashes: np.ndarray, bounds: np.ndarray, common: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(keys, bounds): the first shingles of every set in the order of all shingles, as places in that order."""
    order = np.argsort(common)
    ranked, sizes = common[order], np.diff(bounds)
    keys = (hashes >> np.uint64(2)).view(np.int64)
    if len(ranked):
        at = np.minimum(np.searchsorted(ranked, hashes), len(ranked) - 1)
        keys = np.where(ranked[at] == hashes, LISTED + order[at], keys)
    keys = keys[np.lexsort((keys, np.repeat(np.arange(len(sizes)), sizes)))]
    n = np.where(sizes > 0, sizes - np.ceil(sizes * similarity - 1e-9).astype(np.int64) + 1, 0)
    return keys[ragged(bounds[:-1], n)], np.concatenate([[0], np.cumsum(n)])


def sketches(docs: DataFrame, width: int = 5, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8) -> DataFrame:
    """(doc_id, text_key, set_key, fp, bands) of every row; equal shingle sets have equal keys, no words the key zero.

    ``fp``: the SimHash of the shingles, repeats included. ``bands``: the size
    of the set and the keys under which it meets others.
    """
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, width, id_col, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_cpu_count(1)
        for part in slices(batches, "text", SLICE):
            texts = texts_of(part, "text")
            hashes, bounds = _sets(texts, width)
            keys, ends = _first(hashes, bounds, common.value, similarity)
            bands = pa.StructArray.from_arrays(
                [pa.array(np.diff(bounds).astype(np.int32)), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(keys))], names=["size", "keys"])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_key"), pa.array(_set_keys(hashes, bounds)), pa.array(_fingerprints(texts, width)), bands],
                names=["doc_id", "text_key", "set_key", "fp", "bands"])

    rows = documents(docs, id_col, text_col)
    return rows.withColumn("text_key", text_key(F.col("text"))).mapInArrow(run, SKETCHES)


def _bits(nodes: DataFrame) -> np.ndarray:
    """``WORDS`` words of bits, those of the sets of ``nodes`` (set_key) set; the size is fixed whatever their number."""
    word, bit = F.expr(f"cast(shiftrightunsigned(set_key, 6) & {WORDS - 1} as int)"), F.expr("shiftleft(1L, cast(set_key & 63 as int))")
    found = nodes.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(WORDS, dtype=np.int64)
    bits[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return bits


def _may_hold(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the bit of each key is set: true for all nodes and few others."""
    k = keys.view(np.uint64)
    return (bits.view(np.uint64)[(k >> np.uint64(6)) & np.uint64(WORDS - 1)] >> (k & np.uint64(63))) & np.uint64(1) == 1


def shingle_sets(docs: DataFrame, width: int = 5, id_col: str = "doc_id", text_col: str = "text", bits: np.ndarray | None = None) -> DataFrame:
    """(set_key, shingles) of every row; with ``bits``, of the rows whose bit is set."""
    chosen = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_cpu_count(1)
        for part in slices(batches, "text", SLICE):
            hashes, bounds = _sets(texts_of(part, "text"), width)
            keys = _set_keys(hashes, bounds)
            found = pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(hashes.view(np.int64)))],
                names=["set_key", "shingles"])
            yield found if chosen.value is None else found.filter(pa.array(_may_hold(chosen.value, keys)))

    return documents(docs, id_col, text_col).select("text").mapInArrow(run, "set_key long, shingles array<long>")


def proposed(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): pairs of ``distinct`` (set_key, fp) that SimHash balls propose, linear in the sets.

    Sets of one fingerprint meet the smallest of them; those stand for their
    fingerprints, which ``simhash.links`` joins within ``radius`` bits.
    """
    ones = materialize(distinct.groupBy("fp").agg(F.min("set_key").alias("one")), "fingerprints")
    edges = ball_links(ones.select("fp"), radius)
    left, right = (ones.select(F.col("fp").alias(k), F.col("one").alias(f"{k}_one")) for k in "ab")
    met = distinct.join(ones, "fp").where("set_key != one").select("set_key", "one").union(
        edges.join(left, "a").join(right, "b").select("a_one", "b_one"))
    return met.select(F.least("set_key", "one").alias("a"), F.greatest("set_key", "one").alias("b")).distinct()


def ball_verified(docs: DataFrame, distinct: DataFrame, width: int = 5, similarity: float = 0.8,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a, b): the pairs that SimHash balls propose among ``distinct`` (set_key, fp) and that have the similarity."""
    pairs = materialize(proposed(distinct), "proposed_pairs")
    nodes = pairs.select(F.col("a").alias("set_key")).union(pairs.select("b"))
    return _verified(pairs, _stored_sets(nodes, docs, width, id_col, text_col), similarity)


def _members(distinct: DataFrame) -> DataFrame:
    """(token, set_key, size, last, n): the sets of every key that two or more have, with their number."""
    met = distinct.select("set_key", F.explode("bands.keys").alias("token")).select(
        "token", "set_key", F.count(F.lit(1)).over(Window.partitionBy("token")).alias("n")).where("n > 1")
    sizes = distinct.select("set_key", "bands.size", F.array_max("bands.keys").alias("last"))
    return materialize(met.join(sizes, "set_key"), "members")


def _near(similarity: float) -> Column:
    """Whether the sizes of ``size`` and ``other_size`` allow the similarity."""
    return F.least("size", "other_size") >= _least(F.greatest("size", "other_size"), similarity)


def candidates(members: DataFrame, similarity: float = 0.8) -> DataFrame:
    """(a, b): the sets of different labels whose keys and sizes leave room for the similarity, all of them.

    ``members``: (token, set_key, size, last, label). Keys that both have come
    first in both sets; what else they share lies behind the keys of the one
    whose keys end first.
    """
    classes = members.select("token", F.col("label").alias("other_label")).distinct()
    others = members.select("token", F.col("label").alias("other_label"), F.col("set_key").alias("other"),
                            F.col("size").alias("other_size"), F.col("last").alias("other_last"))
    met = members.join(classes, "token").where("label < other_label").join(others, ["token", "other_label"]).where(_near(similarity))
    behind = _least(F.when(F.col("last") <= F.col("other_last"), F.col("size")).otherwise(F.col("other_size")), similarity) - 1
    overlap = _least(F.col("size") + F.col("other_size"), similarity / (1 + similarity))
    counts = met.select(F.least("set_key", "other").alias("a"), F.greatest("set_key", "other").alias("b"), (overlap - behind).alias("least"))
    return counts.groupBy("a", "b", "least").agg(F.count(F.lit(1)).alias("keys")).where("keys >= least").select("a", "b")


def _stored_sets(nodes: DataFrame, docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(set_key, shingles) of ``nodes``; most other rows end where they are read, before the shuffle."""
    return materialize(
        shingle_sets(docs, width, id_col, text_col, _bits(nodes)).join(nodes.select("set_key").distinct(), "set_key", "left_semi").dropDuplicates(["set_key"]), "shingle_sets")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The ``pairs`` (a, b) whose shingle sets have the similarity."""
    left, right = (sets.select(F.col("set_key").alias(k), F.col("shingles").alias(f"{k}_set")) for k in "ab")
    common = F.size(F.array_intersect("a_set", "b_set"))
    return pairs.join(left, "a").join(right, "b").where(
        common >= F.lit(similarity) * (F.size("a_set") + F.size("b_set") - common)).select("a", "b")


def _labelled(members: DataFrame, links: DataFrame) -> DataFrame:
    """``members`` with the smallest set that ``links`` connect each to as its ``label``."""
    roots = components(links)
    return members.join(roots, members.set_key == roots.node, "left").withColumn("label", F.coalesce("root", "set_key")).drop("node", "root")


def _linked_to_one(members: DataFrame, sets: DataFrame, similarity: float, links: DataFrame | None = None) -> DataFrame:
    """(a, b): ``links`` and links within buckets ``members`` (token, set_key), each set held against one of its bucket.

    First against the smallest, the same in most buckets of a group; those
    still apart then meet another in every bucket, again and again while that
    links any. Every turn is linear in the members.
    """
    labelled = members.withColumn("label", F.col("set_key")) if links is None else materialize(_labelled(members, links), "labelled")
    for turn in range(TURNS):
        order = F.xxhash64("token", "set_key", F.lit(turn)) if turn else F.col("set_key")
        ones = labelled.groupBy("token").agg(F.min(F.struct(order.alias("order"), "set_key", "label")).alias("one"))
        apart = labelled.join(ones, "token").where("label != one.label")
        pairs = apart.select(F.least("set_key", "one.set_key").alias("a"), F.greatest("set_key", "one.set_key").alias("b")).distinct()
        found = materialize(_verified(pairs, sets, similarity), "links_to_one")
        links = found if links is None else links.union(found)
        if found.isEmpty():
            break
        labelled = materialize(_labelled(members, links), "labelled")
    return links


def similar_sets(docs: DataFrame, distinct: DataFrame, width: int = 5, similarity: float = 0.8,
                 id_col: str = "doc_id", text_col: str = "text", links: DataFrame | None = None) -> DataFrame:
    """(a, b), a < b: pairs of ``distinct`` (set_key, bands) whose shingle sets have a Jaccard similarity of ``similarity`` or more.

    ``links``: such pairs that are known already; they are returned with the others. The components are those of all
    similar pairs; of sets that are known to be connected, and of a large bucket's, not every similar pair is returned.
    """
    members = _members(distinct)
    large = materialize(members.where(F.expr("n * (n - 1) / 2") > LEAF_VARIANTS).select("token", "set_key"), "large_buckets")
    if not large.isEmpty():
        links = _linked_to_one(large, _stored_sets(large, docs, width, id_col, text_col), similarity, links)
    labelled = members.withColumn("label", F.col("set_key")) if links is None else materialize(_labelled(members, links), "labelled")
    pairs = materialize(candidates(labelled, similarity), "candidate_pairs")
    nodes = pairs.select(F.col("a").alias("set_key")).union(pairs.select("b"))
    rest = _verified(pairs, _stored_sets(nodes, docs, width, id_col, text_col), similarity)
    return rest if links is None else rest.union(links)


def _kept(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read back."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def one_of_each(docs: DataFrame, width: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component of similar texts the row with the smallest
    id stays (null ids last, then by a hash of the text); of equal rows one. All columns are kept.

    Similarity is that of the sets of lower-cased shingles of ``width`` words. Null and empty texts have the empty
    set and are copies of each other; a text of fewer words is one shingle. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    paths = [scratch_path(spark, label) for label in ("distinct_sets", "ball_links", "similar_sets", "stays")]
    with scratch_scope(spark):
        rows = materialize(sketches(docs, width, id_col, text_col, similarity), "sketches")
        first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("one")
        sets = _kept(rows.groupBy("set_key").agg(first, F.min("fp").alias("fp"), F.min("bands").alias("bands")), paths[0])
    full = sets.where("set_key != 0")
    with scratch_scope(spark):
        near = _kept(ball_verified(docs, full.select("set_key", "fp"), width, similarity, id_col, text_col), paths[1])
    with scratch_scope(spark):
        links = _kept(similar_sets(docs, full.select("set_key", "bands"), width, similarity, id_col, text_col, near), paths[2])
    with scratch_scope(spark):
        roots = components(links)
        rooted = sets.join(roots, sets.set_key == roots.node, "left").select(F.coalesce("root", "set_key").alias("root"), "one")
        stays = _kept(rooted.groupBy("root").agg(F.min("one").alias("one")), paths[3])
    for path in paths[:3]:  # only the rows that stay are read further on
        remove_path(spark, path)
    # Id and text in one key that is never null: the join and the window then share one shuffle of the texts.
    row, copy = (free_name(docs, n) for n in ("near_row", "near_copy"))

    def row_key(doc_id, key):
        return F.concat_ws(":", F.coalesce(doc_id.cast("long").cast("string"), F.lit("none")), key.cast("string"))

    stay = stays.select(row_key(F.col("one.doc_id"), F.col("one.text_key")).alias(row))
    keyed = docs.withColumn(row, row_key(F.col(id_col), text_key(F.col(text_col).cast("string"))))
    order = Window.partitionBy(row).orderBy(F.lit(1))
    return keyed.join(stay, row, "left_semi").withColumn(copy, F.row_number().over(order)).where(F.col(copy) == 1).drop(row, copy)
