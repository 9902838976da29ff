"""Phrase collocations by relational mining of occurrences, length by length.

The occurrence relation of length one holds (place, word) of every word, sorted
by place; places count on by one inside a piece and leave a gap between pieces,
so place stands for piece and position. It is persisted in blocks, one
row for each language and stretch of texts. From then on each length is made
from the one before:

* merge-join: rows of a block whose places are neighbours are an occurrence
  that is one word longer; both relations are sorted, so each is read once;
* group-count: a block's distinct pairs and their counts are shuffled by hash,
  packed by share, and summed over the corpus;
* semi-join: the pairs that are frequent come back to their blocks as numbers,
  and only their occurrences are persisted as the next relation.

A pair goes through a shuffle once for each block, so a word that fills a third
of the corpus is no larger than any other. Shares are as many as the input's
partitions ask for. Hashes only deal the pairs out: groups are told apart by
their words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tremorgrid.llm.byte_bpe import pack, unpack
from tremorgrid.llm.tables import input_partitions
from tremorgrid.llm.text import joined, ragged, space_words, xxh64
from tremorgrid.session import materialize

WORD, SPACE, STOP = 0, 1, 2
SHARES_PER_PARTITION = 2
KINDS = np.zeros(256, dtype=np.uint8)
KINDS[[0x20, 0x09]] = SPACE
KINDS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = STOP
RELATION = "block long, lang string, n_words long, payload binary"
WORDS, GROUPS = [np.int32, np.int32, np.int32, np.uint8], [np.int32, np.int32, np.int64]


@dataclass(frozen=True)
class MiningConfig:
    longest: int = 3  # words of a phrase
    least: int = 10  # occurrences of a candidate
    share: int = 50  # percent: a phrase goes if a longer candidate around it has so many of its occurrences
    top: int = 2000  # phrases reported for each language
    block_bytes: int = 12 << 20  # text of a block


def occurrences(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, A-Z lower-cased, and their places: neighbours in a piece differ by one, others by more."""
    low = pa.concat_arrays([pc.ascii_lower(texts).cast(pa.large_binary())])
    bounds = np.frombuffer(low.buffers()[1], np.int64)[low.offset : low.offset + len(low) + 1] if len(low) else np.zeros(1, np.int64)
    data = np.frombuffer(low.buffers()[2] or b"", np.uint8)[: bounds[-1]]
    kinds = KINDS[data]
    word = kinds == WORD
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    edges = bounds[:-1][bounds[:-1] < len(data)]
    begins[edges] = word[edges]
    starts = np.flatnonzero(begins)
    breaks = np.searchsorted(np.flatnonzero(kinds == STOP), starts) + np.searchsorted(bounds[1:], starts, side="right")
    plain = np.where(word, data, np.uint8(32))
    words, _ = space_words(pa.Array.from_buffers(pa.large_string(), len(low), [None, pa.py_buffer(np.ascontiguousarray(bounds)), pa.py_buffer(plain)]))
    return words, np.arange(len(starts)) + breaks


def word_relation(docs: DataFrame, cfg: MiningConfig) -> DataFrame:
    """The relation of length one: blocks of (step to the place, number of the word), and each block's words."""

    def block(number: int, lang: str, texts: list[pa.Array]) -> pa.RecordBatch:
        words, places = occurrences(pa.concat_arrays(texts))
        coded = words.dictionary_encode()
        data, starts, lengths = joined(pa.concat_arrays([coded.dictionary]))
        keep = np.ones(len(data), bool)
        keep[starts + lengths] = False
        blob = pack(np.diff(places, prepend=0).astype(np.int32), coded.indices.to_numpy(zero_copy_only=False).astype(np.int32), lengths.astype(np.int32), data[keep])
        return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([lang]), pa.array([len(words)]), pa.array([blob], pa.binary())], names=[x.split()[0] for x in RELATION.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pa.set_cpu_count(1)
        number, held, size = TaskContext.get().partitionId() << 32, {}, 0
        for batch in batches:
            langs, texts = batch.column("lang").dictionary_encode(), batch.column("text").cast(pa.large_string())
            sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
            first = 0
            while first < len(texts):  # fill the block at hand, one text at least
                base = sizes[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(sizes, base + cfg.block_bytes - size, side="right")))
                codes = langs.indices.slice(first, last - first)
                for code in pc.unique(codes).to_pylist():
                    held.setdefault(langs.dictionary[code].as_py(), []).append(texts.slice(first, last - first).filter(pc.equal(codes, code)))
                size, first = size + int(sizes[last - 1] - base), last
                if size >= cfg.block_bytes:
                    for lang, own in held.items():
                        yield block(number, lang, own)
                        number += 1
                    held, size = {}, 0
        for lang, own in held.items():
            yield block(number, lang, own)
            number += 1

    return docs.mapInArrow(run, RELATION)


def _word_items(payload: bytes, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """(place and item of each occurrence, share of each item below ``n``, item columns: counts, lengths, bytes) of a block of words."""
    steps, own, lengths, data = unpack(payload, WORDS)
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    share = (xxh64(data, starts, lengths.astype(np.int64)) >> np.uint64(32)).astype(np.int64) % n
    return np.cumsum(steps, dtype=np.int64), own, share, [np.bincount(own, minlength=len(lengths)).astype(np.int32), lengths, starts, data]


def _pair_items(payload: bytes, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """The same of the merge-join of a block of groups with itself; item columns: counts, first and second group of each pair.

    Neighbouring places are an occurrence that is one word longer.
    """
    steps, codes, groups = unpack(payload, GROUPS)
    next_to = np.flatnonzero(steps[1:] == 1)
    key = codes[next_to].astype(np.int64) * max(1, len(groups)) + codes[next_to + 1]
    pairs, own, counts = np.unique(key, return_inverse=True, return_counts=True)
    heads, tails = groups[pairs // max(1, len(groups))], groups[pairs % max(1, len(groups))]
    with np.errstate(over="ignore"):
        mixed = heads.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + tails.astype(np.uint64)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return np.cumsum(steps, dtype=np.int64)[next_to], own, (mixed >> np.uint64(32)).astype(np.int64) % n, [counts.astype(np.int32), heads, tails]


def _taken(items: list[np.ndarray], chosen: np.ndarray) -> bytes:
    """The chosen items, packed: counts and either words or pairs."""
    if len(items) == 3:
        return pack(*[x[chosen] for x in items])
    counts, lengths, starts, data = items
    return pack(counts[chosen], lengths[chosen], data[ragged(starts[chosen], lengths[chosen].astype(np.int64))])


WORD_ITEMS, PAIR_ITEMS = [np.int32, np.int32, np.uint8], [np.int32, np.int64, np.int64]
SHARED = "share long, block long, lang string, payload binary"


def _table(rows: list[tuple]) -> pa.Table:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.binary())
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 4, kinds)], names=[x.split()[0] for x in SHARED.split(", ")])


def shares(relation: DataFrame, n: int, of_words: bool) -> DataFrame:
    """(share, block, lang, payload): each block's distinct items with their counts, dealt to ``n`` shares by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, lang, payload in zip(batch.column("block").to_pylist(), batch.column("lang").to_pylist(), batch.column("payload")):
                _, _, share, items = (_word_items if of_words else _pair_items)(payload.as_py(), n)
                order = np.argsort(share, kind="stable")
                cuts = np.searchsorted(share[order], np.arange(n + 1))
                rows = [(k, block, lang, _taken(items, order[a:b])) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
                yield from _table(rows).to_batches()

    return relation.mapInArrow(run, SHARED)


def counted(shared: DataFrame, least: int, of_words: bool, replies: bool) -> DataFrame:
    """(share, block, lang, payload): the group-count of each share.

    Block -1: the share's frequent groups of a language, packed as items with
    their counts over the corpus. Other blocks (with ``replies``): for each item
    that the block sent, the number of its group in the share, or -1.
    """

    def run(table: pa.Table) -> pa.Table:
        share, out = table.column("share")[0].as_py(), []
        langs = table.column("lang").to_pylist()
        first = 0  # groups are numbered through the share's languages
        for lang in sorted(set(langs)):
            own = [k for k, x in enumerate(langs) if x == lang]
            parts = [unpack(table.column("payload")[k].as_py(), WORD_ITEMS if of_words else PAIR_ITEMS) for k in own]
            counts = np.concatenate([p[0] for p in parts]).astype(np.int64)
            if of_words:
                ends = np.concatenate([[0], np.cumsum(np.concatenate([p[1] for p in parts]), dtype=np.int64)])
                words = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(np.concatenate([p[2] for p in parts]))])
                coded = words.dictionary_encode()
                number, n = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(coded.dictionary)
            else:
                (heads, head), (tails, tail) = (np.unique(np.concatenate([p[k] for p in parts]), return_inverse=True) for k in (1, 2))
                pairs, number = np.unique(head * len(tails) + tail, return_inverse=True)
                n = len(pairs)
            sums = np.zeros(n, dtype=np.int64)
            np.add.at(sums, number, counts)
            frequent = np.flatnonzero(sums >= least)
            if of_words:
                chosen = coded.dictionary.take(pa.array(frequent))
                lengths = pc.binary_length(chosen).to_numpy(zero_copy_only=False).astype(np.int32)
                data = np.frombuffer(b"".join(chosen.to_pylist()), np.uint8)
                blob = pack(sums[frequent], np.arange(first, first + len(frequent)), lengths, data)
            else:
                blob = pack(sums[frequent], np.arange(first, first + len(frequent)), heads[pairs[frequent] // len(tails)], tails[pairs[frequent] % len(tails)])
            if len(frequent):
                out.append((share, -1, lang, blob))
            if replies:
                at = np.full(n, -1, dtype=np.int32)
                at[frequent] = np.arange(first, first + len(frequent))
                said, edge = at[number], np.cumsum([0, *[len(p[0]) for p in parts]])
                out += [(share, table.column("block")[k].as_py(), lang, pack(said[a:b])) for k, a, b in zip(own, edge[:-1], edge[1:])]
            first += len(frequent)
        return _table(out)

    return shared.groupBy("share").applyInArrow(run, SHARED)


def groups_of(stored: DataFrame, of_words: bool) -> DataFrame:
    """(id, lang, f, word) or (id, lang, f, head, tail) of the frequent groups; a group's id is its share and its number there."""
    kinds = [np.int64, np.int64, np.int32, np.uint8] if of_words else [np.int64, np.int64, np.int64, np.int64]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for share, lang, payload in zip(batch.column("share").to_pylist(), batch.column("lang").to_pylist(), batch.column("payload")):
                f, number, a, b = unpack(payload.as_py(), kinds)
                columns = {"id": pa.array((share << 32) + number), "lang": pa.array([lang] * len(f), pa.string()), "f": pa.array(f)}
                if of_words:
                    ends = np.concatenate([[0], np.cumsum(a, dtype=np.int64)])
                    columns["word"] = pa.Array.from_buffers(pa.large_string(), len(a), [None, pa.py_buffer(ends), pa.py_buffer(b)]).cast(pa.string())
                else:
                    columns |= {"head": pa.array(a), "tail": pa.array(b)}
                yield pa.RecordBatch.from_pydict(columns)

    return stored.where("block = -1").mapInArrow(run, "id long, lang string, f long, " + ("word string" if of_words else "head long, tail long"))


def frequent_occurrences(relation: DataFrame, stored: DataFrame, n: int, of_words: bool) -> DataFrame:
    """The relation of the occurrences of frequent groups: a semi-join block by block with the replies to its items."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        said = [(share, unpack(x.as_py(), [np.int32])[0]) for share, x in sorted(zip(right.column("share").to_pylist(), right.column("payload")), key=lambda x: x[0])]
        out = []
        for row in left.to_pylist():
            places, own, share, _ = (_word_items if of_words else _pair_items)(row["payload"], n)
            ids = np.full(len(share), -1, dtype=np.int64)
            if said:
                numbers = np.concatenate([x for _, x in said]).astype(np.int64)
                group = np.repeat(np.array([k for k, _ in said], dtype=np.int64), [len(x) for _, x in said])
                ids[np.argsort(share, kind="stable")] = np.where(numbers < 0, -1, (group << 32) + numbers)
            kept = ids[own] >= 0
            groups, codes = np.unique(ids[own][kept], return_inverse=True)
            out.append((row["block"], row["lang"], int(kept.sum()), pack(np.diff(places[kept], prepend=0).astype(np.int32), codes.astype(np.int32), groups)))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 4, (pa.int64(), pa.string(), pa.int64(), pa.binary()))],
                        names=[x.split()[0] for x in RELATION.split(", ")])

    return relation.groupBy("block").cogroup(stored.where("block >= 0").groupBy("block")).applyInArrow(run, RELATION)


def _cuts(size: int) -> Column:
    """The lowest-scoring cut of a phrase of ``size`` words; products have up to 38 digits."""
    wide = lambda c: f"cast({c} as decimal(19,0))"
    cut = lambda k: (
        f"struct((1000000 * ({wide('f')} * {wide('f')})) div ({wide(f'heads[{k - 1}]')} * {wide(f'tails[{size - k - 1}]')}) as score, "
        f"{k} as k, heads[{k - 1}] as l, tails[{size - k - 1}] as r)")
    return F.array_min(F.expr(f"array({', '.join(cut(k) for k in range(1, size))})"))


def collocations(docs: DataFrame, cfg: MiningConfig = MiningConfig(), text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best ``cfg.top`` phrases of each language.

    ``a``: occurrences inside pieces, ``l`` and ``r`` those of the two parts of
    the lowest-scoring cut, ``n`` all words of the language. Null languages
    count as ``und``; null and empty texts and texts without words have no
    occurrences; repeated rows count each time; other columns are ignored; an
    empty table gives an empty result.
    """
    if cfg.longest < 2:
        raise ValueError("a phrase has two words at least")
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text")).where("text <> ''")
    n = max(8, SHARES_PER_PARTITION * input_partitions(rows))
    relation = materialize(word_relation(rows, cfg), "occurrences_1")
    totals = relation.groupBy("lang").agg(F.sum("n_words").alias("n"))
    stored = materialize(counted(shares(relation, n, True), cfg.least, True, replies=True), "counts_1")
    one = F.array("f")
    groups = materialize(groups_of(stored, True).select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", one.alias("heads"), one.alias("tails")), "groups_1")
    candidates = []
    for size in range(2, cfg.longest + 1):
        relation = materialize(frequent_occurrences(relation, stored, n, of_words=size == 2), f"occurrences_{size - 1}_frequent")
        stored = materialize(counted(shares(relation, n, False), cfg.least, False, replies=size < cfg.longest), f"counts_{size}")
        head = groups.select(F.col("id").alias("head"), F.col("phrase").alias("start"), F.col("heads").alias("before"))
        tail = groups.select(F.col("id").alias("tail"), "last", F.col("tails").alias("behind"))
        longer = materialize(groups_of(stored, False).join(head, "head").join(tail, "tail").select(
            "id", "lang", F.concat_ws(" ", "start", "last").alias("phrase"), "last", "f",
            F.concat("before", one).alias("heads"), F.concat("behind", one).alias("tails"), "head", "tail"), f"groups_{size}")
        if size > 2:
            around = longer.select(F.explode(F.array("head", "tail")).alias("id"), F.col("f").alias("longer")).groupBy("id").agg(F.max("longer").alias("longer"))
            candidates[-1] = groups.join(around, "id", "left").where(f"longer is null or 100 * longer < {cfg.share} * f")
        groups = longer
        candidates.append(groups)
    scored = None
    for size, found in enumerate(candidates, 2):
        own = found.select("lang", "phrase", F.col("f").alias("a"), _cuts(size).alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
        scored = own if scored is None else scored.unionByName(own)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = scored.withColumn("rank", place.cast("long")).where(F.col("rank") <= cfg.top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
