"""Quality rules: repeated substrings inside a text, found with a suffix array over words.

Suffixes are ordered by prefix doubling: ranks of runs of 1, 2, 4, ... words,
where only suffixes that still share their rank are sorted again. Neighbours in
that order have the longest common prefixes; their intervals are the maximal
repeated substrings. A text fails when the union of their spans covers too much
of it or when the longest of them is too long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tremorgrid.llm.tables import documents
from tremorgrid.llm.text import row_sums, slices, space_words, texts_of


@dataclass(frozen=True)
class RepetitionRules:
    window: int = 5  # words in a window of the base rule
    min_words: int = 10
    max_repeat_percent: int = 20
    span_words: int = 10  # shortest repeat that counts as covered
    max_covered: float = 0.15
    max_longest: int = 100
    depth: int | None = None  # repeats are told apart up to so many words (none: as long as they are)


SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "covered_words long, longest_repeat long, base_failed boolean, kept boolean")


def repeat_lengths(codes: np.ndarray, bounds: np.ndarray, depth: int | None = None) -> np.ndarray:
    """For every word, how many words from it on also occur elsewhere in the same text (up to ``depth``).

    ``codes``: integers for words; ``bounds``: offsets of the texts.
    """
    n = len(codes)
    lengths = np.zeros(n, dtype=np.int64)
    if not n:
        return lengths
    sizes = np.diff(bounds)
    ends = np.repeat(bounds[1:], sizes)
    key = np.repeat(np.arange(len(sizes)), sizes) * (int(codes.max()) + 1) + codes
    order = np.argsort(key, kind="stable")
    new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = first
    shared = ~(new & np.append(new[1:], True))
    active, done = order[shared], 1  # suffixes whose first ``done`` words occur twice or more, in suffix order
    lengths[active] = done
    levels = [(1, *_sorted_pairs(active, rank[active]))]
    while len(active) and (depth is None or done < depth):
        ahead = active + done
        second = np.where(ahead < ends[active], rank[np.minimum(ahead, n - 1)], -1)
        group = rank[active]
        again = np.lexsort((second, group))
        active, group, second = active[again], group[again], second[again]
        new_group = np.concatenate([[True], group[1:] != group[:-1]])
        new = new_group | np.concatenate([[True], second[1:] != second[:-1]])
        at = np.arange(len(active))
        head, sub = np.maximum.accumulate(np.where(new_group, at, 0)), np.maximum.accumulate(np.where(new, at, 0))
        # where the order of two neighbours is settled, their common prefix is looked up level by level
        split = np.flatnonzero(new[1:] & ~new_group[1:]) + 1
        common = done + _common(levels, active[split] + done, active[split - 1] + done, ends)
        np.maximum.at(lengths, active[split], common)
        np.maximum.at(lengths, active[split - 1], common)
        rank[active] = group + sub - head
        stay = ~(new & np.append(new[1:], True))
        active, done = active[stay], done * 2
        lengths[active] = np.maximum(lengths[active], done)
        levels.append((done, *_sorted_pairs(active, rank[active])))
    return np.minimum(lengths, ends - np.arange(n))


def _sorted_pairs(positions: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(positions)
    return positions[order], ranks[order]


def _common(levels: list, a: np.ndarray, b: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Common prefix of the suffixes at ``a`` and ``b``, shorter than twice the last level."""
    total, a, b = np.zeros(len(a), dtype=np.int64), a.copy(), b.copy()
    for words, positions, ranks in reversed(levels):
        if not len(positions) or not len(a):
            continue
        i, j = (np.minimum(np.searchsorted(positions, x), len(positions) - 1) for x in (a, b))
        same = (positions[i] == a) & (positions[j] == b) & (ranks[i] == ranks[j])
        step = np.where(same, words, 0)
        total, a, b = total + step, a + step, b + step
    return total


def covered(lengths: np.ndarray, least: int, span: int | None = None) -> np.ndarray:
    """Which words lie in a repeat of at least ``least`` words (or in its first ``span``, at each place)."""
    n = len(lengths)
    starts = np.flatnonzero(lengths >= least)
    edges = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + (lengths[starts] if span is None else span), -1)
    return np.cumsum(edges[:-1]) > 0


def _measure(batch: pa.RecordBatch, rules: RepetitionRules) -> pa.RecordBatch:
    texts = texts_of(batch, "text")
    words, bounds = space_words(texts)
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64) if len(words) else np.zeros(0, np.int64)
    lengths = repeat_lengths(codes, bounds, rules.depth)
    n_words = np.diff(bounds)
    chars = row_sums(pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64), bounds)
    repeat = row_sums(covered(lengths, rules.window, rules.window), bounds)
    long_spans = row_sums(covered(lengths, rules.span_words), bounds)
    longest = np.zeros(len(texts), dtype=np.int64)
    np.maximum.at(longest, np.repeat(np.arange(len(texts)), n_words), lengths)
    failed = (n_words < rules.min_words) | (100 * repeat > rules.max_repeat_percent * n_words)
    kept = ~failed & (long_spans <= rules.max_covered * n_words) & (longest <= rules.max_longest)
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), *(pa.array(np.asarray(x, dtype=np.int64)) for x in (
            n_words, chars, pc.count_substring_regex(texts, r"[#*$%&|<>]").to_numpy(zero_copy_only=False),
            _repeated_lines(texts), repeat, long_spans, longest)), pa.array(failed), pa.array(kept)],
        names=[x.split()[0] for x in SCHEMA.split(", ")])


def _repeated_lines(texts: pa.Array) -> np.ndarray:
    lists = pc.split_pattern(texts, "\n")
    lines, rows = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
    worded = pc.match_substring_regex(lines, r"[^\x20\x09-\x0D]")
    lines, rows = lines.filter(worded), rows[worded.to_numpy(zero_copy_only=False)]
    if not len(lines):
        return np.zeros(len(texts), dtype=np.int64)
    codes = lines.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    pairs = np.unique(rows.astype(np.int64) * (int(codes.max()) + 1) + codes)
    distinct = np.bincount(pairs // (int(codes.max()) + 1), minlength=len(texts))
    return np.bincount(rows, minlength=len(texts)) - distinct


def quality_rules(docs: DataFrame, rules: RepetitionRules = RepetitionRules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: base counts, words covered by long repeats, the longest repeat, and the verdict.

    A null or empty text has no words and fails. Rows with the same or a null
    id are judged one by one; other columns are ignored. The work is local to
    a text, so nothing is shuffled; memory follows slices of a few megabytes
    and the largest single text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_cpu_count(1)
        for part in slices(batches, "text"):
            yield _measure(part, rules)

    return documents(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def passes(text: Column, rules: RepetitionRules = RepetitionRules()) -> Column:
    """Whether a text passes the rules, as a column: filters rows where they are, without a join."""

    @F.pandas_udf("boolean")
    def judged(texts):
        import pandas as pd

        pa.set_cpu_count(1)
        whole = pa.array(texts, pa.string(), from_pandas=True)
        batch = pa.RecordBatch.from_arrays([pa.nulls(len(whole), pa.int64()), whole], names=["doc_id", "text"])
        found = [_measure(part, rules).column("kept").to_numpy(zero_copy_only=False) for part in slices([batch], "text")]
        return pd.Series(np.concatenate(found) if found else np.zeros(0, bool), index=texts.index)

    return judged(text.cast("string"))
