"""Columnar text helpers for Arrow functions: slices of bounded size, words, shingles, hashes."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 6 << 20
#: Characters that the Unicode property White_Space holds beyond ASCII (fixed values).
WIDE_SPACES = "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_UNSAFE_CUT = r" ([\s<" + r"\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|$)"
_CUT = re.compile(rf" (?=[^\s<{WIDE_SPACES}])")


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, in slices of at most ``most`` bytes of text (one row at least)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, first = np.cumsum(sizes), 0
        while first < len(sizes):
            base = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(first, last - first)
            first = last


def texts_of(batch: pa.RecordBatch, column: str) -> pa.Array:
    """A text column with null as the empty text, at offset zero."""
    return pa.concat_arrays([pc.fill_null(batch.column(column).cast(pa.large_string()), "")])


def kept_words(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of a list array without empty ones, and each text's bounds among them (n + 1 offsets)."""
    values, rows = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
    full = pc.greater(pc.binary_length(values), 0)
    if not pc.all(full, min_count=0).as_py():
        values, rows = values.filter(full), rows[full.to_numpy(zero_copy_only=False)]
    return pa.concat_arrays([values]), np.searchsorted(rows, np.arange(len(lists) + 1))


def space_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of all texts and each text's bounds."""
    return kept_words(pc.ascii_split_whitespace(texts))


def alphanumeric_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of all lower-cased texts and each text's bounds."""
    low = pc.ascii_lower(texts)
    parts = pa.concat_arrays([low.cast(pa.large_binary())])
    data = np.frombuffer(parts.buffers()[2] or b"", dtype=np.uint8)
    plain = np.full(256, 32, dtype=np.uint8)
    for low_end, high_end in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        plain[low_end : high_end + 1] = np.arange(low_end, high_end + 1)
    cleaned = pa.Array.from_buffers(pa.large_string(), len(parts), [None, parts.buffers()[1], pa.py_buffer(plain[data])])
    return space_words(cleaned)


def joined(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all words, each followed by one space; start of each word; its length)."""
    lengths = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    spaced = pc.binary_join_element_wise(words.cast(pa.large_string()), pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
    spaced = pa.concat_arrays([spaced])
    data = np.frombuffer(spaced.buffers()[2] or b"", dtype=np.uint8) if len(words) else np.zeros(0, np.uint8)
    return data, np.cumsum(lengths + 1) - lengths - 1, lengths


def shingle_rows(bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, text) of every run of ``width`` words inside one text."""
    counts = np.maximum(np.diff(bounds) - width + 1, 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
    return bounds[:-1][rows] + inside, rows


_P = [np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _mix(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _turn(acc + lane * _P[1], 31) * _P[0]


def xxh64(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of the spans of ``data``, computed for all spans of one length at a time."""
    out = np.empty(len(starts), np.uint64)
    if not len(starts):
        return out
    pad, s = np.concatenate([data, np.zeros(8, np.uint8)]), np.uint64(seed)
    lane8 = np.lib.stride_tricks.as_strided(pad[:8].view("<u8"), shape=(len(data) + 1,), strides=(1,))
    lane4 = np.lib.stride_tricks.as_strided(pad[:4].view("<u4"), shape=(len(data) + 1,), strides=(1,))
    order = np.argsort(lengths, kind="stable")
    by_length = lengths[order]
    cuts = np.flatnonzero(np.diff(by_length)) + 1
    with np.errstate(over="ignore"):
        for low, high in zip(np.r_[0, cuts], np.r_[cuts, len(order)]):
            chosen, n, at = order[low:high], int(by_length[low]), 0
            p = starts[chosen]
            if n >= 32:
                acc = [np.full(len(p), x) for x in (s + _P[0] + _P[1], s + _P[1], s, s - _P[0])]
                while at + 32 <= n:
                    acc = [_mix(a, lane8[p + at + 8 * k]) for k, a in enumerate(acc)]
                    at += 32
                h = _turn(acc[0], 1) + _turn(acc[1], 7) + _turn(acc[2], 12) + _turn(acc[3], 18)
                for a in acc:
                    h = (h ^ _mix(np.uint64(0), a)) * _P[0] + _P[3]
            else:
                h = np.full(len(p), s + _P[4])
            h = h + np.uint64(n)
            while at + 8 <= n:
                h = _turn(h ^ _mix(np.uint64(0), lane8[p + at]), 27) * _P[0] + _P[3]
                at += 8
            if at + 4 <= n:
                h = _turn(h ^ (lane4[p + at].astype(np.uint64) * _P[0]), 23) * _P[1] + _P[2]
                at += 4
            while at < n:
                h = _turn(h ^ (pad[p + at].astype(np.uint64) * _P[4]), 11) * _P[0]
                at += 1
            h = (h ^ (h >> np.uint64(33))) * _P[1]
            h = (h ^ (h >> np.uint64(29))) * _P[2]
            out[chosen] = h ^ (h >> np.uint64(32))
    return out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all elements of the spans, one span after the other."""
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    return np.repeat(starts - first, lengths) + np.arange(total)


def segments(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Texts cut where no token of a byte-level BPE with the usual pattern can lie across, and each text's bounds.

    A cut is made before a space that is followed by neither white space nor
    ``<``: there a match of the pattern always begins, whatever stands before,
    and no special token's string is cut. The parts joined give the text.
    """
    mark = "\x1f"
    marked = pc.replace_substring(texts, " ", mark + " ")
    rough = pc.or_(pc.match_substring_regex(texts, _UNSAFE_CUT), pc.match_substring(texts, mark)).to_numpy(zero_copy_only=False)
    if not rough.any():
        return kept_words(pc.split_pattern(marked, mark))
    lists = pc.split_pattern(marked, mark)
    values, offsets = lists.flatten(), lists.offsets.to_numpy()
    parts, bounds, start = [], [0], 0
    for row in np.flatnonzero(rough):  # rows between rough ones stay columnar
        parts += [values.slice(offsets[start], offsets[row] - offsets[start]), pa.array(_cut(texts[int(row)].as_py()), values.type)]
        bounds += [*(offsets[start + 1 : row + 1] - offsets[start] + bounds[-1])]
        bounds.append(bounds[-1] + len(parts[-1]))
        start = row + 1
    parts.append(values.slice(offsets[start]))
    bounds += [*(offsets[start + 1 :] - offsets[start] + bounds[-1])]
    flat, bounds = pa.concat_arrays(parts), np.asarray(bounds, dtype=np.int64)
    return flat, bounds


def _cut(text: str) -> list[str]:
    at = [0, *(m.start() for m in _CUT.finditer(text)), len(text)]
    return [text[a:b] for a, b in zip(at, at[1:]) if b > a]


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of each text's values; the values lie in order of the texts."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def subwords(words: pa.Array, buckets: int, shortest: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashed features of all words, each word's bounds): the word itself and its n-grams in bytes, ends marked."""
    data, starts, lengths = joined(words)
    marked = np.full(len(data) + len(words), ord(">"), dtype=np.uint8)  # <word> without gaps
    begin = starts + np.arange(len(words))
    marked[begin] = ord("<")
    into = np.arange(len(data)) + np.repeat(np.arange(len(words)), lengths + 1) + 1
    keep = np.ones(len(data), dtype=bool)
    keep[starts + lengths] = False
    marked[into[keep]] = data[keep]
    size = lengths + 2
    owner = np.repeat(np.arange(len(words)), size)
    left = np.repeat(begin + size, size) - np.arange(len(marked))  # bytes up to the word's end
    features, owners = [(xxh64(data, starts, lengths, 1) % np.uint64(buckets)).astype(np.int64)], [np.arange(len(words))]
    rolled = np.zeros(len(marked), dtype=np.uint64)
    padded = np.concatenate([marked, np.zeros(longest, np.uint8)]).astype(np.uint64)
    with np.errstate(over="ignore"):
        for n in range(1, longest + 1):
            rolled = (rolled + padded[n - 1 : n - 1 + len(marked)] + np.uint64(1)) * np.uint64(0x9E3779B185EBCA87)
            rolled ^= rolled >> np.uint64(29)
            if n >= shortest:
                fits = left >= n
                features.append(((rolled[fits] * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64))
                owners.append(owner[fits])
    features, owners = np.concatenate(features), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return features[order], np.searchsorted(owners[order], np.arange(len(words) + 1))
