"""Token counts: only lengths leave the Arrow function, never ids.

Texts are cut at places where no token can lie across, so a very long text is
encoded in short pieces; equal pieces of a batch are encoded once. The pieces
go to the tokenizer in batches of about equal bytes.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tremorgrid.llm.tables import documents
from tremorgrid.llm.text import row_sums, segments, slices, texts_of

ENCODE_BYTES = 1 << 20
LONG_TEXT_BYTES = 8 << 20
SCHEMA = "doc_id long, n_bytes long, n_tokens long"


def _lengths(tokenizer, parts: pa.Array) -> np.ndarray:
    """Tokens of each part, encoded in batches of about ENCODE_BYTES."""
    sizes = pc.binary_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    group = np.cumsum(sizes) // ENCODE_BYTES
    cuts = np.r_[0, np.flatnonzero(np.diff(group)) + 1, len(sizes)]
    out = np.zeros(len(sizes), dtype=np.int64)
    for a, b in zip(cuts[:-1], cuts[1:]):
        encoded = tokenizer.encode_batch_fast(parts.slice(a, b - a).to_pylist(), add_special_tokens=False)
        out[a:b] = [len(e) for e in encoded]
    return out


def token_counts(docs: DataFrame, tokenizer_json: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per input row; null counts as the empty text (0 tokens).

    ``tokenizer_json``: a file that every executor can read, of a byte-level
    BPE. Special strings inside a text count as the library counts them. Rows
    with equal or null ids stay apart; other columns are ignored. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        pa.set_cpu_count(1)
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_json)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        for part in slices(batches, "text", LONG_TEXT_BYTES):
            texts = texts_of(part, "text")
            pieces, bounds = segments(texts)
            coded = pieces.dictionary_encode()
            per_piece = _lengths(tokenizer, coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pc.binary_length(texts).cast(pa.int64()), pa.array(row_sums(per_piece, bounds))],
                names=["doc_id", "n_bytes", "n_tokens"])

    return documents(docs, id_col, text_col).mapInArrow(run, SCHEMA).withColumn("over_limit", F.col("n_tokens") > limit)
