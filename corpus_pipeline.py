"""The corpus pipeline: rules, near-duplicates, decontamination, personal data, token ids.

Each stage takes (spark, docs, sf_dir), works on all rows it is given and
returns a DataFrame that is written as Parquet and read again as the next one's
documents. All but the last return the columns they were given.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tremorgrid.llm import byte_bpe, decontamination, near_texts, pii, repetition
from tremorgrid.llm.tables import table
from tremorgrid.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go. Rows are judged one by one where they are read."""
    return docs.where(repetition.passes(F.col("text")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one document stays: SimHash balls propose pairs, sets of five-word shingles
    with a Jaccard similarity of 0.8 or more link them; an exact join of the sets adds the links that the balls leave out."""
    return near_texts.one_of_each(docs, width=5, similarity=0.8)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of ten words of a benchmark item go."""
    return decontamination.clean_of(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind; n_chars follows."""
    masked = pii.masked(docs)
    return masked.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.char_length("text")).cast(masked.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of ids and decoded bytes."""
    encoded = byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return encoded.select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("decontamination", decontaminated),
    ("personal_data", personal_data), ("byte_bpe", token_ids)]

#: Fingerprints, suffix arrays and the tokenizer are beyond SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each but the last returns is stored in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, f"stage_{name}")
    return docs
