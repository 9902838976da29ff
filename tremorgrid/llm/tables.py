"""Registered tables of a folder and small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator works on, under names of its own."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def input_partitions(df: DataFrame) -> int:
    return df.rdd.getNumPartitions()
