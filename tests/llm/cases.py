"""Awkward rows that every operator must take, and brute-force versions of small helpers."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import SparkSession, types as T

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("fp", T.StringType()),
    T.StructField("rid", T.StringType()), T.StructField("text_key", T.StringType()), T.StructField("key", T.IntegerType()),
    T.StructField("node", T.IntegerType()), T.StructField("words", T.IntegerType()), T.StructField("kept", T.BooleanType())])
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text: str | None) -> list[str]:
    return WORDS.findall(text or "")


def texts() -> list[tuple[int | None, str | None]]:
    long = " ".join(f"w{i * i % 7919}" for i in range(20_000))
    return [
        (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "The quick brown fox jumps over the lazy dog again and again today"),
        (5, "The quick brown fox jumps over the lazy dog again and again today"), (5, "another text with the same id"),
        (None, "a row without an id, of ten words or even more"), (None, None), (6, "x" * 5_000), (7, long), (8, long + " tail"),
        (9, "a\nb\na\nb\n\n\nA\na"), (10, "the cat sat on the mat and the cat sat on the mat and the cat sat on the mat"),
        (11, "naïve café 東京 ٣٤   x y  two   three <|endoftext|> <b> I'll they've\u0085z \x1f mark"),
        (12, "trailing  "), (13, " a  <|endoftext|>b \n c"), (14, "\r\n\x0b\x0c one\x0btwo"), (15, "🙂🙂 Ǆ ß İstanbul"),
        (16, "Mail jo.doe@example.com or +1 (555) 010-9999; card 4111 1111 1111 1111, host 10.0.0.255 and 1.2.3.256"),
    ]


def rows(spark: SparkSession):
    data = [(i, t, "en", "s", None, "f", "r", "k", 1, 2, 3, False) for i, t in texts()]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def empty(spark: SparkSession):
    return spark.createDataFrame([], SCHEMA)


def ordered(found, *columns: str) -> list[tuple]:
    return sorted((tuple(r[c] for c in columns) for r in found.collect()), key=repr)


def sample(spark: SparkSession):
    return spark.read.parquet(str(Path(SF) / "documents.parquet"))
