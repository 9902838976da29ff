"""License scans by diagonal voting, with built-in functions only.

Every run of k words of a text is a gram. Spark joins the hashes of all grams
with the places of the templates' grams (equal hashes are compared as text). A
hit at word d of the text and word t of the template lies on diagonal d - t; on
one diagonal a template word is met at most once. Votes are counted by
diagonal. An insertion or a lost word moves what follows to a neighbouring
diagonal, so the hits of all diagonals within ``shift`` of one are merged, and
the strongest diagonal of its surroundings stands for the span. A span is
verified by the words it really shares: the share of the template's words that
its grams cover, and the share of the span's words that they cover.

Templates are a parameter and small; their grams are the broadcast side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tremorgrid.llm.tables import documents
from tremorgrid.session import materialize, small_side

#: Phrases of the base scan and their labels (fixed values).
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
#: Notices of common licenses and their labels (fixed values: the wording of the published licenses).
NOTICES = (
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
     "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
     "publish, distribute, sublicense, and/or sell copies of the Software", "mit"),
    ("you may not use this file except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0", "apache-2"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
     "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer", "bsd"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
     "the above copyright notice and this permission notice appear in all copies", "isc"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
     "by the Free Software Foundation", "gpl"),
    ("This is free and unencumbered software released into the public domain", "unlicense"),
    ("subject to the terms of the Mozilla Public License, v. 2.0", "mpl-2"),
    ("GNU General Public License, version 2", "gpl-2"),
    ("GNU General Public License, version 3", "gpl-3"),
    ("GNU Lesser General Public License", "lgpl"),
    ("GNU Affero General Public License", "agpl"),
    ("Creative Commons Attribution ShareAlike", "cc-by-sa"),
    ("CC BY SA", "cc-by-sa"),
    ("Creative Commons Attribution NonCommercial", "cc-by-nc"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class ScanConfig:
    k: int = 3  # words of a gram; templates have that many at least
    shift: int = 6  # diagonals on either side that are merged
    whole_below: int = 16  # shorter templates must be met whole, on one diagonal
    cover: float = 0.8  # share of a longer template's words that a span must have
    dense: float = 0.7  # share of the span's words that must come from the template


def word_list(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased; null has none."""
    clean = F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN_WORDS, " "))
    return F.when(clean == "", F.array().cast("array<string>")).otherwise(F.split(clean, " "))


def _gram(words: Column, i: Column, k: int) -> Column:
    return F.concat_ws(" ", *[F.get(words, i + j) for j in range(k)])


def template_grams(spark: SparkSession, base, notices, cfg: ScanConfig) -> tuple[DataFrame, int]:
    """((template, label, is_base, size, at, t_gram, t_hash), a bound of its rows)."""
    rows = [(n, label, is_base, text) for n, (text, label, is_base) in enumerate([(t, b, True) for t, b in base] + [(t, b, False) for t, b in notices])]
    given = spark.createDataFrame(rows, "template int, label string, is_base boolean, text string").withColumn("w", word_list(F.col("text")))
    given = given.withColumn("size", F.size("w"))
    short = given.where(F.col("size") < cfg.k).select("text").collect() if rows else []  # as many rows as templates
    if short:
        raise ValueError(f"a template needs {cfg.k} words at least: {short[0].text!r}")
    grams = given.select("template", "label", "is_base", "size", F.posexplode(F.expr(f"transform(sequence(0, size - {cfg.k}), i -> {_sql_gram('w', cfg.k)})")).alias("at", "t_gram"))
    return grams.withColumn("t_hash", F.xxhash64("t_gram")), sum(len(t) for _, _, _, t in rows)


def _sql_gram(words: str, k: int) -> str:
    return "concat_ws(' ', " + ", ".join(f"{words}[i + {j}]" for j in range(k)) + ")"


def gram_hits(docs: DataFrame, base=BASE, notices=NOTICES, cfg: ScanConfig = ScanConfig(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, doc_id, n_words, template, label, is_base, size, at, place): every gram of a text that a template has.

    Each input row has one row more without a template, so that none is lost.
    """
    templates, bound = template_grams(docs.sparkSession, base, notices, cfg)
    rows = documents(docs, id_col, text_col).select(F.monotonically_increasing_id().alias("rid"), "doc_id", word_list(F.col("text")).alias("words"))
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    # the first element stands for the row itself
    grams = F.expr(f"transform(sequence(-1, greatest(-1, size(words) - {cfg.k})), i -> if(i < 0, cast(null as string), {_sql_gram('words', cfg.k)}))")
    every = rows.select("rid", "doc_id", "n_words", F.posexplode(grams).alias("place", "gram")).withColumn("hash", F.xxhash64("gram"))
    met = every.join(small_side(templates, bound), (F.col("hash") == F.col("t_hash")) & (F.col("gram") == F.col("t_gram")), "left")
    return met.where(F.col("template").isNotNull() | (F.col("place") == 0)).select(
        "rid", "doc_id", "n_words", "template", "label", "is_base", "size", "at", (F.col("place") - 1).alias("place"))


def _covered(places: Column, k: int) -> Column:
    """Number of words that grams at ``places`` cover."""
    return F.size(F.array_distinct(F.flatten(F.transform(places, lambda p: F.sequence(p, p + (k - 1))))))


def verified_spans(hits: DataFrame, cfg: ScanConfig = ScanConfig()) -> DataFrame:
    """(rid, template, label, is_base, diagonal, start, end, cover, dense, holds): one row for each span, end exclusive.

    Of diagonals within ``cfg.shift`` of each other the one with the most
    covered template words stands for all, then the one with the most votes of its own, then the first.
    """
    found = hits.where("template is not null").withColumn("diagonal", F.col("place") - F.col("at"))
    votes = found.groupBy("rid", "template", "label", "is_base", "size", "diagonal").agg(F.collect_list("at").alias("ats"), F.count(F.lit(1)).alias("votes"))
    votes = votes.withColumn("long", ~F.col("is_base") & (F.col("size") >= cfg.whole_below))
    around = Window.partitionBy("rid", "template").orderBy("diagonal").rangeBetween(-cfg.shift, cfg.shift)
    own = F.array(F.struct("diagonal", "ats"))
    lists = F.when(F.col("long"), F.collect_list(F.struct("diagonal", "ats")).over(around)).otherwise(own)
    merged = votes.withColumn("lists", lists)
    merged = merged.withColumn("t_places", F.flatten(F.transform("lists", lambda x: x.ats))).withColumn(
        "d_places", F.flatten(F.transform("lists", lambda x: F.transform(x.ats, lambda a: a + x.diagonal))))
    merged = merged.withColumn("covered", _covered(F.col("t_places"), cfg.k)).withColumn("start", F.array_min("d_places")).withColumn("end", F.array_max("d_places") + cfg.k)
    rank = F.struct("covered", "votes", -F.col("diagonal"))
    best = merged.withColumn("rank", rank).withColumn("top", F.when(F.col("long"), F.max("rank").over(around)).otherwise(F.col("rank"))).where("rank = top")
    best = best.withColumn("cover", F.col("covered") / F.col("size")).withColumn("dense", _covered(F.col("d_places"), cfg.k) / (F.col("end") - F.col("start")))
    holds = F.when(F.col("long"), (F.col("cover") >= cfg.cover) & (F.col("dense") >= cfg.dense)).otherwise(F.col("covered") == F.col("size"))
    return best.select("rid", "template", "label", "is_base", "diagonal", F.col("start").cast("long"), F.col("end").cast("long"), "cover", "dense", holds.alias("holds"))


def license_scan(docs: DataFrame, base=BASE, notices=NOTICES, cfg: ScanConfig = ScanConfig(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, places, spans, score), one row per input row.

    ``places``: array of (start, label) where a base phrase stands word by
    word, by start; ``spans``: array of (start, end, label, cover) of the other
    templates' verified spans; ``score``: the best cover times density of any
    alignment, verified or not, 0 without one. Null and empty texts have no
    words. Rows with equal or null ids stay apart; other columns are ignored;
    an empty table gives an empty result.
    """
    hits = materialize(gram_hits(docs, base, notices, cfg, id_col, text_col), "license_hits")
    spans = verified_spans(hits, cfg)
    place = F.when(F.col("holds") & F.col("is_base"), F.struct("start", "label"))
    span = F.when(F.col("holds") & ~F.col("is_base"), F.struct("start", "end", "label", "cover"))
    of_row = spans.groupBy("rid").agg(F.array_sort(F.collect_list(place)).alias("places"), F.array_sort(F.collect_list(span)).alias("spans"),
                                      F.max(F.col("cover") * F.col("dense")).alias("score"))
    rows = hits.where("place = -1").select("rid", "doc_id", "n_words")
    none = lambda c, kind: F.coalesce(c, F.array().cast(kind)).alias(c)
    return rows.join(of_row, "rid", "left").select(
        "doc_id", "n_words", none("places", "array<struct<start:bigint,label:string>>"),
        none("spans", "array<struct<start:bigint,end:bigint,label:string,cover:double>>"), F.coalesce("score", F.lit(0.0)).alias("score"))
