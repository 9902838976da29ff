"""Exact order statistics without sorting a whole group in one task.

A group (a model's scores, a column's values) may hold any share of the rows,
so no window here spans one. Rows fall into many buckets that follow the sort
order; totals per bucket are few and their running sum gives each bucket's
offset; only the order inside a bucket is left to a window.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKETS = 65_536
SPLITS = 128


def unit_bucket(x: Column) -> Column:
    """Bucket of a value in [0, 1]."""
    return F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)) * (BUCKETS - 1)).cast("int")


def even_buckets(df: DataFrame, groups: list[str], key: str) -> tuple[DataFrame, Column]:
    """``df`` with each group's splitters, and the bucket of ``key`` between them.

    Splitters are approximate quantiles of the group, so heavy tails, crowded
    or infinite values leave the buckets even; the order of buckets follows the
    order of keys whatever the approximation.
    """
    points = F.array(*[F.lit(k / SPLITS) for k in range(1, SPLITS)])
    splits = df.groupBy(*groups).agg(F.percentile_approx(key, points, 4 * SPLITS).alias("_splits"))
    placed = null_safe_join(df, splits, groups)
    return placed, F.size(F.filter("_splits", lambda s: s < F.col(key)))


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys``, where NULL meets NULL; keys are kept once."""
    other = right.withColumnsRenamed({k: f"_other_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_other_{k}")) for k in keys]
    return left.join(other, same).drop(*[f"_other_{k}" for k in keys])


def running_totals(df: DataFrame, groups: list[str], bucket: Column, key: str,
                   measures: list[str], descending: bool = False) -> DataFrame:
    """Add ``cum_<m>`` (up to and including the row, in order of ``key``) and
    ``all_<m>`` (the group's total). Keys must be unique within a group."""

    def sort(name: str) -> Column:
        return F.desc(name) if descending else F.asc(name)

    rows = df.withColumn("_bucket", F.coalesce(bucket, F.lit(0).cast("int")) if groups else bucket)
    per_bucket = rows.groupBy(*groups, "_bucket").agg(
        *[F.sum(m).alias(f"_in_{m}") for m in measures])
    group = Window.partitionBy(*[F.col(g) for g in groups] or [F.lit(0)])
    before = group.orderBy(sort("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        *groups, "_bucket",
        *[F.coalesce(F.sum(f"_in_{m}").over(before), F.lit(0)).alias(f"_before_{m}")
          for m in measures],
        *[F.sum(f"_in_{m}").over(group).alias(f"all_{m}") for m in measures],
    )
    inside = (Window.partitionBy(*groups, "_bucket").orderBy(sort(key))
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = null_safe_join(rows, offsets, [*groups, "_bucket"])
    return joined.withColumns({
        f"cum_{m}": F.sum(m).over(inside) + F.col(f"_before_{m}") for m in measures
    }).drop("_bucket", *[f"_before_{m}" for m in measures])


def ordered_counts(values: DataFrame, groups: list[str], value: str) -> DataFrame:
    """Distinct values with their count ``n`` and running count, per group."""
    counts = values.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(
        F.count(F.lit(1)).alias("n"))
    ranged, bucket = even_buckets(counts, groups, value)
    return running_totals(ranged, groups, bucket, value, ["n"]).drop("_splits")


def quantiles_of(ordered: DataFrame, groups: list[str], value: str,
                 probs: list[float]) -> DataFrame:
    """Exact interpolated quantiles ``(groups, prob, q)`` from running counts."""
    first, last = F.col("cum_n") - F.col("n"), F.col("cum_n") - 1
    probs_array = F.array(*[F.lit(float(p)) for p in probs])

    def rank(p: Column) -> Column:
        return p * (F.col("all_n") - 1)

    def holds(index: Column) -> Column:
        return (index >= first) & (index <= last)

    touched = F.filter(probs_array, lambda p: holds(F.floor(rank(p))) | holds(F.ceil(rank(p))))
    hits = ordered.withColumn("prob", F.explode(touched))
    at, lower = rank(F.col("prob")), F.floor(rank(F.col("prob")))
    return hits.groupBy(*groups, "prob").agg(
        F.max(F.when(holds(lower), F.col(value))).alias("_low"),
        F.max(F.when(holds(F.ceil(at)), F.col(value))).alias("_high"),
        F.max(at - lower).alias("_part"),
    ).select(*groups, "prob",
             (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")).alias("q"))


def column_quantile(df: DataFrame, columns: list[str], prob: float = 0.5,
                    sample_rows: int = 50_000, margin: float = 0.01) -> dict[str, float]:
    """Exact interpolated quantile of each column; all-missing columns are left out.

    A sample only serves to guess two values around the quantile. Then all
    rows are counted: those below the bracket, and those inside it one by one.
    If the counts show that a bracket missed the quantile, the column's whole
    range is counted instead, so the result never depends on the sample.
    Nothing but a few numbers per column reaches the driver, and no shuffle
    carries more than a sliver of the values. ``df`` should be a stored table.
    """
    share = min(1.0, sample_rows / max(df.count(), 1))
    low, high = max(0.0, prob - margin), min(1.0, prob + margin)
    seen = df if share == 1.0 else df.sample(share, seed=1)
    guess = seen.selectExpr(*[
        f"percentile_approx(cast(`{c}` as double), array({low}, {high}), 1000) as `{c}`"
        for c in columns]).first()
    sizes = df.selectExpr(*[f"count(`{c}`) as `{c}`" for c in columns]).first()
    present = [c for c in columns if sizes[c]]
    found = _pick_in_brackets(df, {c: (*guess[c], sizes[c]) for c in present if guess[c]}, prob)
    missed = [c for c in present if c not in found]
    if missed:
        ends = df.selectExpr(*[
            f"struct(cast(min(`{c}`) as double) as lo, cast(max(`{c}`) as double) as hi) as `{c}`"
            for c in missed]).first()
        whole = {c: (ends[c]["lo"], ends[c]["hi"], sizes[c]) for c in missed}
        found.update(_pick_in_brackets(df, whole, prob))
    return found


def _pick_in_brackets(df: DataFrame, brackets: dict[str, tuple[float, float, int]],
                      prob: float) -> dict[str, float]:
    """The quantile of each column whose ranks lie between the given values."""
    if not brackets:
        return {}
    below = df.selectExpr(*[
        f"count_if(`{c}` < {lo!r}D) as `{c}`" for c, (lo, _, _) in brackets.items()]).first()
    cells = ", ".join(
        f"if(`{c}` between {lo!r}D and {hi!r}D, struct({k} as k, cast(`{c}` as double) as value), null)"
        for k, (c, (lo, hi, _)) in enumerate(brackets.items()))
    inside = df.selectExpr(f"explode(array({cells})) as x").where("x is not null").select("x.*")
    limits = [(k, c, float(lo), float(hi), prob * (n - 1) - below[c])
              for k, (c, (lo, hi, n)) in enumerate(brackets.items())]
    known = df.sparkSession.createDataFrame(
        limits, "k int, column string, lo double, hi double, rank double")
    counts = inside.groupBy("k", "value").agg(F.count(F.lit(1)).alias("n")).join(
        F.broadcast(known), "k")
    place = F.coalesce(F.try_divide(F.col("value") - F.col("lo"), F.col("hi") - F.col("lo")),
                       F.lit(0.0))
    ordered = running_totals(counts, ["column"], unit_bucket(place), "value", ["n"])
    rows = ordered.where(
        (F.floor("rank") < F.col("cum_n")) & (F.ceil("rank") >= F.col("cum_n") - F.col("n"))
    ).groupBy("column", "rank").agg(
        F.min("value").alias("low"), F.max("value").alias("high"),
        (F.min(F.col("cum_n") - F.col("n")) <= F.floor("rank")).alias("has_low"),
        (F.max("cum_n") > F.ceil("rank")).alias("has_high"))
    return {r["column"]: r["low"] + (r["high"] - r["low"]) * (r["rank"] - math.floor(r["rank"]))
            for r in rows.collect() if r["has_low"] and r["has_high"]}


def with_row_index(df: DataFrame, blocks: list[str], order: list[str]) -> DataFrame:
    """Zero-based position of each row in the order (blocks, order) as ``row_index``.

    ``blocks`` must be few (calendar days x horizons): their counts alone are
    summed up in one place, rows are numbered within their block.
    """
    counts = df.groupBy(*blocks).agg(F.count(F.lit(1)).alias("_n"))
    before = (Window.partitionBy(F.lit(0)).orderBy(*blocks)
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(*blocks, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_skip"))
    within = Window.partitionBy(*blocks).orderBy(*order)
    return df.join(offsets, blocks).withColumn(
        "row_index", F.col("_skip") + F.row_number().over(within) - 1).drop("_skip")


def sample_exactly(df: DataFrame, n: int, key: str, seed: int) -> DataFrame:
    """Exactly ``n`` rows (or all, if fewer) in a reproducible random choice.

    Rows are ordered by a hash of their unique key and counted by its first
    digits (at most 65,536 counts). Rows in buckets below the cut are kept as
    they are; only the rows of the bucket at the cut are ranked.
    """
    hashed = df.withColumn("_hash", F.md5(F.concat_ws(":", F.lit(seed), F.col(key))))
    hashed = hashed.withColumn("_bucket", F.substring("_hash", 1, 4))
    counts = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = counts.withColumn("_before", before).where(F.col("_before") < n).agg(
        F.max(F.struct("_bucket", "_before")).alias("c")).first()["c"]
    if cut is None:
        return df.limit(0)
    below = hashed.where(F.col("_bucket") < cut["_bucket"])
    at = hashed.where(F.col("_bucket") == cut["_bucket"]).orderBy("_hash").limit(n - cut["_before"])
    return below.unionByName(at).select(*df.columns)
