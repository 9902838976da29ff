"""Purged chronological splits, cross-validation folds and leak checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tremorgrid.config import HazardConfig
from tremorgrid.operators.ordered import with_row_index

MATRIX_ORDER = (["day", "horizon_day"], ["cell_lat", "cell_lon"])


def split_bounds(matrix: DataFrame, cfg: HazardConfig) -> DataFrame:
    """One row: last training day and the first and last days of val and test.

    The distinct days form a single array, as long as the calendar.
    """
    days = matrix.select("day").distinct().agg(F.sort_array(F.collect_set("day")).alias("days"))
    n = F.size("days")
    train_end = F.floor(n * F.lit(cfg.train_frac)).cast("int")
    val_end = F.floor(n * F.lit(cfg.train_frac + cfg.val_frac)).cast("int")
    val_start = F.least(train_end + cfg.horizon_days, val_end)
    test_start = F.least(val_end + cfg.horizon_days, n)
    return days.select(
        F.get("days", train_end - 1).alias("train_last"),
        F.when(val_start < val_end, F.get("days", val_start)).alias("val_first"),
        F.get("days", val_end - 1).alias("val_last"),
        F.when(test_start < n, F.get("days", test_start)).alias("test_first"),
    )


def with_split(matrix: DataFrame, cfg: HazardConfig) -> DataFrame:
    """Tag rows ``train``, ``val``, ``test`` or ``purged`` (between the others)."""
    bounds = split_bounds(matrix, cfg).select(
        F.struct("train_last", "val_first", "val_last", "test_first")).scalar()
    day = F.col("day")
    split = (F.when(day <= bounds["train_last"], "train")
             .when(day.between(bounds["val_first"], bounds["val_last"]), "val")
             .when(day >= bounds["test_first"], "test")
             .otherwise("purged"))
    return matrix.withColumn("split", split)


def split_summary(split: DataFrame, cfg: HazardConfig) -> DataFrame:
    """Rows, days, positives and class ratio of each split; purge gap in rows."""
    rows, days, pos = F.count(F.lit(1)), F.count_distinct("day"), F.sum("target").cast("long")
    return split.groupBy("split").agg(
        rows.alias("rows"), days.alias("days"),
        F.min("day").alias("first_day"), F.max("day").alias("last_day"),
        pos.alias("positives"),
        F.avg(F.col("target").cast("double")).alias("positive_rate"),
        ((rows - pos) / F.greatest(pos, F.lit(1))).alias("class_ratio"),
        gap_rows(rows, days, cfg).alias("gap_rows"),
    )


def gap_rows(rows: Column, days: Column, cfg: HazardConfig) -> Column:
    """Rows that make up the purge gap at the split's average density."""
    return F.rint(F.lit(cfg.horizon_days) * (rows / F.greatest(days, F.lit(1)))).cast("long")


def fold_ranges(n: int, gap: int, folds: int) -> list[tuple[int, int, int]]:
    """Expanding folds over row positions: (train end, test start, test end)."""
    size = n // (folds + 1)
    starts = [n - (folds - k) * size for k in range(folds)]
    return [(max(0, s - gap), s, s + size) for s in starts]


def indexed_rows(train: DataFrame) -> DataFrame:
    return with_row_index(train, *MATRIX_ORDER)


def with_folds(indexed: DataFrame, n: Column, gap: Column, cfg: HazardConfig) -> DataFrame:
    """Repeat each row for every fold it belongs to, with ``fold`` and ``role``."""
    size = F.floor(n / (cfg.cv_folds + 1)).cast("long")
    k, i = F.col("fold"), F.col("row_index")
    start = n - (cfg.cv_folds - k + 1) * size
    role = F.when(i < start - gap, "train").when((i >= start) & (i < start + size), "test")
    return (indexed.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(cfg.cv_folds))))
            .withColumn("role", role).where(F.col("role").isNotNull()))


def cv_folds(train: DataFrame, cfg: HazardConfig) -> DataFrame:
    """Rows, day range and positives of each fold's training and test part."""
    size = train.agg(F.struct(
        F.count(F.lit(1)).alias("n"),
        gap_rows(F.count(F.lit(1)), F.count_distinct("day"), cfg).alias("gap"))).scalar()
    return with_folds(indexed_rows(train), size["n"], size["gap"], cfg).groupBy(
        "fold", "role"
    ).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("row_index").alias("first_row"), F.max("row_index").alias("last_row"),
        F.min("day").alias("first_day"), F.max("day").alias("last_day"),
        F.sum("target").cast("long").alias("positives"),
    )


def label_known_by(cutoff: Column) -> Column:
    """True for rows whose label window ends no later than the cutoff.

    The implied ``day < cutoff`` is spelled out so that partitions by day are
    pruned.
    """
    return (F.col("day") < cutoff) & (F.date_add("day", F.col("horizon_day")) <= cutoff)


def training_rows(matrix: DataFrame, cutoff: Column) -> DataFrame:
    return matrix.where(label_known_by(cutoff))


def forecast_rows(matrix: DataFrame, cutoff: Column) -> DataFrame:
    return matrix.where(F.col("day") == cutoff)


def assert_leak_free(train: DataFrame, cutoff: Column) -> DataFrame:
    """The same rows; the job fails at any row labelled beyond the cutoff."""
    ends = F.date_add("day", F.col("horizon_day"))
    check = F.assert_true(ends <= cutoff, F.lit("label window reaches past the cutoff"))
    return train.where(check.isNull())
