"""Exact ranking, threshold and calibration metrics of scored rows.

Scored rows carry a 0/1 label and a probability; ``groups`` names the columns
that tell apart models, horizons or cutoffs. One table of distinct scores with
running class counts answers all rank-based metrics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tremorgrid.operators.ordered import (
    even_buckets, null_safe_join, ordered_counts, quantiles_of, running_totals,
)


def scored_rows(scored: DataFrame, score: str = "proba") -> DataFrame:
    """Rows that have a score."""
    return scored.where(F.col(score).isNotNull() & ~F.isnan(score))


def score_table(scored: DataFrame, groups: list[str], label: str = "target",
                score: str = "proba") -> DataFrame:
    """Per distinct score: its positives and negatives (``pos``, ``neg``), those
    scored at least as high (``tp``, ``fp``) and the group's totals.

    Rows without a score (NULL or NaN, as of a model that is absent) take no
    part in any metric; ``n`` counts those that do."""
    counts = scored_rows(scored, score).groupBy(*groups, score).agg(
        F.sum(F.col(label)).cast("long").alias("pos"),
        F.sum(1 - F.col(label)).cast("long").alias("neg"),
    )
    spread, bucket = even_buckets(counts, groups, score)
    return running_totals(
        spread, groups, bucket, score, ["pos", "neg"], descending=True
    ).drop("_splits").withColumnsRenamed({"cum_pos": "tp", "cum_neg": "fp", "all_pos": "positives",
                          "all_neg": "negatives", score: "threshold"})


def _auc_terms() -> Column:
    below = F.col("negatives") - F.col("fp")
    return F.col("pos") * (below + F.col("neg") * 0.5)


def rank_metrics(table: DataFrame, groups: list[str]) -> DataFrame:
    """ROC-AUC and average precision per group; NULL where one class is absent."""
    p, n = F.first("positives"), F.first("negatives")
    both = (p > 0) & (n > 0)
    step = F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))
    return table.groupBy(*groups).agg(
        F.when(both, F.sum(_auc_terms()) / (p * n).cast("double")).alias("roc_auc"),
        F.when(both, F.sum(step) / p).alias("pr_auc"),
    )


def f1(precision: Column, recall: Column) -> Column:
    return 2 * precision * recall / (precision + recall + F.lit(1e-12))


def best_f1(table: DataFrame, groups: list[str]) -> DataFrame:
    """The threshold with the highest F1 on these rows; the lowest one on ties."""
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    recall = F.try_divide(F.col("tp"), F.col("positives"))
    ranked = F.struct(F.coalesce(f1(precision, recall), F.lit(0.0)).alias("f1"),
                      (-F.col("threshold")).alias("t"), "tp", "fp", "positives")
    return table.groupBy(*groups).agg(F.max(ranked).alias("b")).select(
        *groups, (-F.col("b.t")).alias("best_f1_threshold"),
        (F.col("b.tp") / (F.col("b.tp") + F.col("b.fp"))).alias("precision_at_best_f1"),
        F.coalesce(F.try_divide(F.col("b.tp"), F.col("b.positives")), F.lit(0.0))
         .alias("recall_at_best_f1"),
        _f1_from_counts(F.col("b.tp"), F.col("b.fp"), F.col("b.positives") - F.col("b.tp"))
        .alias("f1_at_best_f1_threshold"),
    )


def _f1_from_counts(tp: Column, fp: Column, fn: Column) -> Column:
    return F.coalesce(F.try_divide(2.0 * tp, 2 * tp + fp + fn), F.lit(0.0))


def threshold_metrics(scored: DataFrame, groups: list[str], threshold: float = 0.5,
                      label: str = "target", score: str = "proba") -> DataFrame:
    """Confusion counts, precision, recall, F1 and Brier score in one pass."""
    yes, hit = F.col(label) == 1, F.col(score) >= threshold
    counts = scored_rows(scored, score).groupBy(*groups).agg(
        F.count_if(~yes & ~hit).alias("tn"), F.count_if(~yes & hit).alias("fp"),
        F.count_if(yes & ~hit).alias("fn"), F.count_if(yes & hit).alias("tp"),
        F.avg(F.pow(F.col(score) - F.col(label), 2)).alias("brier_score"),
        F.avg(score).alias("mean_predicted"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    zero = F.lit(0.0)
    return counts.withColumns({
        "precision": F.coalesce(F.try_divide(tp, tp + fp), zero),
        "recall": F.coalesce(F.try_divide(tp, tp + fn), zero),
        "f1": _f1_from_counts(tp, fp, fn),
        "n": F.col("tn") + fp + fn + tp,
        "n_positive": tp + fn,
    })


def roc_points(table: DataFrame, groups: list[str]) -> DataFrame:
    """(fpr, tpr) at each distinct score, from the highest down."""
    return table.select(
        *groups, "threshold",
        F.try_divide(F.col("fp"), F.col("negatives")).alias("fpr"),
        F.try_divide(F.col("tp"), F.col("positives")).alias("tpr"),
    )


def pr_points(table: DataFrame, groups: list[str]) -> DataFrame:
    """(recall, precision) at each distinct score."""
    return table.select(
        *groups, "threshold",
        F.try_divide(F.col("tp"), F.col("positives")).alias("recall"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
    )


def calibration(scored: DataFrame, groups: list[str], n_bins: int = 10,
                label: str = "target", score: str = "proba") -> DataFrame:
    """Observed rate against mean score in quantile bins; empty bins vanish."""
    inner = [k / n_bins for k in range(1, n_bins)]
    scored = scored_rows(scored, score)
    edges = quantiles_of(ordered_counts(scored, groups, score), groups, score, inner)
    per_group = edges.groupBy(*groups).agg(F.collect_list("q").alias("edges"))
    below = F.size(F.filter("edges", lambda e: e < F.col(score)))
    return null_safe_join(scored, per_group, groups).groupBy(*groups, below.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(score).alias("mean_predicted"),
        F.avg(F.col(label).cast("double")).alias("observed_rate"),
    )


def by_group(scored: DataFrame, groups: list[str], label: str = "target",
             score: str = "proba") -> DataFrame:
    """n, positive rate, mean score, ROC-AUC, average precision and Brier per group."""
    scored = scored_rows(scored, score)
    plain = scored.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col(label)).cast("long").alias("positives"),
        F.avg(F.col(label).cast("double")).alias("positive_rate"),
        F.avg(score).alias("mean_predicted"),
        F.avg(F.pow(F.col(score) - F.col(label), 2)).alias("brier"),
    )
    ranks = rank_metrics(score_table(scored, groups, label, score), groups)
    return null_safe_join(plain, ranks, groups)


def compare_models(scored: DataFrame) -> DataFrame:
    """One row per model with all test metrics, ranked by ROC-AUC."""
    table = score_table(scored, ["model"])
    rows = (
        threshold_metrics(scored, ["model"])
        .join(rank_metrics(table, ["model"]), "model")
        .join(best_f1(table, ["model"]), "model")
    )
    return rows.withColumn("rank", rank_models())


def rank_models() -> Column:
    """Place of each model by ROC-AUC; the name decides ties. Models are few."""
    return F.row_number().over(
        Window.partitionBy(F.lit(0)).orderBy(F.desc("roc_auc"), F.asc("model"))).cast("int")


def justify_best(ranked: DataFrame) -> DataFrame:
    """The best model and a sentence that says why."""
    best = F.max_by(F.struct("model", "roc_auc"), -F.col("rank"))
    second = F.max_by(F.struct("model", "roc_auc"), F.when(F.col("rank") == 2, 1))
    top = ranked.agg(best.alias("best"), second.alias("second"))
    text = F.format_string("%s ranks first by test ROC-AUC (%.4f)",
                           F.col("best.model"), F.col("best.roc_auc"))
    runner_up = F.format_string("; next is %s (%.4f)", F.col("second.model"),
                                F.col("second.roc_auc"))
    return top.select(
        F.col("best.model").alias("best_model"), F.col("best.roc_auc").alias("roc_auc"),
        F.when(F.col("second.model").isNotNull(), F.concat(text, runner_up)).otherwise(text)
         .alias("justification"),
    )
