"""Tuning and training of the candidate models, evaluation, publishing."""

from __future__ import annotations

import itertools
import json
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tremorgrid.config import HazardConfig
from tremorgrid.operators import boosted, boosting, metrics, splits
from tremorgrid.operators.imputation import Imputation, fit_imputation
from tremorgrid.session import materialize

KEEP = ["day", "horizon_day", "cell_lat", "cell_lon", "target"]

# Parameter grids searched for each model.
GRIDS = {
    "adaboost_dt": {"depth": [2, 5, 7], "rounds": [200, 300, 400, 500, 600], "rate": [0.6]},
    "adaboost_rf": {"rounds": [200, 700], "subset": ["sqrt", "log2"], "depth": [4],
                    "trees": [15], "rate": [1.0]},
    "gbt": {"depth": [4, 6, 8], "rate": [0.01, 0.03, 0.1], "rounds": [2000]},
}


def prepare(rows: DataFrame, imputation: Imputation, extra: tuple[str, ...] = ()) -> DataFrame:
    """Keys, label and the imputed inputs as one vector."""
    return rows.select(*KEEP, *extra, imputation.vector().alias(boosting.VECTOR))


def parameter_sets(grid: dict[str, list]) -> list[dict]:
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def fit(model: str, train: DataFrame, columns: list[str], params: dict, seed: int, judge: DataFrame | None = None, patience: int = 50):
    """One fitted candidate; boosted trees stop by ``judge`` rows if there are any. Raises ``Unfit`` if the rows train no model."""
    if model == "gbt":
        return boosted.fit_boosted(train, columns, judge=judge, patience=patience, seed=seed, **params)
    kind = "forest" if model == "adaboost_rf" else "tree"
    return boosting.fit_samme(train, columns, kind=kind, seed=seed, **params)


def grid_search(model: str, train: DataFrame, columns: list[str], grid: dict[str, list],
                cfg: HazardConfig, parallelism: int = 2, patience: int = 50) -> DataFrame:
    """ROC-AUC of each grid point on each expanding fold: (grid_no, fold, rounds, roc_auc, params).

    ``train`` must be a stored table of prepared rows with ``row_index``. Numbers
    of rounds cost one fit a fold: an ensemble's first members are the smaller
    ensemble, so one pass scores the fold at all of them. Boosted trees find
    their number by ``patience``; their row has the best one. Fits run side by
    side from driver threads, and staged scores of all fits are judged by one
    grouped query. A fold of one class, or a grid point that trains no model
    there, has a NULL score.
    """
    n, days = train.agg(F.count(F.lit(1)), F.count_distinct("day")).first()
    gap = round(cfg.horizon_days * n / max(days, 1))
    ranges = list(enumerate(splits.fold_ranges(n, gap, cfg.cv_folds), 1))
    index, longest = F.col("row_index"), max(grid["rounds"])
    points = parameter_sets(grid)  # as they are reported
    shapes = parameter_sets({k: v for k, v in grid.items() if k != "rounds"})  # as they are fitted
    if model == "gbt":
        points = [p | {"rounds": longest} for p in shapes]
    number = {str(p): k for k, p in enumerate(points)}

    def run(job):
        shape, (fold, (train_end, start, end)) = job
        part, judged = train.where(index < train_end), train.where((index >= start) & (index < end))
        judge = judged if model == "gbt" else None
        try:
            fitted = fit(model, part, columns, shape | {"rounds": longest}, cfg.seed, judge, patience)
        except boosting.Unfit:
            own = [longest] if model == "gbt" else grid["rounds"]
            return [(number[str({k: (shape | {"rounds": r})[k] for k in points[0]})], fold, None, None) for r in own]
        if model == "gbt":
            best = {r: auc for r, auc in fitted.curve}.get(fitted.rounds)
            return [(number[str(shape | {"rounds": longest})], fold, fitted.rounds, best)]
        at = F.create_map(*[x for r in grid["rounds"] for x in (F.lit(r), F.lit(number[str({k: (shape | {"rounds": r})[k] for k in grid})]))])
        staged = fitted.staged(judged, grid["rounds"], ["target"])
        return staged.select(at[F.col("rounds")].alias("grid_no"), F.lit(fold).alias("fold"), "rounds", "target", "proba")

    with ThreadPoolExecutor(parallelism) as pool:
        results = list(pool.map(run, itertools.product(shapes, ranges)))
    plain = [row for r in results if isinstance(r, list) for row in r]
    staged = [r for r in results if isinstance(r, DataFrame)]
    scores = train.sparkSession.createDataFrame(plain, "grid_no int, fold int, rounds int, roc_auc double")
    if staged:
        groups = ["grid_no", "fold", "rounds"]
        together = reduce(DataFrame.unionByName, staged)
        scores = scores.unionByName(metrics.rank_metrics(metrics.score_table(together, groups), groups).select(*groups, "roc_auc"))
    names = F.create_map(*[x for k, p in enumerate(points) for x in (F.lit(k), F.lit(json.dumps(p)))])
    return scores.withColumn("params", names[F.col("grid_no")])


def grid_scores(folds: DataFrame) -> DataFrame:
    """Mean fold score of each parameter set; the first of the best is marked.

    Folds without a score are the same for all sets (their rows decide); a mean
    over differing folds is refused.
    """
    means = folds.groupBy("grid_no", "params").agg(
        F.avg("roc_auc").alias("mean_roc_auc"), F.count("roc_auc").alias("folds_scored"),
        F.array_sort(F.collect_list(F.when(F.col("roc_auc").isNotNull(), F.col("fold")))).alias("_which"))
    if means.select("_which").distinct().count() > 1:
        raise ValueError("parameter sets were scored on differing folds")
    means = means.drop("_which")
    best = means.agg(F.max_by("grid_no", F.struct(
        F.coalesce("mean_roc_auc", F.lit(-1.0)), -F.col("grid_no")))).scalar()
    return means.withColumn("is_best", F.col("grid_no") == best)


def best_params(scores: DataFrame) -> dict:
    """The parameters of the grid point marked as best."""
    return json.loads(scores.where("is_best").first()["params"])


def train_test(matrix: DataFrame, cfg: HazardConfig) -> tuple[DataFrame, DataFrame, DataFrame, Imputation]:
    """Prepared training, validation and test rows, and the fitted imputation.

    ``matrix`` must be a stored table. The parts are written to the shared
    folder once, since fitting and tuning read them many times.
    """
    tagged = splits.with_split(matrix, cfg).where(F.col("split") != "purged")
    train = tagged.where(F.col("split") == "train").drop("split")
    imputation = fit_imputation(train, tagged.drop("split"))
    prepared = materialize(prepare(tagged, imputation, ("split",)), "prepared")
    parts = [prepared.where(F.col("split") == s).drop("split") for s in ("train", "val", "test")]
    return (*parts, imputation)


def fit_models(train: DataFrame, val: DataFrame, columns: list[str], chosen: dict[str, dict], cfg: HazardConfig,
               patience: int = 50) -> tuple[dict[str, object], dict[str, str]]:
    """(fitted models, reasons of those that the rows do not train), by model key.

    Boosted trees stop by the validation rows; the others train with the rounds they are given.
    """
    fitted, absent = {}, {}
    for model, params in chosen.items():
        try:
            fitted[model] = fit(model, train, columns, params, cfg.seed, val, patience)
        except boosting.Unfit as reason:
            absent[model] = str(reason)
    return fitted, absent
