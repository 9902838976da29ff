"""Gradient-boosted trees that stop when the judging rows no longer gain.

Each round fits one regression tree to the Newton step of the logistic loss:
label (y - p) / (p (1 - p)), weight w p (1 - p), so a leaf holds the step that
minimises the loss to second order. The margin of every row is a column; after
each block of rounds margins are written to the shared folder, and the next
block starts from that table. Judging rows are scored with every number of
trees of the block at once, and one grouped query gives the ROC-AUC of each.
Boosting ends ``patience`` rounds after the best one; no round behind the block
in which that happens is ever fitted, and nothing is fitted twice.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressionModel
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tremorgrid.operators import metrics
from tremorgrid.operators.boosting import VECTOR, Unfit, class_counts
from tremorgrid.session import materialize, scratch_scope

BLOCK = 10  # rounds between two stored margins
LEAST_HESSIAN = 1e-6


def probability(margin: Column) -> Column:
    return 1 / (1 + F.exp(-margin))


def _grown(rows: DataFrame, trees: list, rate: float) -> DataFrame:
    """``rows`` with the steps of a block's trees added to their margin."""
    for tree in trees:
        rows = tree.copy().setPredictionCol("_step").transform(rows)
        rows = rows.withColumn("margin", F.col("margin") + F.col("_step") * F.lit(rate)).drop("_step")
    return rows


def _ensemble(trees: list[DecisionTreeRegressionModel], rate: float, spark: SparkSession) -> GBTRegressionModel:
    """All trees as one Spark ML model: a plan that scores rows holds one function, however many trees there are."""
    jvm, name = spark._jvm, "org.apache.spark.ml.regression.GBTRegressionModel"
    own = JavaWrapper._new_java_array([t._java_obj for t in trees], jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel)
    rates = JavaWrapper._new_java_array([float(rate)] * len(trees), jvm.double)
    return GBTRegressionModel(JavaWrapper._new_java_obj(name, f"boosted_{uuid.uuid4().hex}", own, rates))


@dataclass
class BoostedTrees:
    """Trees in order, the step rate, and the judged ROC-AUC after each round that was fitted."""

    members: list[DecisionTreeRegressionModel]
    rate: float
    columns: list[str]
    curve: list[tuple[int, float | None]] = field(default_factory=list)

    @property
    def rounds(self) -> int:
        return len(self.members)

    def transform(self, rows: DataFrame, name: str = "proba") -> DataFrame:
        if not self.members:
            return rows.withColumn(name, probability(F.lit(0.0)))
        whole = _ensemble(self.members, self.rate, rows.sparkSession)
        scored = whole.setFeaturesCol(VECTOR).setPredictionCol("_margin").transform(rows)
        return scored.withColumn(name, probability(F.col("_margin"))).drop("_margin")

    def importances(self) -> list[float]:
        """Share of each input in the impurity that all trees together remove."""
        total = [0.0] * len(self.columns)
        for tree in self.members:
            for k, v in enumerate(tree.featureImportances.toArray()):
                total[k] += float(v)
        whole = sum(total)
        return [v / whole if whole else 0.0 for v in total]

    def save(self, spark: SparkSession, path: str) -> None:
        if self.members:
            _ensemble(self.members, self.rate, spark).write().overwrite().save(f"{path}/trees")
        meta = {"rate": self.rate, "columns": self.columns, "rounds": self.rounds, "curve": self.curve}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "BoostedTrees":
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        members = list(GBTRegressionModel.load(f"{path}/trees").trees) if meta["rounds"] else []
        return BoostedTrees(members, meta["rate"], meta["columns"], [tuple(x) for x in meta["curve"]])


def best_of(curve: list[tuple[int, float | None]], patience: int) -> tuple[int, bool]:
    """(round with the best score, whether ``patience`` rounds after it brought nothing better); the first wins ties."""
    best, best_auc = 0, float("-inf")
    for at, auc in curve:
        if auc is not None and auc > best_auc:
            best, best_auc = at, auc
        elif at - best >= patience:
            return best, True
    return best, False


def staged_scores(rows: DataFrame, trees: list, rate: float, first: int, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """(``keep``, rounds and proba after each of ``trees``; rows with their margin after the last one).

    ``first`` is the number of the round of the first of ``trees``.
    """
    stages = []
    for k, tree in enumerate(trees):
        rows = _grown(rows, [tree], rate)
        rows = rows.withColumn(f"_stage_{k}", F.col("margin"))
        stages.append(f"_stage_{k}")
    each = rows.select(*keep, F.posexplode(F.array(*stages)).alias("_at", "_margin"))
    each = each.select(*keep, (F.col("_at") + first).alias("rounds"), probability(F.col("_margin")).alias("proba"))
    return each, rows.drop(*stages)


def fit_boosted(train: DataFrame, columns: list[str], depth: int = 4, rate: float = 0.1, rounds: int = 2000,
                judge: DataFrame | None = None, patience: int = 50, seed: int = 42,
                positive_weight: float | None = None) -> BoostedTrees:
    """Boosted trees over prepared rows (``target`` and the input vector).

    ``positive_weight`` defaults to negatives per positive of ``train``. With
    ``judge`` rows, boosting stops by their ROC-AUC and keeps the trees up to
    the best round; judging rows of one class have no ROC-AUC, so all rounds
    stay. Without them all ``rounds`` are fitted.
    """
    with scratch_scope(train.sparkSession):  # the model does not read the margins any more
        return _boost(train, columns, depth, rate, rounds, judge, patience, seed, positive_weight)


def _boost(train, columns, depth, rate, rounds, judge, patience, seed, positive_weight) -> BoostedTrees:
    pos, neg = class_counts(train)
    if not pos or not neg:
        raise Unfit("training rows of one class")
    weight = positive_weight if positive_weight is not None else neg / pos
    rows = train.select("target", VECTOR, F.lit(0.0).alias("margin"))
    seen = judge.select("target", VECTOR, F.lit(0.0).alias("margin")) if judge is not None else None
    members, curve = [], []
    while len(members) < rounds:
        base = rows.persist()  # one block's rows: computed again from the stored table if an executor is lost
        block = []
        for _ in range(min(BLOCK, rounds - len(members))):
            p = probability(F.col("margin"))
            hessian = F.greatest(p * (1 - p), F.lit(LEAST_HESSIAN))
            step = _grown(base, block, rate).select(
                VECTOR, ((F.col("target") - p) / hessian).alias("y"),
                (hessian * F.when(F.col("target") == 1, float(weight)).otherwise(1.0)).alias("w"))
            learner = DecisionTreeRegressor(featuresCol=VECTOR, labelCol="y", weightCol="w", maxDepth=depth, maxBins=64,
                                            seed=seed + len(members) + len(block))
            block.append(learner.fit(step))
        first, members = len(members) + 1, members + block
        if seen is not None:
            staged, after = staged_scores(seen, block, rate, first, ["target"])
            table = metrics.score_table(staged, ["rounds"])
            curve += [(r["rounds"], r["roc_auc"]) for r in metrics.rank_metrics(table, ["rounds"]).orderBy("rounds").collect()]
            best, stop = best_of(curve, patience)
            if stop:
                base.unpersist()
                break
            seen = materialize(after, "boosted-judge")
        if len(members) < rounds:
            rows = materialize(_grown(base, block, rate), "boosted-margins")
        base.unpersist()
    best, _ = best_of(curve, patience) if curve else (0, False)
    return BoostedTrees(members[: best or len(members)], rate, list(columns), curve)
