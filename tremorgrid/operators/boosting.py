"""Discrete AdaBoost (SAMME) over weighted trees or forests, and what all classifiers share.

Members are fitted by Spark ML on distributed rows; the boosting loop adds what
Spark ML lacks. Gradient-boosted trees are in ``boosted``.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.ml.classification import (
    DecisionTreeClassificationModel, DecisionTreeClassifier,
    RandomForestClassificationModel, RandomForestClassifier,
)
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tremorgrid.session import materialize, scratch_scope

VECTOR = "features"
CHECKPOINT_EVERY = 5


class Unfit(ValueError):
    """A model that these rows cannot train; evaluation reports it as absent."""


def class_counts(train: DataFrame) -> tuple[int, int]:
    row = train.agg(F.count(F.lit(1)).alias("n"), F.sum("target").alias("pos")).first()
    return int(row["pos"] or 0), int(row["n"] - (row["pos"] or 0))


def class_ratio(train: DataFrame) -> float:
    """Negatives per positive, the weight of a positive row."""
    pos, neg = class_counts(train)
    return neg / max(pos, 1)


def check_schema(declared: list[str], fitted: list[str]) -> None:
    """Fail if a model was fitted on other inputs than those declared."""
    odd = sorted(set(declared) ^ set(fitted))
    if odd:
        sides = ", ".join(f"{c} ({'stored list' if c in declared else 'model'} only)" for c in odd)
        raise ValueError(f"the stored column list and the model are from different runs: {sides}")


def check_order(declared: list[str], fitted: list[str]) -> None:
    """Fail if a model was fitted on other inputs than those declared, or on the same in another order."""
    check_schema(declared, fitted)
    moved = [c for c, f in zip(declared, fitted) if c != f]
    if moved or len(declared) != len(fitted):
        raise ValueError(f"the stored column list and the model differ in order or number, first at {(moved or ['the end'])[0]}")


# --- SAMME boosting ---------------------------------------------------------

@dataclass
class SammeModel:
    """Weighted votes of trees or forests."""

    members: list
    weights: list[float]
    kind: str
    columns: list[str]

    def transform(self, rows: DataFrame, name: str = "proba") -> DataFrame:
        """Probability of the positive class: the logistic of twice the mean vote."""
        votes, helpers = F.lit(0.0), []
        for k, (model, weight) in enumerate(zip(self.members, self.weights)):
            vote = f"_vote_{k}"
            rows = _predict(model, rows, vote)
            votes = votes + (F.col(vote) * 2 - 1) * F.lit(weight)
            helpers.append(vote)
        margin = votes * F.lit(2.0 / sum(self.weights))
        return rows.withColumn(name, 1 / (1 + F.exp(-margin))).drop(*helpers)

    def staged(self, rows: DataFrame, at: list[int], keep: list[str]) -> DataFrame:
        """``keep``, ``rounds`` and the probability after each number of members in ``at``.

        One pass over the rows: running sums of the votes are taken at those
        members. A number beyond the last member counts all of them, as boosting
        that ended early would.
        """
        votes, margins, weight, last = F.lit(0.0), {}, 0.0, len(self.members)
        wanted = {min(a, last) for a in at}
        for k, (model, w) in enumerate(zip(self.members, self.weights), 1):
            rows = _predict(model, rows, "_vote")
            total = f"_sum_{k % 2}"
            rows = rows.withColumn(total, (F.col(f"_sum_{1 - k % 2}") if k > 1 else votes) + (F.col("_vote") * 2 - 1) * F.lit(w)).drop("_vote")
            weight += w
            if k in wanted:
                rows = rows.withColumn(f"_margin_{k}", F.col(total) * F.lit(2.0 / weight))
                margins[k] = f"_margin_{k}"
        stages = F.array(*[F.struct(F.lit(a).alias("rounds"), F.col(margins[min(a, last)]).alias("margin")) for a in sorted(set(at))])
        each = rows.select(*keep, F.explode(stages).alias("_s"))
        return each.select(*keep, "_s.rounds", (1 / (1 + F.exp(-F.col("_s.margin")))).alias("proba"))

    def importances(self) -> list[float]:
        """Mean importance of each input, weighted by the members' votes."""
        total = sum(self.weights)
        parts = [m.featureImportances.toArray() * w for m, w in zip(self.members, self.weights)]
        return [float(v) / total for v in sum(parts)]

    def save(self, spark: SparkSession, path: str) -> None:
        for k, model in enumerate(self.members):
            model.write().overwrite().save(f"{path}/member-{k:04d}")
        meta = {"kind": self.kind, "weights": self.weights, "columns": self.columns}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode(
            "overwrite").text(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "SammeModel":
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        loader = (RandomForestClassificationModel if meta["kind"] == "forest"
                  else DecisionTreeClassificationModel)
        members = [loader.load(f"{path}/member-{k:04d}") for k in range(len(meta["weights"]))]
        return SammeModel(members, meta["weights"], meta["kind"], meta["columns"])


def _predict(model, rows: DataFrame, name: str) -> DataFrame:
    return model.setRawPredictionCol("").setProbabilityCol("").setPredictionCol(name).transform(rows)


def fit_samme(train: DataFrame, columns: list[str], rounds: int, kind: str = "tree",
              depth: int = 5, rate: float = 0.6, trees: int = 15, subset: str = "sqrt",
              seed: int = 42) -> SammeModel:
    """Discrete AdaBoost over decision trees (``tree``) or small forests (``forest``).

    Rows start with equal weight; members see them balanced between the
    classes on top, but are judged by the weights without that balance, as the
    method prescribes. A first member that is no better than chance by them
    leaves no model: ``Unfit``. After each round the weight of misclassified rows grows.
    Weights are written to the shared folder every few rounds, so the plan
    stays short and no executor's loss costs more than those rounds.
    """
    with scratch_scope(train.sparkSession):  # the model does not read the weights any more
        return _boost(train, columns, rounds, kind, depth, rate, trees, subset, seed)


def _boost(train, columns, rounds, kind, depth, rate, trees, subset, seed) -> SammeModel:
    pos, neg = class_counts(train)
    if not pos or not neg:
        raise Unfit("training rows of one class")
    n = pos + neg
    balance = F.when(F.col("target") == 1, n / (2.0 * max(pos, 1))).otherwise(n / (2.0 * max(neg, 1)))
    rows = train.select("target", VECTOR).withColumn("w", F.lit(1.0 / n))
    members, weights = [], []
    for k in range(rounds):
        options = dict(featuresCol=VECTOR, labelCol="target", weightCol="bw", maxDepth=depth,
                       seed=seed + k, maxBins=64)
        learner = (RandomForestClassifier(numTrees=trees, featureSubsetStrategy=subset, **options)
                   if kind == "forest" else DecisionTreeClassifier(**options))
        model = learner.fit(rows.withColumn("bw", F.col("w") * balance))
        judged = _predict(model, rows, "vote").withColumn("miss", F.col("vote") != F.col("target"))
        sums = judged.agg(F.sum(F.when(F.col("miss"), F.col("w")).otherwise(0.0)).alias("bad"),
                          F.sum("w").alias("all")).first()
        error = sums["bad"] / sums["all"]
        if error <= 0:
            members, weights = members + [model], weights + [1.0]
            break
        if error >= 0.5:
            if not members:
                raise Unfit("the first member is no better than chance")
            break
        alpha = rate * math.log((1 - error) / error)
        members.append(model)
        weights.append(alpha)
        grown = F.col("w") * F.when(F.col("miss"), math.exp(alpha)).otherwise(1.0)
        total = sums["all"] + sums["bad"] * (math.exp(alpha) - 1)
        rows = judged.select("target", VECTOR, (grown / F.lit(total)).alias("w"))
        if (k + 1) % CHECKPOINT_EVERY == 0 and k + 1 < rounds:
            rows = materialize(rows, "samme-weights")
    return SammeModel(members, weights, kind, list(columns))


def importance_table(spark: SparkSession, model: str, columns: list[str],
                     values: list[float]) -> DataFrame:
    """(model, feature, importance) - as many rows as the model has inputs."""
    rows = [(model, c, float(v)) for c, v in zip(columns, values)]
    return spark.createDataFrame(rows, "model string, feature string, importance double")


def top_importances(table: DataFrame, k: int = 15) -> DataFrame:
    w = Window.partitionBy("model").orderBy(F.desc("importance"), F.asc("feature"))
    return table.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
