"""The model bundle: everything that serving needs from one training run, published together.

A bundle is a run of the table store: each fitted model, the imputation (input
columns, indicators, medians) and the parameters as JSON. The run becomes
visible by one manifest file after all of it is written. Loading takes all
artifacts from the same run, tolerates models that are absent, and compares the
inputs a model was fitted on with the stored column list both ways.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tremorgrid.config import HazardConfig
from tremorgrid.operators.boosted import BoostedTrees
from tremorgrid.operators.boosting import VECTOR, SammeModel, check_order
from tremorgrid.operators.imputation import Imputation
from tremorgrid.plans import forecast as serving
from tremorgrid.sources.tables import TableStore

IMPUTATION = "columns array<string>, indicators array<string>, medians map<string,double>"
PARAMETERS = "params map<string,string>, rounds map<string,int>, absent map<string,string>"


@dataclass(frozen=True)
class Bundle:
    run_id: str
    models: dict[str, object]
    imputation: Imputation
    params: dict[str, dict]
    absent: dict[str, str]  # model key -> why it was not fitted

    def score(self, rows: DataFrame) -> DataFrame:
        """``rows`` of features with ``proba_<model>`` of every model at hand."""
        scored = rows.withColumn(VECTOR, self.imputation.vector())
        for key, model in self.models.items():
            scored = model.transform(scored, f"proba_{key}")
        return scored.drop(VECTOR)


def publish_bundle(store: TableStore, run_id: str, models: dict[str, object], imputation: Imputation,
                   params: dict[str, dict], absent: dict[str, str] | None = None,
                   extra: dict[str, str] | None = None) -> None:
    """Write all artifacts of a run, then publish them (and ``extra`` paths written under it) at once."""
    spark, artifacts = store.spark, dict(extra or {})
    for key, model in models.items():
        check_order(imputation.feature_columns, model.columns)
        artifacts[f"model_{key}"] = store.path(f"model_{key}", run_id)
        store.refuse_published(f"model_{key}", run_id)
        model.save(spark, artifacts[f"model_{key}"])
    inputs = spark.createDataFrame([(imputation.columns, imputation.indicators, dict(imputation.medians))], IMPUTATION)
    chosen = spark.createDataFrame(
        [({k: json.dumps(v) for k, v in params.items()}, {k: _rounds(m) for k, m in models.items()}, dict(absent or {}))], PARAMETERS)
    artifacts["imputation"] = store.write_report(inputs, "imputation", run_id)
    artifacts["parameters"] = store.write_report(chosen, "parameters", run_id)
    store.publish(run_id, artifacts)


def _rounds(model) -> int:
    return len(model.members)


def load_bundle(store: TableStore, run_id: str | None = None, models: list[str] | None = None) -> Bundle:
    """The bundle in use, or that of a run; only ``models`` if they are named."""
    if run_id is None:
        newest = store.version("imputation")
        if newest is None:
            raise FileNotFoundError(f"no published bundle under {store.root}")
        run_id = newest["run_id"]
    inputs = store.read_report("imputation", IMPUTATION, run_id).first()
    chosen = store.read_report("parameters", PARAMETERS, run_id).first()
    imputation = Imputation(list(inputs.columns), list(inputs.indicators), dict(inputs.medians))
    wanted, found = models if models is not None else list(serving.MODEL_NAMES), {}
    paths = store.artifacts(run_id)
    for key in wanted:
        path = paths.get(f"model_{key}")
        if path is None:  # absent models are served as missing
            continue
        kind = BoostedTrees if key == "gbt" else SammeModel
        found[key] = kind.load(store.spark, path)
        check_order(imputation.feature_columns, found[key].columns)
    return Bundle(run_id, found, imputation, {k: json.loads(v) for k, v in (chosen.params or {}).items()}, dict(chosen.absent or {}))


def refresh_forecast(store: TableStore, run_id: str, catalog: DataFrame, bundle: Bundle,
                     cfg: HazardConfig = HazardConfig()) -> None:
    """Score the catalog's last day with a bundle's models, write and publish the forecast table."""
    rows = serving.forecast(catalog, bundle.score, list(serving.MODEL_NAMES), cfg)
    path = store.write(rows.withColumn("model_run", F.lit(bundle.run_id)), "forecast", run_id,
                       sort_by=["horizon_day", "cell_lat", "cell_lon"])
    store.publish(run_id, {"forecast": path})


def stored_forecast(store: TableStore, horizon: int | None = None, cfg: HazardConfig = HazardConfig(),
                    run_id: str | None = None) -> DataFrame:
    """The forecast in use (or that of a run), all of it or one clamped horizon; nothing is scored here."""
    rows = store.read("forecast", run_id=run_id)
    return rows if horizon is None else serving.horizon_slice(rows, horizon, cfg)
