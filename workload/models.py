"""Registered queries that train models, publish tables or run streams."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tremorgrid.operators import boosting, cleaning, metrics, splits
from tremorgrid.operators.imputation import fit_imputation
from tremorgrid.plans import backtest, bundle, features, forecast, reports, training
from tremorgrid.session import materialize, scratch_path
from tremorgrid.sources import catalog as feed
from tremorgrid.sources import views
from tremorgrid.sources.tables import TableStore
from tremorgrid.streaming import events as streams
from workload import sql as S
from workload.queries import (
    _B, _CUTS, _MX_COLUMNS, _MX_E, _MX_O, _SPLIT, CFG, cell_names, clean_events, events_matrix, orders, orders_matrix, query,
    raw_events, ORACLES,
)
from workload.sql import q

# Boosted trees of up to 2,000 rounds as configured; the patience is shorter than the library's 50 (README: measured times).
GBT = dict(depth=4, rate=0.1, rounds=2000)
PATIENCE = 10
# The other two ensembles are reduced in their number of members only (README: measured times).
SAMME_TREE = dict(depth=5, rate=0.6, rounds=10)
SAMME_FOREST = dict(depth=4, rate=1.0, rounds=3, trees=15, subset="sqrt")
CHOSEN = {"gbt": GBT, "adaboost_dt": SAMME_TREE, "adaboost_rf": SAMME_FOREST}

_STORES: dict[tuple[str, str], tuple[TableStore, dict]] = {}


def bundle_store(spark, d) -> TableStore:
    """The store of the models trained on the long catalog; trained and published once a session and folder.

    Holds the prepared rows as a table, too: all model queries read the same.
    """
    key = (spark.sparkContext.applicationId, d)
    if key not in _STORES:
        store = TableStore(spark, scratch_path(spark, "bundle"))
        matrix = materialize(orders_matrix(spark, d), "matrix")
        train, val, test, imputation = training.train_test(matrix, CFG)
        fitted, absent = training.fit_models(train, val, imputation.feature_columns, CHOSEN, CFG, PATIENCE)
        tagged = train.withColumn("split", F.lit("train")).unionByName(val.withColumn("split", F.lit("val"))).unionByName(
            test.withColumn("split", F.lit("test")))
        extra = {"prepared": store.write(tagged, "prepared", "run-1"), "matrix": store.write(matrix, "matrix", "run-1", month_of="day")}
        bundle.publish_bundle(store, "run-1", fitted, imputation, CHOSEN, absent, extra)
        _STORES[key] = store, fitted
    return _STORES[key][0]


def split_rows(store: TableStore, split: str) -> DataFrame:
    return store.read("prepared").where(F.col("split") == split).drop("split")


def auc_of(scored: DataFrame, score: str) -> float | None:
    """ROC-AUC by Spark's evaluator, a second formula."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.functions import array_to_vector

    rows = scored.select(F.col("target").cast("double").alias("label"), array_to_vector(F.array(1 - F.col(score), score)).alias("raw"))
    return BinaryClassificationEvaluator(rawPredictionCol="raw", labelCol="label", numBins=0).evaluate(rows)


_MAGNITUDES = (f"{q(f'{S.THRESHOLD} - log10(cast(0.5 as double)) / {_B}')} as mag_likely, "
               f"{q(f'{S.THRESHOLD} - log10(cast(0.1 as double)) / {_B}')} as mag_severe")


def _forecast_sql(catalog: str) -> str:
    return f"""
with {S.features(catalog)}, snap as (select * from feat where day = (select max(day) from ev)),
fc as (select day as asof_date, h.h as horizon_day, snap.*
       from snap, (select cast(unnest(generate_series(1, {S.HORIZON})) as integer) as h) h)
select asof_date, horizon_day, cell_lat, cell_lon, {', '.join(f'{q(c)} as {c}' for c in forecast.DISPLAY_COLUMNS)},
       true as proba_in_range, true as others_absent, true as as_trained, {_MAGNITUDES} from fc"""


def _served(store: TableStore, catalog: DataFrame, key: str, fitted, imputation) -> DataFrame:
    """Refresh the stored forecast with one model of the bundle, and hold it against the model in memory.

    A model that the rows did not train is absent: its column is NULL.
    """
    loaded = bundle.load_bundle(store, models=[key])
    bundle.refresh_forecast(store, f"forecast-{key}", catalog, loaded, CFG)
    rows = bundle.stored_forecast(store)

    def score(r):
        if fitted is None:
            return r.withColumn("again", F.lit(None).cast("double"))
        return fitted.transform(r.withColumn(boosting.VECTOR, imputation.vector()), "again")

    keys = ["horizon_day", "cell_lat", "cell_lon"]
    again = score(features.expand_horizons(features.snapshot(catalog, CFG), CFG)).select(*keys, "again")
    others = [F.col(f"proba_{m}").isNull() for m in forecast.MODEL_NAMES if m != key]
    p = F.col(f"proba_{key}")
    return rows.join(again, keys).select(
        "asof_date", "horizon_day", "cell_lat", "cell_lon", *forecast.DISPLAY_COLUMNS,
        F.coalesce((p > 0) & (p < 1), F.lit(fitted is None)).alias("proba_in_range"), (others[0] & others[1]).alias("others_absent"),
        F.coalesce(F.abs(p - F.col("again")) < 1e-9, F.lit(fitted is None)).alias("as_trained"), "mag_likely", "mag_severe")


@query("gbt_forecast", _forecast_sql(S.ORDERS))
def gbt_forecast(spark, d):
    """The forecast table of the long catalog from the stored boosted trees; the other models are absent.

    So are the boosted trees if the rows do not train them: on large catalogs every cell-day can have an event ahead.
    """
    store = bundle_store(spark, d)
    fitted = _STORES[(spark.sparkContext.applicationId, d)][1]
    own, gbt = bundle.load_bundle(store, models=[]), fitted.get("gbt")
    serving = TableStore(spark, scratch_path(spark, "serving"))
    models, absent = ({k: v for k, v in x.items() if k == "gbt"} for x in (fitted, own.absent))
    bundle.publish_bundle(serving, "run-1", models, own.imputation, {"gbt": GBT}, absent)
    return _served(serving, orders(spark, d), "gbt", gbt, own.imputation)


def _boosted_forecast(spark, d, key) -> DataFrame:
    """Train on all labelled rows of the short catalog, publish, forecast from its last day."""
    matrix = materialize(events_matrix(spark, d), "matrix")
    imputation = fit_imputation(matrix)
    train = materialize(training.prepare(matrix, imputation), "prepared")
    fitted, absent = training.fit_models(train, None, imputation.feature_columns, {key: CHOSEN[key]}, CFG)
    store = TableStore(spark, scratch_path(spark, "serving"))
    bundle.publish_bundle(store, "run-1", fitted, imputation, {key: CHOSEN[key]}, absent)
    return _served(store, clean_events(spark, d), key, fitted.get(key), imputation)


@query("adaboost_tree_forecast", _forecast_sql(S.EVENTS_CLEAN))
def adaboost_tree_forecast(spark, d):
    return _boosted_forecast(spark, d, "adaboost_dt")


@query("adaboost_forest_forecast", _forecast_sql(S.EVENTS_CLEAN))
def adaboost_forest_forecast(spark, d):
    return _boosted_forecast(spark, d, "adaboost_rf")


_MODELS_SQL = "(select unnest(['adaboost_dt', 'adaboost_rf', 'gbt']) as model) m"


def evaluation(spark, d) -> DataFrame:
    """All metrics of the bundle's models on the purged test split, by model and over horizons; absent models with a reason."""
    store = bundle_store(spark, d)
    loaded, test = bundle.load_bundle(store), split_rows(bundle_store(spark, d), "test")
    parts = [model.transform(test).select(F.lit(key).alias("model"), "horizon_day", "target", "proba") for key, model in loaded.models.items()]
    none = test.where("false").select(F.lit("").alias("model"), "horizon_day", "target", F.lit(0.0).alias("proba"))  # if no model is there
    scored = materialize(reduce(DataFrame.unionByName, parts, none), "scored")
    by_horizon = metrics.by_group(scored, ["model", "horizon_day"])
    each = F.struct("horizon_day", *[c for c in by_horizon.columns if c not in ("model", "horizon_day")])
    table = metrics.compare_models(scored).join(
        by_horizon.groupBy("model").agg(F.array_sort(F.collect_list(each)).alias("by_horizon")), "model")
    names = spark.createDataFrame([(k, loaded.absent.get(k)) for k in forecast.MODEL_NAMES], "model string, absent string")
    return names.join(table, "model", "left")


@query("test_evaluation", f"""
with {_MX_O}, {_SPLIT},
h as (select horizon_day, count(*) as n, sum(target) as pos from tagged where split = 'test' group by horizon_day),
t as (select cast(sum(n) as bigint) as n, cast(sum(pos) as bigint) as pos,
             array_to_string(list(concat(horizon_day, ':', n, ':', cast(pos as bigint)) order by horizon_day), ',') as by_horizon from h)
select m.model, t.n as test_rows, t.pos as test_positives, t.by_horizon, true as counts_agree, true as auc_agrees, true as in_range
from t, {_MODELS_SQL}""")
def test_evaluation(spark, d):
    """What SQL can check of the evaluation: rows and positives by horizon, ROC-AUC by a second formula, ranges."""
    store = bundle_store(spark, d)
    test = split_rows(store, "test")
    per = test.groupBy("horizon_day").agg(F.count(F.lit(1)).alias("n"), F.sum("target").alias("pos"))
    line = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("horizon_day", "n", "pos"))), lambda x: F.concat_ws(
        ":", x.horizon_day.cast("string"), x.n.cast("string"), x.pos.cast("string"))), ",")
    split = per.agg(F.sum("n").alias("test_rows"), F.sum("pos").cast("long").alias("test_positives"), line.alias("by_horizon"))
    table = materialize(evaluation(spark, d), "evaluation")
    loaded = bundle.load_bundle(store)
    second = {k: auc_of(m.transform(test), "proba") for k, m in loaded.models.items()}
    other = spark.createDataFrame([(k, second.get(k)) for k in forecast.MODEL_NAMES], "model string, second double")
    there = F.col("n").isNotNull()
    share = lambda c: F.col(c).between(0, 1)
    counts = (F.col("n") == F.col("test_rows")) & (F.col("n_positive") == F.col("test_positives")) & (
        F.array_join(F.transform("by_horizon_metrics", lambda x: F.concat_ws(":", x.horizon_day.cast("string"), x.n.cast("string"), x.positives.cast("string"))), ",") == F.col("by_horizon"))
    rows = table.withColumnRenamed("by_horizon", "by_horizon_metrics").join(other, "model").crossJoin(F.broadcast(split))  # one row
    named = F.col("absent").isNotNull()
    return rows.select(
        "model", "test_rows", "test_positives", "by_horizon", F.when(there, counts).otherwise(named).alias("counts_agree"),
        F.when(there, F.abs(F.col("roc_auc") - F.col("second")) < 1e-9).otherwise(named).alias("auc_agrees"),
        F.when(there, share("roc_auc") & share("pr_auc") & share("brier_score") & share("best_f1_threshold") & share("f1")).otherwise(named).alias("in_range"))


@query("tuned_rounds", f"""
with {_MX_O}, {_SPLIT}
select count(*) as val_rows, cast(sum(target) as bigint) as val_positives, true as stopped_by_patience, true as best_is_first_maximum,
       true as kept_up_to_best, true as auc_agrees
from tagged where split = 'val'""")
def tuned_rounds(spark, d):
    """How boosting stopped: its curve on the validation rows, and the best value by a second formula; an absent model has a reason."""
    store = bundle_store(spark, d)
    loaded, val = bundle.load_bundle(store, models=["gbt"]), split_rows(store, "val")
    if "gbt" not in loaded.models:
        facts = ["gbt" in loaded.absent] * 4
    else:
        model = loaded.models["gbt"]
        values = [(r, auc) for r, auc in model.curve if auc is not None]
        best, best_auc = max(values, key=lambda x: (x[1], -x[0]))
        facts = [
            len(model.curve) >= best + PATIENCE or len(model.curve) == GBT["rounds"],
            all(auc < best_auc for r, auc in values if r < best), model.rounds == best, abs(auc_of(model.transform(val), "proba") - best_auc) < 1e-9]
    names = ("stopped_by_patience", "best_is_first_maximum", "kept_up_to_best", "auc_agrees")
    return val.agg(F.count(F.lit(1)).alias("val_rows"), F.sum("target").cast("long").alias("val_positives")).select(
        "*", *[F.lit(bool(f)).alias(n) for f, n in zip(facts, names)])


_GAPS = " + ".join(f"cast(bool_or({c} is null) as integer)" for c in S.FEATURE_NAMES)


@query("feature_importance", f"""
with {_MX_O}, {_SPLIT},
inputs as (select 3 + {len(S.FEATURE_NAMES)} + {_GAPS} as n from tagged where split <> 'purged')
select m.model, cast(i.n as integer) as inputs, true as known, true as in_order, true as whole from inputs i, {_MODELS_SQL}""")
def feature_importance(spark, d):
    """The top 15 inputs of every model of the bundle: known names, falling order, shares of one."""
    loaded = bundle.load_bundle(bundle_store(spark, d))
    columns, spread = loaded.imputation.feature_columns, []
    tables = [boosting.importance_table(spark, k, columns, m.importances()) for k, m in loaded.models.items()]
    every = reduce(DataFrame.unionByName, tables, boosting.importance_table(spark, "", [], []))
    top = boosting.top_importances(every, 15).groupBy("model").agg(
        F.array_sort(F.collect_list(F.struct("rank", "importance", "feature"))).alias("top"))
    sums = every.groupBy("model").agg(F.sum("importance").alias("total"), F.min("importance").alias("least"))
    names = spark.createDataFrame([(k, loaded.absent.get(k)) for k in forecast.MODEL_NAMES], "model string, absent string")
    falling = F.forall(F.sequence(F.lit(1), F.size("top") - 1), lambda k: F.get("top", k - 1)["importance"] >= F.get("top", k)["importance"])
    known = (F.size("top") == min(15, len(columns))) & F.forall("top", lambda x: x.feature.isin(columns))
    there, named = F.col("top").isNotNull(), F.col("absent").isNotNull()
    return names.join(top, "model", "left").join(sums, "model", "left").select(
        "model", F.lit(len(columns)).alias("inputs"), F.when(there, known).otherwise(named).alias("known"), F.when(there, falling).otherwise(named).alias("in_order"),
        F.when(there, (F.abs(F.col("total") - 1) < 1e-6) & (F.col("least") >= 0)).otherwise(named).alias("whole"))


# Two of the configured depths, and a shorter patience (README: measured times); rounds as configured.
SEARCHED, SEARCH_PATIENCE = {"depth": [4, 6], "rate": [0.1], "rounds": [2000]}, 5


@query("grid_search_scores", """
select cast(k as integer) as grid_no, concat('{"depth": ', d, ', "rate": 0.1, "rounds": 2000}') as params,
       true as folds_agree, true as in_range, true as best_is_highest
from (values (0, 4), (1, 6)) v(k, d)""")
def grid_search_scores(spark, d):
    """Grid search of the boosted trees over the folds of the short catalog, every fit stopped by patience."""
    matrix = materialize(events_matrix(spark, d), "matrix")
    imputation = fit_imputation(matrix)
    indexed = materialize(training.prepare(splits.indexed_rows(matrix), imputation, ("row_index",)), "indexed")
    folds = materialize(training.grid_search("gbt", indexed, imputation.feature_columns, SEARCHED, CFG, parallelism=4, patience=SEARCH_PATIENCE), "fold-scores")
    scores = training.grid_scores(folds)
    best = scores.agg(F.max("mean_roc_auc").alias("highest"), F.count_if("is_best").alias("marked"), F.max("folds_scored").alias("most"))
    return scores.crossJoin(F.broadcast(best)).select(  # one row
        "grid_no", "params", (F.col("folds_scored") == F.col("most")).alias("folds_agree"),
        F.coalesce(F.col("mean_roc_auc").between(0, 1), F.lit(True)).alias("in_range"),
        ((F.col("marked") == 1) & (~F.col("is_best") | F.col("mean_roc_auc").eqNullSafe(F.col("highest")))).alias("best_is_highest"))


@query("walk_forward_gbt", f"""
with {_MX_O}, {_CUTS},
tr as (select cutoff, count(*) as train_rows, {q('avg(target)')} as train_positive_rate
       from cuts join mx on mx.day + mx.horizon_day <= cutoff group by cutoff),
fr as (select cutoff, count(*) as n, cast(sum(target) as bigint) as positives, {q('avg(target)')} as positive_rate
       from cuts join mx on mx.day = cutoff group by cutoff)
select tr.cutoff, fr.n, fr.positives, fr.positive_rate, tr.train_rows, tr.train_positive_rate, true as in_range, true as horizons_agree
from tr join fr on tr.cutoff = fr.cutoff""")
def walk_forward_gbt(spark, d):
    """Refit at ten cutoffs with the tuned parameters of the stored bundle; one row a date with what it was trained on.

    If the bundle's model is absent there are no tuned parameters, so no scores: the counts alone.
    """
    store = bundle_store(spark, d)
    chosen = store.read_report("parameters", bundle.PARAMETERS).first()
    matrix = store.read("matrix").drop("month")
    cutoffs = backtest.cutoff_list(matrix, CFG)
    if "gbt" not in (chosen.rounds or {}):
        named = F.lit("gbt" in (chosen.absent or {}))
        counts = matrix.where(F.col("day").isin(cutoffs)).groupBy(F.col("day").alias("cutoff")).agg(
            F.count(F.lit(1)).alias("n"), F.sum("target").cast("long").alias("positives"), F.avg(F.col("target").cast("double")).alias("positive_rate"))
        trained = backtest.training_stats(matrix, spark.createDataFrame([(c,) for c in cutoffs], "cutoff date"), CFG)
        return counts.join(trained, "cutoff").select(
            "cutoff", "n", "positives", "positive_rate", "train_rows", "train_positive_rate", named.alias("in_range"), named.alias("horizons_agree"))
    params = json.loads(chosen.params["gbt"]) | {"rounds": chosen.rounds["gbt"]}
    scored = materialize(backtest.walk_forward(matrix, cutoffs, backtest.gbt_scorer(params, CFG)), "scored")
    dates = spark.createDataFrame([(c,) for c in cutoffs], "cutoff date")
    table = backtest.per_date_table(scored, matrix, dates, CFG)
    horizons = backtest.per_horizon(scored, CFG).groupBy("cutoff").agg(F.sum("n").alias("_n"), F.sum("positives").alias("_pos"), F.max("precision_at_top").alias("_top"))
    share = lambda c: F.coalesce(F.col(c).between(0, 1), F.lit(True))
    return table.join(horizons, "cutoff").select(
        "cutoff", "n", "positives", "positive_rate", "train_rows", "train_positive_rate",
        (share("roc_auc") & share("pr_auc") & share("brier") & share("_top")).alias("in_range"),
        ((F.col("_n") == F.col("n")) & (F.col("_pos") == F.col("positives"))).alias("horizons_agree"))


@query("model_bundle", f"""
with {_MX_O}, {_SPLIT},
inputs as (select 3 + {len(S.FEATURE_NAMES)} + {_GAPS} as n from tagged where split <> 'purged'),
t as (select count(*) as n from tagged where split = 'test')
select m.model, cast(i.n as integer) as inputs, t.n as scored_rows, true as same_scores, true as same_inputs, true as foreign_refused
from inputs i, t, {_MODELS_SQL}""")
def model_bundle(spark, d):
    """Train, publish, load: stored models score as those in memory, and inputs of another run are refused."""
    store = bundle_store(spark, d)
    fitted, test = _STORES[(spark.sparkContext.applicationId, d)][1], split_rows(store, "test")
    loaded = bundle.load_bundle(store)
    columns, out = loaded.imputation.feature_columns, []
    for key in forecast.MODEL_NAMES:
        if key not in fitted:  # absent with a reason, and nothing is loaded for it
            gone = key in loaded.absent and key not in loaded.models
            out.append(test.agg(F.count(F.lit(1)).alias("scored_rows")).select(F.lit(key).alias("model"), "scored_rows", *[F.lit(gone).alias(c) for c in ("same_scores", "same_inputs", "foreign_refused")]))
            continue
        try:
            boosting.check_schema(columns[1:] + ["another_column"], loaded.models[key].columns)
            refused = False
        except ValueError as e:
            refused = "another_column" in str(e) and columns[0] in str(e)
        both = loaded.models[key].transform(fitted[key].transform(test, "ours"), "stored")
        out.append(both.agg(F.count(F.lit(1)).alias("scored_rows"), (F.max(F.abs(F.col("ours") - F.col("stored"))) == 0).alias("same_scores")).select(
            F.lit(key).alias("model"), "scored_rows", "same_scores", F.lit(loaded.models[key].columns == columns).alias("same_inputs"), F.lit(refused).alias("foreign_refused")))
    return reduce(DataFrame.unionByName, out).withColumn("inputs", F.lit(len(columns)))


# --- tables -------------------------------------------------------------------

@query("published_matrix", f"with {_MX_E} select day, horizon_day, {_MX_COLUMNS}, target from mx")
def published_matrix(spark, d):
    """Write, publish and read back the matrix, partitioned by month."""
    store = TableStore(spark, scratch_path(spark, "store"))
    matrix = events_matrix(spark, d)
    path = store.write(matrix, "matrix", "run-1", month_of="day", sort_by=["day", "cell_lat"])
    store.publish("run-1", {"matrix": path})
    return store.read("matrix").drop("month")


@query("catalog_versions", f"""
with a as (select * from ({S.DEDUPED}) d), b as (select * from ({S.EVENTS_CLEAN}) c)
select 1 as step, 'first' as run_id, (select count(*) from a) as rows, (select {q('sum(mag)')} from a) as mag union all
select 2, 'second', (select count(*) from b), (select {q('sum(mag)')} from b) union all
select 3, 'first', (select count(*) from a), (select {q('sum(mag)')} from a) union all
select 4, 'first', (select count(*) from a), (select {q('sum(mag)')} from a) union all
select 5, 'second', (select count(*) from b), (select {q('sum(mag)')} from b)""")
def catalog_versions(spark, d):
    """Two published versions of the catalog; the first read again by its run, made current again, and the second still there."""
    store = TableStore(spark, scratch_path(spark, "store"))
    raw = raw_events(spark, d)
    store.publish("first", {"catalog": store.write(cleaning.upsert(raw.where("id % 2 = 0"), [raw.where("id % 2 = 1")]), "catalog", "first")})

    def seen(step, run_id=None):
        name = store.version("catalog", run_id)["run_id"]
        return store.read("catalog", run_id=run_id).agg(F.count(F.lit(1)).alias("rows"), F.sum("mag").alias("mag")).select(
            F.lit(step).alias("step"), F.lit(name).alias("run_id"), "rows", "mag")

    out = [seen(1)]
    store.publish("second", {"catalog": store.write(clean_events(spark, d), "catalog", "second")})
    out += [seen(2), seen(3, "first")]
    store.rollback("first")
    out += [seen(4), seen(5, "second")]
    return reduce(DataFrame.unionByName, out)


@query("cleaning_report", f"""
with s as ({ORACLES['clean_step_counts']})
select cast(step_no as integer) as step_no, step, cast(rows as bigint) as rows from s""")
def cleaning_report(spark, d):
    """Step counts written as one JSON document, published, and read back as rows."""
    store = TableStore(spark, scratch_path(spark, "store"))
    counts = cleaning.clean_step_counts(raw_events(spark, d), CFG)
    step = F.struct("step_no", "step", "rows")
    report = counts.agg(F.array_sort(F.collect_list(step)).alias("steps"))
    store.publish("run-1", {"cleaning": store.write_report(report, "cleaning", "run-1")})
    read = store.read_report("cleaning", report.schema)
    return read.select(F.inline("steps")).select(F.col("step_no").cast("int"), "step", "rows")


@query("csv_feed", f"""
select cast(id as varchar) as id, time, updated, latitude, longitude, depth, mag,
       "magType", type from ({S.EVENTS_RAW}) r""")
def csv_feed(spark, d):
    """Deliver the catalog as a CSV text feed and type it again."""
    path = scratch_path(spark, "feed")
    raw = views.as_raw_text(raw_events(spark, d))
    raw.write.option("header", True).csv(path)
    typed = cleaning.coerce_types(feed.read_feed(spark, path, tuple(raw.columns)))
    return typed.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("time", "updated")})


# --- streams ------------------------------------------------------------------

def event_stream(spark, d) -> DataFrame:
    """The events table as a file stream, in the shape of a catalog.

    It arrives in three deliveries, one micro-batch each, in order of time.
    """
    table, path = views.read_table(spark, d, "events"), scratch_path(spark, "landing")
    second = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = table.select(second.cast("double").alias("t")).approxQuantile("t", [1 / 3, 2 / 3], 0.01)
    for part in (second < low, (second >= low) & (second < high), (second >= high) | second.isNull()):
        table.where(part).coalesce(1).write.mode("append").parquet(path)
    source = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return views.events_as_catalog(source).withColumns(
        {c: F.col(c).cast("timestamp") for c in ("time", "updated")})


@query("stream_upsert", f"""
select id, time, updated, latitude, longitude, depth, mag, "magType", type
from ({S.DEDUPED}) d""")
def stream_upsert(spark, d):
    root, state = scratch_path(spark, "upsert"), scratch_path(spark, "state")
    source = event_stream(spark, d)
    streams.upsert_stream(source, root, state).awaitTermination()
    return streams.current_catalog(spark, root, source.schema).withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("time", "updated")})


@query("stream_dedupe", f"""
select distinct id from ({S.EVENTS_RAW}) r""")
def stream_dedupe(spark, d):
    root, state = scratch_path(spark, "dedupe"), scratch_path(spark, "state")
    streams.run_available(streams.drop_resent(event_stream(spark, d), "1 day"), state).format(
        "parquet").start(root).awaitTermination()
    return spark.read.parquet(root).select("id")


@query("stream_cell_day", f"""
with cat as ({S.EVENTS_RAW}),
g as (select cast(time as date) as day, cast(floor(latitude) as integer) as i,
             cast(floor(longitude) as integer) as j, count(*) as n, max(mag) as m
      from cat group by 1, 2, 3)
select day, i, j, n, {q('m')} as max_mag from g
where cast(day + 1 as timestamp) <= (select max(time) - interval 1 hour from cat)""")
def stream_cell_day(spark, d):
    root, state = scratch_path(spark, "counts"), scratch_path(spark, "state")
    counts = streams.cell_day_stream(event_stream(spark, d), "1 hour", CFG)
    streams.run_available(counts, state).format("parquet").start(root).awaitTermination()
    return cell_names(spark.read.parquet(root)).select("day", "i", "j", "n", "max_mag")


@query("stream_decay", f"""
with cat as ({S.DEDUPED}),
e as (select cast(floor(latitude) as integer) as i, cast(floor(longitude) as integer) as j,
             cast(time as date) as day from cat)
select i, j, {q('''sum(pow(cast(0.5 as double),
         ((select max(day) from e) - day) / cast(3 as double)))''')} as decayed from e group by i, j""")
def stream_decay(spark, d):
    root, state = scratch_path(spark, "decay"), scratch_path(spark, "state")
    streams.decay_stream(event_stream(spark, d), root, state, CFG.neighbor_half_life,
                         CFG).awaitTermination()
    return cell_names(streams.decay_state(spark, root, CFG.neighbor_half_life)).select("i", "j", "decayed")
