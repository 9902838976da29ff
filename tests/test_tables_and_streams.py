"""Published tables, model files and multi-batch streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tremorgrid.config import HazardConfig
from tremorgrid.operators import boosted, boosting, cleaning
from tremorgrid.operators.boosting import SammeModel
from tremorgrid.operators.imputation import Imputation
from tremorgrid.plans import bundle, reports, training
from tremorgrid.session import folders, materialize, scratch_scope, shared_dir
from tremorgrid.sources import catalog as feed
from tremorgrid.sources import views
from tremorgrid.sources.tables import TableStore
from tremorgrid.streaming import events as streams
from tremorgrid.streaming.buckets import BucketedTable

SF = "/root/testdata/sf0.001"
CFG = HazardConfig(mag_threshold=3.5, min_events_per_cell=10)


def test_unpublished_runs_stay_invisible(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert store.current("t") is None
    first = store.write(spark.range(3), "t", "r1")
    with pytest.raises(FileNotFoundError):
        store.read("t")
    store.publish("r1", {"t": first})
    second = store.write(spark.range(5), "t", "r2")
    assert store.read("t").count() == 3
    store.publish("r2", {"t": second})
    assert store.read("t").count() == 5
    assert spark.read.parquet(first).count() == 3  # the old version remains as backup


def test_report_round_trip(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    report = cleaning.clean_step_counts(views.catalog_events(spark, SF), CFG).agg(
        F.sort_array(F.collect_list(F.struct("step_no", "step", "rows"))).alias("steps"))
    store.publish("r", {"cleaning": store.write_report(report, "cleaning", "r")})
    steps = store.read_report("cleaning").first().steps
    assert [s.rows for s in steps] == [1000, 980, 958, 958, 937, 933]
    assert reports.as_json(report).first().report.startswith('{"steps":[{"step_no":0')


def test_csv_feed_keeps_text_and_nulls(spark, tmp_path):
    path = str(tmp_path / "feed.csv")
    (tmp_path / "feed.csv").write_text(
        ",".join(feed.FEED_COLUMNS) + "\n" + "2024-01-01T00:00:00Z,1,2,3,,ml" + "," * 16 + "\n")
    row = feed.read_feed(spark, path).first()
    assert row.latitude == "1" and row.mag is None and row.magType == "ml"
    assert cleaning.coerce_types(feed.read_feed(spark, path)).first().latitude == 1.0


@pytest.fixture(scope="module")
def separable(spark):
    rows = spark.range(600).select(
        (F.col("id") % 2).cast("int").alias("target"),
        F.array((F.col("id") % 2) * 2.0 + F.rand(1), F.rand(2)).alias("x"))
    from pyspark.ml.functions import array_to_vector
    return rows.select("target", array_to_vector("x").alias(boosting.VECTOR)).cache()


@pytest.mark.parametrize("kind", ["tree", "forest"])
def test_samme_learns_and_survives_saving(spark, tmp_path, separable, kind):
    noisy = separable.withColumn("target", F.when(F.rand(3) < 0.1, 1 - F.col("target"))
                                 .otherwise(F.col("target"))).cache()
    model = boosting.fit_samme(noisy, ["x1", "x2"], rounds=7, kind=kind, depth=2, trees=3)
    scored = model.transform(noisy)
    low, high = scored.agg(F.min("proba"), F.max("proba")).first()
    assert 0.119 < low < 0.5 < high < 0.881
    hits = scored.where((F.col("proba") > 0.5) == (F.col("target") == 1)).count()
    assert hits / noisy.count() > 0.85
    model.save(spark, str(tmp_path / kind))
    again = SammeModel.load(spark, str(tmp_path / kind)).transform(noisy)
    assert again.agg(F.sum("proba")).first()[0] == pytest.approx(scored.agg(F.sum("proba")).first()[0])
    assert model.importances()[0] > model.importances()[1]


@pytest.fixture(scope="module")
def noisy(spark):
    """Rows whose second input says something, with a fifth of the labels turned; split in two."""
    from pyspark.ml.functions import array_to_vector

    rows = spark.range(800).select(
        F.col("id"), F.array(F.rand(5), F.rand(6), F.rand(7)).alias("x")).withColumn(
        "target", ((F.col("x")[1] > 0.5) != (F.rand(8) < 0.2)).cast("int"))
    stored = rows.select("id", "target", array_to_vector("x").alias(boosting.VECTOR)).cache()
    return stored.where("id % 2 = 0").drop("id"), stored.where("id % 2 = 1").drop("id")


def test_boosting_waits_and_keeps_the_best_round(spark, tmp_path, noisy):
    train, judge = noisy
    model = boosted.fit_boosted(train, ["a", "b", "c"], depth=3, rate=0.5, rounds=60, judge=judge, patience=7)
    values = [v for _, v in model.curve]
    best = values.index(max(values)) + 1
    assert model.rounds == best and [r for r, _ in model.curve] == list(range(1, len(values) + 1))
    assert len(values) >= best + 7 and len(values) <= best + 7 + boosted.BLOCK
    again = boosted.fit_boosted(train, ["a", "b", "c"], depth=3, rate=0.5, rounds=best)  # no judge: all rounds
    scored = again.transform(model.transform(judge, "stopped"), "short")
    assert scored.where("abs(stopped - short) > 1e-9").isEmpty()
    pos = judge.where("target = 1").count()
    pairs = model.transform(judge).select("target", "proba")
    a, b = pairs.where("target = 1").select(F.col("proba").alias("p")), pairs.where("target = 0").select(F.col("proba").alias("q"))
    auc = a.crossJoin(b).agg(F.avg(F.when(F.col("p") > F.col("q"), 1.0).when(F.col("p") == F.col("q"), 0.5).otherwise(0.0))).first()[0]
    assert auc == pytest.approx(max(values)) and auc > 0.7 and pos
    assert model.importances()[1] > 0.4 and sum(model.importances()) == pytest.approx(1)
    model.save(spark, str(tmp_path / "m"))
    loaded = boosted.BoostedTrees.load(spark, str(tmp_path / "m"))
    assert loaded.curve == model.curve and loaded.columns == model.columns
    assert loaded.transform(model.transform(judge, "ours"), "stored").where("ours <> stored").isEmpty()


def test_first_newton_step_by_hand(spark):
    from pyspark.ml.functions import array_to_vector

    rows = spark.createDataFrame([(1, 0.0), (1, 0.0), (0, 0.0), (0, 1.0), (0, 1.0), (1, 1.0)], "target int, x double")
    rows = rows.select("target", array_to_vector(F.array("x")).alias(boosting.VECTOR), "x")
    model = boosted.fit_boosted(rows, ["x"], depth=1, rate=1.0, rounds=1, positive_weight=2.0)
    # leaf = sum w (y - 1/2) / sum w / 4
    want = {0.0: (2 * 2 * 0.5 - 0.5) / ((2 * 2 + 1) / 4), 1.0: (2 * 0.5 - 2 * 0.5) / ((2 + 2) / 4)}
    for r in model.transform(rows).collect():
        assert r.proba == pytest.approx(1 / (1 + 2.718281828459045 ** -want[r.x]))


def test_best_of_stops_at_patience():
    assert boosted.best_of([(1, 0.5), (2, 0.7), (3, 0.7), (4, 0.6)], 2) == (2, True)
    assert boosted.best_of([(1, 0.5), (2, 0.7), (3, 0.7)], 2) == (2, False)
    assert boosted.best_of([(1, None), (2, None), (3, None)], 2) == (0, True)
    assert boosted.best_of([(1, 0.5), (2, 0.4), (3, 0.4), (4, 0.9)], 2) == (1, True)  # what comes later does not count


def test_judge_of_one_class_leaves_all_rounds(noisy):
    train, judge = noisy
    model = boosted.fit_boosted(train, ["a", "b", "c"], depth=1, rate=0.5, rounds=3, judge=judge.where("target = 1"), patience=50)
    assert model.rounds == 3 and [v for _, v in model.curve] == [None] * 3
    with pytest.raises(boosting.Unfit):
        boosted.fit_boosted(train.where("target = 0"), ["a", "b", "c"], rounds=2)


def test_staged_votes_are_those_of_shorter_ensembles(noisy):
    train, judge = noisy
    long = boosting.fit_samme(train, ["a", "b", "c"], rounds=5, depth=1)
    staged = long.staged(judge, [1, 3, 5, 9], ["target"]).groupBy("rounds").agg(F.sum("proba").alias("s")).collect()
    at = {r.rounds: r.s for r in staged}
    assert sorted(at) == [1, 3, 5, 9] and at[9] == at[5]  # boosting that ended is as it is
    for k in (1, 3, 5):
        short = boosting.fit_samme(train, ["a", "b", "c"], rounds=k, depth=1)
        assert short.transform(judge).agg(F.sum("proba")).first()[0] == pytest.approx(at[min(k, len(long.members))])


def test_uninformative_rows_train_no_first_member(spark):
    from pyspark.ml.functions import array_to_vector

    rows = spark.createDataFrame([(int(k % 30 == 0), float(k % 5 < 3)) for k in range(300)], "target int, x double")
    rows = rows.select("target", array_to_vector(F.array("x")).alias(boosting.VECTOR))
    fitted, absent = training.fit_models(rows, None, ["x"], {"adaboost_dt": dict(depth=2, rounds=3, rate=0.6)}, CFG)
    assert not fitted and "chance" in absent["adaboost_dt"]


def test_grid_over_rounds_costs_one_fit_a_fold(spark, noisy, monkeypatch):
    fits, plain = [], boosting.fit_samme
    monkeypatch.setattr(boosting, "fit_samme", lambda *a, **k: fits.append(k["rounds"]) or plain(*a, **k))
    rows = noisy[0].withColumn("day", F.lit("2024-01-01").cast("date")).withColumn("row_index", F.monotonically_increasing_id())
    n = rows.count()
    rows = spark.createDataFrame([(*r[:3], k) for k, r in enumerate(rows.collect())], rows.schema).cache()
    grid = {"depth": [1, 2], "rounds": [1, 2, 4], "rate": [0.6]}
    folds = training.grid_search("adaboost_dt", rows, ["a", "b", "c"], grid, CFG.with_(horizon_days=0, cv_folds=2), parallelism=1).cache()
    assert sorted(fits) == [4] * 4 and folds.count() == 12 and n
    scores = training.grid_scores(folds).collect()
    assert len(scores) == 6 and sum(r.is_best for r in scores) == 1
    assert training.best_params(training.grid_scores(folds))["rate"] == 0.6


def test_bundle_is_published_as_one_and_refuses_other_inputs(spark, tmp_path, noisy):
    train, judge = noisy
    store, columns = TableStore(spark, str(tmp_path / "s")), ["a", "b", "c"]
    imputation = Imputation(columns, [], {"a": 0.1, "b": 1 / 3, "c": 2.0})
    gbt = boosted.fit_boosted(train, columns, depth=1, rounds=2)
    with pytest.raises(FileNotFoundError):
        bundle.load_bundle(store)
    bundle.publish_bundle(store, "r1", {"gbt": gbt}, imputation, {"gbt": {"depth": 1}}, {"adaboost_dt": "no better than chance"})
    loaded = bundle.load_bundle(store)
    assert loaded.imputation == imputation and set(loaded.models) == {"gbt"} and loaded.absent == {"adaboost_dt": "no better than chance"}
    assert loaded.params == {"gbt": {"depth": 1}} and bundle.load_bundle(store, models=[]).models == {}
    features = spark.createDataFrame([(0.5, None, 1.0), (0.1, 0.9, None)], "a double, b double, c double")
    assert loaded.score(features).columns == ["a", "b", "c", "proba_gbt"] and loaded.score(features).where("proba_gbt between 0 and 1").count() == 2
    for other in (["a", "b", "x"], ["b", "a", "c"], ["a", "b"]):
        with pytest.raises(ValueError):
            bundle.publish_bundle(store, "r2", {"gbt": gbt}, Imputation(other, [], {}), {})
    assert bundle.load_bundle(store).run_id == "r1"  # nothing of the refused run is visible
    with pytest.raises(FileExistsError):
        bundle.publish_bundle(store, "r1", {"gbt": gbt}, imputation, {})


def test_many_trees_score_and_are_stored_as_one_model(spark, tmp_path, noisy):
    train, _ = noisy
    few = boosted.fit_boosted(train, ["a", "b", "c"], depth=2, rounds=4)
    many = boosted.BoostedTrees(few.members * 200, 0.01, few.columns, [(1, None)])
    steps = boosted._grown(train.withColumn("margin", F.lit(0.0)), few.members, 0.01)  # tree by tree
    off = many.transform(steps).agg(F.max(F.abs(F.col("proba") - 1 / (1 + F.exp(-200 * F.col("margin")))))).first()[0]
    assert off < 1e-9
    many.save(spark, str(tmp_path / "m"))
    stored = boosted.BoostedTrees.load(spark, str(tmp_path / "m"))
    assert (stored.rounds, stored.rate, stored.columns, stored.curve) == (800, 0.01, ["a", "b", "c"], [(1, None)])
    assert stored.importances() == many.importances()
    assert stored.transform(many.transform(train, "ours"), "theirs").where("ours != theirs").count() == 0


def test_catalog_of_one_class_has_no_trained_model(spark, tmp_path):
    """Every day of every cell has a strong event: all labels are one, as on large catalogs, so no model is trained."""
    from workload import models

    days = spark.range(240).select(F.expr("timestamp_ntz'2020-01-01' + make_dt_interval(cast(id as int))").alias("o_orderdate"), "id")
    rows = days.crossJoin(spark.range(2).select(F.col("id").alias("o_custkey")))
    rows.select((F.lit(130) + 143 * (2 * F.col("id") + F.col("o_custkey"))).alias("o_orderkey"), "o_custkey", "o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(0, 3), (1, 4)], "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(3,), (4,)], "n_nationkey int").write.parquet(f"{tmp_path}/nation.parquet")
    d = str(tmp_path)
    got = models.gbt_forecast(spark, d).collect()
    assert sorted({(r.horizon_day, r.cell_lon) for r in got}) == [(h, c) for h in range(1, 8) for c in (1.5, 2.5)] and len(got) == 14
    assert all(r.proba_in_range and r.others_absent and r.as_trained for r in got)
    facts = ("stopped_by_patience", "best_is_first_maximum", "kept_up_to_best", "auc_agrees")
    assert [all(r[f] for f in facts) for r in models.tuned_rounds(spark, d).collect()] == [True]
    assert [r.known and r.in_order and r.whole for r in models.feature_importance(spark, d).collect()] == [True] * 3
    judged = models.test_evaluation(spark, d).collect()
    assert len(judged) == 3 and all(r.counts_agree and r.auc_agrees and r.in_range and r.test_rows == r.test_positives > 0 for r in judged)
    dates = models.walk_forward_gbt(spark, d).collect()
    assert len(dates) == 10 and all(r.n == r.positives == 14 and r.positive_rate == r.train_positive_rate == 1 and r.in_range and r.horizons_agree for r in dates)


def test_versions_rollback_and_prune(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"))
    for k in (1, 2, 3, 4):
        store.publish(f"r{k}", {"t": store.write(spark.range(k), "t", f"r{k}"), "u": store.write(spark.range(10 * k), "u", f"r{k}")})
    assert [v["run_id"] for v in store.versions("t")] == ["r4", "r3", "r2", "r1"]
    store.rollback("r2")
    assert store.read("t").count() == 2 and store.read("u").count() == 20 and store.read("t", run_id="r4").count() == 4
    store.write(spark.range(7), "t", "r3b")  # never published, older than the newest
    store.write(spark.range(7), "t", "r5")  # being written now
    assert sorted(store.prune("t", keep=2)) == ["r1", "r3", "r3b"]
    assert sorted(folders(spark, str(tmp_path / "s/t"))) == ["run_id=r2", "run_id=r4", "run_id=r5"]
    assert store.read("t").count() == 2 and store.read("u", run_id="r1").count() == 10
    with pytest.raises(FileNotFoundError):
        store.read("t", run_id="r1")
    with pytest.raises(FileExistsError):  # a removed run's name is not used again
        store.write(spark.range(1), "t", "r1")
    with pytest.raises(FileNotFoundError):
        store.rollback("r9")
    assert store.prune("t", keep=2) == []


def test_fits_leave_no_tables_behind(spark, noisy):
    train, judge = noisy
    base = shared_dir(spark)
    before = set(folders(spark, base))
    boosted.fit_boosted(train, ["a", "b", "c"], depth=1, rounds=boosted.BLOCK + 1, judge=judge)
    boosting.fit_samme(train, ["a", "b", "c"], rounds=boosting.CHECKPOINT_EVERY + 1, depth=1)
    assert set(folders(spark, base)) == before
    with scratch_scope(spark):
        kept = materialize(spark.range(3), "kept").count()
    assert kept == 3 and set(folders(spark, base)) == before


def test_grid_search_scores_every_fold(spark, separable):
    from pyspark.sql import Window
    rows = separable.withColumns({
        "day": F.lit("2024-01-01").cast("date"),
        "row_index": F.row_number().over(Window.orderBy(F.monotonically_increasing_id())) - 1,
    }).cache()
    cfg = CFG.with_(horizon_days=0, cv_folds=2)
    folds = training.grid_search("gbt", rows, ["a", "b"],
                                 {"depth": [1, 2], "rate": [0.3], "rounds": [1]}, cfg)
    assert folds.count() == 4 and folds.agg(F.min("roc_auc")).first()[0] > 0.95
    best = training.grid_scores(folds).where("is_best").collect()
    assert [r.grid_no for r in best] == [0]  # equal scores: the first wins


@pytest.fixture()
def landing(spark, tmp_path):
    """The catalog delivered in three files, the middle one twice."""
    rows = views.catalog_events(spark, SF).withColumns(
        {c: F.col(c).cast("timestamp") for c in ("time", "updated")})
    path = tmp_path / "landing"
    for k, part in enumerate((0, 1, 1, 2)):
        rows.where(F.col("id") % 3 == part).coalesce(1).write.parquet(str(path / f"part={k}"))
    return (spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1)
            .parquet(str(path / "part=*")), rows)


def test_stream_upsert_equals_batch(spark, tmp_path, landing):
    stream, rows = landing
    root = str(tmp_path / "table")
    streams.upsert_stream(stream, root, str(tmp_path / "cp"), buckets=8).awaitTermination()
    current = streams.current_catalog(spark, root, rows.schema, buckets=8)
    expected = cleaning.keep_latest(rows)
    assert current.exceptAll(expected).count() == 0 and current.count() == expected.count()


def changed(spark, root, version):
    return {n for n in folders(spark, f"{root}/rows/version={version}")}


def test_a_batch_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    schema = "id string, updated timestamp, mag double"
    table = BucketedTable(spark, str(tmp_path / "t"), spark.createDataFrame([], schema).schema, ["id"], buckets=16)
    every = spark.range(500).select(F.col("id").cast("string").alias("id"), F.lit("2024-01-01").cast("timestamp").alias("updated"), F.lit(1.0).alias("mag"))
    streams.merge_batch(table, every, 0)
    for k in range(1, 20):
        streams.merge_batch(table, every.where(f"id = '{k}'").withColumns({"mag": F.lit(1.0 + k), "updated": F.lit("2024-02-01").cast("timestamp")}), k)
        assert len(changed(spark, table.root, k)) == 1  # however many batches came before
    want = {str(i): 1.0 + i if 0 < i < 20 else 1.0 for i in range(500)}
    assert {r.id: r.mag for r in table.read().collect()} == want
    older = every.where("id in ('3', '400')").withColumns({"mag": F.lit(9.0), "updated": F.lit("2023-01-01").cast("timestamp")})
    streams.merge_batch(table, older, 20)  # out of date: nothing changes
    streams.merge_batch(table, older, 20)  # and the batch may run again
    assert {r.id: r.mag for r in table.read().collect()} == want
    removed = table.vacuum()
    left = sum(len(changed(spark, table.root, v)) for v in range(21))
    assert removed > 10 and left <= 32 and {r.id: r.mag for r in table.read().collect()} == want
    assert table.vacuum() == 0 and table.read(buckets=set()).count() == 0


def test_decayed_counts_over_many_small_batches(spark, tmp_path):
    """Twenty batches of new, repeated and revised events; a batch run twice; expiry of contributions."""
    make = lambda rows: spark.createDataFrame(rows, "id string, time timestamp_ntz, updated timestamp_ntz, latitude double, longitude double").withColumns(
        {c: F.col(c).cast("timestamp") for c in ("time", "updated")})
    at = lambda day, minute=0: dt.datetime(2024, 1, 1) + dt.timedelta(days=day, minutes=minute)
    batches = [[(f"e{k}", at(k), at(k), 1.5 + k % 3, 2.5), (f"e{k // 2}", at(k // 2), at(k, 1), 7.5 if k % 5 == 0 else 1.5, 2.5)] for k in range(20)]
    events, cells = streams.decay_tables(spark, str(tmp_path), 8)
    touched = []
    for k, rows in enumerate(batches):
        for _ in range(2 if k == 7 else 1):
            streams.decay_batch(events, cells, make(rows), k, 3, CFG)
        touched.append(len(changed(spark, cells.root, k)))
    latest = {}
    for rows in batches:
        for i, time, updated, lat, lon in sorted(rows, key=lambda r: r[2]):
            if i not in latest or updated >= latest[i][1]:
                latest[i] = (time, updated, int(lat))
    newest, want = max(t for t, _, _ in latest.values()), {}
    for time, _, lat in latest.values():
        want[lat] = want.get(lat, 0) + 0.5 ** ((newest - time).days / 3)
    got = {r.cell_lat_floor: r.decayed for r in streams.decay_state(spark, str(tmp_path), 3, 8).collect()}
    assert got == pytest.approx(want) and max(touched) <= 3
    streams.decay_batch(events, cells, make([("late", at(40), at(40), 1.5, 2.5)]), 20, 3, CFG, keep_days=5)
    bucket = events.touched(spark.createDataFrame([("late",)], "id string"))
    assert [r.id for r in events.read(buckets=bucket).collect()] == ["late"]


def test_stream_dedupe_drops_resent_events(spark, tmp_path, landing):
    stream, rows = landing
    root = str(tmp_path / "out")
    streams.run_available(streams.drop_resent(stream, "60 days"), str(tmp_path / "cp")).format(
        "parquet").start(root).awaitTermination()
    assert spark.read.parquet(root).count() == rows.select("id").distinct().count()


def test_stream_decay_equals_batch(spark, tmp_path, landing):
    stream, rows = landing
    root = str(tmp_path / "state")
    streams.decay_stream(stream, root, str(tmp_path / "cp"), 3, CFG).awaitTermination()
    sent = cleaning.keep_latest(rows)  # what was sent again or revised counts once
    day = F.unix_date(F.to_date("time"))
    last = sent.agg(F.max(day)).first()[0]
    expected = sent.groupBy(F.floor("latitude").cast("int").alias("cell_lat_floor"),
                            F.floor("longitude").cast("int").alias("cell_lon_floor")).agg(
        F.sum(F.pow(F.lit(0.5), (last - day) / 3.0)).alias("y"))
    both = streams.decay_state(spark, root, 3).join(expected, ["cell_lat_floor", "cell_lon_floor"], "full")
    assert both.where("decayed is null or y is null or abs(decayed - y) > 1e-9").count() == 0


def test_stream_counts_are_complete_days(spark, tmp_path, landing):
    stream, rows = landing
    root = str(tmp_path / "counts")
    counts = streams.cell_day_stream(stream, "40 days", CFG)
    streams.run_available(counts, str(tmp_path / "cp")).format("parquet").start(
        root).awaitTermination()
    # nothing is 40 days old yet, so no day is complete
    assert spark.read.schema("day date, n long").parquet(root).count() == 0
