"""Properties that hold whatever the data, on generated and given tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tremorgrid.config import HazardConfig
from tremorgrid.operators import cleaning, grid, metrics, ordered, rolling, splits
from tremorgrid.plans import backtest, features
from tremorgrid.sources import catalog as feed
from tremorgrid.sources import views

SF = "/root/testdata/sf0.001"
CFG = HazardConfig(mag_threshold=3.5, min_events_per_cell=10)


@pytest.fixture(scope="module")
def clean(spark):
    return cleaning.clean_catalog(views.catalog_events(spark, SF), CFG).cache()


@pytest.fixture(scope="module")
def matrix(spark, clean):
    return features.feature_matrix(clean, CFG).cache()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("half_life,days,step", [(3, 6000, 1), (10, 3000, 7), (1, 2500, 40)])
def test_decay_equals_the_recursion(spark, half_life, days, step):
    rng = random.Random(half_life)
    x = {d: rng.choice([1.0, 1e12, 1e17]) for d in range(9000, 9000 + days, step)}
    df = spark.createDataFrame([("c", d, v) for d, v in x.items()], "c string, d int, x double")
    got = {r.d: r.y for r in rolling.decayed_sums(df, ["c"], "d", {"y": ("x", half_life)}).collect()}
    y = 0.0
    for d in range(9000, 9000 + days):
        y = x.get(d, 0.0) + 0.5 ** (1 / half_life) * y
        if d in x:
            assert got[d] == pytest.approx(y, rel=1e-9)


def test_rolling_features_against_numpy(spark):
    rng = np.random.default_rng(7)
    day = np.sort(rng.integers(0, 500, 300))
    mag = np.round(rng.exponential(0.5, 300) + 2, 1)
    rows = [(k, int(d), float(m)) for k, (d, m) in enumerate(zip(day, mag))]
    df = spark.createDataFrame(rows, "id long, d int, mag double").select(
        "id", F.timestamp_seconds(F.col("d") * 86400 + 5).alias("time"),
        F.lit(1.5).alias("latitude"), F.lit(1.5).alias("longitude"), "mag")
    cfg = HazardConfig(min_events_per_cell=1, warmup_events=1)
    for r in features.cell_day_features(df, cfg).collect():
        t = (r.day - __import__("datetime").date(1970, 1, 1)).days
        for w in cfg.count_windows:
            inside = mag[(day <= t) & (day > t - w)]
            assert r[f"rolling_count_{w}d"] == len(inside)
            if len(inside):
                assert r[f"rolling_max_mag_{w}d"] == inside.max()
                assert r[f"rolling_mean_mag_{w}d"] == pytest.approx(inside.mean())
            else:
                assert r[f"rolling_max_mag_{w}d"] is None and r[f"rolling_mean_mag_{w}d"] is None
            energy = np.log10(np.sum(10 ** (1.5 * inside + 4.8)) + 1)
            assert r[f"log_energy_{w}d"] == pytest.approx(energy, abs=1e-9)


def test_snapshot_equals_the_series(spark, clean):
    snap = features.snapshot(clean, CFG, lookback=3)
    series = features.cell_day_features(clean, CFG)
    keys, names = ["day", "cell_lat", "cell_lon"], features.feature_columns(CFG)
    both = snap.join(series.select(*keys, *[F.col(c).alias(f"s_{c}") for c in names]), keys)
    assert snap.count() == both.count() == 3 * grid.active_cells(clean, CFG).count()
    off = [F.coalesce(F.abs(F.col(c) - F.col(f"s_{c}")) > 1e-9,
                      F.col(c).isNull() != F.col(f"s_{c}").isNull()) for c in names]
    wrong = both.agg(*[F.count_if(o).alias(c) for c, o in zip(names, off)]).first()
    assert not any(wrong)


def test_labels_grow_with_the_horizon(matrix):
    keys = ["day", "cell_lat", "cell_lon"]
    runs = matrix.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("horizon_day", "target")))
                                     .alias("r"))
    bad = runs.where(F.exists(
        F.sequence(F.lit(0), F.lit(5)), lambda k: F.get("r", k)["target"] > F.get("r", k + 1)["target"]))
    assert bad.count() == 0


def test_matrix_does_not_depend_on_row_order_or_partitions(spark, clean, matrix):
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        other = features.feature_matrix(clean.orderBy(F.desc("id")).repartition(5), CFG)
        names = [c for c, t in matrix.dtypes if t == "double"]
        total = lambda df: [round(v, 4) for v in df.agg(*[
            F.coalesce(F.sum(F.round(c, 6)), F.lit(0.0)) for c in names]).first()]
        assert other.count() == matrix.count() and total(other) == pytest.approx(total(matrix))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_matrix_counts_and_columns(matrix):
    assert matrix.count() == 2226 and len(matrix.columns) == 35


def test_feature_plan_has_three_shuffles_and_one_scan(spark):
    catalog = spark.createDataFrame(
        [], "id long, time timestamp, latitude double, longitude double, mag double")
    plan = plan_of(features.feature_matrix(catalog, CFG, last_day=F.lit(20000)))
    assert plan.count("Exchange hashpartitioning") == 3
    assert plan.count("Scan") == 1 and "Join" not in plan and "SinglePartition" not in plan


def test_upsert_drops_rows_before_the_shuffle(spark, tmp_path):
    spark.range(100).selectExpr("id % 3 id", "current_timestamp() updated").write.parquet(
        str(tmp_path / "t"))
    plan = plan_of(cleaning.keep_latest(spark.read.parquet(str(tmp_path / "t"))))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_splits_are_disjoint_and_purged(spark):
    days = spark.range(100).select(F.date_add(F.lit("2024-01-01").cast("date"),
                                              F.col("id").cast("int")).alias("day"))
    spans = {r[0]: (r[1], r[2]) for r in splits.with_split(days, CFG).groupBy("split").agg(
        F.min("day"), F.max("day")).collect()}
    assert (spans["val"][0] - spans["train"][1]).days == 8
    assert (spans["test"][0] - spans["val"][1]).days == 8


def test_training_rows_never_look_past_the_cutoff(matrix):
    cutoff = F.lit("2024-01-14").cast("date")
    train = splits.training_rows(matrix, cutoff)
    assert train.count() > 0
    assert train.where(F.date_add("day", F.col("horizon_day")) > cutoff).count() == 0
    expected = matrix.where(F.date_add("day", F.col("horizon_day")) <= cutoff).count()
    assert train.count() == expected


def test_row_index_follows_the_order(matrix):
    rows = splits.indexed_rows(matrix).orderBy("row_index").collect()
    assert [r.row_index for r in rows] == list(range(len(rows)))
    keys = [(r.day, r.horizon_day, r.cell_lat, r.cell_lon) for r in rows]
    assert keys == sorted(keys)


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_quantiles_on_skewed_values(spark, seed):
    rng = np.random.default_rng(seed)
    values = np.concatenate([np.zeros(400), rng.lognormal(0, 4, 701)])
    df = spark.createDataFrame([(float(v), None if k % 3 else float(-v))
                                for k, v in enumerate(values)], "a double, b double")
    got = ordered.column_quantile(df, ["a", "b"])
    assert got["a"] == pytest.approx(np.median(values), rel=1e-12)
    assert got["b"] == pytest.approx(np.median(-values[::3]), rel=1e-12)
    long = df.select(F.lit("a").alias("g"), F.col("a").alias("v"))
    rows = ordered.quantiles_of(ordered.ordered_counts(long, ["g"], "v"), ["g"], "v",
                                [0.0, 0.1, 0.5, 0.9, 1.0]).collect()
    for r in rows:
        assert r.q == pytest.approx(np.quantile(values, r.prob), rel=1e-12, abs=1e-12)


def test_medians_stay_exact_when_the_sample_misleads(spark):
    df = spark.range(5000).select(F.col("id").cast("double").alias("a"))
    assert ordered.column_quantile(df, ["a"], sample_rows=3, margin=0.0) == {"a": 2499.5}


def test_auc_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400)
    p = np.round(np.clip(rng.normal(0.4 + 0.1 * y, 0.2), 0, 1), 2)
    df = spark.createDataFrame([(int(a), float(b), "m") for a, b in zip(y, p)],
                               "target int, proba double, model string")
    got = metrics.rank_metrics(metrics.score_table(df, ["model"]), ["model"]).first()
    pos, neg = p[y == 1], p[y == 0]
    wins = (pos[:, None] > neg[None, :]).mean() + 0.5 * (pos[:, None] == neg[None, :]).mean()
    assert got.roc_auc == pytest.approx(wins, rel=1e-12)


def test_sample_has_exactly_n_rows(clean):
    assert ordered.sample_exactly(clean, 37, "id", 42).count() == 37
    assert ordered.sample_exactly(clean, 10 ** 6, "id", 42).count() == clean.count()


def test_time_chunks_fit_and_cover(spark, clean):
    plan = feed.plan_time_chunks(clean, "2024-01-01 00:00:00", "2024-02-01 00:00:00", 60).orderBy(
        "start").collect()
    assert all(c.rows <= 60 for c in plan) and sum(c.rows for c in plan) == clean.count()
    assert all(a.end <= b.start for a, b in zip(plan, plan[1:]))


def test_top_cells_break_ties_in_grid_order(spark):
    rows = [("2024-01-01", 1, float(k % 4), float(k), 0, 0.5) for k in range(20)]
    df = spark.createDataFrame(
        rows, "cutoff string, horizon_day int, cell_lat double, cell_lon double, target int, proba double")
    top = backtest.top_cells(df, CFG).orderBy("rank").collect()
    keys = sorted((float(k % 4), float(k)) for k in range(20))[:10]
    assert [(r.cell_lat, r.cell_lon) for r in top] == keys


def test_cutoffs_are_reproducible_and_checked(matrix):
    cfg = CFG.with_(min_history_days=5, n_cutoffs=3)
    assert backtest.cutoff_list(matrix, cfg) == backtest.cutoff_list(matrix.repartition(7), cfg)
    with pytest.raises(ValueError, match="enough history"):
        backtest.cutoff_list(matrix, CFG)


def test_evaluation_uses_the_purged_test_split(spark):
    import __spark_entry__  # noqa: F401
    from workload import models

    test = models.trained(spark, "/root/testdata/sf0.001")[2]
    got = models.test_evaluation(spark, "/root/testdata/sf0.001").collect()
    want = {r.horizon_day: r["count"] for r in test.groupBy("horizon_day").count().collect()}
    assert len(got) == 3 and all({h.horizon_day: h.n for h in r.by_horizon} == want for r in got)
