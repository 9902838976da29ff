"""Small literal tables with answers worked out by hand."""

import datetime as dt
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tremorgrid.config import HazardConfig
from tremorgrid.functions import scalar as fn
from tremorgrid.operators import boosting, cleaning, grid, metrics, rolling, splits
from tremorgrid.operators.imputation import fit_imputation
from tremorgrid.plans import features, forecast
from tremorgrid.sources import catalog as feed

START = dt.datetime(2024, 1, 1, 12)


def events(spark, rows):
    """rows: (day offset, lat, lon, mag)"""
    data = [(k, START + dt.timedelta(days=d), float(lat), float(lon), float(m))
            for k, (d, lat, lon, m) in enumerate(rows)]
    return spark.createDataFrame(
        data, "id long, time timestamp, latitude double, longitude double, mag double")


@pytest.fixture(scope="module")
def three_cells(spark):
    rows = [(d, 10.5, 20.5, 2.0) for d in range(50)]
    rows += [(d, 5.5, 5.5, 2.0) for d in (0, 10, 20)] + [(0, -5.5, -5.5, 2.0)]
    return events(spark, rows).cache()


@pytest.mark.parametrize("minimum,cells", [(2, {(10, 20), (5, 5)}), (50, {(10, 20)})])
def test_active_cells(three_cells, minimum, cells):
    cfg = HazardConfig(min_events_per_cell=minimum)
    found = grid.active_cells(three_cells, cfg).collect()
    assert {(r.cell_lat_floor, r.cell_lon_floor) for r in found} == cells


def test_lookback_gives_rows_per_cell(three_cells):
    cfg = HazardConfig(min_events_per_cell=2)
    rows = features.snapshot(three_cells, cfg, lookback=5).groupBy("cell_lat").count().collect()
    assert {r[0]: r[1] for r in rows} == {10.5: 5, 5.5: 5}


def test_negative_coordinates_floor(spark):
    df = events(spark, [(0, -0.5, -1.0, 2.0)])
    row = grid.with_cells(df, HazardConfig()).first()
    assert (row.cell_lat_floor, row.cell_lon_floor) == (-1, -1)


def test_upsert_newest_wins_and_is_idempotent(spark):
    schema = "id string, updated timestamp, mag double"
    t = lambda h: dt.datetime(2024, 1, 1, h)
    old = spark.createDataFrame([("a", t(1), 1.0), ("b", t(5), 2.0), ("c", t(1), 3.0)], schema)
    new = spark.createDataFrame(
        [("a", t(2), 1.5), ("b", t(4), 9.0), ("c", None, 3.3), ("b", t(5), 2.2)], schema)
    once = cleaning.upsert(old, [new])
    got = {r.id: r.mag for r in once.collect()}
    # newer revision, older revision ignored / equal time: later arrival, missing time wins
    assert got == {"a": 1.5, "b": 2.2, "c": 3.3}
    assert {r.id: r.mag for r in cleaning.upsert(once, [new]).collect()} == got


def test_missing_ids_form_one_group(spark):
    rows = [(None, dt.datetime(2024, 1, 1, h), float(h)) for h in range(4)]
    df = spark.createDataFrame(rows, "id string, updated timestamp, mag double")
    assert [r.mag for r in cleaning.keep_latest(df).collect()] == [3.0]


def test_lenient_types(spark):
    raw = spark.createDataFrame(
        [("2024-01-01T00:00:00.123Z", "x", "1.5", ""), ("never", "2024-01-02", "NaN", "ml")],
        "time string, updated string, mag string, magType string")
    a, b = cleaning.coerce_types(raw).orderBy("mag").collect()[::-1]
    assert a.time == dt.datetime(2024, 1, 1, 0, 0, 0, 123000) and a.updated is None
    assert (a.mag, a.magType, b.time, b.mag, b.magType) == (1.5, None, None, None, "ml")


def test_completeness_magnitude(spark):
    df = events(spark, [(0, 1, 1, 1.24), (1, 1, 1, 1.26), (2, 1, 1, 1.26), (3, 1, 1, 2.0)])
    assert grid.completeness_magnitude(df, HazardConfig()).first().mc_cell == 13 * 0.1 + 0.2


def test_completeness_tie_goes_to_first_seen(spark):
    df = events(spark, [(0, 1, 1, 3.0), (1, 1, 1, 2.0), (2, 1, 1, 2.0), (3, 1, 1, 3.0)])
    assert grid.completeness_magnitude(df, HazardConfig()).first().modal_bin == 30


def test_qualifying_counts_match_plain_comparison(spark):
    mags = [2.0, 2.0, 2.0, 2.1, 2.19, 2.2, 2.2000000000000001, 2.21, 2.24, 2.26, 2.3, 2.9]
    df = events(spark, [(k % 3, 1, 1, m) for k, m in enumerate(mags)])
    cfg = HazardConfig()
    mc = grid.completeness_magnitude(df, cfg).first().mc_cell
    got = grid.cell_days(df, cfg).agg(F.sum("qual_count"), F.sum("qual_summag")).first()
    kept = [m for m in mags if m >= mc]
    assert got[0] == len(kept) and got[1] == pytest.approx(sum(kept))


def test_decay_by_hand(spark):
    df = spark.createDataFrame([(1, d, x) for d, x in enumerate([1.0, 0.0, 0.0, 4.0])],
                               "c int, d int, x double")
    rows = rolling.decayed_sums(df, ["c"], "d", {"y": ("x", 3)}).orderBy("d").collect()
    assert [round(r.y, 4) for r in rows] == [1.0, 0.7937, 0.63, 4.5]


def test_neighbours_exclude_self_and_distant(spark):
    df = events(spark, [(0, 0.5, 0.5, 2), (0, 0.5, 1.5, 2), (0, 1.5, 1.5, 2), (0, 2.5, 2.5, 2)])
    days = grid.with_neighbors(grid.cell_days(df, HazardConfig()))
    row = days.where("cell_lat_floor = 0 and cell_lon_floor = 0").first()
    assert (row.n, row.nbr_n) == (1, 2)


def test_no_wrap_at_the_antimeridian(spark):
    df = events(spark, [(0, 0.5, 179.5, 2), (0, 0.5, -179.5, 2)])
    days = grid.with_neighbors(grid.cell_days(df, HazardConfig())).where("cell_n is not null")
    assert [r.nbr_n for r in days.collect()] == [0, 0]


def test_labels(spark):
    rows = [(d, 1, 1, 5.0 if d == 4 else 2.0) for d in range(10)]
    cfg = HazardConfig(min_events_per_cell=1, warmup_events=1)
    got = features.feature_matrix(events(spark, rows), cfg).collect()
    first = dt.date(2024, 1, 1)
    assert {(r.day - first).days for r in got} == {0, 1, 2}
    for r in got:
        t = (r.day - first).days
        assert r.target == int(t < 4 <= t + r.horizon_day)


def test_horizon_expansion_keeps_rows(spark):
    df = spark.createDataFrame([(1.5, 2.5, 10.0), (3.5, 4.5, 20.0)], "a double, b double, x double")
    out = features.expand_horizons(df, HazardConfig())
    assert out.count() == 14
    for h in range(1, 8):
        assert sorted(out.where(F.col("horizon_day") == h).drop("horizon_day").collect()) == \
            sorted(df.collect())


def test_magnitude_readout(spark):
    df = spark.createDataFrame([(1, 1.0, 0.5), (2, None, 0.8), (3, None, None)],
                               "k int, b_value_90d double, b_value_365d double")
    rows = forecast.with_magnitudes(df, HazardConfig()).orderBy("k").collect()
    assert [round(r.mag_severe, 6) for r in rows] == [5.5, 5.75, 5.5]
    assert rows[0].mag_likely == pytest.approx(4.80103, abs=1e-6)
    assert all(r.mag_severe >= r.mag_likely >= 4.5 for r in rows)


def test_exceedance_inverts_quantile(spark):
    row = spark.range(1).select(fn.exceedance_prob(
        F.lit(0.9), F.lit(4.5), fn.magnitude_quantile(F.lit(0.9), 4.5, 0.2)).alias("p")).first()
    assert row.p == pytest.approx(0.2)


def test_alert_threshold_is_strict(spark):
    df = spark.createDataFrame([(None,), (0.1,), (0.3,), (0.9,)], "p double")
    assert [r.p for r in forecast.alerts(df, "p").collect()] == [0.9]


def test_risk_scale(spark):
    df = spark.createDataFrame([(p,) for p in (-5.0, 0.0, 0.3, 0.5, 1.0, 1.5)], "p double")
    rows = df.select(fn.risk_color(F.col("p"), 0.3).alias("c"),
                     fn.risk_radius(F.col("p"), 0.3).alias("r")).collect()
    assert [r.c for r in rows[:3]] == ["rgb(145,207,96)"] * 3
    assert [r.c for r in rows[4:]] == ["rgb(215,48,39)"] * 2
    assert rows[3].c not in (rows[0].c, rows[5].c)
    assert [r.r for r in rows] == pytest.approx([5, 5, 5, 5 + 9 * 0.2 / 0.7, 14, 14])


def test_horizon_is_clamped(spark):
    df = features.expand_horizons(spark.createDataFrame([(dt.date(2024, 1, 1),)], "asof_date date"))
    low, high = (forecast.horizon_slice(df, h).collect() for h in (-3, 99))
    assert low[0].horizon_end == dt.date(2024, 1, 2) and high[0].horizon_end == dt.date(2024, 1, 8)


def test_imputation(spark):
    df = spark.createDataFrame(
        [(1.0, None, None), (2.0, 5.0, None), (3.0, 7.0, None), (10.0, None, None)],
        "a double, b double, c double")
    fitted = fit_imputation(df)
    assert fitted.medians == {"a": 2.5, "b": 6.0}
    assert fitted.feature_columns == ["a", "b", "c", "b_missing", "c_missing"]
    rows = fitted.transform(df).orderBy("a").collect()
    assert (rows[0].b, rows[0].b_missing, rows[0].c, rows[0].c_missing) == (6.0, 1, 0.0, 1)
    assert (rows[1].b, rows[1].b_missing) == (5.0, 0)


def test_scores(spark):
    pairs = [(0, .95), (1, .9), (0, .8), (1, .7), (1, .4), (0, .35), (0, .3), (1, .1), (0, .1)]
    df = spark.createDataFrame(pairs, "target int, proba double").withColumn("model", F.lit("m"))
    row = metrics.rank_metrics(metrics.score_table(df, ["model"]), ["model"]).first()
    assert row.roc_auc == pytest.approx(0.525) and row.pr_auc == pytest.approx(0.511111, abs=1e-6)


def test_single_class_has_no_rank_metrics(spark):
    df = spark.createDataFrame([(0, .9), (0, .1)], "target int, proba double").withColumn(
        "model", F.lit("m"))
    row = metrics.by_group(df, ["model"]).first()
    assert row.roc_auc is None and row.pr_auc is None and row.brier == pytest.approx(0.41)


def test_split_bounds(spark):
    first = dt.date(2025, 1, 1)
    days = spark.range(629).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("day"))
    bounds = splits.split_bounds(days, HazardConfig()).first()
    assert [(b - first).days for b in bounds] == [439, 447, 533, 541]
    assert bounds.train_last == dt.date(2026, 3, 16) and bounds.test_first == dt.date(2026, 6, 26)


def test_fold_ranges():
    assert splits.fold_ranges(1_027_922, 16_353, 5) == [
        (154969, 171322, 342642), (326289, 342642, 513962), (497609, 513962, 685282),
        (668929, 685282, 856602), (840249, 856602, 1027922)]


def test_leak_check_fails_the_job(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 5), 7)], "day date, horizon_day int")
    assert splits.assert_leak_free(df, F.lit(dt.date(2024, 1, 12))).count() == 1
    with pytest.raises(PySparkException):
        splits.assert_leak_free(df, F.lit(dt.date(2024, 1, 11))).collect()


def test_schema_check():
    boosting.check_schema(["a", "b"], ["b", "a"])
    with pytest.raises(ValueError, match="different runs"):
        boosting.check_schema(["a", "b"], ["a", "c"])


def test_resume_window(spark):
    df = events(spark, [(0, 1, 1, 2), (3, 1, 1, 2)])
    row = feed.incremental_window(df, HazardConfig(), end=dt.datetime(2024, 1, 5)).first()
    assert row.start == START + dt.timedelta(days=3, minutes=-60)
    assert feed.incremental_window(df, HazardConfig(), end=START).count() == 0
    with pytest.raises(PySparkException):
        feed.incremental_window(df.limit(0), HazardConfig(), end=START).collect()


def test_recent_significant(spark):
    df = events(spark, [(0, 1, 1, 5), (9, 1, 1, 5), (10, 1, 1, 4), (10, 1, 1, 6)]).withColumn(
        "depth", F.lit(1.0))
    got = feed.recent_significant(df, days=1, min_mag=4.5).collect()
    assert [r.mag for r in got] == [6.0, 5.0]


def test_parse_instant(spark):
    df = spark.createDataFrame([("2024-01-02",), ("2024-01-02T03:04:05",), ("no",)], "t string")
    got = [r[0] for r in df.select(fn.parse_instant(F.col("t"))).collect()]
    assert got == [dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5), None]


def test_b_value_gate(spark):
    df = spark.createDataFrame([(9.0, 27.0), (10.0, 30.0)], "n double, s double")
    got = [r[0] for r in df.select(rolling.b_value(
        F.col("n"), F.col("s"), F.lit(2.5), HazardConfig())).collect()]
    assert got[0] is None and got[1] == pytest.approx(math.log10(math.e) / (3.0 - 2.45))
