"""Missing groups and scores, refused writes, plans that cannot be kept."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tremorgrid.operators import metrics
from tremorgrid.operators.ordered import sample_exactly
from tremorgrid.session import materialize
from tremorgrid.sources.catalog import plan_time_chunks
from tremorgrid.sources.tables import TableStore

ROWS = [(None, 1, 0.9), (None, 0, 0.2), ("a", 1, 0.8), ("a", 0, 0.4), ("a", 1, None), ("a", 0, float("nan")), ("b", 1, None)]


def scored(spark):
    return spark.createDataFrame(ROWS, "model string, target int, proba double")


def test_null_groups_are_kept_and_missing_scores_left_out(spark):
    got = {r.model: r for r in metrics.by_group(scored(spark), ["model"]).collect()}
    assert set(got) == {None, "a"}
    assert got[None].n == 2 and got[None].roc_auc == 1.0
    assert got["a"].n == 2 and got["a"].positives == 1 and got["a"].roc_auc == 1.0
    assert {r.model: r.n for r in metrics.threshold_metrics(scored(spark), ["model"]).collect()} == {None: 2, "a": 2}
    table = metrics.score_table(scored(spark), ["model"])
    assert table.where("model is null").count() == 2
    assert metrics.calibration(scored(spark), ["model"], 2).where("model is null").count() == 2


def test_sample_has_the_asked_size(spark):
    rows = spark.range(5000).withColumn("x", F.col("id") * 2)
    for n in (0, 1, 17, 4999, 5000, 9000):
        got = sample_exactly(rows, n, "id", 3)
        assert got.columns == rows.columns and got.select("id").distinct().count() == got.count() == min(n, 5000)
    assert sorted(sample_exactly(rows, 50, "id", 3).collect()) == sorted(sample_exactly(rows.repartition(9), 50, "id", 3).collect())


def test_chunk_plan_raises_when_a_piece_stays_too_big(spark):
    day = dt.datetime(2024, 1, 1)
    rows = spark.createDataFrame([(day,)] * 5 + [(day + dt.timedelta(days=1),)], "time timestamp")
    end = day + dt.timedelta(days=2)
    assert sum(r.rows for r in plan_time_chunks(rows, day, end, 5).collect()) == 6
    with pytest.raises(ValueError, match="more than 4 events"):  # whatever columns are read of the plan
        plan_time_chunks(rows, day, end, 4)


def test_chunk_plan_halves_dense_pieces_down_to_single_instants(spark):
    day = dt.datetime(2024, 1, 1)
    offsets = [0, 1, 2, 3, 5, 8, 13, 13, 40, 1_000_000, 86_400_000_000 - 1]
    rows = spark.createDataFrame([(day + dt.timedelta(microseconds=o),) for o in offsets], "time timestamp")
    plan = plan_time_chunks(rows, day, day + dt.timedelta(days=1), 2).orderBy("start").collect()
    spans = [((r.start - day) // dt.timedelta(microseconds=1), (r.end - day) // dt.timedelta(microseconds=1), r.rows) for r in plan]
    assert all(n == sum(a <= o < b for o in offsets) <= 2 for a, b, n in spans) and sum(n for *_, n in spans) == len(offsets)
    assert all(b <= c for (_, b, _), (c, *_) in zip(spans, spans[1:])) and max(r.level for r in plan) > 20
    assert plan_time_chunks(rows, day, day, 2).count() == 0


def test_published_runs_are_not_overwritten_and_can_be_rolled_back(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}")
    days = spark.range(60).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day"), "id").repartition(16)
    for run, rows in (("run-1", days), ("run-2", days.where("id < 10"))):
        store.publish(run, {"t": store.write(rows, "t", run, month_of="day", sort_by=["day"])})
    assert store.read("t").count() == 10
    assert len(list(tmp_path.glob("t/run_id=run-1/month=*/part-*"))) <= 6
    with pytest.raises(FileExistsError):
        store.write(days, "t", "run-1")
    with pytest.raises(FileExistsError):
        store.write_report(days, "t", "run-2")
    store.publish("run-1-again", {"t": store.path("t", "run-1")})  # back to the earlier version
    assert store.read("t").count() == 60


def test_shared_folder_is_needed_off_local(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        conf = {}
        sparkContext = Context()

    from tremorgrid.session import shared_dir

    with pytest.raises(RuntimeError, match="shared folder"):
        shared_dir(Session())
    assert materialize(spark.range(3), "t").count() == 3


@pytest.mark.parametrize("values", ["pow(id, 9)", "0.001 + id / 1e9", "if(id = 7, double('inf'), id * 1.0)"])
def test_buckets_stay_even_whatever_the_values(spark, values):
    from tremorgrid.operators.ordered import even_buckets, ordered_counts

    rows = spark.range(4000).selectExpr("'g' as g", f"cast({values} as double) as x")
    placed, bucket = even_buckets(rows, ["g"], "x")
    assert placed.groupBy(bucket).count().agg(F.max("count")).first()[0] < 4 * 4000 / 128
    got = [r.cum_n for r in ordered_counts(rows, ["g"], "x").orderBy("x").collect()]
    assert got == list(range(1, 4001))
