"""Continuous versions of the upsert, the cell-day counts and the decayed counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tremorgrid.config import HazardConfig
from tremorgrid.functions import scalar as fn
from tremorgrid.operators.cleaning import keep_latest
from tremorgrid.operators.grid import CELL, with_cells
from tremorgrid.session import materialize, scratch_scope
from tremorgrid.streaming.buckets import BucketedTable


FADED = 1e-12  # a decayed count below this is nothing


def run_available(stream: DataFrame, checkpoint: str, **options) -> StreamingQuery:
    """A writer that works through what has arrived and stops."""
    return (stream.writeStream.option("checkpointLocation", checkpoint)
            .options(**options).trigger(availableNow=True))


def drop_resent(events: DataFrame, lateness: str = "60 minutes") -> DataFrame:
    """Drop events sent again within the allowed lateness (first arrival stays)."""
    return events.withWatermark("time", lateness).dropDuplicatesWithinWatermark(["id"])


def catalog_table(spark: SparkSession, root: str, schema: T.StructType, buckets: int = 64) -> BucketedTable:
    return BucketedTable(spark, f"{root}/catalog", schema, ["id"], buckets)


def merge_batch(table: BucketedTable, batch: DataFrame, batch_id: int) -> None:
    """The latest revision of every event; only buckets with an event of the batch are read and written."""
    fresh = materialize(keep_latest(batch).select(*table.schema.names), "batch")
    touched = table.touched(fresh)
    old = table.read(batch_id, touched)
    both = old.withColumn("_arrival", F.lit(0)).unionByName(fresh.withColumn("_arrival", F.lit(1)))
    table.replace(keep_latest(both, arrival="_arrival").drop("_arrival"), touched, batch_id)


def upsert_stream(events: DataFrame, root: str, checkpoint: str, buckets: int = 64) -> StreamingQuery:
    """Merge each batch of new and revised events into the catalog under ``root``.

    A batch that is run again starts from its predecessor's catalog, so every
    event counts once. Files no longer used go after each batch.
    """
    schema = events.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        table = catalog_table(batch.sparkSession, root, schema, buckets)
        with scratch_scope(batch.sparkSession):
            merge_batch(table, batch, batch_id)
        table.vacuum()

    return run_available(events, checkpoint).foreachBatch(write).start()


def current_catalog(spark: SparkSession, root: str, schema: T.StructType, buckets: int = 64) -> DataFrame:
    """Latest revision of every event received so far; later batches win ties."""
    return catalog_table(spark, root, schema, buckets).read()


def cell_day_stream(events: DataFrame, lateness: str, cfg: HazardConfig = HazardConfig()) -> DataFrame:
    """Event counts and largest magnitude per cell and day; a day is emitted once
    it is complete, that is when the watermark has passed its end."""
    timed = with_cells(events, cfg).withWatermark("time", lateness)
    return timed.groupBy(F.window("time", "1 day"), *CELL).agg(
        F.count(F.lit(1)).alias("n"), F.max("mag").alias("max_mag"),
    ).select(F.to_date("window.start").alias("day"), *CELL, "n", "max_mag")


def decay_tables(spark: SparkSession, root: str, buckets: int = 64) -> tuple[BucketedTable, BucketedTable]:
    """(last contribution of each event, decayed count of each cell as of its newest event)."""
    events = T.StructType.fromDDL("id string, updated timestamp, cell_lat_floor int, cell_lon_floor int, day int")
    cells = T.StructType.fromDDL("cell_lat_floor int, cell_lon_floor int, as_of int, decayed double")
    return (BucketedTable(spark, f"{root}/contributions", events, ["id"], buckets),
            BucketedTable(spark, f"{root}/cells", cells, list(CELL), buckets))


def decay_batch(events: BucketedTable, cells: BucketedTable, batch: DataFrame, batch_id: int, half_life: int,
                cfg: HazardConfig, keep_days: int | None = None) -> None:
    """Change the decayed counts of the cells that a batch touches.

    Decay is linear: an event adds its share, and one that is sent again or
    revised first takes the share of its earlier version away, which its last
    contribution tells. Both tables are read and written in the touched buckets
    only. Contributions more than ``keep_days`` older than the batch's newest
    event go when their bucket is written; a later revision of such an event
    counts as a new one.
    """
    located = with_cells(batch, cfg).select(
        F.col("id").cast("string").alias("id"), F.col("updated").cast("timestamp").alias("updated"),
        *[F.col(c).cast("int").alias(c) for c in CELL], fn.day_number(F.col("time")).cast("int").alias("day"))
    fresh = materialize(keep_latest(located), "batch")
    touched = events.touched(fresh)
    old = events.read(batch_id, touched)
    merged = keep_latest(old.withColumn("_arrival", F.lit(0)).unionByName(fresh.withColumn("_arrival", F.lit(1))), arrival="_arrival")
    merged = materialize(merged, "merged")
    before = events.of_keys(fresh, touched, batch_id).withColumn("share", F.lit(-1.0))
    after = merged.join(fresh.select("id").distinct(), "id", "left_semi").withColumn("share", F.lit(1.0))
    changes = materialize(before.unionByName(after.drop("_arrival")).where("day is not null").select(*CELL, F.col("day").alias("as_of"), F.col("share").alias("decayed")), "changes")
    moved = cells.touched(changes)
    rows = cells.read(batch_id, moved).unionByName(changes.select(*cells.schema.names))
    newest = rows.groupBy(*CELL).agg(F.max("as_of").alias("newest"))
    weight = fn.decay_weight(F.col("newest") - F.col("as_of"), half_life)
    sums = rows.join(newest, CELL).groupBy(*CELL, F.col("newest").alias("as_of")).agg(F.sum(F.col("decayed") * weight).alias("decayed"))
    kept = merged.drop("_arrival")
    if keep_days is not None:
        kept = kept.where(F.col("day") >= fresh.agg(F.max("day")).scalar() - keep_days)
    cells.replace(sums.where(F.col("decayed") > FADED), moved, batch_id)
    events.replace(kept, touched, batch_id)


def decay_stream(events: DataFrame, root: str, checkpoint: str, half_life: int,
                 cfg: HazardConfig = HazardConfig(), buckets: int = 64, keep_days: int | None = None) -> StreamingQuery:
    """Keep each cell's decayed event count up to date, batch by batch (``decay_batch``)."""

    def update(batch: DataFrame, batch_id: int) -> None:
        tables = decay_tables(batch.sparkSession, root, buckets)
        with scratch_scope(batch.sparkSession):
            decay_batch(*tables, batch, batch_id, half_life, cfg, keep_days)
        for table in tables:
            table.vacuum()

    return run_available(events, checkpoint).foreachBatch(update).start()


def decay_state(spark: SparkSession, root: str, half_life: int, buckets: int = 64) -> DataFrame:
    """Decayed count of every cell as of the newest day of all cells."""
    rows = decay_tables(spark, root, buckets)[1].read()
    newest = rows.agg(F.max("as_of")).scalar()
    weight = fn.decay_weight(newest - F.col("as_of"), half_life)
    return rows.withColumn("decayed", F.col("decayed") * weight).withColumn("as_of", newest).where(F.col("decayed") > FADED)
