"""Reading event catalogs: text feeds, typed tables, time ranges, fetch plans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tremorgrid.config import HazardConfig
from tremorgrid.session import materialize

# Columns of the public event feed's CSV export, in its order.
FEED_COLUMNS = (
    "time", "latitude", "longitude", "depth", "mag", "magType", "nst", "gap", "dmin", "rms",
    "net", "id", "updated", "place", "type", "horizontalError", "depthError", "magError",
    "magNst", "status", "locationSource", "magSource",
)


def text_schema(columns: tuple[str, ...] = FEED_COLUMNS) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_feed(spark: SparkSession, path: str, columns: tuple[str, ...] = FEED_COLUMNS) -> DataFrame:
    """A CSV feed with every column as text; empty fields are NULL."""
    return (spark.read.schema(text_schema(columns))
            .option("header", True).option("enforceSchema", False).csv(path))


def read_range(catalog: DataFrame, start=None, end=None, min_mag: float | None = None,
               max_mag: float | None = None, event_type: str | None = None) -> DataFrame:
    """Rows within the given bounds (both ends included); absent bounds add no filter."""
    conditions: list[Column] = []
    if start is not None:
        conditions.append(F.col("time") >= start)
    if end is not None:
        conditions.append(F.col("time") <= end)
    if min_mag is not None:
        conditions.append(F.col("mag") >= min_mag)
    if max_mag is not None:
        conditions.append(F.col("mag") <= max_mag)
    if event_type:
        conditions.append(F.col("type") == event_type)
    for condition in conditions:
        catalog = catalog.where(condition)
    return catalog


def incremental_window(catalog: DataFrame, cfg: HazardConfig, start=None, end=None) -> DataFrame:
    """The (start, end) to fetch next, as one row; none if nothing is due.

    Without a start the fetch resumes a little before the newest event, so
    that late revisions near the old boundary are read again.
    """
    overlap = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(cfg.overlap_minutes))
    resume = F.max("time") - overlap
    until = F.lit(end) if end is not None else F.current_timestamp()
    window = catalog.agg((F.lit(start) if start is not None else resume).alias("start"))
    checked = F.when(F.col("start").isNull(),
                     F.raise_error(F.lit("no start given and no event to resume from")))
    return window.select(F.coalesce(F.col("start"), checked).alias("start"), until.alias("end")
                         ).where(F.col("start") < F.col("end"))


#: Halvings counted in one pass over the events; pieces that are still too big are halved one by one.
FIRST_LEVELS = 20


def plan_time_chunks(events: DataFrame, start, end, cap: int) -> DataFrame:
    """Split [start, end) by halving until each piece holds at most ``cap`` events.

    Events are counted once, in pieces of 2^-20 of the range; counts of the
    coarser ones are sums of those. A piece is kept if it fits and its parent
    does not. Empty pieces are left out. Events of pieces that are too big even
    then, and no others, are halved on, down to single microseconds. One instant
    with more than ``cap`` events raises at once: a fetch by any plan would be cut
    off at the source.
    """
    micros = F.unix_micros(F.col("time").cast("timestamp"))
    first, last = (F.unix_micros(F.lit(x).cast("timestamp")) for x in (start, end))
    low, high = events.sparkSession.range(1).select(first, last).first()
    width = max(1, -(-(high - low) >> FIRST_LEVELS))
    inside = events.select(micros.alias("at")).where(F.col("at").between(low, high - 1))
    fine = inside.groupBy(F.expr(f"(at - {low}L) div {width}L").alias("piece")).agg(F.count(F.lit(1)).alias("n"))
    nodes = fine.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(FIRST_LEVELS)))).groupBy(
        "level", F.expr(f"shiftright(piece, {FIRST_LEVELS} - level)").alias("node")).agg(F.sum("n").alias("rows"))
    siblings = Window.partitionBy("level", F.shiftright("node", 1))
    fits_alone = (F.col("rows") <= cap) | (F.col("level") == FIRST_LEVELS)
    parent_too_big = (F.sum("rows").over(siblings) > cap) | (F.col("level") == 0)
    size = F.expr(f"shiftleft({width}L, {FIRST_LEVELS} - level)")
    kept = materialize(nodes.withColumn("keep", fits_alone & parent_too_big).where("keep").select(
        "level", "node", "rows", (F.lit(low) + F.col("node") * size).alias("begin"), size.alias("size")), "chunks")
    done = [kept.where(F.col("rows") <= cap)]
    big = kept.where(F.col("rows") > cap)
    while not big.isEmpty():
        stuck = big.where("size = 1").orderBy("begin").select("begin", "rows").first()
        if stuck is not None:
            raise ValueError(f"more than {cap} events in one instant: {stuck['rows']} in microsecond {stuck['begin']}")
        if len(done) == 1:  # the events of the big pieces, found by their number
            numbered = inside.withColumn("node", F.expr(f"(at - {low}L) div {width}L"))
            held = numbered.join(big, "node").select("at", "level", "node", "begin", "size")
        else:
            held = held.join(big.select("level", "node"), ["level", "node"], "left_semi")
        half = F.shiftright(F.col("size") + 1, 1)
        later = (F.col("at") >= F.col("begin") + half).cast("long")
        held = materialize(held.select("at", (F.col("level") + 1).alias("level"), (F.col("node") * 2 + later).alias("node"),
                                       (F.col("begin") + later * half).alias("begin"), F.when(later == 1, F.col("size") - half).otherwise(half).alias("size")), "chunks-held")
        split = materialize(held.groupBy("level", "node", "begin", "size").agg(F.count(F.lit(1)).alias("rows")).select(kept.columns), "chunks")
        done.append(split.where(F.col("rows") <= cap))
        big = split.where(F.col("rows") > cap)
    return reduce(DataFrame.unionByName, done).select(
        "level", "node", "rows", F.timestamp_micros("begin").alias("start"),
        F.timestamp_micros(F.least(F.col("begin") + F.col("size"), F.lit(high))).alias("end"))


def recent_significant(catalog: DataFrame, days: int = 30, min_mag: float = 4.5) -> DataFrame:
    """Events of the last ``days`` before the newest event, newest first."""
    since = catalog.agg(F.max("time") - F.make_dt_interval(F.lit(days))).scalar()
    columns = [c for c in ("latitude", "longitude", "depth", "mag", "place") if c in catalog.columns]
    return catalog.where((F.col("time") >= since) & (F.col("mag") >= min_mag)).orderBy(
        F.desc("time")
    ).select(F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("time"), *columns)
