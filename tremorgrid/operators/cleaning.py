"""Typing, upsert and rule-based cleaning of event catalogs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tremorgrid.config import HazardConfig

NUMERIC_COLUMNS = (
    "latitude", "longitude", "depth", "mag", "nst", "gap", "dmin", "rms",
    "horizontalError", "depthError", "magError", "magNst",
)
TIME_COLUMNS = ("time", "updated")


def coerce_types(raw: DataFrame) -> DataFrame:
    """Cast the known columns leniently: what does not parse becomes NULL."""

    def typed(name: str) -> Column:
        c = F.col(name)
        if name in TIME_COLUMNS:
            return F.try_to_timestamp(c.cast("string")).alias(name)
        if name in NUMERIC_COLUMNS:
            number = c.try_cast("double")
            return F.when(~F.isnan(number), number).alias(name)
        return F.when(c != "", c).alias(name)

    return raw.select([typed(c) for c in raw.columns])


def keep_latest(df: DataFrame, key: str = "id", version: str = "updated",
                arrival: str | None = None) -> DataFrame:
    """One row per key: the one revised last.

    A missing version wins over any other, ties go to the later arrival and
    then to a fixed order of the row's content. ``row_number() = 1`` lets Spark
    drop superseded rows before the shuffle (window group limit), so a key that
    holds a large share of all rows sends one row per map task.
    """
    order = [F.desc_nulls_first(version)]
    if arrival:
        order.append(F.desc(arrival))
    order.append(F.xxhash64(*[F.col(c) for c in df.columns]))
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def upsert(current: DataFrame | None, batches: list[DataFrame], key: str = "id",
           version: str = "updated") -> DataFrame:
    """Merge newly arrived batches into the current catalog."""
    parts = ([current] if current is not None else []) + list(batches)
    tagged = [p.withColumn("_arrival", F.lit(n)) for n, p in enumerate(parts)]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return keep_latest(merged, key, version, "_arrival").drop("_arrival")


def failed_rule(cfg: HazardConfig) -> Column:
    """Name of the first cleaning rule a deduplicated row breaks, else NULL."""

    def outside(name: str, bounds: tuple[float, float]) -> Column:
        return ~F.coalesce(F.col(name).between(*bounds), F.lit(False))

    rule = F.when(F.col("mag").isNull() | F.col("magType").isNull(), "missing_mag_or_magtype")
    rule = rule.when(F.col("time").isNull(), "missing_time")
    if cfg.event_type:
        other_type = ~F.coalesce(F.col("type") == cfg.event_type, F.lit(False))
        rule = rule.when(other_type, "non_matching_eventtype")
    return rule.when(
        outside("latitude", cfg.lat_bounds)
        | outside("longitude", cfg.lon_bounds)
        | outside("depth", cfg.depth_bounds),
        "out_of_physical_bounds",
    )


def clean_catalog(catalog: DataFrame, cfg: HazardConfig = HazardConfig()) -> DataFrame:
    """Deduplicate, then keep the rows that break no rule."""
    return keep_latest(catalog).where(failed_rule(cfg).isNull())


def clean_step_counts(catalog: DataFrame, cfg: HazardConfig = HazardConfig()) -> DataFrame:
    """Rows left and removed after each cleaning step: (step_no, step, rows, removed)."""
    rules = ["missing_mag_or_magtype", "missing_time", "non_matching_eventtype",
             "out_of_physical_bounds"]
    broken = failed_rule(cfg)
    counts = keep_latest(catalog).agg(
        F.count(F.lit(1)).alias("deduped"),
        *[F.count_if(broken == r).alias(r) for r in rules],
    ).withColumn("raw", catalog.agg(F.count(F.lit(1))).scalar())
    removed = [F.lit(0).cast("long"), F.col("raw") - F.col("deduped")] + [F.col(r) for r in rules]
    names = ["raw", "duplicate_ids"] + rules
    steps, left = [], F.col("raw")
    for n, (name, gone) in enumerate(zip(names, removed)):
        left = left - gone
        steps.append(F.struct(F.lit(n).alias("step_no"), F.lit(name).alias("step"),
                              left.alias("rows"), gone.alias("removed")))
    return counts.select(F.inline(F.array(*steps)))


def catalog_summary(catalog: DataFrame) -> DataFrame:
    """Row count, time span and magnitude range of a catalog."""
    return catalog.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("time").alias("first_time"), F.max("time").alias("last_time"),
        F.min("mag").alias("min_mag"), F.max("mag").alias("max_mag"),
        F.count_if(F.col("mag").isNull()).alias("missing_mag"),
    )
