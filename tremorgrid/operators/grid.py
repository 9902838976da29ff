"""Grid cells, active cells, calendars and daily aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tremorgrid.config import MOORE_OFFSETS, HazardConfig
from tremorgrid.functions import scalar as fn
from tremorgrid.session import small_side

CELL = ["cell_lat_floor", "cell_lon_floor"]


def by_cell(df: DataFrame) -> DataFrame:
    """Partition by cell into the session's full number of shuffle partitions.

    The number is fixed because the rows multiply afterwards (quiet days,
    horizons): sizes at the shuffle would make AQE merge too many partitions.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *CELL)


def with_cells(events: DataFrame, cfg: HazardConfig) -> DataFrame:
    return events.withColumns({
        "cell_lat_floor": fn.cell_index(F.col("latitude"), cfg.grid_deg),
        "cell_lon_floor": fn.cell_index(F.col("longitude"), cfg.grid_deg),
    })


def cell_counts(events: DataFrame, cfg: HazardConfig) -> DataFrame:
    return with_cells(events, cfg).groupBy(*CELL).agg(F.count(F.lit(1)).alias("n_events"))


def active_cells(events: DataFrame, cfg: HazardConfig) -> DataFrame:
    return cell_counts(events, cfg).where(F.col("n_events") >= cfg.min_events_per_cell)


def cell_coverage(events: DataFrame, cfg: HazardConfig) -> DataFrame:
    """How many cells are active and which share of events they hold."""
    active = F.col("n_events") >= cfg.min_events_per_cell
    return cell_counts(events, cfg).agg(
        F.count_if(active).alias("n_active_cells"),
        F.count(F.lit(1)).alias("n_total_cells"),
        (F.lit(100.0) * F.sum(F.when(active, F.col("n_events")).otherwise(0))
         / F.sum("n_events")).alias("coverage_pct"),
    )


def restrict_to_active(events: DataFrame, active: DataFrame, cfg: HazardConfig) -> DataFrame:
    """Events of active cells; the cell list is bounded by the size of the grid."""
    cells = small_side(active.select(*CELL), cfg.max_cells)
    return with_cells(events, cfg).join(cells, CELL, "left_semi")


def calendar_bounds(events: DataFrame) -> DataFrame:
    """First and last day (days since the epoch) of the whole catalog."""
    day = fn.day_number(F.col("time"))
    return events.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def cell_day_bins(events: DataFrame, cfg: HazardConfig) -> DataFrame:
    """Events summed per (cell, day, magnitude bin).

    This is the only shuffle that sees events, and they are combined before
    it. Behind it a cell has at most days x bins rows, so a cell holding a
    large share of all events is no larger than any other.

    A cell's completeness magnitude is some bin's value plus a fixed
    correction, so the bin it falls into splits at a place known for each bin
    beforehand: ``edge_*`` sum the part at or above that place. Qualifying
    counts need no second pass over the events.
    """
    steps = round(cfg.mc_correction / cfg.mag_bin)
    mag = F.col("mag")
    binned = with_cells(events, cfg).select(
        *CELL, fn.day_number(F.col("time")).alias("day_ord"), "time", "mag",
        fn.mag_bin(mag, cfg.mag_bin).alias("bin"),
    )
    edge = mag >= mc_of_bin(F.col("bin") - steps, cfg)
    return binned.groupBy(*CELL, "day_ord", "bin").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("mag").alias("sum_mag"),
        F.max("mag").alias("max_mag"),
        F.sum(fn.energy_joules(mag)).alias("sum_energy"),
        F.sum((mag >= cfg.mag_threshold).cast("int")).alias("sig_count"),
        F.sum(edge.cast("int")).alias("edge_n"),
        F.sum(F.when(edge, mag).otherwise(0.0)).alias("edge_mag"),
        F.min("time").alias("first_time"),
    )


def mc_of_bin(bin_no: Column, cfg: HazardConfig) -> Column:
    return bin_no * F.lit(cfg.mag_bin) + F.lit(cfg.mc_correction)


def with_modal_bin(bins: DataFrame) -> DataFrame:
    """Attach each cell's total and its fullest magnitude bin.

    Ties go to the bin seen first, then to the lower one. One shuffle by cell
    serves both windows and the daily sums that follow.
    """
    per_bin, per_cell = Window.partitionBy(*CELL, "bin"), Window.partitionBy(*CELL)
    ranked = bins.repartition(*CELL).withColumns({
        "_bin_n": F.sum("n").over(per_bin),
        "_bin_first": F.min("first_time").over(per_bin),
    })
    fullest = F.struct((-F.col("_bin_n")).alias("n"), F.col("_bin_first").alias("t"),
                       F.col("bin").alias("bin"))
    return ranked.withColumns({
        "modal_bin": F.min(fullest).over(per_cell)["bin"],
        "cell_n": F.sum("n").over(per_cell),
    }).drop("_bin_n", "_bin_first")


def completeness_magnitude(events: DataFrame, cfg: HazardConfig) -> DataFrame:
    """Completeness magnitude per cell: modal bin plus correction."""
    binned = with_cells(events, cfg).groupBy(
        *CELL, fn.mag_bin(F.col("mag"), cfg.mag_bin).alias("bin")
    ).agg(F.count(F.lit(1)).alias("n"), F.min("time").alias("first_time"))
    fullest = F.min(F.struct((-F.col("n")).alias("n"), "first_time", "bin"))["bin"]
    return binned.groupBy(*CELL).agg(
        F.sum("n").alias("n_events"), fullest.alias("modal_bin")
    ).withColumn("mc_cell", mc_of_bin(F.col("modal_bin"), cfg))


def cell_days(events: DataFrame, cfg: HazardConfig) -> DataFrame:
    """One row per cell and day with events: counts, sums, maxima, Mc."""
    steps = round(cfg.mc_correction / cfg.mag_bin)
    cut = F.col("modal_bin") + steps

    def qualifying(whole: str, edge: str) -> Column:
        return F.sum(F.when(F.col("bin") > cut, F.col(whole))
                     .when(F.col("bin") == cut, F.col(edge)).otherwise(0))

    return with_modal_bin(cell_day_bins(events, cfg)).groupBy(
        *CELL, "modal_bin", "cell_n", "day_ord"
    ).agg(
        F.sum("n").alias("n"),
        F.sum("sum_mag").alias("sum_mag"),
        F.max("max_mag").alias("max_mag"),
        F.sum("sum_energy").alias("sum_energy"),
        qualifying("n", "edge_n").alias("qual_count"),
        qualifying("sum_mag", "edge_mag").alias("qual_summag"),
        F.sum("sig_count").alias("sig_count"),
    ).withColumn("mc_cell", mc_of_bin(F.col("modal_bin"), cfg))


def with_neighbors(days: DataFrame) -> DataFrame:
    """Add ``nbr_n``: events of the day in the eight surrounding cells.

    Each cell-day is sent to itself and its eight neighbours, so no join is
    needed. Rows appear for cells and days with neighbour events only; cells
    without any event of their own keep a NULL ``cell_n``.
    """
    targets = F.array(*[
        F.struct(F.lit(a).alias("dlat"), F.lit(b).alias("dlon"))
        for a, b in ((0, 0),) + MOORE_OFFSETS
    ])
    own = (F.col("to.dlat") == 0) & (F.col("to.dlon") == 0)
    own_columns = [c for c in days.columns if c not in CELL + ["day_ord"]]
    sent = days.withColumn("to", F.explode(targets)).select(
        (F.col("cell_lat_floor") + F.col("to.dlat")).alias("cell_lat_floor"),
        (F.col("cell_lon_floor") + F.col("to.dlon")).alias("cell_lon_floor"),
        "day_ord",
        F.when(~own, F.col("n")).otherwise(0).alias("nbr_n"),
        *[F.when(own, F.col(c)).alias(c) for c in own_columns],
    )
    return by_cell(sent).groupBy(*CELL, "day_ord").agg(
        F.sum("nbr_n").alias("nbr_n"), *[F.max(c).alias(c) for c in own_columns]
    )


def dense_cell_days(events: DataFrame, cfg: HazardConfig) -> DataFrame:
    """Active cells x every catalog day; quiet days hold zero counts and sums."""
    w = Window.partitionBy(*CELL).orderBy("day_ord")
    bounds = calendar_bounds(events)
    days = cell_days(events, cfg).where(F.col("cell_n") >= cfg.min_events_per_cell)
    filled = days.withColumns({
        "_from": F.when(F.row_number().over(w) == 1, bounds.select("first_day").scalar())
                  .otherwise(F.col("day_ord")),
        "_to": F.coalesce(F.lead("day_ord").over(w) - 1, bounds.select("last_day").scalar()),
    }).withColumn("d", F.explode(F.sequence("_from", "_to")))
    has_events = F.col("d") == F.col("day_ord")
    zero = {"n": 0, "sum_mag": 0.0, "sum_energy": 0.0, "qual_count": 0, "qual_summag": 0.0,
            "sig_count": 0}
    return filled.select(
        *CELL, F.date_from_unix_date("d").alias("day"), F.col("d").alias("day_ord"),
        *[F.when(has_events, F.col(c)).otherwise(v).alias(c) for c, v in zero.items()],
        F.when(has_events, F.col("max_mag")).alias("max_mag"),
        "mc_cell",
    )
