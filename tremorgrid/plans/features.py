"""The feature matrix and the live snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tremorgrid.config import HazardConfig
from tremorgrid.operators import grid, rolling


def feature_columns(cfg: HazardConfig) -> list[str]:
    """Feature columns of a cell-day in their fixed order (no key, no label)."""
    names = ["mc_cell", "historical_event_count", "days_since_last_event"]
    for n in cfg.count_windows:
        names += [f"rolling_count_{n}d", f"rolling_mean_mag_{n}d", f"rolling_max_mag_{n}d",
                  f"log_energy_{n}d"]
    for hl in cfg.half_lives:
        names += [f"decay_count_hl{hl}d", f"decay_log_energy_hl{hl}d"]
    names += [f"neighbor_decay_count_hl{cfg.neighbor_half_life}d"]
    for n in cfg.b_windows:
        names += [f"b_value_{n}d", f"b_value_{n}d_n_events"]
    return names + ["doy_sin", "doy_cos"]


def matrix_columns(cfg: HazardConfig) -> list[str]:
    return ["day", "horizon_day", "cell_lat", "cell_lon", *feature_columns(cfg), "target"]


def last_day_of(catalog: DataFrame) -> Column:
    """Last calendar day as a scalar subquery over the time column alone."""
    return grid.calendar_bounds(catalog).select("last_day").scalar()


def cell_day_features(catalog: DataFrame, cfg: HazardConfig = HazardConfig(),
                      last_day: Column | None = None, whole_calendar: bool = False) -> DataFrame:
    """Dense features per (cell, day) of active cells, before any row filter.

    Series start with the first day on which the cell or a neighbour had an
    event: before it all features are zero or missing. With ``whole_calendar``
    these days have rows too, from the first day of the catalog.
    """
    last = last_day if last_day is not None else last_day_of(catalog)
    first = grid.calendar_bounds(catalog).select("first_day").scalar() if whole_calendar else None
    days = grid.with_neighbors(grid.cell_days(catalog, cfg))
    return rolling.trailing_features(rolling.running_series(days, cfg, first), last, cfg)


def labelled_days(catalog: DataFrame, cfg: HazardConfig = HazardConfig(),
                  last_day: Column | None = None) -> DataFrame:
    """Cell-days past their warm-up whose longest horizon is fully observed."""
    last = last_day if last_day is not None else last_day_of(catalog)
    return cell_day_features(catalog, cfg, last).where(
        (F.col("historical_event_count") >= cfg.warmup_events)
        & (F.col("day_ord") + cfg.horizon_days <= last)
    )


def expand_horizons(days: DataFrame, cfg: HazardConfig = HazardConfig()) -> DataFrame:
    """One copy of each row per horizon day."""
    return days.withColumn("horizon_day", F.explode(F.sequence(F.lit(1), F.lit(cfg.horizon_days))))


def feature_matrix(catalog: DataFrame, cfg: HazardConfig = HazardConfig(),
                   last_day: Column | None = None) -> DataFrame:
    """(day, horizon, cell) rows with features and label, from a clean catalog.

    The horizons are spread out last, so every window runs on the smallest
    possible number of rows.
    """
    reached = F.col("next_sig") <= F.col("day_ord") + F.col("horizon_day")
    rows = expand_horizons(labelled_days(catalog, cfg, last_day), cfg)
    return rows.withColumn("target", F.coalesce(reached, F.lit(False)).cast("int")).select(
        *matrix_columns(cfg))


def snapshot(catalog: DataFrame, cfg: HazardConfig = HazardConfig(), lookback: int = 1,
             last_day: Column | None = None) -> DataFrame:
    """Current features of every active cell: no label, no warm-up filter."""
    last = last_day if last_day is not None else last_day_of(catalog)
    days = grid.with_neighbors(grid.cell_days(catalog, cfg))
    return rolling.features_as_of(days, last, lookback, cfg).select(
        "day", "cell_lat", "cell_lon", *feature_columns(cfg))
