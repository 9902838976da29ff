"""Data dictionary, feature report and the summary tables of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tremorgrid.config import HazardConfig
from tremorgrid.operators import grid
from tremorgrid.plans import features


def describe_columns(cfg: HazardConfig) -> dict[str, str]:
    """What each column of the feature matrix means."""
    text = {
        "day": "Day of the forecast (UTC). Features know its end; the target looks past it.",
        "horizon_day": f"Days looked ahead, 1 to {cfg.horizon_days}; an input like any other.",
        "cell_lat": f"Latitude of the cell's centre ({cfg.grid_deg} degree grid).",
        "cell_lon": f"Longitude of the cell's centre ({cfg.grid_deg} degree grid).",
        "mc_cell": "Magnitude above which the cell's record is complete, from all its events.",
        "historical_event_count": "Events in the cell since the catalog began, day included.",
        "days_since_last_event": "Days since the cell's latest event; 0 on a day with events.",
        "doy_sin": "Sine of the season (day of the year over 365.25).",
        "doy_cos": "Cosine of the season (day of the year over 365.25).",
        "target": (f"1 if an event of magnitude {cfg.mag_threshold} or more follows within "
                   "horizon_day days, else 0."),
    }
    for n in cfg.count_windows:
        text[f"rolling_count_{n}d"] = f"Events in the last {n} days."
        text[f"rolling_mean_mag_{n}d"] = f"Mean magnitude in the last {n} days; missing if none."
        text[f"rolling_max_mag_{n}d"] = f"Largest magnitude in the last {n} days; missing if none."
        text[f"log_energy_{n}d"] = f"log10(1 + joules radiated in the last {n} days)."
    for hl in cfg.half_lives:
        text[f"decay_count_hl{hl}d"] = f"Events weighted by age, halved every {hl} days."
        text[f"decay_log_energy_hl{hl}d"] = (
            f"log10(1 + joules weighted by age, halved every {hl} days).")
    hl = cfg.neighbor_half_life
    text[f"neighbor_decay_count_hl{hl}d"] = (
        f"Events of the eight surrounding cells weighted by age, halved every {hl} days.")
    for n in cfg.b_windows:
        text[f"b_value_{n}d"] = (
            f"Gutenberg-Richter b-value of the last {n} days; missing below "
            f"{cfg.min_events_for_b} complete events.")
        text[f"b_value_{n}d_n_events"] = f"Complete events behind b_value_{n}d."
    return text


def data_dictionary(matrix: DataFrame, cfg: HazardConfig) -> DataFrame:
    """(column_no, column, dtype, pct_missing, description) of the matrix."""
    text = describe_columns(cfg)
    cells = [F.struct(
        F.lit(k).alias("column_no"), F.lit(name).alias("column"), F.lit(dtype).alias("dtype"),
        F.round(F.avg(F.col(name).isNull().cast("double")) * 100, 3).alias("pct_missing"),
        F.lit(text.get(name, "")).alias("description"),
    ).alias(name) for k, (name, dtype) in enumerate(matrix.dtypes)]
    one = matrix.agg(*cells)
    return one.select(F.inline(F.array(*[F.col(c) for c in matrix.columns])))


def label_rates(matrix: DataFrame) -> DataFrame:
    """Positive rate over all rows (horizon NULL) and by horizon, in one pass."""
    return matrix.rollup("horizon_day").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("target").cast("long").alias("positives"),
        F.avg(F.col("target").cast("double")).alias("positive_rate"))


def threshold_rates(catalog: DataFrame, thresholds: list[float], cfg: HazardConfig) -> DataFrame:
    """Positive rate per magnitude threshold and horizon, without rebuilding features.

    Labels of all thresholds come from the largest magnitude of each day.
    """
    w = Window.partitionBy(*grid.CELL).orderBy("day_ord")
    ahead = w.rowsBetween(1, cfg.horizon_days)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    dense = grid.dense_cell_days(catalog, cfg)
    labelled = dense.withColumns({
        "history": F.sum("n").over(so_far),
        **{f"_next_{k}": F.min(F.when(F.col("max_mag") >= m, F.col("day_ord"))).over(ahead)
           for k, m in enumerate(thresholds)},
    }).where((F.col("history") >= cfg.warmup_events)
             & (F.col("day_ord") + cfg.horizon_days <= features.last_day_of(catalog)))
    by_threshold = F.array(*[
        F.struct(F.lit(float(m)).alias("mag_threshold"), F.col(f"_next_{k}").alias("next_sig"))
        for k, m in enumerate(thresholds)])
    rows = features.expand_horizons(
        labelled.select("day_ord", F.inline(by_threshold)), cfg)
    hit = F.coalesce(F.col("next_sig") <= F.col("day_ord") + F.col("horizon_day"), F.lit(False))
    return rows.groupBy("mag_threshold", "horizon_day").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(hit).alias("positives"),
        F.avg(hit.cast("double")).alias("positive_rate"))


def feature_report(catalog: DataFrame, cfg: HazardConfig) -> DataFrame:
    """One row of counts about the matrix: cells, dropped rows, positives, dates.

    Rows lost to the warm-up follow by arithmetic, since the series do not
    hold the empty days before a cell's first event.
    """
    bounds = grid.calendar_bounds(catalog).select(F.struct("first_day", "last_day")).scalar()
    cells = grid.cell_coverage(catalog, cfg).select(
        F.struct("n_active_cells", "n_total_cells", "coverage_pct")).scalar()
    days = features.cell_day_features(catalog, cfg, bounds["last_day"]).where(
        F.col("historical_event_count") >= cfg.warmup_events)
    labelled = F.col("day_ord") + cfg.horizon_days <= F.col("last_day")
    positive_horizons = F.when(
        F.col("next_sig").isNotNull(),
        cfg.horizon_days + 1 - (F.col("next_sig") - F.col("day_ord"))).otherwise(0)
    counted = days.withColumn("last_day", bounds["last_day"]).agg(
        F.count(F.lit(1)).alias("warm_rows"),
        F.count_if(labelled).alias("labelled_rows"),
        F.sum(F.when(labelled, positive_horizons)).cast("long").alias("target_positive_count"),
        F.min(F.when(labelled, F.col("day"))).alias("first_day"),
        F.max(F.when(labelled, F.col("day"))).alias("last_day"),
    )
    n_days = bounds["last_day"] - bounds["first_day"] + 1
    final_rows = F.col("labelled_rows") * cfg.horizon_days
    return counted.select(
        cells["n_active_cells"].alias("n_active_cells"),
        cells["n_total_cells"].alias("n_total_cells"),
        cells["coverage_pct"].alias("coverage_pct"),
        (cells["n_active_cells"] * n_days - F.col("warm_rows")).alias("rows_dropped_warmup"),
        (F.col("warm_rows") - F.col("labelled_rows")).alias("rows_dropped_no_label"),
        final_rows.alias("final_row_count"),
        F.lit(len(features.matrix_columns(cfg))).alias("final_column_count"),
        "target_positive_count",
        F.try_divide(F.col("target_positive_count"), final_rows).alias("target_positive_rate"),
        "first_day", "last_day",
    )


def as_json(report: DataFrame, column: str = "report") -> DataFrame:
    """Each row of a report as one JSON text."""
    return report.select(F.to_json(F.struct(*[F.col(c) for c in report.columns])).alias(column))


def headline(ranked: DataFrame) -> DataFrame:
    """Display table of a model comparison: rounded metrics, percentages as text."""

    def pct(name: str) -> Column:
        return F.format_string("%.2f%%", F.col(name) * 100).alias(name)

    return ranked.orderBy("rank").select(
        "rank", "model", *[F.round(c, 4).alias(c) for c in ("roc_auc", "pr_auc", "brier_score")],
        pct("precision"), pct("recall"),
    )
