"""Serving: snapshot -> horizons -> model probabilities -> alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tremorgrid.config import HazardConfig
from tremorgrid.functions import scalar as fn
from tremorgrid.plans.features import expand_horizons, snapshot

# Model keys and the names they are shown under.
MODEL_NAMES = {
    "adaboost_dt": "AdaBoost + Decision Tree",
    "adaboost_rf": "AdaBoost + Random Forest",
    "gbt": "Gradient-boosted trees",
}

DISPLAY_COLUMNS = (
    "historical_event_count", "days_since_last_event", "rolling_count_7d", "rolling_count_30d",
    "rolling_count_90d", "rolling_max_mag_365d", "mc_cell", "b_value_90d", "b_value_365d",
)


def with_magnitudes(rows: DataFrame, cfg: HazardConfig = HazardConfig()) -> DataFrame:
    """Add the likely (50 %) and severe (10 %) magnitude, given a significant event."""
    b = fn.effective_b(F.col("b_value_90d"), F.col("b_value_365d"), cfg.default_b, cfg.b_floor)
    return rows.withColumns({
        "mag_likely": fn.magnitude_quantile(b, cfg.mag_threshold, 0.5),
        "mag_severe": fn.magnitude_quantile(b, cfg.mag_threshold, 0.1),
    })


def forecast(catalog: DataFrame, score, models: list[str], cfg: HazardConfig = HazardConfig(),
             last_day: Column | None = None) -> DataFrame:
    """One row per horizon and active cell with a probability column per model.

    ``score(rows)`` adds ``proba_<model>`` for the models at hand; those of
    absent models are NULL. Write the result as table ``forecast``: serving
    reads slices of it.
    """
    rows = with_magnitudes(expand_horizons(snapshot(catalog, cfg, 1, last_day), cfg), cfg)
    scored = score(rows)
    for key in models:
        if f"proba_{key}" not in scored.columns:
            scored = scored.withColumn(f"proba_{key}", F.lit(None).cast("double"))
    return scored.select(
        F.col("day").alias("asof_date"), "horizon_day", "cell_lat", "cell_lon",
        *DISPLAY_COLUMNS, *[f"proba_{key}" for key in models], "mag_likely", "mag_severe")


def horizon_slice(forecasts: DataFrame, horizon: int, cfg: HazardConfig = HazardConfig()) -> DataFrame:
    """The forecast for one horizon (clamped to the valid ones) and the day it ends."""
    h = fn.clamp_horizon(horizon, cfg.horizon_days)
    return forecasts.where(F.col("horizon_day") == h).withColumn(
        "horizon_end", F.date_add("asof_date", h)).drop("horizon_day")


def alerts(rows: DataFrame, proba: str, cfg: HazardConfig = HazardConfig()) -> DataFrame:
    """Rows whose probability exceeds the alert threshold, with colour and radius."""
    p = F.col(proba)
    return rows.where(p > cfg.alert_threshold).withColumns({
        "risk_color": fn.risk_color(p, cfg.alert_threshold),
        "risk_radius": fn.risk_radius(p, cfg.alert_threshold),
    })
