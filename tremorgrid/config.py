"""Parameters of the hazard pipeline, gathered in one immutable object."""

from __future__ import annotations

from dataclasses import dataclass, replace

# The eight cells around a cell (Moore neighbourhood), as (lat, lon) steps.
MOORE_OFFSETS = tuple(
    (dlat, dlon) for dlat in (-1, 0, 1) for dlon in (-1, 0, 1) if (dlat, dlon) != (0, 0)
)


@dataclass(frozen=True)
class HazardConfig:
    """Every tunable of cleaning, features, splits, backtests and serving."""

    # cleaning
    event_type: str = "earthquake"
    lat_bounds: tuple[float, float] = (-90.0, 90.0)
    lon_bounds: tuple[float, float] = (-180.0, 180.0)
    depth_bounds: tuple[float, float] = (-5.0, 700.0)

    # grid and features
    grid_deg: float = 1.0
    min_events_per_cell: int = 50
    warmup_events: int = 5
    horizon_days: int = 7
    count_windows: tuple[int, ...] = (7, 30, 90, 365)
    b_windows: tuple[int, ...] = (90, 365)
    min_events_for_b: int = 10
    mag_bin: float = 0.1
    mc_correction: float = 0.2
    utsu_correction: float = 0.05
    half_lives: tuple[int, ...] = (3, 10)
    neighbor_half_life: int = 3
    mag_threshold: float = 4.5

    # magnitude readout and alerts
    default_b: float = 1.0
    b_floor: float = 0.3
    alert_threshold: float = 0.3

    # splits, tuning, backtest
    train_frac: float = 0.70
    val_frac: float = 0.15
    cv_folds: int = 5
    min_history_days: int = 180
    top_cells: int = 10
    n_cutoffs: int = 10
    seed: int = 42

    # ingest
    overlap_minutes: int = 60
    chunk_cap: int = 8000

    def with_(self, **changes) -> "HazardConfig":
        """A copy with some parameters changed."""
        return replace(self, **changes)

    @property
    def max_cells(self) -> int:
        """Upper bound on the number of grid cells: the globe is finite."""
        return int((180 / self.grid_deg + 1) * (360 / self.grid_deg + 1))
