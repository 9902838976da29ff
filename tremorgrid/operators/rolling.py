"""Trailing features of cell-day series.

The series stay sparse (event days only) as long as possible. Everything that
changes on event days alone - running totals, decayed sums, the last event -
is computed there and carried over quiet days; only then the calendar is
filled in, within the partition, and trailing windows are differences of
running totals ``w`` days apart. Running totals are integers or decimals, so
these differences are exact however long the history, and cost per row does
not depend on the window width.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tremorgrid.config import HazardConfig
from tremorgrid.functions import scalar as fn
from tremorgrid.operators.grid import CELL

MAG_SUM = "decimal(38,12)"
ENERGY_SUM = "decimal(38,6)"

# A decayed sum is a running total of x * 2^(t / half-life), scaled back. The
# exponent must stay below the limit of doubles, so totals restart in blocks
# of twice this many half-lives. Two staggered sets of blocks are kept and the
# one with more history behind the row is read, so no term younger than this
# many half-lives is ever lost (2^-400 of an event is nothing in a double).
BLOCK_HALF_LIVES = 400

TOTALS = ("events", "mag", "energy", "qual_n", "qual_mag")


def _decay_inputs(cfg: HazardConfig) -> dict[str, tuple[str, int]]:
    inputs = {}
    for hl in cfg.half_lives:
        inputs[f"decay_n_{hl}"] = ("n", hl)
        inputs[f"decay_energy_{hl}"] = ("sum_energy", hl)
    inputs[f"decay_nbr_{cfg.neighbor_half_life}"] = ("nbr_n", cfg.neighbor_half_life)
    return inputs


def decayed_sums(df: DataFrame, keys: list[str], day: str,
                 inputs: dict[str, tuple[str, int]]) -> DataFrame:
    """Exponentially decayed running sums ``name -> (value column, half-life)``.

    Equal to y[t] = x[t] + 0.5^(1/half-life) * y[t-1] over consecutive days;
    days may be missing from the series. Half-lives share blocks as long as
    the longest keeps enough history in them.
    """
    out = df
    for group in _block_groups({hl for _, hl in inputs.values()}):
        members = {k: v for k, v in inputs.items() if v[1] in group}
        span = BLOCK_HALF_LIVES * min(group)
        out = _decay_in_blocks(out, keys, day, members, span)
    return out


def _block_groups(half_lives: set[int]) -> list[list[int]]:
    groups: list[list[int]] = []
    for hl in sorted(half_lives):
        if groups and hl <= 4 * groups[-1][0]:
            groups[-1].append(hl)
        else:
            groups.append([hl])
    return groups


def _decay_in_blocks(df: DataFrame, keys: list[str], day: str,
                     inputs: dict[str, tuple[str, int]], span: int) -> DataFrame:
    t = F.col(day)
    blocks = {"_even": F.floor(t / (2 * span)) * (2 * span),
              "_odd": F.floor((t + span) / (2 * span)) * (2 * span) - span}
    df = df.withColumns({b: start.cast("int") for b, start in blocks.items()})
    older = {}
    for block in blocks:
        w = (Window.partitionBy(*keys, block).orderBy(day)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        age = t - F.col(block)
        df = df.withColumns({
            f"{block}_{name}": F.sum(F.col(x) * fn.decay_weight(-age, hl)).over(w)
            for name, (x, hl) in inputs.items()
        })
        older[block] = age
    use_even = older["_even"] >= older["_odd"]
    df = df.withColumns({
        name: F.when(use_even, F.col(f"_even_{name}") * fn.decay_weight(older["_even"], hl))
               .otherwise(F.col(f"_odd_{name}") * fn.decay_weight(older["_odd"], hl))
        for name, (_, hl) in inputs.items()
    })
    return df.drop(*blocks, *[f"{b}_{n}" for b in blocks for n in inputs])


def active_days(days: DataFrame, cfg: HazardConfig) -> DataFrame:
    """Event days of the active cells (neighbour-only days hold zeros of their own)."""
    per_cell = Window.partitionBy(*CELL)
    return days.withColumns({
        "cell_n": F.max("cell_n").over(per_cell),
        "mc_cell": F.max("mc_cell").over(per_cell),
    }).where(F.col("cell_n") >= cfg.min_events_per_cell).withColumns({
        c: F.coalesce(F.col(c), F.lit(0))
        for c in ("n", "sum_mag", "sum_energy", "qual_count", "qual_summag", "sig_count")
    })


def _from_first_day(days: DataFrame, first_day: Column) -> DataFrame:
    """A day without events at ``first_day`` for each cell whose series starts later."""
    first = F.row_number().over(Window.partitionBy(*CELL).orderBy("day_ord")) == 1
    late = F.col("_first") & (F.col("day_ord") > first_day)
    copies = F.when(late, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False)))
    doubled = days.withColumn("_first", first).withColumn("_added", F.explode(copies)).drop("_first")
    empty = {c: F.when(F.col("_added"), F.lit(0)).otherwise(F.col(c)).cast(t)
             for c, t in days.dtypes if c in ("n", "nbr_n", "sum_mag", "sum_energy", "qual_count", "qual_summag", "sig_count")}
    return doubled.withColumns(empty | {
        "max_mag": F.when(~F.col("_added"), F.col("max_mag")),
        "day_ord": F.when(F.col("_added"), first_day).otherwise(F.col("day_ord")),
    }).drop("_added")


def running_series(days: DataFrame, cfg: HazardConfig, first_day: Column | None = None) -> DataFrame:
    """Running totals, decayed sums and last event on each event day of active cells.

    With ``first_day`` every cell's series begins there.
    """
    by_day = Window.partitionBy(*CELL).orderBy("day_ord")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    active = active_days(days, cfg)
    if first_day is not None:
        active = _from_first_day(active, first_day)
    totals = active.withColumns({
        "events": F.sum("n").over(so_far),
        "mag": F.sum(F.col("sum_mag").cast(MAG_SUM)).over(so_far),
        "energy": F.sum(F.col("sum_energy").cast(ENERGY_SUM)).over(so_far),
        "qual_n": F.sum("qual_count").over(so_far),
        "qual_mag": F.sum(F.col("qual_summag").cast(MAG_SUM)).over(so_far),
        "last_event": F.max(F.when(F.col("n") > 0, F.col("day_ord"))).over(so_far),
        "next_day": F.lead("day_ord").over(by_day),
    })
    return decayed_sums(totals, CELL, "day_ord", _decay_inputs(cfg))


def fill_calendar(series: DataFrame, last_day: Column) -> DataFrame:
    """Repeat each row over the quiet days up to the next one, as column ``d``."""
    until = F.coalesce(F.col("next_day") - 1, last_day)
    return series.withColumn("d", F.explode(F.sequence("day_ord", until)))


def trailing_maxima(dense: DataFrame, value: str, order: WindowSpec,
                    widths: tuple[int, ...]) -> DataFrame:
    """Maximum of ``value`` over the last ``w`` rows, for each width.

    A wide window is covered by a few shifted copies of the next narrower one
    (overlaps do no harm to a maximum), so the cost per row stays small and
    all windows share one sort.
    """
    narrower = None
    for width in sorted(widths):
        name = f"rolling_max_mag_{width}d"
        if narrower is None:
            dense = dense.withColumn(name, F.max(value).over(order.rowsBetween(1 - width, 0)))
        else:
            shifts = {*range(0, width - narrower[1], narrower[1]), width - narrower[1]}
            shifted = [F.lag(narrower[0], k).over(order) if k else F.col(narrower[0])
                       for k in sorted(shifts)]
            dense = dense.withColumn(
                name, F.greatest(*shifted) if len(shifted) > 1 else shifted[0])
        narrower = (name, width)
    return dense


def trailing_features(series: DataFrame, last_day: Column, cfg: HazardConfig) -> DataFrame:
    """The dense feature series of each cell, with the next significant day ahead.

    ``next_sig`` is the first day with a significant event among the following
    ``horizon_days`` days, from which the label of every horizon follows.
    """
    w = Window.partitionBy(*CELL).orderBy("d")
    on_event_day = F.col("d") == F.col("day_ord")
    dense = fill_calendar(series, last_day).withColumns({
        "totals": F.struct(*TOTALS),
        "day_max": F.when(on_event_day, F.col("max_mag")),
        "sig_day": F.when(on_event_day & (F.col("sig_count") > 0), F.col("d")),
    })
    widths = sorted({*cfg.count_windows, *cfg.b_windows})
    windowed = trailing_maxima(dense, "day_max", w, cfg.count_windows).withColumns({
        **{f"_before_{n}": F.lag("totals", n).over(w) for n in widths},
        "next_sig": F.min("sig_day").over(w.rowsBetween(1, cfg.horizon_days)),
    })

    def trailing(total: str, n: int | None) -> Column:
        if n is None:
            return F.col(f"totals.{total}")
        return F.col(f"totals.{total}") - F.coalesce(F.col(f"_before_{n}.{total}"), F.lit(0))

    quiet = F.col("d") - F.col("day_ord")
    features = feature_projection(
        cfg, trailing,
        largest=lambda n: F.col(f"rolling_max_mag_{n}d"),
        decayed=lambda name, hl: F.col(f"decay_{name}_{hl}") * fn.decay_weight(quiet, hl))
    return windowed.select(
        *[c.alias(name) for name, c in features.items()],
        F.col("d").alias("day_ord"), "next_sig", "sig_day",
    )


def feature_projection(cfg: HazardConfig, trailing: Callable[[str, int | None], Column],
                       largest: Callable[[int], Column],
                       decayed: Callable[[str, int], Column]) -> dict[str, Column]:
    """All features of a cell-day ``d``, from accessors to its trailing sums.

    ``trailing(total, width)`` is a sum over the last ``width`` days (all days
    if None), ``largest(width)`` the largest magnitude in them and
    ``decayed(name, half_life)`` a decayed sum.
    """
    day = F.date_from_unix_date("d")
    features = {
        "day": day,
        "cell_lat": fn.cell_center(F.col("cell_lat_floor"), cfg.grid_deg),
        "cell_lon": fn.cell_center(F.col("cell_lon_floor"), cfg.grid_deg),
        "mc_cell": F.col("mc_cell"),
        "historical_event_count": trailing("events", None).cast("double"),
        "days_since_last_event": (F.col("d") - F.col("last_event")).cast("double"),
    }
    for n in cfg.count_windows:
        count = trailing("events", n).cast("double")
        features[f"rolling_count_{n}d"] = count
        features[f"rolling_mean_mag_{n}d"] = F.try_divide(
            trailing("mag", n).cast("double"), count)
        features[f"rolling_max_mag_{n}d"] = largest(n)
        features[f"log_energy_{n}d"] = fn.log_plus_one(trailing("energy", n).cast("double"))
    for hl in cfg.half_lives:
        features[f"decay_count_hl{hl}d"] = decayed("n", hl)
        features[f"decay_log_energy_hl{hl}d"] = fn.log_plus_one(decayed("energy", hl))
    hl = cfg.neighbor_half_life
    features[f"neighbor_decay_count_hl{hl}d"] = decayed("nbr", hl)
    for n in cfg.b_windows:
        count = trailing("qual_n", n).cast("double")
        features[f"b_value_{n}d"] = b_value(
            count, trailing("qual_mag", n).cast("double"), F.col("mc_cell"), cfg)
        features[f"b_value_{n}d_n_events"] = count
    angle = fn.season_angle(day)
    features["doy_sin"], features["doy_cos"] = F.sin(angle), F.cos(angle)
    return features


def features_as_of(days: DataFrame, last_day: Column, lookback: int,
                   cfg: HazardConfig) -> DataFrame:
    """Features of the last ``lookback`` days only, for every active cell.

    A few days need no series: each is one conditional aggregate over the
    cell's event days.
    """
    seen = F.col("day_ord") <= F.col("d")
    age = F.col("d") - F.col("day_ord")

    def within(n: int | None) -> Column:
        return seen if n is None else seen & (age < n)

    def total(value: str, n: int | None) -> Column:
        return F.sum(F.when(within(n), F.col(value)).otherwise(0))

    source = {"events": ("n", "bigint"), "mag": ("sum_mag", MAG_SUM),
              "energy": ("sum_energy", ENERGY_SUM), "qual_n": ("qual_count", "bigint"),
              "qual_mag": ("qual_summag", MAG_SUM)}
    aggregates = {"last_event": F.max(F.when(seen & (F.col("n") > 0), F.col("day_ord")))}
    for n in {None, *cfg.count_windows, *cfg.b_windows}:
        for name in TOTALS:
            aggregates[f"{name}_{n}"] = total(name, n)
        aggregates[f"max_{n}"] = F.max(F.when(within(n), F.col("max_mag")))
    for name, (value, hl) in _decay_inputs(cfg).items():
        weighted = F.col(value) * fn.decay_weight(age, hl)
        aggregates[name] = F.sum(F.when(seen, weighted).otherwise(0.0))
    as_of = F.explode(F.sequence(last_day - (lookback - 1), last_day))
    rows = active_days(days, cfg).withColumn("d", as_of).select(
        *CELL, "mc_cell", "d", "day_ord", "n", "nbr_n", "max_mag", "sum_energy",
        *[F.col(column).cast(kind).alias(name) for name, (column, kind) in source.items()])
    summed = rows.groupBy(*CELL, "mc_cell", "d").agg(
        *[c.alias(name) for name, c in aggregates.items()])
    features = feature_projection(
        cfg, lambda name, n: F.col(f"{name}_{n}"), lambda n: F.col(f"max_{n}"),
        lambda name, hl: F.col(f"decay_{name}_{hl}"))
    return summed.select(*[c.alias(name) for name, c in features.items()])


def b_value(count: Column, mag_sum: Column, mc: Column, cfg: HazardConfig) -> Column:
    """Maximum-likelihood b-value; NULL below the minimum sample."""
    excess = mag_sum / count - (mc - F.lit(cfg.utsu_correction))
    return F.when(count >= cfg.min_events_for_b, F.lit(math.log10(math.e)) / excess)
