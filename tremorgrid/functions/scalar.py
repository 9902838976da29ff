"""Column expressions shared by the feature, forecast and alert plans."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# Colours of the risk scale from calm to severe (RGB), and the
# marker radius at the alert threshold and its growth up to certainty.
RISK_COLORS = ((145, 207, 96), (254, 224, 139), (252, 141, 89), (215, 48, 39))
RISK_RADIUS_MIN = 5.0
RISK_RADIUS_SPAN = 9.0

DAYS_PER_YEAR = 365.25


def energy_joules(mag: Column) -> Column:
    """Radiated energy in joules for a magnitude."""
    return F.pow(F.lit(10.0), mag * 1.5 + 4.8)


def log_plus_one(x: Column) -> Column:
    return F.log10(x + F.lit(1.0))


def exceedance_prob(b: Column, base: Column, m: Column) -> Column:
    """P(M >= m | M >= base) under Gutenberg-Richter with slope ``b``."""
    return F.pow(F.lit(10.0), -b * (m - base))


def magnitude_quantile(b: Column, base: float, prob: float) -> Column:
    """The magnitude exceeded with probability ``prob``, given M >= base."""
    return F.lit(base) - F.lit(math.log10(prob)) / b


def effective_b(b_short: Column, b_long: Column, default: float, floor: float) -> Column:
    """Short-window b-value, else the long one, else a default; floored."""
    return F.greatest(F.coalesce(b_short, b_long, F.lit(default)), F.lit(floor))


def mag_bin(mag: Column, width: float) -> Column:
    """Number of the magnitude bin (half-even rounding)."""
    return F.rint(mag / F.lit(width)).cast("int")


def cell_index(coord: Column, size: float) -> Column:
    """Grid index of a coordinate; floors towards minus infinity."""
    return F.floor(coord / F.lit(size)).cast("int")


def cell_center(index: Column, size: float) -> Column:
    return (index + F.lit(0.5)) * F.lit(size)


def day_number(ts: Column) -> Column:
    """Days since 1970-01-01 of a timestamp."""
    return F.unix_date(F.to_date(ts))


def season_angle(day: Column) -> Column:
    return F.dayofyear(day) * F.lit(2 * math.pi / DAYS_PER_YEAR)


def decay_weight(age_days: Column, half_life: float) -> Column:
    """Weight left after ``age_days``; halves every ``half_life`` days."""
    return F.pow(F.lit(2.0), -age_days / F.lit(float(half_life)))


def clamp_horizon(h: int, horizon_days: int) -> int:
    return max(1, min(int(h), horizon_days))


def risk_position(p: Column, threshold: float) -> Column:
    """Place of a probability between the alert threshold (0) and one (1)."""
    t = (p - F.lit(threshold)) / F.lit(1.0 - threshold)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))


def risk_color(p: Column, threshold: float) -> Column:
    """``rgb(r,g,b)`` interpolated over the colour stops."""
    stops = len(RISK_COLORS)
    reach = risk_position(p, threshold) * F.lit(float(stops - 1))
    low = F.least(F.lit(stops - 2), F.floor(reach).cast("int"))
    table = F.array(*[F.array(*[F.lit(float(v)) for v in rgb]) for rgb in RISK_COLORS])
    start, end = F.element_at(table, low + 1), F.element_at(table, low + 2)

    def channel(k: int) -> Column:
        a, b = F.element_at(start, k), F.element_at(end, k)
        return F.floor(a + (b - a) * (reach - low) + 0.5).cast("int")

    return F.format_string("rgb(%d,%d,%d)", channel(1), channel(2), channel(3))


def risk_radius(p: Column, threshold: float) -> Column:
    return F.lit(RISK_RADIUS_MIN) + F.lit(RISK_RADIUS_SPAN) * risk_position(p, threshold)


def percent_text(x: Column) -> Column:
    return F.format_string("%.2f%%", x * 100)


def parse_instant(text: Column) -> Column:
    """A date or date-time text as a timestamp; NULL where it is neither."""
    return F.try_to_timestamp(F.trim(text))


def null_if_nan(x: Column) -> Column:
    return F.when(~F.isnan(x), x)
