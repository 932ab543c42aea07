"""Ratios and rounding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ratio(part: Column | str, whole: Column | str, scale: int = 2) -> Column:
    """``part / whole`` rounded half up to ``scale`` digits; 0 when ``whole`` is 0 or NULL.

    Counts are rounded in whole-number arithmetic, so a decimal tie never depends on how a binary
    fraction happens to be stored.
    """
    part, whole = _col(part).cast("bigint"), _col(whole).cast("bigint")
    unit = 10**scale
    rounded = F.call_function("div", part * (2 * unit) + whole, whole * 2)
    return F.when(whole > 0, rounded / F.lit(float(unit))).otherwise(F.lit(0.0))


def format_double(value: Column | str, scale: int) -> Column:
    """A double rounded half up; NaN reads 0."""
    return F.round(F.nanvl(_col(value), F.lit(0.0)), scale)
