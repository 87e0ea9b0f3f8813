"""Date/time column functions (Column -> Column)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from pawprint.functions.text import ColumnOrName, _col

TWO_PI = 2.0 * math.pi

# Fixed values that must equal the reference's for identical results.
DAYS_PER_YEAR = 365.25
WEEKDAY_NAMES = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
# Hour bins (-1, 5], (5, 11], (11, 16], (16, 23] and their labels.
TIME_OF_DAY_BINS = ((5, "Night"), (11, "Morning"), (16, "Afternoon"), (23, "Evening"))
# Kitten season: day of year 91..304 inclusive.
KITTEN_SEASON = (91, 304)
WEEKEND, WEEKDAY = "Weekend", "Weekday"
IN_SEASON, OUT_OF_SEASON = "Kitten Season", "Out of Season"


def parse_datetime(c: ColumnOrName, on_error: str = "raise") -> Column:
    """Text or timestamp -> ``timestamp_ntz``; date-only text is accepted.

    ``on_error='raise'`` fails the job on bad text (ANSI cast), ``'null'``
    turns it into null. NTZ keeps hours independent of the session timezone.
    """
    if on_error not in ("raise", "null"):
        raise ValueError("on_error must be 'raise' or 'null'")
    c = _col(c)
    return c.try_cast("timestamp_ntz") if on_error == "null" else c.cast("timestamp_ntz")


def cyclic(value: Column, period: float) -> tuple[Column, Column]:
    """(sin, cos) of ``2*pi*value/period``."""
    angle = F.lit(TWO_PI) * value / F.lit(period)
    return F.sin(angle), F.cos(angle)


def weekday(c: ColumnOrName) -> Column:
    """Monday = 0 ... Sunday = 6 (not ``dayofweek``, where Sunday = 1)."""
    return F.weekday(_col(c))


def is_weekend(c: ColumnOrName) -> Column:
    """1.0 on Saturday/Sunday, 0.0 otherwise, null when the date is null."""
    return (weekday(c) >= 5).cast("double")


def weekend_label(c: ColumnOrName) -> Column:
    return F.when(F.coalesce(weekday(c) >= 5, F.lit(False)), F.lit(WEEKEND)).otherwise(F.lit(WEEKDAY))


def weekday_name(c: ColumnOrName) -> Column:
    """Short English weekday name (Mon..Sun); sort by ``weekday`` for that order."""
    return F.date_format(_col(c), "E")


def time_of_day(c: ColumnOrName) -> Column:
    """Hour bins right-closed; hours outside (-1, 23] and null dates -> null."""
    h = F.hour(_col(c))
    expr = None
    lower = -1
    for upper, label in TIME_OF_DAY_BINS:
        cond = (h > lower) & (h <= upper)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
        lower = upper
    return expr


def kitten_season(c: ColumnOrName) -> Column:
    lo, hi = KITTEN_SEASON
    cond = F.coalesce(F.dayofyear(_col(c)).between(lo, hi), F.lit(False))
    return F.when(cond, F.lit(IN_SEASON)).otherwise(F.lit(OUT_OF_SEASON))
