"""Calendar features."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import PEAK_HOURS
from .numeric import col_, round_half_even


def hour(ts) -> Column:
    return F.hour(col_(ts))


def day_of_week(ts) -> Column:
    """Monday = 0 ... Sunday = 6 (``weekday``, not ``dayofweek``)."""
    return F.weekday(col_(ts))


def month(ts) -> Column:
    return F.month(col_(ts))


def cyclic(c, period: int, fn: str) -> Column:
    """sin/cos of 2*pi*c/period rounded to 4 digits."""
    angle = F.lit(2.0 * math.pi) * col_(c) / F.lit(float(period))
    raw = F.sin(angle) if fn == "sin" else F.cos(angle)
    return round_half_even(raw, 4)


def is_peak_hour(h) -> Column:
    return col_(h).isin(PEAK_HOURS).cast("int")


def is_friday_evening(dow, h) -> Column:
    return ((col_(dow) == 4) & (col_(h) >= 17)).cast("int")


def is_monday_morning(dow, h) -> Column:
    return ((col_(dow) == 0) & (col_(h) < 10)).cast("int")
