"""Numeric column expressions that must give bit-identical results everywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_even(c, digits: int = 2) -> Column:
    """numpy ``round(digits)``: ``rint(x * 10^d) / 10^d``.

    Spark ``round`` is half-up and ``bround`` rounds the decimal value, both
    differ from numpy on binary ties; ``rint`` on the scaled double does not.
    ``+ 0.0`` turns a negative zero into zero.
    """
    scale = float(10 ** digits)
    return F.rint(col_(c) * F.lit(scale)) / F.lit(scale) + F.lit(0.0)


def exact_sum(c) -> Column:
    """Order-free sum of a 2-decimal measure (DECIMAL accumulation)."""
    return F.sum(col_(c).cast("decimal(18,2)")).cast("double")


def exact_mean(c) -> Column:
    """Mean of a 2-decimal measure that does not depend on summation order."""
    return exact_sum(c) / F.count(col_(c))


def clip(c, lo: float, hi: float) -> Column:
    """``clip(x, lo, hi)``; NULL stays NULL."""
    x = col_(c)
    return F.when(x.isNull(), F.lit(None)).otherwise(
        F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), x)))


def abs_error(truth, pred, digits: int = 2) -> Column:
    """``round(|truth - pred|, 2)``."""
    return round_half_even(F.abs(col_(truth) - col_(pred)), digits)


def safe_ratio(num, den) -> Column:
    """num / den with a zero denominator giving NULL."""
    d = col_(den)
    return col_(num) / F.when(d != 0, d)


def round6(c) -> Column:
    """Six-digit rounding used for statistics whose last bits depend on order."""
    return round_half_even(c, 6)
