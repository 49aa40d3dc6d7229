"""Domain codes: capacity bins, weather severity, labels, verdicts.

P11, P12, P13, P25, P26, P27 as native column expressions (no Python UDF).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import (CAPACITY_EDGES, FROZEN_CODES, OFFICE_BELOW, RESIDENTIAL_ABOVE,
                      SEVERITY_LABELS, SEVERITY_RULES, STORMY_CODES, WEEKDAY_LABELS)
from .numeric import col_


def right_closed_bin(c, edges: Sequence[float]) -> Column:
    """Index of the right-closed bin (e[i], e[i+1]]; outside -> NULL."""
    x = col_(c)
    expr = None
    for i in range(len(edges) - 1):
        cond = (x > edges[i]) & (x <= edges[i + 1])
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def capacity_group(c) -> Column:
    """(0,20] (20,35] (35,50] (50,999] -> 0..3; anything else NULL."""
    return right_closed_bin(c, CAPACITY_EDGES)


def _in_ranges(x: Column, ranges) -> Column:
    cond = None
    for lo, hi in ranges:
        part = (x >= lo) if hi is None else x.between(lo, hi)
        cond = part if cond is None else (cond | part)
    return cond


def weather_severity(code) -> Column:
    """WMO code -> 0..4 by ranges; NULL and uncovered codes -> 0."""
    x = col_(code)
    expr = F.lit(0)
    # Later rules override earlier ones, as successive assignments do.
    for level, ranges in SEVERITY_RULES:
        expr = F.when(_in_ranges(x, ranges), F.lit(level)).otherwise(expr)
    return expr


def is_frozen(code) -> Column:
    return F.coalesce(col_(code).isin(FROZEN_CODES), F.lit(False)).cast("int")


def is_stormy(code) -> Column:
    return F.coalesce(col_(code).isin(STORMY_CODES), F.lit(False)).cast("int")


def code_label(c, labels: Sequence[str]) -> Column:
    """P25: code -> label via a literal map; unknown code -> its text."""
    m = F.create_map(*[x for i, lab in enumerate(labels) for x in (F.lit(i), F.lit(lab))])
    x = col_(c)
    return F.coalesce(F.element_at(m, x), x.cast("string"))


def severity_label(c) -> Column:
    return code_label(c, SEVERITY_LABELS)


def weekday_label(c) -> Column:
    return code_label(c, WEEKDAY_LABELS)


def profile_class(ratio, null_as_mixed: bool = True) -> Column:
    """Ratio > 1.2 residential, < 0.8 office, else mixed.

    NULL ratio counts as mixed on the station map (``null_as_mixed``) and as
    no class in the profile counts.
    """
    r = col_(ratio)
    expr = (F.when(r > RESIDENTIAL_ABOVE, F.lit("residential"))
            .when(r < OFFICE_BELOW, F.lit("office")))
    if null_as_mixed:
        return expr.otherwise(F.lit("mixed"))
    return expr.when(r.isNotNull(), F.lit("mixed"))


def band_verdict(c, good: float, fair: float) -> Column:
    """Metric >= good -> 'good', >= fair -> 'fair', else 'weak'; NULL stays NULL."""
    x = col_(c)
    return (F.when(x >= good, F.lit("good")).when(x >= fair, F.lit("fair"))
            .when(x.isNotNull(), F.lit("weak")))
