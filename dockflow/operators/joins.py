"""Join helpers: broadcast only behind a size bound, shuffle join beyond it.

Lookup joins (J2-J7) attach small fitted tables to data-sized frames. A table
is broadcast when its size is bounded either by construction (``proven_rows``:
e.g. a group-by on month has at most 13 keys, fitted profiles report their
exact row counts) or by a measured count, and rows x row width stays below
``BROADCAST_MAX_BYTES``. Anything larger falls back to a shuffle join that
AQE can split when keys are skewed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Ceiling for broadcasting a lookup table: its estimated size in bytes
# (rows x schema row width). Well below Spark's 8 GB broadcast limit, and
# cheap to ship to a thousand executors.
BROADCAST_MAX_BYTES = 256 << 20

_TYPE_BYTES = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "int": 4, "date": 4, "float": 4,
               "long": 8, "bigint": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8}


def row_width(df: DataFrame) -> int:
    """Estimated bytes per row (UnsafeRow-like: 8-byte header + fields; strings 32)."""
    width = 8
    for f in df.schema.fields:
        width += _TYPE_BYTES.get(f.dataType.typeName(), 32)
    return width


def is_broadcastable(small: DataFrame, proven_rows: int | None = None,
                     max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``small`` fits ``max_bytes``: from a proven row count, or by
    counting at most the first ``max_rows + 1`` rows."""
    max_rows = max(1, max_bytes // row_width(small))
    if proven_rows is not None:
        return proven_rows <= max_rows
    return small.limit(max_rows + 1).count() <= max_rows


def join_bounded(big: DataFrame, small: DataFrame, on: Sequence[str] | str | object,
                 how: str = "left", proven_rows: int | None = None) -> DataFrame:
    """``big JOIN small`` broadcasting ``small`` only when its size is bounded.

    ``proven_rows`` is a bound known by construction (e.g. 13 for a month
    key); without it the table is measured.
    """
    if is_broadcastable(small, proven_rows):
        small = F.broadcast(small)
    return big.join(small, on, how)


def fitted_scalars(df: DataFrame, **aggs) -> dict:
    """Compute a few scalars in one aggregation and return them to the driver.

    Callers stamp them on rows with ``F.lit``: a one-row result is the only
    thing that reaches the driver, and no cross join is planned.
    """
    row = df.agg(*[expr.alias(name) for name, expr in aggs.items()]).first()
    return row.asDict() if row is not None else {k: None for k in aggs}
