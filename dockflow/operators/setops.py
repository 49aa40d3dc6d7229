"""Set operations: union by name (U1) and keep-first de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL aligned by column name; missing columns become NULL."""
    if not frames:
        raise ValueError("nothing to union")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def dedup_keep_first(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per ``key``, the first by ``order`` (e.g. source order, then position).

    ``min_by`` in a hash aggregation instead of ``row_number`` over a window:
    duplicates are reduced map-side before the shuffle, so a key repeated in
    a third of the input does not end up as one huge window partition.
    Rows whose order struct ties keep an arbitrary one of them.
    """
    key = list(key)
    rest = [c for c in df.columns if c not in key]
    ordc = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    g = df.groupBy(*key).agg(F.min_by(F.struct(*rest), ordc).alias("_r"))
    return g.select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest])
