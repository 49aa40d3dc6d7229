"""Boolean decoding (P1, P2) and alias resolution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numeric import col_


def decode_tf(c) -> Column:
    """P1 strict: 't' -> true, 'f' -> false (case-insensitive), else NULL."""
    s = F.lower(col_(c).cast("string"))
    return F.when(s == "t", F.lit(True)).when(s == "f", F.lit(False))


def truthy(c) -> Column:
    """P2 permissive truth as boolean: True, 1, 'true', 't', '1'; NULL -> false."""
    s = F.lower(col_(c).cast("string"))
    return F.coalesce(s.isin("true", "t", "1"), F.lit(False))


def truthy_flag(c) -> Column:
    """P2 as a 0/1 integer."""
    return truthy(c).cast("int")


def resolve_alias(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """First existing column name of ``candidates`` (None if none)."""
    present = set(df.columns)
    for name in candidates:
        if name in present:
            return name
    return None


def rename_legacy(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rename an old header to the current one if present."""
    if old in df.columns and new not in df.columns:
        return df.withColumnRenamed(old, new)
    return df


def project_features(df: DataFrame, features: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Ordered subset of ``features`` that exist, plus the missing names."""
    present = set(df.columns)
    keep = [f for f in features if f in present]
    missing = [f for f in features if f not in present]
    return df.select(*keep), missing
