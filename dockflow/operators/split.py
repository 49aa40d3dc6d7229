"""Temporal splits: quantile cutoff (W3), expanding folds (W4), early stop.

Cutoffs are exact order statistics of integer microseconds. They are found
by histogram refinement: each pass is one distributed aggregation into at
most ``fanout`` bins restricted to the current bracket, and only when the
bracket holds at most ``max_collect`` (100k) rows are those (value,
count) pairs brought to the driver. Memory is bounded at any data size and a
pass count of about log_fanout(range) (4-5 for a year of microseconds); no
global sort, no single-task window, no percentile buffer of all distinct
timestamps.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import TRAIN_QUANTILE


def micros(ts: str = "datetime") -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _stats(df: DataFrame, x: Column):
    v = df.select(x.cast("long").alias("_x")).where(F.col("_x").isNotNull())
    return v.agg(F.count(F.lit(1)).alias("n"), F.min("_x").alias("lo"), F.max("_x").alias("hi")).first()


def order_statistics(df: DataFrame, x: Column, ranks: Sequence[int],
                     max_collect: int = 100_000, fanout: int = 4096, stats=None,
                     pushdown_ts: str | None = None) -> dict[int, int]:
    """Exact k-th smallest values (0-based ranks) of an integral column.

    ``pushdown_ts``: when ``x`` is the microseconds of that timestamp column,
    each bracket is also stated as a timestamp range, which reaches the
    parquet scan: later passes read only the row groups inside the bracket.
    """
    v = df.select(x.cast("long").alias("_x"), *([pushdown_ts] if pushdown_ts else [])) \
        .where(F.col("_x").isNotNull())
    out: dict[int, int] = {}
    todo = sorted(set(int(r) for r in ranks))
    if not todo:
        return out
    st = stats if stats is not None else _stats(df, x)
    n = st["n"]
    if any(r < 0 or r >= n for r in todo):
        raise ValueError(f"rank outside [0, {n})")
    # Pending searches grouped by bracket: (lo, hi, rows below lo, rows inside) -> ranks.
    pending = {(st["lo"], st["hi"], 0, n): todo}
    while pending:
        nxt: dict = {}
        for (lo, hi, below, inside), rs in pending.items():
            rng = v.where(F.col("_x").between(lo, hi))
            if pushdown_ts:
                rng = rng.where(F.col(pushdown_ts).between(F.timestamp_micros(F.lit(int(lo))),
                                                           F.timestamp_micros(F.lit(int(hi)))))
            if inside <= max_collect or hi - lo < fanout:
                pairs = (rng.groupBy("_x").agg(F.count(F.lit(1)).alias("c"))
                         .orderBy("_x").limit(max_collect + fanout + 1).collect())
                if len(pairs) <= max_collect + fanout:
                    for r in rs:
                        acc = below
                        for p in pairs:
                            acc += p["c"]
                            if acc > r:
                                out[r] = p["_x"]
                                break
                    continue
            width = max(1, math.ceil((hi - lo + 1) / fanout))
            bins = (rng.groupBy(F.floor((F.col("_x") - F.lit(lo)) / F.lit(width)).alias("b"))
                    .agg(F.count(F.lit(1)).alias("c")).orderBy("b").collect())
            for r in rs:
                acc = below
                for p in bins:
                    if acc + p["c"] > r:
                        b_lo = lo + p["b"] * width
                        nxt.setdefault((b_lo, min(hi, b_lo + width - 1), acc, p["c"]), []).append(r)
                        break
                    acc += p["c"]
        pending = nxt
    return out


def exact_quantiles(df: DataFrame, x: Column, probs: Sequence[float], **kw) -> dict[float, float]:
    """Linear-interpolated quantiles (pandas ``quantile``/DuckDB ``quantile_cont``)."""
    st = _stats(df, x)
    n = st["n"]
    if n == 0:
        return {p: None for p in probs}
    need = {}
    for p in probs:
        pos = p * (n - 1)
        k = math.floor(pos)
        need[p] = (k, min(k + 1, n - 1), pos - k)
    stats = order_statistics(df, x, [r for k, k1, _ in need.values() for r in (k, k1)], stats=st, **kw)
    res = {}
    for p, (k, k1, frac) in need.items():
        a, b = float(stats[k]), float(stats[k1])
        res[p] = a + (b - a) * frac if frac > 0 else a
    return res


def temporal_split(df: DataFrame, ts: str = "datetime", q: float = TRAIN_QUANTILE,
                   split_col: str = "split") -> tuple[DataFrame, float]:
    """cutoff = q-quantile of time; train = t <= cutoff < test.

    Returns the frame with a ``split`` column ('train'/'test') and the cutoff
    in microseconds.
    """
    cutoff = exact_quantiles(df, micros(ts), [q], pushdown_ts=ts)[q]
    if cutoff is None:
        return df.withColumn(split_col, F.lit(None).cast("string")), None
    # A missing timestamp is in neither split (NULL label), as with NaT in the reference.
    x = micros(ts)
    label = F.when(x <= F.lit(cutoff), F.lit("train")).when(x > F.lit(cutoff), F.lit("test"))
    return df.withColumn(split_col, label), cutoff


def train_condition(cutoff: float, ts: str = "datetime") -> Column:
    """``ts <= cutoff`` as a plain timestamp comparison.

    Timestamps are whole microseconds, so ``x <= cutoff`` equals
    ``x <= floor(cutoff)``; the literal form reaches the parquet scan as a
    pushed filter (row groups outside the range are skipped).
    """
    lit_ts = F.timestamp_micros(F.lit(int(math.floor(cutoff))))
    return F.col(ts) <= lit_ts


def split_summary(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Rows and share (%) per split, plus the number of columns."""
    from pyspark.sql import Window
    from ..functions import round_half_even
    g = df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # <= 2 rows
    ncols = len([c for c in df.columns if c != split_col])
    return g.select(split_col, "n", round_half_even(F.col("n") / total * F.lit(100.0), 1)
                    .alias("share"), F.lit(ncols).cast("bigint").alias("n_columns"))


def before(us: int, ts: str = "datetime") -> Column:
    """``ts`` earlier than a time in microseconds, as a plain timestamp comparison that reaches the parquet scan."""
    return F.col(ts) < F.timestamp_micros(F.lit(int(us)))


def fold_cutoffs(df: DataFrame, ts: str = "datetime", n_splits: int = 3) -> list[tuple[int, int | None]]:
    """W4 as time ranges: for each fold the first microsecond of its test block and of the rows behind it (None at
    the end). Training rows of a fold are those before the first, so folds are read by range, without exploding."""
    x = micros(ts)
    st = _stats(df, x)
    n = st["n"]
    size = n // (n_splits + 1)
    if size == 0:
        raise ValueError("too few rows for the folds")
    starts = [n - (n_splits - i) * size for i in range(n_splits)]
    v = order_statistics(df, x, starts, stats=st, pushdown_ts=ts)
    return [(v[s], v[starts[i + 1]] if i + 1 < n_splits else None) for i, s in enumerate(starts)]


def expanding_time_folds(df: DataFrame, ts: str = "datetime", n_splits: int = 3) -> DataFrame:
    """Expanding-window folds by time (train = past, test = next block).

    Row positions of a time-ordered frame become rank cutoffs: with
    ``size = n // (n_splits + 1)``, fold i tests ranks
    ``[n - (n_splits - i) * size, + size)`` and trains on all earlier ranks.
    Each row is emitted once per fold it belongs to (at most ``n_splits``
    rows), with columns ``fold`` and ``role``; no join, no global row number.
    """
    entries = []
    for i, (lo, end) in enumerate(fold_cutoffs(df, ts, n_splits)):
        role = F.when(before(lo, ts), F.lit("train"))
        role = role.when(before(end, ts), F.lit("test")) if end is not None else role.when(F.col(ts).isNotNull(), F.lit("test"))
        entries.append(F.struct(F.lit(i).alias("fold"), role.alias("role")))
    folded = df.withColumn("_f", F.explode(F.array(*entries)))
    return (folded.where(F.col("_f.role").isNotNull())
            .withColumn("fold", F.col("_f.fold")).withColumn("role", F.col("_f.role")).drop("_f"))


def early_stop_split(df: DataFrame, ts: str = "datetime", ratio: float = 0.85,
                     out: str = "is_validation") -> DataFrame:
    """First ``int(n * ratio)`` rows by time train, the rest validate."""
    cut = early_stop_cutoff(df, ts, ratio)
    return df.withColumn(out, F.lit(False) if cut is None else ~before(cut, ts))


def early_stop_cutoff(df: DataFrame, ts: str = "datetime", ratio: float = 0.85) -> int | None:
    """W5 as a time: the first microsecond of the validation rows, None if there are none."""
    x = micros(ts)
    st = _stats(df, x)
    k = int(st["n"] * ratio)
    return order_statistics(df, x, [k], stats=st, pushdown_ts=ts)[k] if k < st["n"] else None
