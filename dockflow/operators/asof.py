"""Time-based as-of lag per key with a forward tolerance.

For a row at time t and lag L the lag value is the value of the *earliest*
row of the same key whose time lies in ``[t - L, t - L + tolerance]`` (both
ends inclusive), NULL when there is none. This is a RANGE window frame over
microseconds, so all lags share one partitioning and one sort.

Scale: a plain ``partitionBy(key)`` window puts every row of a key into one
task, which breaks when one station holds a large share of the data. The
default plan partitions by ``(key, time bucket)`` instead, with a bucket
width chosen per key from its density (one day for ordinary keys, down to the
tolerance for very hot ones). A row is needed by targets in
``[s + L - tol, s + L]`` for each lag, so it is also copied (as a source only)
into the other buckets those windows touch; the copies are the only extra
rows and are dropped after the window. Results are identical to the plain
window for any width.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import LAG_MINUTES, LAG_TOLERANCE_MINUTES, TARGET_RAW

_US_PER_MIN = 60 * 1_000_000

DEFAULT_LAGS = {f"lag_{m}min": m for m in LAG_MINUTES}


def _frame_bounds(minutes: int, tolerance: int) -> tuple[int, int]:
    return -minutes * _US_PER_MIN, (-minutes + tolerance) * _US_PER_MIN


# Adaptive bucketing: aim at this many rows per (key, bucket) window partition.
TARGET_ROWS_PER_BUCKET = 500_000
# Keys denser than the default width allows get their own width; at most this
# many exceptions travel in a broadcast table (a proven size bound).
MAX_HOT_KEYS = 1_000
MAX_BUCKET_MINUTES = 24 * 60


def asof_lag(df: DataFrame, key: str = "station_id", ts: str = "datetime",
             value: str = TARGET_RAW, lags: Mapping[str, int] | None = None,
             tolerance_minutes: int = LAG_TOLERANCE_MINUTES,
             bucket_minutes: int | str | None = "auto",
             target_rows: int = TARGET_ROWS_PER_BUCKET, max_hot: int = MAX_HOT_KEYS,
             dedup_order: Sequence | None = None) -> DataFrame:
    """Add one column per entry of ``lags`` (name -> minutes).

    ``bucket_minutes``: ``"auto"`` (default) picks the time-bucket width per
    key from its density, so no (key, bucket) holds much more than
    ``TARGET_ROWS_PER_BUCKET`` rows; an int fixes the width for all keys;
    ``None`` is the plain per-key window (only for data without hot keys).
    Every choice gives the same values.

    ``dedup_order``: keep one row per (key, time), the first by these columns or expressions
    (U2 before J1, so duplicate polls cannot make the lag ambiguous). It runs
    on the lag's own exchange and sort (previous-row time comparison): no
    extra shuffle.
    """
    lags = dict(lags or DEFAULT_LAGS)
    if not lags:
        return df
    if tolerance_minutes < 0 or any(m < 0 for m in lags.values()):
        raise ValueError("lags and tolerance must be >= 0")
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    base = df.withColumn("_us", us)
    if bucket_minutes is None:
        if dedup_order:
            base = base.repartition(key)
            wd = Window.partitionBy(key).orderBy("_us", *dedup_order)
            base = base.withColumn("_prev", F.lag("_us").over(wd))
            base = (base.where(F.col("_prev").isNull() | (F.col("_prev") != F.col("_us"))
                               | F.col("_us").isNull()).drop("_prev"))
        w = Window.partitionBy(key).orderBy("_us")
        cols = {}
        for name, minutes in lags.items():
            lo, hi = _frame_bounds(minutes, tolerance_minutes)
            cols[name] = F.when(F.col("_us").isNotNull(),
                                F.first(value).over(w.rangeBetween(lo, hi)))
        return base.withColumns(cols).drop("_us")
    if bucket_minutes == "auto":
        base, width = _adaptive_width(base, key, tolerance_minutes, target_rows, max_hot)
    else:
        width = F.lit(int(bucket_minutes) * _US_PER_MIN)
    return _bucketed(base, key, value, lags, tolerance_minutes, width, dedup_order)


def _adaptive_width(base: DataFrame, key: str, tolerance: int,
                    target_rows: int = TARGET_ROWS_PER_BUCKET, max_hot: int = MAX_HOT_KEYS):
    """Per-key bucket width (microseconds) from row density.

    Rows are counted per key and default bucket (a day); only keys with a day
    of more than ``target_rows`` need narrower buckets, sized from their
    densest day, so a burst counts and a key with a handful of rows never
    does. The default width stays a day unless there are more than
    ``max_hot`` such keys; then it is what the next one needs. At most
    ``max_hot + 1`` rows reach the driver and the broadcast table. Widths
    stay within [tolerance, 1 day].
    """
    lo_w = max(tolerance, 1) * _US_PER_MIN
    hi_w = MAX_BUCKET_MINUTES * _US_PER_MIN

    def width_for(n):
        return max(lo_w, min(hi_w, int(target_rows * hi_w / n)))

    u = F.col("_us")
    days = (base.where(u.isNotNull() & F.col(key).isNotNull()).groupBy(key, F.floor(u / hi_w).alias("_day"))
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > target_rows))
    top = (days.groupBy(key).agg(F.max("n").alias("n")).orderBy(F.col("n").desc(), F.col(key))
           .limit(max_hot + 1).collect())
    default = hi_w if len(top) <= max_hot else width_for(top[-1]["n"])
    hot = [(r[key], width_for(r["n"])) for r in top[:max_hot]]
    hot = [(k, w) for k, w in hot if w < default]
    if not hot:
        return base, F.lit(default)
    kt = base.schema[key].dataType.simpleString()
    widths = base.sparkSession.createDataFrame(hot, f"{key} {kt}, _width long")
    joined = base.join(F.broadcast(widths), key, "left")
    return joined, F.coalesce(F.col("_width"), F.lit(default))


def _bucketed(base: DataFrame, key: str, value: str, lags: Mapping[str, int],
              tolerance: int, width, dedup_order: Sequence | None = None) -> DataFrame:
    u = F.col("_us")
    base = base.withColumn("_w", width)
    wcol = F.col("_w")
    own = F.floor(u / wcol)
    # A source at s serves targets in [s + L - tol, s + L] for each lag L:
    # the buckets of those windows, without its own one, get a copy.
    reach = None
    for minutes in lags.values():
        lo_b = F.floor((u + F.lit((minutes - tolerance) * _US_PER_MIN)) / wcol)
        hi_b = F.floor((u + F.lit(minutes * _US_PER_MIN)) / wcol)
        seq = F.sequence(lo_b, hi_b)
        reach = seq if reach is None else F.array_union(reach, seq)
    extra = F.filter(reach, lambda b: b != own)

    # One scan: each row expands to its own bucket (target and source) plus
    # one source-only copy per extra bucket. Copies keep key, time and value;
    # other columns are NULL in them.
    entries = F.concat(
        F.array(F.struct(own.alias("b"), F.lit(False).alias("c"))),
        F.when(u.isNotNull(), F.transform(extra, lambda b: F.struct(b.alias("b"), F.lit(True).alias("c"))))
        .otherwise(F.array().cast("array<struct<b:bigint,c:boolean>>")))
    keep = {key, value, "_us"}
    out_cols = [c for c in base.columns if c not in ("_w", "_width")]
    exploded = base.withColumn("_e", F.explode(entries))
    both = exploded.select(
        *[F.col(c) if c in keep else F.when(~F.col("_e.c"), F.col(c)).alias(c) for c in out_cols],
        F.col("_e.b").alias("_b"), F.col("_e.c").alias("_src_only"))
    if dedup_order:
        # Same (key, time) -> same bucket for targets and for copies: the
        # partitioning of the lag window already clusters the duplicates.
        # One exchange on (key, bucket) and one sort by (time, order...) serve
        # both windows; a row is kept when the previous row has another time.
        both = both.repartition(key, "_b")
        wd = Window.partitionBy(key, "_b").orderBy("_us", *dedup_order)
        both = both.withColumn("_prev", F.lag("_us").over(wd))
        both = (both.where(F.col("_prev").isNull() | (F.col("_prev") != F.col("_us")) | F.col("_us").isNull())
                .drop("_prev"))
    w = Window.partitionBy(key, "_b").orderBy("_us")
    cols = {}
    for name, minutes in lags.items():
        lo, hi = _frame_bounds(minutes, tolerance)
        cols[name] = F.when(u.isNotNull(), F.first(value).over(w.rangeBetween(lo, hi)))
    return (both.withColumns(cols).where(~F.col("_src_only"))
            .drop("_us", "_b", "_src_only"))


def drop_incomplete(df: DataFrame, cols) -> DataFrame:
    """P20: drop rows where any of ``cols`` is NULL."""
    return df.na.drop(subset=list(cols))


def lag_audit(with_lags: DataFrame, cols=tuple(DEFAULT_LAGS)) -> DataFrame:
    """Rows dropped for a missing lag and rows remaining (one pass)."""
    complete = None
    for c in cols:
        complete = F.col(c).isNotNull() if complete is None else complete & F.col(c).isNotNull()
    return with_lags.agg(F.count_if(~complete).alias("rows_dropped"),
                         F.count_if(complete).alias("rows_remaining"))
