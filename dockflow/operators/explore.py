"""Exploration aggregates (A6-A20), top-k and sampling (T5, T6), J7, J8, W1.

All are plain group-bys with partial (map-side) aggregation; the few global
scalars (min/max for histograms) are fitted in one aggregation each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (exact_mean, profile_class, round6, round_half_even, safe_ratio,
                         truthy_flag)
from ..schema import EVENING_HOURS, FILL_BANDS, MORNING_HOURS, TARGET_RAW
from .joins import fitted_scalars, join_bounded


def mean_by(df: DataFrame, keys, value: str = TARGET_RAW, out: str = "mean_fill",
            with_count: bool = False) -> DataFrame:
    """Exact (order-free) mean of a 2-decimal measure per key; NULL keys dropped."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    nonnull = None
    for k in keys:
        nonnull = F.col(k).isNotNull() if nonnull is None else nonnull & F.col(k).isNotNull()
    aggs = [exact_mean(value).alias(out)]
    if with_count:
        aggs.insert(0, F.count(F.lit(1)).alias("n"))
    return df.where(nonnull).groupBy(*keys).agg(*aggs)


def profile_by_hour(df: DataFrame) -> DataFrame:
    """A14."""
    return mean_by(df, "hour")


def profile_by_weekday(df: DataFrame) -> DataFrame:
    """A15."""
    return mean_by(df, "day_of_week")


def weather_impact(df: DataFrame) -> DataFrame:
    """Count and mean fill by severity."""
    return mean_by(df, "weather_severity", with_count=True)


def mean_fill_by_station(df: DataFrame) -> DataFrame:
    """A18."""
    return mean_by(df, "station_id")


def vacation_impact(df: DataFrame, flag: str = "is_vacation") -> DataFrame:
    """Mean fill by the P2 vacation flag; empty unless both levels exist.

    The level count is a window over the (at most 2-row) aggregate, so the
    single-partition window sees two rows, never the data.
    """
    from pyspark.sql import Window
    g = (df.withColumn("vacation", truthy_flag(flag)).groupBy("vacation")
         .agg(exact_mean(TARGET_RAW).alias("mean_fill")))
    levels = F.count(F.lit(1)).over(Window.partitionBy())
    return g.withColumn("_levels", levels).where(F.col("_levels") >= 2).drop("_levels")


def readings_per_day(df: DataFrame, ts: str = "datetime") -> DataFrame:
    """Count by calendar date."""
    return df.groupBy(F.to_date(ts).alias("date")).agg(F.count(F.lit(1)).alias("n"))


def readings_per_weekday(df: DataFrame, ts: str = "datetime") -> DataFrame:
    """Count by weekday (Mon=0)."""
    return (df.groupBy(F.weekday(ts).alias("day_of_week"))
            .agg(F.count(F.lit(1)).alias("n")))


def coverage_summary(df: DataFrame, ts: str = "datetime", approx: bool = False) -> DataFrame:
    """A10: rows, distinct stations, first/last time, whole days, weeks (1 digit).

    ``approx=True`` swaps the exact distinct count (a shuffle on station_id)
    for HyperLogLog++ (``approx_count_distinct``), one pass with no shuffle of keys.
    """
    distinct = (F.approx_count_distinct("station_id") if approx
                else F.count_distinct("station_id"))
    g = df.agg(F.count(F.lit(1)).alias("n_rows"), distinct.alias("n_stations"),
               F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
    span_s = F.unix_micros(F.col("last_ts")) - F.unix_micros(F.col("first_ts"))
    days = F.floor(span_s / F.lit(86_400_000_000)).cast("bigint")
    return g.withColumn("n_days", days).withColumn(
        "n_weeks", round_half_even(F.col("n_days") / F.lit(7.0), 1))


def fill_mean_median(df: DataFrame, value: str = TARGET_RAW) -> DataFrame:
    """Mean and median of the fill rate.

    The median runs on (value, count) pairs: a 2-decimal percentage has at
    most 10,001 distinct values, so the percentile buffer stays bounded at
    any data size.
    """
    pairs = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_c"))
    mean = (F.sum(F.col(value).cast("decimal(18,2)") * F.col("_c")).cast("double")
            / F.sum("_c"))
    return pairs.agg(mean.alias("mean_fill"),
                     round6(F.percentile(value, F.lit(0.5), F.col("_c"))).alias("median_fill"))


def equiwidth_histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """``bins`` equal-width bins over [min, max] with empty bins kept.

    min/max are fitted scalars; each row maps to
    ``least(floor((x - min) / (max - min) * n), n - 1)``; the bin frame comes
    from ``range(bins)`` and is left-joined to the counts (``bins`` rows).
    """
    s = fitted_scalars(df, lo=F.min(value), hi=F.max(value))
    lo, hi = s["lo"], s["hi"]
    spark = df.sparkSession
    frame = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    if lo is None:
        return frame.select("bin", F.lit(None).cast("double").alias("bin_lo"),
                            F.lit(None).cast("double").alias("bin_hi"),
                            F.lit(0).cast("bigint").alias("n"))
    width = (hi - lo) / bins if hi > lo else 0.0
    x = F.col(value)
    idx = (F.least(F.floor((x - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(bins))), F.lit(bins - 1))
           if hi > lo else F.lit(0))
    counts = (df.where(x.isNotNull()).groupBy(idx.cast("int").alias("bin"))
              .agg(F.count(F.lit(1)).alias("n")))
    out = join_bounded(frame, counts, "bin", "left", proven_rows=bins)
    return out.select(
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_hi"),
        F.coalesce(F.col("n"), F.lit(0).cast("bigint")).alias("n"))


def boxplot_by_station(df: DataFrame, stations: DataFrame, value: str = TARGET_RAW) -> DataFrame:
    """q1, median, q3 and 1.5-IQR whiskers per station of ``stations``.

    Quartiles run on (station, value, count) triples so each station's buffer
    is bounded by the distinct values of a 2-decimal percentage.
    """
    rows = df.join(F.broadcast(stations.select("station_id")), "station_id", "left_semi")
    triples = rows.groupBy("station_id", value).agg(F.count(F.lit(1)).alias("_c"))
    q = (triples.groupBy("station_id")
         .agg(F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("_c"))
              .alias("_q")))
    q = q.select("station_id", round6(F.col("_q")[0]).alias("q1"),
                 round6(F.col("_q")[1]).alias("median"), round6(F.col("_q")[2]).alias("q3"))
    q = q.withColumn("_iqr", F.col("q3") - F.col("q1"))
    fenced = triples.join(F.broadcast(q), "station_id")      # q: <= one row per chosen station
    v = F.col(value)
    inside = (v >= F.col("q1") - F.lit(1.5) * F.col("_iqr")) & (v <= F.col("q3") + F.lit(1.5) * F.col("_iqr"))
    whiskers = fenced.where(inside).groupBy("station_id").agg(
        F.min(value).alias("whisker_lo"), F.max(value).alias("whisker_hi"))
    # Both sides hold one row per chosen station (top-k, e.g. 20).
    return q.drop("_iqr").join(F.broadcast(whiskers), "station_id", "left")


def top_stations_by_count(df: DataFrame, n: int = 20) -> DataFrame:
    """T5: the ``n`` stations with most readings (ties by id). TakeOrdered, no full sort."""
    return (df.groupBy("station_id").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc("station_id")).limit(n))


def semi_join_top_stations(df: DataFrame, n: int = 20) -> DataFrame:
    """Rows of the ``n`` busiest stations (left semi join, broadcast n keys)."""
    top = top_stations_by_count(df, n).select("station_id")
    return df.join(F.broadcast(top), "station_id", "left_semi")


def seeded_sample(df: DataFrame, n: int, seed: int, id_col: str = "reading_id") -> DataFrame:
    """At most ``n`` rows without replacement, reproducible by seed.

    Rows are ordered by ``md5(id || seed)``, which gives the same rows in any
    engine. Only rows whose hash lies below a threshold derived from the row
    count are sorted: about ``n`` rows in all partitions together, instead of
    ``n`` of each. Should fewer than ``n`` remain, the threshold is doubled.
    """
    key = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(str(seed))))
    total = df.count()
    share = (n + 6 * n ** 0.5 + 16) / total if total else 1.0
    while share < 1:
        few = df.where(key < F.lit(f"{int(share * 16 ** 12):012x}"))
        if few.select(F.lit(1)).limit(n).count() >= n:
            return few.orderBy(key, F.col(id_col)).limit(n)
        share *= 2
    return df.orderBy(key, F.col(id_col)).limit(n)


def morning_evening_ratio(df: DataFrame, digits: int | None = 3) -> DataFrame:
    """A4: per station mean fill in hours 7-9 over mean in 17-19.

    One group-by with conditional means; a zero or missing evening mean gives
    NULL and the station is dropped; rounded to ``digits`` (None: unrounded).
    """
    h = F.col("hour")
    morning = F.when(h.isin(MORNING_HOURS), F.col(TARGET_RAW))
    evening = F.when(h.isin(EVENING_HOURS), F.col(TARGET_RAW))
    g = df.where(F.col("station_id").isNotNull()).groupBy("station_id").agg(
        exact_mean(morning).alias("_m"), exact_mean(evening).alias("_e"))
    ratio = safe_ratio(F.col("_m"), F.col("_e"))
    if digits is not None:
        ratio = round_half_even(ratio, digits)
    return g.select("station_id", ratio.alias("ratio")).where(F.col("ratio").isNotNull())


def profile_counts(ratios: DataFrame) -> DataFrame:
    """Stations per profile class and share (NULL ratios excluded)."""
    from pyspark.sql import Window
    g = (ratios.withColumn("profile", profile_class("ratio", null_as_mixed=False))
         .where(F.col("profile").isNotNull())
         .groupBy("profile").agg(F.count(F.lit(1)).alias("n_stations")))
    total = F.sum("n_stations").over(Window.partitionBy())   # <= 3 rows
    return g.withColumn("share", round_half_even(F.col("n_stations") / total * F.lit(100.0), 1))


def fill_band_counts(df: DataFrame, value: str = TARGET_RAW, include_lowest: bool = False) -> DataFrame:
    """Counts in (0,20] (20,40] (40,60] (60,80] (80,100]; exact 0 in no band
    unless ``include_lowest``."""
    x = F.col(value)
    expr = None
    for i in range(len(FILL_BANDS) - 1):
        lo, hi = FILL_BANDS[i], FILL_BANDS[i + 1]
        cond = ((x >= lo) if (include_lowest and i == 0) else (x > lo)) & (x <= hi)
        label = F.lit(f"{lo}-{hi}")
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return (df.select(expr.alias("band")).where(F.col("band").isNotNull())
            .groupBy("band").agg(F.count(F.lit(1)).alias("n")))


def trend_correlation(df: DataFrame, a: str = "station_trend_avg", b: str = TARGET_RAW) -> DataFrame:
    """Pearson correlation (6 digits)."""
    return df.agg(round6(F.corr(a, b)).alias("corr"))


def variance_reduction(df: DataFrame, raw: str = TARGET_RAW, res: str = "residual",
                       anomaly: str | None = "temp_anomalie") -> DataFrame:
    """Sample sigma of fill and residual, their ratio, sigma of the anomaly."""
    aggs = [round6(F.stddev_samp(raw)).alias("std_fill"),
            round6(F.stddev_samp(res)).alias("std_residual"),
            round6(F.stddev_samp(raw) / F.stddev_samp(res)).alias("reduction")]
    if anomaly:
        aggs.append(round6(F.stddev_samp(anomaly)).alias("std_temp_anomaly"))
    return df.agg(*aggs)


def station_map_table(readings_clean: DataFrame, ratios: DataFrame) -> DataFrame:
    """Station x (name, lat/lon) x ratio/profile x mean fill, chained left joins.

    The station dimension is the first row per station (K2); all three inputs
    are keyed by station_id, so the joins are co-partitioned on that key.
    """
    from ..sinks.writers import station_dimension
    dim = station_dimension(readings_clean)
    means = mean_fill_by_station(readings_clean)
    out = (dim.join(ratios, "station_id", "left")
           .join(means, "station_id", "left"))
    return out.withColumn("profile", profile_class("ratio", null_as_mixed=True))
