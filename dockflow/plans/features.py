"""Feature build: C2 row features, C3 lagged features, C4 station trend, C5 feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import round_half_even
from ..operators import asof, profiles, split
from ..operators.clean import clean_readings
from ..operators.explore import trend_correlation, variance_reduction
from ..operators.features import row_features
from ..session import materialize
from ..schema import TARGET_RAW
from ..sources.tables import readings
from . import sqltext as Q
from .catalog import output, register

NO_ROUND = ("lat", "lon", "latitude", "longitude")


def lagged_features(raw: DataFrame, bucket_minutes: int | str | None = "auto") -> DataFrame:
    """C3 = C1 + C2 + U2 + J1 x 2 + P20 (one row per station and time, SURVEY §8.2 #13)."""
    feats = row_features(clean_readings(raw))
    # Deterministic keep-first among duplicate polls: by value, then a row hash
    # (one long instead of a sort over every column).
    order = [F.col(TARGET_RAW), F.xxhash64(*[c for c in feats.columns if c not in ("station_id", "datetime")])]
    with_lags = asof.asof_lag(feats, bucket_minutes=bucket_minutes, dedup_order=order)
    return asof.drop_incomplete(with_lags, asof.DEFAULT_LAGS)


def final_rounding(df: DataFrame, digits: int = 2, skip=NO_ROUND) -> DataFrame:
    """K1 rounding: every double column to ``digits`` (half to even), except coordinates."""
    cols = {f.name: round_half_even(f.name, digits) for f in df.schema.fields
            if isinstance(f.dataType, T.DoubleType) and f.name not in skip}
    return df.withColumns(cols)


def feature_table(raw: DataFrame, q: float = 0.80, persist: bool = True,
                  bucket_minutes: int | str | None = "auto") -> tuple[DataFrame, profiles.Profiles, float]:
    """Lagged features -> temporal split -> fitted profiles -> residual target -> K1.

    The lagged frame is written once to the shared checkpoint folder: the
    cutoff, the profile fit and the output all read it back with pruning
    instead of re-running the window shuffle three times.
    """
    lagged = lagged_features(raw, bucket_minutes)
    if persist:
        # Time-ordered files: the split filter and the cutoff search skip row groups.
        lagged = materialize(lagged.sortWithinPartitions("datetime"), "lagged")
    with_split, cutoff = split.temporal_split(lagged, q=q)
    # Same rows as split == 'train', written so that the filter is pushed to the scan.
    train = lagged.where(split.train_condition(cutoff)) if cutoff is not None \
        else with_split.where(F.col("split") == "train")
    prof = profiles.fit_profiles(train, persist=persist)
    out = profiles.apply_ratio(with_split, prof)
    out = profiles.apply_normal(out, prof)
    out = profiles.apply_trend(out, prof)
    out = profiles.residual_target(out)
    return final_rounding(out), prof, cutoff


def station_trend(lagged_train: DataFrame, target: DataFrame) -> DataFrame:
    """C4: A1-A3 fitted on ``lagged_train`` applied to ``target`` (J2 + P19)."""
    prof = profiles.fit_profiles(lagged_train)
    return profiles.apply_trend(target, prof)


# ---------------------------------------------------------------------------
# Registered queries
# ---------------------------------------------------------------------------

_R2 = Q.r


def _ft_sql(final: str) -> str:
    return f"""WITH {Q.LAGGED},
cut AS (SELECT quantile_cont(us, 0.8) AS c FROM lagged),
sp AS (SELECT lagged.*, CASE WHEN us <= c THEN 'train' ELSE 'test' END AS split FROM lagged, cut),
tr AS (SELECT * FROM sp WHERE split = 'train'),
l1all AS (SELECT station_id, day_of_week, hour, month, count(capacity_status_calc) AS n,
                 {Q.exact_mean('capacity_status_calc')} AS m FROM tr
          WHERE station_id IS NOT NULL AND day_of_week IS NOT NULL AND hour IS NOT NULL AND month IS NOT NULL
          GROUP BY station_id, day_of_week, hour, month),
l1 AS (SELECT station_id, day_of_week, hour, month, {_R2('m')} AS station_trend_avg FROM l1all WHERE n >= 3),
l2 AS (SELECT station_id, day_of_week, hour, {_R2(Q.exact_mean('capacity_status_calc'))} AS station_trend_fallback
       FROM tr WHERE station_id IS NOT NULL GROUP BY station_id, day_of_week, hour),
gm AS (SELECT {Q.exact_mean('capacity_status_calc')} AS g FROM tr),
me AS (SELECT station_id,
              {Q.exact_mean('CASE WHEN hour IN (7,8,9) THEN capacity_status_calc END')} AS mo,
              {Q.exact_mean('CASE WHEN hour IN (17,18,19) THEN capacity_status_calc END')} AS ev
       FROM tr WHERE station_id IS NOT NULL GROUP BY station_id),
ra AS (SELECT station_id, {_R2('mo / nullif(ev, 0)', 3)} AS ratio FROM me WHERE mo / nullif(ev, 0) IS NOT NULL),
nm AS (SELECT month, {Q.exact_mean('apparent_temperature')} AS monthly_temp FROM tr GROUP BY month),
j AS (SELECT sp.* EXCLUDE (us),
             coalesce(l1.station_trend_avg, l2.station_trend_fallback, gm.g) AS station_trend_avg,
             {_R2('coalesce(ra.ratio, 1e0)', 3)} AS morning_evening_ratio,
             {_R2('sp.apparent_temperature - nm.monthly_temp')} AS temp_anomalie
      FROM sp
      LEFT JOIN l1 ON sp.station_id = l1.station_id AND sp.day_of_week = l1.day_of_week
                  AND sp.hour = l1.hour AND sp.month = l1.month
      LEFT JOIN l2 ON sp.station_id = l2.station_id AND sp.day_of_week = l2.day_of_week AND sp.hour = l2.hour
      LEFT JOIN ra ON sp.station_id = ra.station_id
      LEFT JOIN nm ON sp.month = nm.month
      CROSS JOIN gm),
res AS (SELECT *, {_R2('lag_240min - station_trend_avg')} AS lag_res_240min,
               {_R2('capacity_status_calc - station_trend_avg')} AS residual FROM j),
ft AS (SELECT * REPLACE ({', '.join(f"{_R2(c)} AS {c}" for c in _DOUBLES)}) FROM res)
{final}"""


_DOUBLES = ["capacity_status_calc", "apparent_temperature", "hour_sin", "hour_cos", "dow_sin",
            "dow_cos", "lag_60min", "lag_240min", "morning_evening_ratio", "temp_anomalie",
            "station_trend_avg", "lag_res_240min", "residual"]

FEATURE_TABLE_SQL = _ft_sql("SELECT * FROM ft")


def _ft(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _, _ = feature_table(readings(spark, sf_dir))
    return out


@register("feature_table", FEATURE_TABLE_SQL)
def q_feature_table(spark, sf_dir):
    return output(_ft(spark, sf_dir))


@register("row_features", f"WITH {Q.ROWFEAT} SELECT * FROM feat")
def q_row_features(spark, sf_dir):
    return output(row_features(clean_readings(readings(spark, sf_dir))))


@register("lagged_features", f"WITH {Q.LAGGED} SELECT * EXCLUDE (us) FROM lagged")
def q_lagged_features(spark, sf_dir):
    return output(lagged_features(readings(spark, sf_dir)))


@register("asof_lag", f"""WITH {Q.ROWFEAT},
withus AS (SELECT *, epoch_us(datetime) AS us FROM feat)
SELECT reading_id, station_id, capacity_status_calc, {Q.lag_expr(60, 'lag_60min')},
       {Q.lag_expr(240, 'lag_240min')} FROM withus""")
def q_asof_lag(spark, sf_dir):
    feats = row_features(clean_readings(readings(spark, sf_dir)))
    return asof.asof_lag(feats).select("reading_id", "station_id", "capacity_status_calc",
                                       "lag_60min", "lag_240min")


@register("lag_audit", f"""WITH {Q.ROWFEAT},
withus AS (SELECT *, epoch_us(datetime) AS us FROM feat),
l AS (SELECT {Q.lag_expr(60, 'lag_60min')}, {Q.lag_expr(240, 'lag_240min')} FROM withus)
SELECT CAST(count_if(lag_60min IS NULL OR lag_240min IS NULL) AS BIGINT) AS rows_dropped,
       CAST(count_if(lag_60min IS NOT NULL AND lag_240min IS NOT NULL) AS BIGINT) AS rows_remaining FROM l""")
def q_lag_audit(spark, sf_dir):
    feats = row_features(clean_readings(readings(spark, sf_dir)))
    return asof.lag_audit(asof.asof_lag(feats))


@register("temporal_quantile_split", f"""WITH {Q.LAGGED},
cut AS (SELECT quantile_cont(us, 0.8) AS c FROM lagged)
SELECT reading_id, CASE WHEN us <= c THEN 'train' ELSE 'test' END AS split FROM lagged, cut""")
def q_temporal_split(spark, sf_dir):
    lagged = lagged_features(readings(spark, sf_dir))
    out, _ = split.temporal_split(lagged)
    return out.select("reading_id", "split")


@register("split_summary", f"""WITH {Q.LAGGED},
cut AS (SELECT quantile_cont(us, 0.8) AS c FROM lagged),
sp AS (SELECT CASE WHEN us <= c THEN 'train' ELSE 'test' END AS split FROM lagged, cut),
g AS (SELECT split, count(*) AS n FROM sp GROUP BY split)
SELECT split, n, {Q.r('n / (SELECT sum(n) FROM g) * 100e0', 1)} AS share,
       (SELECT count(*) FROM (DESCRIBE SELECT * EXCLUDE (us) FROM lagged)) AS n_columns FROM g""")
def q_split_summary(spark, sf_dir):
    lagged = lagged_features(readings(spark, sf_dir))
    out, _ = split.temporal_split(lagged)
    return split.split_summary(out)


def _train(spark, sf_dir):
    lagged = materialize(lagged_features(readings(spark, sf_dir)), "lagged")
    out, cutoff = split.temporal_split(lagged)
    return out.where(split.train_condition(cutoff))


@register("trend_level1", _ft_sql("SELECT station_id, day_of_week, hour, month, n, "
                                  f"{_R2('m')} AS station_trend_avg FROM l1all WHERE n >= 3"))
def q_trend_level1(spark, sf_dir):
    p = profiles.fit_profiles(_train(spark, sf_dir))
    return p.level1.join(p.support, profiles.L1).select(*profiles.L1, "n", "station_trend_avg")


@register("trend_level2", _ft_sql("SELECT * FROM l2"))
def q_trend_level2(spark, sf_dir):
    return profiles.fit_profiles(_train(spark, sf_dir)).level2


@register("global_mean", _ft_sql("SELECT g AS global_mean FROM gm"))
def q_global_mean(spark, sf_dir):
    p = profiles.fit_profiles(_train(spark, sf_dir))
    return spark.createDataFrame([(p.global_mean,)], "global_mean double")


@register("morning_evening_ratio", _ft_sql("SELECT * FROM ra"))
def q_ratio(spark, sf_dir):
    return profiles.fit_profiles(_train(spark, sf_dir)).ratio


@register("monthly_normal", _ft_sql("SELECT * FROM nm"))
def q_monthly_normal(spark, sf_dir):
    return profiles.fit_profiles(_train(spark, sf_dir)).normal


@register("trend_support_audit", _ft_sql(
    "SELECT CAST(count_if(n < 3) AS BIGINT) AS n_ignored, CAST(count_if(n >= 3) AS BIGINT) AS n_valid FROM l1all"))
def q_trend_support(spark, sf_dir):
    return profiles.trend_support_audit(profiles.fit_profiles(_train(spark, sf_dir)))


@register("trend_lookup", _ft_sql("SELECT reading_id, split, station_trend_avg FROM ft"))
def q_trend_lookup(spark, sf_dir):
    return _ft(spark, sf_dir).select("reading_id", "split", "station_trend_avg")


@register("ratio_lookup", _ft_sql("SELECT reading_id, morning_evening_ratio FROM ft"))
def q_ratio_lookup(spark, sf_dir):
    return _ft(spark, sf_dir).select("reading_id", "morning_evening_ratio")


@register("monthly_normal_lookup", _ft_sql("SELECT reading_id, temp_anomalie FROM ft"))
def q_normal_lookup(spark, sf_dir):
    return _ft(spark, sf_dir).select("reading_id", "temp_anomalie")


@register("residual_target", _ft_sql("SELECT reading_id, lag_res_240min, residual FROM ft"))
def q_residual(spark, sf_dir):
    return _ft(spark, sf_dir).select("reading_id", "lag_res_240min", "residual")


@register("trend_correlation", _ft_sql(
    f"SELECT {Q.r(Q.no_nan('corr(station_trend_avg, capacity_status_calc)'), 6)} AS corr "
    "FROM ft WHERE split = 'train'"))
def q_trend_corr(spark, sf_dir):
    return trend_correlation(_ft(spark, sf_dir).where(F.col("split") == "train"))


@register("variance_reduction", _ft_sql(
    f"SELECT {Q.r('stddev_samp(capacity_status_calc)', 6)} AS std_fill, "
    f"{Q.r('stddev_samp(residual)', 6)} AS std_residual, "
    f"{Q.r('stddev_samp(capacity_status_calc) / stddev_samp(residual)', 6)} AS reduction, "
    f"{Q.r('stddev_samp(temp_anomalie)', 6)} AS std_temp_anomaly FROM ft WHERE split = 'train'"))
def q_variance_reduction(spark, sf_dir):
    return variance_reduction(_ft(spark, sf_dir).where(F.col("split") == "train"))
