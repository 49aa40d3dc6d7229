"""Per-key registrations of row operators and small composites that the larger
plans use internally (P1-P13, P18-P20, J5, J7, W2, T1, C4, S8, K1, K6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import (capacity_group, cyclic, decode_tf, is_friday_evening, is_frozen,
                         is_monday_morning, is_peak_hour, is_stormy, project_features, truthy_flag,
                         round6, round_half_even, safe_ratio, weather_severity)
from ..operators import clean as C
from ..operators import evaluate as E
from ..operators import profiles as PR
from ..operators.explore import morning_evening_ratio, station_map_table
from ..operators.features import date_parts
from ..schema import FEATURES, TARGET
from ..session import scratch_path
from ..sinks import writers as W
from ..sources.tables import readings
from . import sqltext as Q
from .catalog import output, register
from .evaluation import _ev, _tables, report_tables
from .features import _ft_sql, feature_table, lagged_features


def _r(spark, sf_dir):
    return readings(spark, sf_dir)


@register("decode_tf", f"""WITH {Q.READINGS}
SELECT reading_id, CASE WHEN lower(is_renting) = 't' THEN true WHEN lower(is_renting) = 'f' THEN false END AS is_renting,
  CASE WHEN lower(is_holiday) = 't' THEN true WHEN lower(is_holiday) = 'f' THEN false END AS is_holiday
FROM readings""")
def q_decode_tf(spark, sf_dir):
    return _r(spark, sf_dir).select("reading_id", decode_tf("is_renting").alias("is_renting"),
                                    decode_tf("is_holiday").alias("is_holiday"))


@register("truthy_flag", f"""WITH {Q.READINGS}
SELECT reading_id, CAST({Q.truthy('is_renting')} AS INT) AS is_renting,
  CAST({Q.truthy('is_vacation')} AS INT) AS is_vacation FROM readings""")
def q_truthy(spark, sf_dir):
    return _r(spark, sf_dir).select("reading_id", truthy_flag("is_renting").alias("is_renting"),
                                    truthy_flag("is_vacation").alias("is_vacation"))


@register("bike_totals", f"""WITH {Q.READINGS}
SELECT reading_id, bikes_mechanical + bikes_ebike AS total_bikes,
  bikes_mechanical + bikes_ebike + numdocksavailable AS total_capacity FROM readings""")
def q_totals(spark, sf_dir):
    return C.bike_totals(_r(spark, sf_dir)).select("reading_id", "total_bikes", "total_capacity")


@register("filter_positive_capacity", f"""WITH {Q.READINGS}
SELECT reading_id FROM readings WHERE bikes_mechanical + bikes_ebike + numdocksavailable > 0""")
def q_positive(spark, sf_dir):
    return C.filter_positive_capacity(C.bike_totals(_r(spark, sf_dir))).select("reading_id")


@register("filter_in_service", f"""WITH {Q.READINGS}
SELECT reading_id FROM readings WHERE {Q.truthy('is_renting')}""")
def q_in_service(spark, sf_dir):
    return C.filter_in_service(_r(spark, sf_dir)).select("reading_id")


@register("fill_rate", f"WITH {Q.CLEAN} SELECT reading_id, capacity_status_calc FROM clean")
def q_fill_rate(spark, sf_dir):
    return C.clean_readings(_r(spark, sf_dir)).select("reading_id", "capacity_status_calc")


@register("date_parts", f"""WITH {Q.READINGS}
SELECT reading_id, CAST(hour(datetime) AS INT) AS hour, CAST(isodow(datetime) - 1 AS INT) AS day_of_week,
  CAST(month(datetime) AS INT) AS month, CAST(datetime AS DATE) AS date FROM readings""")
def q_date_parts(spark, sf_dir):
    return date_parts(_r(spark, sf_dir)).select("reading_id", "hour", "day_of_week", "month",
                                                 F.to_date("datetime").alias("date"))


@register("cyclic_encoding", f"WITH {Q.ROWFEAT} SELECT reading_id, hour_sin, hour_cos, dow_sin, dow_cos FROM feat")
def q_cyclic(spark, sf_dir):
    d = date_parts(C.clean_readings(_r(spark, sf_dir)))
    return d.select("reading_id", cyclic("hour", 24, "sin").alias("hour_sin"),
                    cyclic("hour", 24, "cos").alias("hour_cos"),
                    cyclic("day_of_week", 7, "sin").alias("dow_sin"),
                    cyclic("day_of_week", 7, "cos").alias("dow_cos"))


@register("peak_flags", f"""WITH {Q.ROWFEAT}
SELECT reading_id, is_peak_hour, is_friday_evening, is_monday_morning FROM feat""")
def q_peak(spark, sf_dir):
    d = date_parts(C.clean_readings(_r(spark, sf_dir)))
    return d.select("reading_id", is_peak_hour("hour").alias("is_peak_hour"),
                    is_friday_evening("day_of_week", "hour").alias("is_friday_evening"),
                    is_monday_morning("day_of_week", "hour").alias("is_monday_morning"))


@register("capacity_group", f"WITH {Q.READINGS} SELECT reading_id, {Q.capacity_group()} AS capacity_group FROM readings")
def q_capacity_group(spark, sf_dir):
    return _r(spark, sf_dir).select("reading_id", capacity_group("capacity").alias("capacity_group"))


@register("weather_severity", f"WITH {Q.READINGS} SELECT reading_id, {Q.severity()} AS weather_severity FROM readings")
def q_severity(spark, sf_dir):
    return _r(spark, sf_dir).select("reading_id", weather_severity("weather_code").alias("weather_severity"))


@register("frozen_stormy_flags", f"""WITH {Q.ROWFEAT} SELECT reading_id, is_frozen, is_stormy FROM feat""")
def q_frozen(spark, sf_dir):
    r = C.clean_readings(_r(spark, sf_dir))
    return r.select("reading_id", is_frozen("weather_code").alias("is_frozen"),
                    is_stormy("weather_code").alias("is_stormy"))


@register("feature_projection", _ft_sql(f"SELECT {', '.join(FEATURES)} FROM ft"))
def q_projection(spark, sf_dir):
    ft, _, _ = _tables(spark, sf_dir)
    out, missing = project_features(ft, FEATURES)
    if missing:
        raise ValueError(f"missing features {missing}")
    return out


@register("fallback_chain", _ft_sql("""SELECT reading_id, split,
  CASE WHEN l1.station_trend_avg IS NOT NULL THEN 1 WHEN l2.station_trend_fallback IS NOT NULL THEN 2 ELSE 3 END AS tier
  FROM sp LEFT JOIN l1 USING (station_id, day_of_week, hour, month)
          LEFT JOIN l2 USING (station_id, day_of_week, hour)"""))
def q_fallback(spark, sf_dir):
    lagged = lagged_features(_r(spark, sf_dir))
    from ..operators.split import temporal_split
    from ..session import materialize
    sp, _ = temporal_split(materialize(lagged, "lagged"))
    p = PR.fit_profiles(sp.where(F.col("split") == "train"))
    j = (sp.join(p.level1.withColumn("_t1", F.lit(1)), PR.L1, "left")
         .join(p.level2.withColumn("_t2", F.lit(2)), PR.L2, "left"))
    return j.select("reading_id", "split", F.coalesce("_t1", "_t2", F.lit(3)).alias("tier"))


@register("drop_incomplete_rows", f"WITH {Q.LAGGED} SELECT reading_id FROM lagged")
def q_drop_incomplete(spark, sf_dir):
    return lagged_features(_r(spark, sf_dir)).select("reading_id")


@register("scalar_broadcast", _ft_sql("SELECT reading_id, g AS global_mean FROM sp CROSS JOIN gm"))
def q_scalar(spark, sf_dir):
    lagged = lagged_features(_r(spark, sf_dir))
    from ..operators.split import temporal_split
    from ..session import materialize
    sp, _ = temporal_split(materialize(lagged, "lagged"))
    p = PR.fit_profiles(sp.where(F.col("split") == "train"))
    return sp.select("reading_id", F.lit(p.global_mean).cast("double").alias("global_mean"))


@register("station_map_table", f"""WITH {Q.VIZ},
dim AS (SELECT station_id, arg_min(name, datetime) AS name FROM viz WHERE station_id IS NOT NULL GROUP BY station_id),
me AS (SELECT station_id,
  {Q.exact_mean('CASE WHEN hour IN (7,8,9) THEN capacity_status_calc END')} AS mo,
  {Q.exact_mean('CASE WHEN hour IN (17,18,19) THEN capacity_status_calc END')} AS ev,
  {Q.exact_mean('capacity_status_calc')} AS mean_fill FROM viz WHERE station_id IS NOT NULL GROUP BY station_id)
SELECT dim.station_id, dim.name, CASE WHEN mo / nullif(ev, 0) IS NOT NULL THEN mo / nullif(ev, 0) END AS ratio,
  me.mean_fill,
  CASE WHEN mo / nullif(ev, 0) > 1.2 THEN 'residential' WHEN mo / nullif(ev, 0) < 0.8 THEN 'office' ELSE 'mixed' END AS profile
FROM dim LEFT JOIN me ON dim.station_id = me.station_id""")
def q_station_map(spark, sf_dir):
    from .exploration import _viz
    v = _viz(spark, sf_dir)
    return station_map_table(v, morning_evening_ratio(v, digits=None))


@register("temp_anomaly_fitted", _ft_sql("SELECT reading_id, split, temp_anomalie FROM ft"))
def q_temp_anomaly(spark, sf_dir):
    ft, _, _ = _tables(spark, sf_dir)
    return ft.select("reading_id", "split", "temp_anomalie")


@register("sort_station_time", f"WITH {Q.CLEAN} SELECT reading_id, station_id, datetime FROM clean")
def q_sort(spark, sf_dir):
    """Total order by (station, time) as a range-partitioned, per-partition
    sorted write (no single-task global sort), read back."""
    c = C.clean_readings(_r(spark, sf_dir)).select("reading_id", "station_id", "datetime")
    path = scratch_path(spark, "sorted")
    c.repartitionByRange("station_id", "datetime").sortWithinPartitions("station_id", "datetime") \
        .write.parquet(path)
    return output(spark.read.parquet(path))


@register("station_trend", _ft_sql("SELECT reading_id, split, station_trend_avg FROM ft"))
def q_station_trend(spark, sf_dir):
    """C4: A1-A3 on train applied to both splits (J2 + P19), K1 rounding."""
    from ..operators.split import temporal_split
    from ..session import materialize
    from .features import final_rounding
    lagged = materialize(lagged_features(_r(spark, sf_dir)), "lagged")
    sp, _ = temporal_split(lagged)
    p = PR.fit_profiles(sp.where(F.col("split") == "train"))
    out = PR.apply_trend(sp, p).select("reading_id", "split", "station_trend_avg")
    return final_rounding(out)


@register("export_feature_tables", _ft_sql("SELECT * FROM ft"))
def q_export_ft(spark, sf_dir):
    """K1 write (partitioned by split) and S8 checked read-back."""
    ft, _, _ = feature_table(_r(spark, sf_dir))
    path = scratch_path(spark, "features")
    W.export_feature_tables(ft, path)
    return output(W.load_checked(spark, path, required=FEATURES + ["residual", "split"]))


@register("load_features_checked", _ft_sql(f"SELECT {', '.join(FEATURES)}, residual FROM ft WHERE split = 'train'"))
def q_load_checked(spark, sf_dir):
    ft, _, _ = feature_table(_r(spark, sf_dir))
    path = scratch_path(spark, "features")
    W.export_feature_tables(ft, path)
    df = W.load_checked(spark, f"{path}/split=train", required=FEATURES + ["residual"])
    assert W.load_checked(spark, f"{path}/absent", optional=True) is None
    return df.select(*FEATURES, "residual")


REPORT_FINAL = ("""SELECT 'benchmark' AS section, rank AS ord, Modele AS label, MAE AS value FROM board
UNION ALL SELECT 'fill_rate', 1, 'MAE', MAE FROM fr
UNION ALL SELECT 'fill_rate', 2, 'R2', R2 FROM fr
UNION ALL SELECT 'fill_rate', 3, 'P90', p90 FROM p9
UNION ALL SELECT 'fill_rate', 4, 'gain_pct', """ + Q.r('(base - mae) / nullif(base, 0) * 100e0') + """ FROM g
UNION ALL SELECT 'error_histogram', b.bin, b.label,
  coalesce(h.n, 0) / nullif((SELECT count(*) FROM preds WHERE taux_pred IS NOT NULL), 0) * 100e0
  FROM (VALUES """ + ", ".join(f"({i}, '{lab}')" for i, lab in enumerate(E.error_bin_labels())) + """) b(bin, label)
  LEFT JOIN (SELECT CASE """ + " ".join(
    [f"WHEN capacity_status_calc - taux_pred < {E.ERROR_EDGES[0]} THEN 0"]
    + [f"WHEN capacity_status_calc - taux_pred >= {E.ERROR_EDGES[i]} "
       f"AND capacity_status_calc - taux_pred < {E.ERROR_EDGES[i + 1]} THEN {i + 1}"
       for i in range(len(E.ERROR_EDGES) - 1)]
    + [f"WHEN capacity_status_calc - taux_pred >= {E.ERROR_EDGES[-1]} THEN {len(E.ERROR_EDGES)}"])
    + """ END AS bin,
    count(*) AS n FROM preds WHERE taux_pred IS NOT NULL GROUP BY 1) h ON h.bin = b.bin""")


def _report_sql() -> str:
    from .evaluation import _MBASE, _metrics_sql
    extra = (_MBASE + ",\nfr AS (SELECT " + _metrics_sql("capacity_status_calc", "taux_pred")
             + " FROM preds WHERE taux_pred IS NOT NULL),\np9 AS (SELECT "
             + Q.r("quantile_cont(" + Q.r("abs(capacity_status_calc - taux_pred)") + ", 0.9)", 6)
             + " AS p90 FROM preds WHERE taux_pred IS NOT NULL)")
    return _ev(REPORT_FINAL, extra)


@register("report_tables", _report_sql())
def q_report_tables(spark, sf_dir):
    _, train, test = _tables(spark, sf_dir)
    return report_tables(spark, train, test)


_SHARES_SQL = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, coalesce(abs({Q.r(f'covar_pop({f}, residual) / nullif(stddev_pop({f}) * stddev_pop(residual), 0)', 6)}), 0) AS c FROM ft WHERE split = 'train'"
    for f in FEATURES)


def correlation_shares(train):
    """Importance rows (feature, importance) from the table itself: shares of |correlation with the target|."""
    spread = lambda f: F.stddev_pop(f) * F.stddev_pop(TARGET)
    row = train.agg(*[round6(safe_ratio(F.covar_pop(f, TARGET), spread(f))).alias(f) for f in FEATURES]).first()
    c = {f: abs(row[f] or 0.0) for f in FEATURES}
    total = sum(c.values()) or 1.0
    return train.sparkSession.createDataFrame([(f, v / total * 100.0) for f, v in c.items()], "feature string, importance double") \
        .select("feature", round_half_even("importance", 2).alias("importance"))


_TOP_SQL = (f"SELECT feature, {Q.r('c / sum(c) OVER () * 100e0')} AS importance FROM ({_SHARES_SQL}) "
            "ORDER BY importance DESC, feature LIMIT 10")


@register("top_features", _ft_sql(_TOP_SQL))
def q_top_features(spark, sf_dir):
    """T4 over importance rows that SQL can derive."""
    _, train, _ = _tables(spark, sf_dir)
    return E.top_features(correlation_shares(train))


@register("evaluation_report", _report_sql() + f"""
UNION ALL SELECT 'features', 0, feature, importance FROM ({_TOP_SQL})""")
def q_evaluation_report(spark, sf_dir):
    """C7 = T2 T4 A25-A29 -> K6, with the top-features section (T4 over correlation shares)."""
    _, train, test = _tables(spark, sf_dir)
    return report_tables(spark, train, test, correlation_shares(train))
