"""C6 exploration prep and the exploration queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import weather_severity
from ..operators import clean as C
from ..operators import explore as X
from ..operators.features import date_parts, monthly_anomaly_transform
from ..schema import TARGET_RAW
from ..sources.tables import readings
from . import sqltext as Q
from .catalog import output, register


def viz_prepared(df: DataFrame) -> DataFrame:
    """Clean readings + date parts + weather severity (no lags)."""
    return date_parts(C.clean_readings(df)).withColumn(
        "weather_severity", weather_severity("weather_code"))


def _viz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viz_prepared(readings(spark, sf_dir))


@register("viz_prepared", f"WITH {Q.VIZ} SELECT * FROM viz")
def q_viz_prepared(spark, sf_dir):
    return output(_viz(spark, sf_dir))


@register("profile_by_hour", f"""WITH {Q.VIZ}
SELECT hour, {Q.exact_mean('capacity_status_calc')} AS mean_fill FROM viz GROUP BY hour""")
def q_profile_by_hour(spark, sf_dir):
    return X.profile_by_hour(_viz(spark, sf_dir))


@register("profile_by_weekday", f"""WITH {Q.VIZ}
SELECT day_of_week, {Q.exact_mean('capacity_status_calc')} AS mean_fill FROM viz GROUP BY day_of_week""")
def q_profile_by_weekday(spark, sf_dir):
    return X.profile_by_weekday(_viz(spark, sf_dir))


@register("weather_impact", f"""WITH {Q.VIZ}
SELECT weather_severity, count(*) AS n, {Q.exact_mean('capacity_status_calc')} AS mean_fill
FROM viz GROUP BY weather_severity""")
def q_weather_impact(spark, sf_dir):
    return X.weather_impact(_viz(spark, sf_dir))


@register("mean_fill_by_station", f"""WITH {Q.VIZ}
SELECT station_id, {Q.exact_mean('capacity_status_calc')} AS mean_fill FROM viz
WHERE station_id IS NOT NULL GROUP BY station_id""")
def q_mean_fill_by_station(spark, sf_dir):
    return X.mean_fill_by_station(_viz(spark, sf_dir))


@register("vacation_impact", f"""WITH {Q.VIZ},
g AS (SELECT CAST({Q.truthy('is_vacation')} AS INT) AS vacation,
             {Q.exact_mean('capacity_status_calc')} AS mean_fill FROM viz GROUP BY 1)
SELECT * FROM g WHERE (SELECT count(*) FROM g) >= 2""")
def q_vacation_impact(spark, sf_dir):
    return X.vacation_impact(_viz(spark, sf_dir))


# Coverage works on the raw readings (before cleaning), as in the reference.
@register("readings_per_day", f"""WITH {Q.READINGS}
SELECT CAST(datetime AS DATE) AS date, count(*) AS n FROM readings GROUP BY 1""")
def q_readings_per_day(spark, sf_dir):
    return X.readings_per_day(readings(spark, sf_dir))


@register("readings_per_weekday", f"""WITH {Q.READINGS}
SELECT CAST(isodow(datetime) - 1 AS INT) AS day_of_week, count(*) AS n FROM readings GROUP BY 1""")
def q_readings_per_weekday(spark, sf_dir):
    return X.readings_per_weekday(readings(spark, sf_dir))


@register("coverage_summary", f"""WITH {Q.READINGS},
g AS (SELECT count(*) AS n_rows, count(DISTINCT station_id) AS n_stations,
             min(datetime) AS first_ts, max(datetime) AS last_ts FROM readings)
SELECT *, CAST(floor((epoch_us(last_ts) - epoch_us(first_ts)) / 86400000000) AS BIGINT) AS n_days,
       {Q.r('CAST(floor((epoch_us(last_ts) - epoch_us(first_ts)) / 86400000000) AS BIGINT) / 7e0', 1)} AS n_weeks
FROM g""")
def q_coverage_summary(spark, sf_dir):
    return output(X.coverage_summary(readings(spark, sf_dir)))


@register("fill_mean_median", f"""WITH {Q.VIZ}
SELECT {Q.exact_mean('capacity_status_calc')} AS mean_fill,
       {Q.r('quantile_cont(capacity_status_calc, 0.5)', 6)} AS median_fill FROM viz""")
def q_fill_mean_median(spark, sf_dir):
    return X.fill_mean_median(_viz(spark, sf_dir))


_HIST_SQL = """WITH {viz},
mm AS (SELECT min(capacity_status_calc) AS lo, max(capacity_status_calc) AS hi FROM viz),
b AS (SELECT CAST(least(floor((capacity_status_calc - lo) / (hi - lo) * {n}e0), {n1}) AS INT) AS bin, count(*) AS n
      FROM viz, mm WHERE capacity_status_calc IS NOT NULL GROUP BY 1),
f AS (SELECT CAST(range AS INT) AS bin FROM range(0, {n}))
SELECT f.bin, lo + f.bin * ((hi - lo) / {n}) AS bin_lo, lo + (f.bin + 1) * ((hi - lo) / {n}) AS bin_hi,
       coalesce(b.n, 0) AS n
FROM f CROSS JOIN mm LEFT JOIN b ON b.bin = f.bin"""


@register("equiwidth_histogram", _HIST_SQL.format(viz=Q.VIZ, n=50, n1=49))
def q_equiwidth_histogram(spark, sf_dir):
    return X.equiwidth_histogram(_viz(spark, sf_dir), TARGET_RAW, 50)


_NAMED_HIST_SQL = """{ctes},
mm AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
b AS (SELECT CASE WHEN hi > lo THEN least(CAST(floor((x - lo) / (hi - lo) * {n}e0) AS INT), {n1}) ELSE 0 END AS bin, count(*) AS n
      FROM v, mm WHERE x IS NOT NULL GROUP BY 1),
f AS (SELECT CAST(range AS INT) AS bin FROM range(0, {n}))
SELECT f.bin, coalesce(b.n, 0) AS n FROM f LEFT JOIN b ON b.bin = f.bin"""


@register("anomaly_histogram", _NAMED_HIST_SQL.format(n=60, n1=59, ctes=f"""WITH {Q.VIZ},
am AS (SELECT month, {Q.exact_mean('apparent_temperature')} AS mm FROM viz GROUP BY month),
v AS (SELECT viz.apparent_temperature - am.mm AS x FROM viz LEFT JOIN am ON viz.month = am.month)"""))
def q_anomaly_histogram(spark, sf_dir):
    """A12 of the monthly temperature anomaly (60 bins)."""
    return X.equiwidth_histogram(monthly_anomaly_transform(_viz(spark, sf_dir)), "temp_anom", 60).select("bin", "n")


@register("ratio_histogram", _NAMED_HIST_SQL.format(n=40, n1=39, ctes=f"""WITH {Q.VIZ},
me AS (SELECT station_id, {Q.exact_mean('CASE WHEN hour IN (7,8,9) THEN capacity_status_calc END')} AS mo,
  {Q.exact_mean('CASE WHEN hour IN (17,18,19) THEN capacity_status_calc END')} AS ev FROM viz WHERE station_id IS NOT NULL GROUP BY station_id),
v AS (SELECT mo / nullif(ev, 0) AS x FROM me)"""))
def q_ratio_histogram(spark, sf_dir):
    """A12 of the stations' morning / evening ratio (40 bins)."""
    ratios = X.morning_evening_ratio(_viz(spark, sf_dir), digits=None).where("station_id IS NOT NULL")
    return X.equiwidth_histogram(ratios, "ratio", 40).select("bin", "n")


@register("top_stations_by_count", f"""WITH {Q.VIZ}
SELECT station_id, count(*) AS n FROM viz GROUP BY station_id ORDER BY n DESC, station_id LIMIT 20""")
def q_top_stations(spark, sf_dir):
    return X.top_stations_by_count(_viz(spark, sf_dir))


@register("semi_join_top_stations", f"""WITH {Q.VIZ},
top AS (SELECT station_id FROM viz GROUP BY station_id ORDER BY count(*) DESC, station_id LIMIT 20)
SELECT * FROM viz WHERE station_id IN (SELECT station_id FROM top)""")
def q_semi_join_top(spark, sf_dir):
    return output(X.semi_join_top_stations(_viz(spark, sf_dir)))


@register("boxplot_by_station", f"""WITH {Q.VIZ},
top AS (SELECT station_id FROM viz GROUP BY station_id ORDER BY count(*) DESC, station_id LIMIT 20),
r AS (SELECT * FROM viz WHERE station_id IN (SELECT station_id FROM top)),
q AS (SELECT station_id, {Q.r('quantile_cont(capacity_status_calc, 0.25)', 6)} AS q1,
             {Q.r('quantile_cont(capacity_status_calc, 0.5)', 6)} AS median,
             {Q.r('quantile_cont(capacity_status_calc, 0.75)', 6)} AS q3 FROM r GROUP BY station_id),
w AS (SELECT r.station_id, min(capacity_status_calc) AS whisker_lo, max(capacity_status_calc) AS whisker_hi
      FROM r JOIN q ON r.station_id = q.station_id
      WHERE capacity_status_calc >= q1 - 1.5e0 * (q3 - q1) AND capacity_status_calc <= q3 + 1.5e0 * (q3 - q1)
      GROUP BY r.station_id)
SELECT q.*, w.whisker_lo, w.whisker_hi FROM q LEFT JOIN w ON q.station_id = w.station_id""")
def q_boxplot(spark, sf_dir):
    v = _viz(spark, sf_dir)
    return X.boxplot_by_station(v, X.top_stations_by_count(v))


@register("seeded_sample", f"""WITH {Q.VIZ}
SELECT * FROM viz ORDER BY md5(CAST(reading_id AS VARCHAR) || '42'), reading_id LIMIT 4000""")
def q_seeded_sample(spark, sf_dir):
    return output(X.seeded_sample(_viz(spark, sf_dir), 4000, 42))


@register("fill_band_counts", f"""WITH {Q.VIZ},
b AS (SELECT CASE WHEN capacity_status_calc > 0 AND capacity_status_calc <= 20 THEN '0-20'
                  WHEN capacity_status_calc > 20 AND capacity_status_calc <= 40 THEN '20-40'
                  WHEN capacity_status_calc > 40 AND capacity_status_calc <= 60 THEN '40-60'
                  WHEN capacity_status_calc > 60 AND capacity_status_calc <= 80 THEN '60-80'
                  WHEN capacity_status_calc > 80 AND capacity_status_calc <= 100 THEN '80-100' END AS band
      FROM viz)
SELECT band, count(*) AS n FROM b WHERE band IS NOT NULL GROUP BY band""")
def q_fill_bands(spark, sf_dir):
    return X.fill_band_counts(_viz(spark, sf_dir))


@register("monthly_anomaly_transform", f"""WITH {Q.VIZ},
m AS (SELECT month, {Q.exact_mean('apparent_temperature')} AS mm FROM viz GROUP BY month)
SELECT viz.reading_id, viz.month, viz.apparent_temperature,
       {Q.r('viz.apparent_temperature - m.mm', 6)} AS temp_anom
FROM viz LEFT JOIN m ON viz.month = m.month""")
def q_monthly_anomaly(spark, sf_dir):
    from ..functions import round6
    out = monthly_anomaly_transform(_viz(spark, sf_dir))
    return out.select("reading_id", "month", "apparent_temperature",
                      round6(F.col("temp_anom")).alias("temp_anom"))


@register("cleaning_audit", f"""WITH {Q.READINGS},
t AS (SELECT *, bikes_mechanical + bikes_ebike + numdocksavailable AS total_capacity FROM readings)
SELECT count(*) AS rows_in, CAST(count_if(total_capacity = 0) AS BIGINT) AS zero_capacity_removed,
       CAST(count_if(total_capacity > 0 AND NOT {Q.truthy('is_renting')}) AS BIGINT) AS out_of_service_removed,
       CAST(count_if(total_capacity > 0 AND {Q.truthy('is_renting')}) AS BIGINT) AS rows_kept,
       CAST(count_if(total_capacity > 0 AND {Q.truthy('is_renting')} AND ({Q.capacity_group()}) IS NULL) AS BIGINT)
         AS capacity_out_of_bins FROM t""")
def q_cleaning_audit(spark, sf_dir):
    return C.cleaning_audit(readings(spark, sf_dir))


@register("clean_readings", f"WITH {Q.CLEAN} SELECT * FROM clean")
def q_clean_readings(spark, sf_dir):
    return output(C.clean_readings(readings(spark, sf_dir)))


@register("scan_readings", f"WITH {Q.READINGS} SELECT * FROM readings")
def q_scan_readings(spark, sf_dir):
    return output(readings(spark, sf_dir))
