"""C7 evaluation: predictions, metrics, leaderboard, report tables (K6).

The registered queries score three deterministic predictors fitted on the
training split, so every table is SQL-checkable: the train-mean baseline
(M3), the trend alone (residual 0) and residual persistence
(``lag_res_240min``). pyspark.ml models feed the same operators (see
``dockflow.ml``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exact_mean, profile_class, weekday_label
from ..operators import evaluate as E
from ..operators.explore import profile_by_weekday
from ..functions import clip
from ..schema import BASELINE_NAME, SEVERITY_LABELS, TARGET, TARGET_RAW, WEEKDAY_LABELS
from ..session import materialize
from ..sources.tables import readings
from . import sqltext as Q
from .catalog import output, register
from .features import _ft_sql, feature_table

TREND_ONLY = "Tendance seule"
PERSISTENCE = "Persistance residu 240min"


def _tables(spark: SparkSession, sf_dir: str):
    """The C5 table, written once by split, and its two splits: every metric and fit reads the written table."""
    ft, _, _ = feature_table(readings(spark, sf_dir))
    ft = materialize(ft, "ft", partition_by="split")
    train = ft.where(F.col("split") == "train")
    test = ft.where(F.col("split") == "test")
    return ft, train, test


def train_mean(train: DataFrame) -> float:
    """M3 fit: mean of the training residual (exact)."""
    return train.agg(exact_mean(TARGET).alias("m")).first()["m"]


def predictions(test: DataFrame, model: str, baseline_mean: float | None = None) -> DataFrame:
    """M13 for the deterministic predictors: residual_pred, taux_pred, erreur_absolue."""
    if model == BASELINE_NAME:
        pred = F.lit(float(baseline_mean))
    elif model == TREND_ONLY:
        pred = F.lit(0.0)
    elif model == PERSISTENCE:
        pred = F.col("lag_res_240min")
    else:
        raise KeyError(model)
    return E.prediction_columns(test.withColumn("residual_pred", pred))


def results_table(train: DataFrame, test: DataFrame) -> DataFrame:
    """Residual-scale metrics per predictor (input of T2)."""
    m = train_mean(train)
    base = E.constant_metrics(test, TARGET, m).withColumn("Modele", F.lit(BASELINE_NAME))
    parts = [base]
    for name in (TREND_ONLY, PERSISTENCE):
        p = predictions(test, name)
        parts.append(E.regression_metrics(p, TARGET, "residual_pred", exact=True).withColumn("Modele", F.lit(name)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("Modele", "MAE", "RMSE", "R2")


def best_model(board: DataFrame) -> str:
    return board.where(F.col("rank") == 1).select("Modele").first()["Modele"]


def report_tables(spark: SparkSession, train: DataFrame, test: DataFrame,
                  importance: DataFrame | None = None) -> DataFrame:
    """K6: the report as one long table (section, ord, label, value)."""
    board = E.leaderboard(results_table(train, test))
    bench = board.select(F.lit("benchmark").alias("section"), F.col("rank").alias("ord"),
                         F.col("Modele").alias("label"), F.col("MAE").alias("value"))
    best = best_model(board)
    preds = predictions(test, best, train_mean(train))
    met = E.regression_metrics(preds, TARGET_RAW, "taux_pred", exact=True).first()
    gain = E.gain_vs_mean_baseline(preds, exact=True).first()
    p90 = E.abs_error_percentile(preds).first()["p90"]
    fill = spark.createDataFrame(
        [("fill_rate", 1, "MAE", met["MAE"]), ("fill_rate", 2, "R2", met["R2"]),
         ("fill_rate", 3, "P90", p90), ("fill_rate", 4, "gain_pct", gain["gain_pct"])],
        "section string, ord int, label string, value double")
    hist = E.error_histogram(preds).select(F.lit("error_histogram").alias("section"),
                                           F.col("bin").alias("ord"), "label",
                                           F.col("share").alias("value"))
    parts = [bench, fill, hist]
    if importance is not None:
        top = E.top_features(importance).withColumn("ord", F.lit(0))
        parts.append(top.select(F.lit("features").alias("section"), "ord",
                                F.col("feature").alias("label"), F.col("importance").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------------------
# SQL side
# ---------------------------------------------------------------------------

def _dec(c: str) -> str:
    return f"CAST({c} AS DECIMAL(18,2))"


def _metrics_sql(y: str, p: str) -> str:
    e = f"({_dec(y)} - {_dec(p)})"
    sae, sse = f"CAST(sum(abs({e})) AS DOUBLE)", f"CAST(sum({e} * {e}) AS DOUBLE)"
    sy, syy = f"CAST(sum({_dec(y)}) AS DOUBLE)", f"CAST(sum({_dec(y)} * {_dec(y)}) AS DOUBLE)"
    return (f"{Q.r(f'{sae} / nullif(count(*), 0)', 4)} AS MAE, "
            f"{Q.r(f'sqrt({sse} / nullif(count(*), 0))', 4)} AS RMSE, "
            f"{Q.r(f'1e0 - {sse} / nullif({syy} - {sy} * {sy} / count(*), 0)', 4)} AS R2")


_EVAL_CTES = f"""te AS (SELECT * FROM ft WHERE split = 'test'),
bm AS (SELECT {Q.exact_mean('residual')} AS m FROM ft WHERE split = 'train'),
cs AS (SELECT count(*) AS n, CAST(sum({_dec('residual')}) AS DOUBLE) AS sy,
              CAST(sum({_dec('residual')} * {_dec('residual')}) AS DOUBLE) AS syy,
              coalesce(CAST(sum(CASE WHEN residual > m THEN {_dec('residual')} END) AS DOUBLE), 0e0) AS s_hi,
              count_if(residual > m) AS n_hi,
              coalesce(CAST(sum(CASE WHEN residual < m THEN {_dec('residual')} END) AS DOUBLE), 0e0) AS s_lo,
              count_if(residual < m) AS n_lo, any_value(m) AS m
       FROM te, bm WHERE residual IS NOT NULL),
mres AS (
  SELECT '{BASELINE_NAME}' AS Modele,
         {Q.r('((s_hi - n_hi * m) + (n_lo * m - s_lo)) / nullif(n, 0)', 4)} AS MAE,
         {Q.r('sqrt((syy - 2e0 * m * sy + n * m * m) / nullif(n, 0))', 4)} AS RMSE,
         {Q.r('1e0 - (syy - 2e0 * m * sy + n * m * m) / nullif(syy - sy * sy / n, 0)', 4)} AS R2 FROM cs
  UNION ALL SELECT '{TREND_ONLY}', {_metrics_sql('residual', '0e0')} FROM te
  UNION ALL SELECT '{PERSISTENCE}', {_metrics_sql('residual', 'lag_res_240min')} FROM te
     WHERE lag_res_240min IS NOT NULL),
board AS (SELECT *, CAST(row_number() OVER (ORDER BY MAE, Modele) AS INT) AS rank,
                 row_number() OVER (ORDER BY MAE, Modele) = 1 AS is_best,
                 {Q.r(f"(coalesce((SELECT max(MAE) FROM mres WHERE Modele = '{BASELINE_NAME}'), 99e0) - MAE) / nullif(coalesce((SELECT max(MAE) FROM mres WHERE Modele = '{BASELINE_NAME}'), 99e0), 0) * 100e0")} AS gain_pct
          FROM mres),
pr AS (SELECT te.*, CASE (SELECT Modele FROM board WHERE rank = 1)
                      WHEN '{BASELINE_NAME}' THEN (SELECT m FROM bm)
                      WHEN '{TREND_ONLY}' THEN 0e0 ELSE lag_res_240min END AS residual_pred FROM te),
pr2 AS (SELECT *, CASE WHEN station_trend_avg + residual_pred IS NULL THEN NULL
                       ELSE greatest(0e0, least(100e0, station_trend_avg + residual_pred)) END AS taux_pred FROM pr),
preds AS (SELECT * REPLACE ({Q.r('residual_pred')} AS residual_pred, {Q.r('taux_pred')} AS taux_pred),
                 {Q.r('abs(capacity_status_calc - taux_pred)')} AS erreur_absolue FROM pr2)"""


def _ev(final: str, extra: str = "") -> str:
    """Feature-table CTEs + evaluation CTEs (+ ``extra`` CTEs) + final select."""
    more = f",\n{extra}" if extra else ""
    return f"{_ft_sql('').rstrip()},\n{_EVAL_CTES}{more}\n{final}"


def _best_preds(spark, sf_dir):
    ft, train, test = _tables(spark, sf_dir)
    board = E.leaderboard(results_table(train, test))
    return predictions(test, best_model(board), train_mean(train))


@register("regression_metrics", _ev("SELECT * FROM mres"))
def q_regression_metrics(spark, sf_dir):
    _, train, test = _tables(spark, sf_dir)
    return results_table(train, test)


_RAW_PRED = "(station_trend_avg * 0.98765 + lag_60min * 0.0123457)"


@register("regression_metrics_unrounded", _ev(
    f"SELECT {Q.r('avg(abs(y - p))', 4)} AS MAE, {Q.r('sqrt(avg((y - p) * (y - p)))', 4)} AS RMSE, "
    f"{Q.r('1e0 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))', 4)} AS R2, "
    f"{Q.r('avg(abs(y - m))', 4)} AS baseline_mae FROM u, (SELECT avg(y) AS m FROM u)",
    f"u AS (SELECT CAST(capacity_status_calc AS DOUBLE) AS y, CAST({_RAW_PRED} AS DOUBLE) AS p FROM te "
    "WHERE capacity_status_calc IS NOT NULL AND station_trend_avg IS NOT NULL AND lag_60min IS NOT NULL)"))
def q_metrics_unrounded(spark, sf_dir):
    """A25 / A26 on a predictor with many decimals."""
    _, _, test = _tables(spark, sf_dir)
    d = test.select(F.col(TARGET_RAW).cast("double").alias("y"), F.expr(_RAW_PRED).cast("double").alias("p")).dropna()
    base = E.gain_vs_mean_baseline(d, "y", "p").select("baseline_mae").first()["baseline_mae"]
    return E.regression_metrics(d, "y", "p").withColumn("baseline_mae", F.lit(base))


@register("mean_baseline", _ev("SELECT MAE, RMSE, R2 FROM mres WHERE Modele = 'Baseline (moyenne)'"))
def q_mean_baseline(spark, sf_dir):
    _, train, test = _tables(spark, sf_dir)
    return E.constant_metrics(test, TARGET, train_mean(train))


@register("leaderboard", _ev("SELECT * FROM board"))
def q_leaderboard(spark, sf_dir):
    _, train, test = _tables(spark, sf_dir)
    return E.leaderboard(results_table(train, test))


@register("gap_to_second", _ev(
    f"SELECT {Q.r('max(CASE WHEN rank = 2 THEN MAE END) - max(CASE WHEN rank = 1 THEN MAE END)', 4)} AS gap FROM board"))
def q_gap(spark, sf_dir):
    _, train, test = _tables(spark, sf_dir)
    return E.gap_to_second(E.leaderboard(results_table(train, test)))


@register("clip_reconstruct", _ev("SELECT reading_id, residual_pred, taux_pred FROM preds"))
def q_clip_reconstruct(spark, sf_dir):
    return _best_preds(spark, sf_dir).select("reading_id", "residual_pred", "taux_pred")


@register("abs_error", _ev("SELECT reading_id, erreur_absolue FROM preds"))
def q_abs_error(spark, sf_dir):
    return _best_preds(spark, sf_dir).select("reading_id", "erreur_absolue")


@register("score_and_reconstruct", _ev("SELECT * FROM preds"))
def q_score(spark, sf_dir):
    return output(_best_preds(spark, sf_dir))


@register("reconstructed_metrics", _ev(f"SELECT {_metrics_sql('capacity_status_calc', 'taux_pred')} FROM preds"))
def q_reconstructed_metrics(spark, sf_dir):
    return E.regression_metrics(_best_preds(spark, sf_dir), TARGET_RAW, "taux_pred", exact=True)


_MBASE = f"""mb AS (SELECT CAST(sum({_dec('capacity_status_calc')}) AS DOUBLE) / nullif(count(*), 0) AS m FROM preds),
mb2 AS (SELECT count(*) AS n,
     coalesce(CAST(sum(CASE WHEN capacity_status_calc > m THEN {_dec('capacity_status_calc')} END) AS DOUBLE), 0e0) AS s_hi,
     count_if(capacity_status_calc > m) AS n_hi,
     coalesce(CAST(sum(CASE WHEN capacity_status_calc < m THEN {_dec('capacity_status_calc')} END) AS DOUBLE), 0e0) AS s_lo,
     count_if(capacity_status_calc < m) AS n_lo, any_value(m) AS m,
     CAST(sum(abs({_dec('capacity_status_calc')} - {_dec('taux_pred')})) AS DOUBLE) / nullif(count(*), 0) AS mae
     FROM preds, mb),
g AS (SELECT mae, ((s_hi - n_hi * m) + (n_lo * m - s_lo)) / nullif(n, 0) AS base FROM mb2)"""


@register("gain_vs_mean_baseline", _ev(
    f"SELECT {Q.r('mae', 4)} AS mae, {Q.r('base', 4)} AS baseline_mae, "
    f"{Q.r('(base - mae) / nullif(base, 0) * 100e0')} AS gain_pct FROM g", _MBASE))
def q_gain(spark, sf_dir):
    return E.gain_vs_mean_baseline(_best_preds(spark, sf_dir), exact=True)


_ABS_ERR = Q.r('abs(capacity_status_calc - taux_pred)')


@register("abs_error_percentile", _ev(
    f"SELECT {Q.r(f'quantile_cont({_ABS_ERR}, 0.9)', 6)} AS p90 FROM preds WHERE taux_pred IS NOT NULL"))
def q_p90(spark, sf_dir):
    return E.abs_error_percentile(_best_preds(spark, sf_dir))


@register("error_histogram", _ev("""SELECT b.bin, b.label, coalesce(h.n, 0) AS n,
       coalesce(h.n, 0) / nullif((SELECT count(*) FROM preds WHERE taux_pred IS NOT NULL), 0) * 100e0 AS share
FROM (VALUES """ + ", ".join(f"({i}, '{lab}')" for i, lab in enumerate(E.error_bin_labels())) + """) b(bin, label)
LEFT JOIN (SELECT CASE """ + " ".join(
    [f"WHEN capacity_status_calc - taux_pred < {E.ERROR_EDGES[0]} THEN 0"]
    + [f"WHEN capacity_status_calc - taux_pred >= {E.ERROR_EDGES[i]} AND capacity_status_calc - taux_pred < {E.ERROR_EDGES[i + 1]} THEN {i + 1}"
       for i in range(len(E.ERROR_EDGES) - 1)]
    + [f"WHEN capacity_status_calc - taux_pred >= {E.ERROR_EDGES[-1]} THEN {len(E.ERROR_EDGES)}"]) + """ END AS bin,
       count(*) AS n FROM preds WHERE taux_pred IS NOT NULL GROUP BY 1) h ON h.bin = b.bin"""))
def q_error_histogram(spark, sf_dir):
    return E.error_histogram(_best_preds(spark, sf_dir))


def _label_sql(c: str, labels) -> str:
    whens = " ".join(f"WHEN {i} THEN '{lab}'" for i, lab in enumerate(labels))
    return f"CASE {c} {whens} ELSE CAST({c} AS VARCHAR) END"


_SEV_MAP = _label_sql("weather_severity", SEVERITY_LABELS)


@register("error_by_weather", _ev(f"""SELECT weather_severity,
  {Q.r(f"CAST(sum({_dec('erreur_absolue')}) AS DOUBLE) / count(erreur_absolue)")} AS mae,
  {_SEV_MAP} AS label FROM preds WHERE weather_severity IS NOT NULL GROUP BY weather_severity"""))
def q_error_by_weather(spark, sf_dir):
    return E.error_by_weather(_best_preds(spark, sf_dir))


@register("code_labels", f"""WITH {Q.VIZ}
SELECT day_of_week, {Q.exact_mean('capacity_status_calc')} AS mean_fill,
  {_label_sql('day_of_week', WEEKDAY_LABELS)} AS label FROM viz GROUP BY day_of_week""")
def q_code_labels(spark, sf_dir):
    from .exploration import _viz
    return profile_by_weekday(_viz(spark, sf_dir)).withColumn("label", weekday_label("day_of_week"))


@register("station_profile_class", _ft_sql("""SELECT station_id, ratio,
  CASE WHEN ratio > 1.2 THEN 'residential' WHEN ratio < 0.8 THEN 'office' ELSE 'mixed' END AS profile FROM ra"""))
def q_profile_class(spark, sf_dir):
    from .features import _train
    from ..operators.profiles import fit_profiles
    r = fit_profiles(_train(spark, sf_dir)).ratio
    return r.withColumn("profile", profile_class("ratio"))


@register("profile_counts", _ft_sql("""SELECT profile, count(*) AS n_stations,
  """ + Q.r("count(*) / sum(count(*)) OVER () * 100e0", 1) + """ AS share FROM (
  SELECT CASE WHEN ratio > 1.2 THEN 'residential' WHEN ratio < 0.8 THEN 'office' ELSE 'mixed' END AS profile
  FROM ra) GROUP BY profile"""))
def q_profile_counts(spark, sf_dir):
    from .features import _train
    from ..operators.explore import profile_counts
    from ..operators.profiles import fit_profiles
    return profile_counts(fit_profiles(_train(spark, sf_dir)).ratio)


@register("clip_residual", _ft_sql("""SELECT reading_id, """
                                   "CASE WHEN residual IS NULL THEN NULL ELSE greatest(-50e0, least(50e0, residual)) END"
                                   """ AS residual_clipped FROM ft"""))
def q_clip_residual(spark, sf_dir):
    ft, _, _ = _tables(spark, sf_dir)
    return ft.select("reading_id", clip("residual", -50.0, 50.0).alias("residual_clipped"))


_GAIN = Q.r('(base - mae) / nullif(base, 0) * 100e0')


def _band_sql(expr: str, good: float, fair: float) -> str:
    return (f"CASE WHEN {expr} >= {good} THEN 'good' WHEN {expr} >= {fair} THEN 'fair' "
            f"WHEN {expr} IS NOT NULL THEN 'weak' END")


_VERDICT_FINAL = f"""SELECT gain_pct, corr, variance_reduction, r2, gap,
  {_band_sql('gain_pct', 60.0, 30.0)} AS gain_pct_verdict, {_band_sql('corr', 0.85, 0.7)} AS corr_verdict,
  {_band_sql('variance_reduction', 2.5, 1.5)} AS variance_reduction_verdict,
  {_band_sql('r2', 0.85, 0.7)} AS r2_verdict, gap < 0.1 AS near_tie
FROM (SELECT {_GAIN} AS gain_pct,
  (SELECT {Q.r(Q.no_nan('corr(station_trend_avg, capacity_status_calc)'), 6)} FROM ft WHERE split = 'train') AS corr,
  (SELECT {Q.r('stddev_samp(capacity_status_calc) / stddev_samp(residual)', 6)} FROM ft WHERE split = 'train')
    AS variance_reduction,
  (SELECT R2 FROM fr) AS r2,
  (SELECT {Q.r('max(CASE WHEN rank = 2 THEN MAE END) - max(CASE WHEN rank = 1 THEN MAE END)', 4)} FROM board) AS gap
  FROM g)"""


@register("verdict_bands", _ev(_VERDICT_FINAL, _MBASE + ",\nfr AS (SELECT "
                               + _metrics_sql("capacity_status_calc", "taux_pred")
                               + " FROM preds WHERE taux_pred IS NOT NULL)"))
def q_verdicts(spark, sf_dir):
    """P27 over the one-row frame of A26 gain, A6 corr, A7 ratio, reconstructed R2 and T3 gap."""
    from ..operators.explore import trend_correlation, variance_reduction
    _, train, test = _tables(spark, sf_dir)
    board = E.leaderboard(results_table(train, test))
    preds = predictions(test, best_model(board), train_mean(train))
    vals = {
        "gain_pct": E.gain_vs_mean_baseline(preds, exact=True).first()["gain_pct"],
        "corr": trend_correlation(train).first()["corr"],
        "variance_reduction": variance_reduction(train, anomaly=None).first()["reduction"],
        "r2": E.regression_metrics(preds, TARGET_RAW, "taux_pred", exact=True).first()["R2"],
        "gap": E.gap_to_second(board).first()["gap"],
    }
    row = spark.createDataFrame([tuple(vals.values())], ", ".join(f"{k} double" for k in vals))
    return E.verdicts(row)
