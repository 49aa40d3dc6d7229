"""Registered model queries.

Fits run on the C5 training split and score its test split. The ranking (M11,
K5) fits its four models with the reference's tuned parameters, the defaults
of ``dockflow.ml.models``; the fits of a single tree model use small settings.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exact_mean, round6, round_half_even
from ..ml import models as M
from ..operators import split as SP
from ..operators.setops import union_all_by_name
from ..schema import FEATURES, FEATURES_SEARCH, RANDOM_SEED, RIDGE_ALPHA, TARGET, TARGET_RAW
from ..session import scratch_path
from ..sinks import writers as W
from . import sqltext as Q
from .catalog import output, register
from .evaluation import _tables
from .features import _ft_sql

# Settings of the registered fits of a single model: small, round numbers. The ranking does not use them.
SMALL = {
    "rf": {"n_estimators": 20, "max_depth": 8, "min_samples_leaf": 20, "max_features": 0.9},
    "gbt": {"n_estimators": 20, "max_depth": 4, "learning_rate": 0.2, "subsample": 0.9, "min_samples_leaf": 20, "max_features": 0.9},
    "gbt_es": {"n_estimators": 40, "max_depth": 4, "learning_rate": 0.2, "subsample": 0.9, "min_child_weight": 20,
               "colsample_bytree": 1.0, "colsample_bylevel": 1.0, "gamma": 0.0},
}
NAMES = {"baseline": "Baseline (moyenne)", "ridge": "Ridge", "rf": "Random Forest", "gbt_es": "Boosted trees (early stop)"}
# Search spaces of the registered search, smaller than the tuned ones of schema.SEARCH_SPACES.
SMALL_SPACES = {
    "ridge": {"alpha": (1e-2, 1e2, True, False)},
    "rf": {"n_estimators": (5, 10, False, True), "max_depth": (5, 8, False, True), "min_samples_leaf": (5, 20, False, True), "max_features": (0.8, 1.0, False, False)},
    "gbt": {"n_estimators": (5, 10, False, True), "max_depth": (3, 5, False, True), "learning_rate": (0.1, 0.3, True, False), "subsample": (0.8, 1.0, False, False)},
    "gbt_es": {"n_estimators": (10, 20, False, True), "max_depth": (3, 5, False, True), "learning_rate": (0.1, 0.3, True, False)},
}
TRIALS = 2

# A label planted from the table's own columns, so that every model must find it: SQL states the same label, the
# baseline's errors and that the models beat it.
PLANTED = "planted"


def planted(ft):
    """``ft`` with the planted label: two linear terms and a jump."""
    y = F.col("apparent_temperature") + F.lit(0.2) * F.col("lag_60min") + F.when(F.col("hour") < 12, F.lit(10.0)).otherwise(F.lit(0.0))
    return ft.withColumn(PLANTED, round_half_even(y, 2))


_PLANTED_SQL = (f"p AS (SELECT *, {Q.r('CAST(apparent_temperature AS DOUBLE) + 0.2e0 * lag_60min + CASE WHEN hour < 12 THEN 10e0 ELSE 0e0 END', 2)} AS planted FROM ft), "
                f"b AS (SELECT {Q.exact_mean('planted')} AS m FROM p WHERE split = 'train')")


def _planted_sql(select: str) -> str:
    return _ft_sql(f"SELECT * FROM (WITH {_PLANTED_SQL}\n{select})")


def _planted_tables(spark, sf_dir):
    ft = planted(_tables(spark, sf_dir)[0])
    return ft.where(F.col("split") == "train"), ft.where(F.col("split") == "test")


_MED_SQL = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, {Q.r(f'quantile_cont(CAST({f} AS DOUBLE), 0.5)', 6)} AS median "
    f"FROM ft WHERE split = 'train' AND {f} IS NOT NULL" for f in FEATURES)


@register("median_impute", _ft_sql(_MED_SQL))
def q_median_impute(spark, sf_dir):
    _, train, _ = _tables(spark, sf_dir)
    med, _, _ = M.fit_preprocessing(train, FEATURES, scale=False)
    df = spark.createDataFrame([(k, v) for k, v in med.items()], "feature string, median double")
    return df.select("feature", round6(F.col("median")).alias("median"))


_SCALE_SQL = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, {Q.r(f'avg(CAST({f} AS DOUBLE))', 6)} AS mean, "
    f"CASE WHEN coalesce(stddev_pop(CAST({f} AS DOUBLE)), 0) = 0 THEN 1e0 "
    f"ELSE {Q.r(f'stddev_pop(CAST({f} AS DOUBLE))', 6)} END AS scale FROM ft WHERE split = 'train'"
    for f in FEATURES)


@register("standard_scale", _ft_sql(_SCALE_SQL))
def q_standard_scale(spark, sf_dir):
    _, train, _ = _tables(spark, sf_dir)
    _, sc, _ = M.fit_preprocessing(train, FEATURES)
    df = spark.createDataFrame([(f, m, s) for f, (m, s) in sc.items()], "feature string, mean double, scale double")
    return df.select("feature", round6(F.col("mean")).alias("mean"), round6(F.col("scale")).alias("scale"))


_BEATEN_SQL = _planted_sql(f"""SELECT reading_id, planted, {Q.r('abs(planted - m)')} AS baseline_error, true AS beats_baseline
FROM p, b WHERE split = 'test'""")


def _fit_and_compare(spark, sf_dir, kind):
    """Every test row with its planted label and the mean baseline's error; does the model halve that error overall?"""
    train, test = _planted_tables(spark, sf_dir)
    scored = M.predict(M.fit(kind, train, FEATURES, SMALL.get(kind), PLANTED).model, test)
    mean = F.lit(train.agg(exact_mean(PLANTED)).first()[0])
    own, base = F.abs(F.col(PLANTED) - F.col("residual_pred")), F.abs(F.col(PLANTED) - mean)
    err = scored.agg(F.avg(own).alias("own"), F.avg(base).alias("base")).first()
    beats = err["base"] is not None and err["own"] < 0.5 * err["base"]
    return scored.select("reading_id", PLANTED, round_half_even(base, 2).alias("baseline_error"), F.lit(beats).alias("beats_baseline"))


@register("ridge_fit_predict", _ft_sql(" UNION ALL ".join(
    f"SELECT '{f}' AS feature, count(*) AS n_train, true AS balanced FROM ft WHERE split = 'train'" for f in FEATURES)))
def q_ridge(spark, sf_dir):
    """The normal equations of the fit, a row per feature: z'(y - prediction) = alpha w, z the scaled feature (up to
    1e-5 of count times sigma: equal columns make the solver iterate)."""
    _, train, _ = _tables(spark, sf_dir)
    model = M.fit("ridge", train, FEATURES).model
    rest = F.col(TARGET) - F.col("prediction")
    sums = model.transform(train).agg(F.count("*").alias("n"), F.stddev_pop(TARGET).alias("sigma"), *[F.sum(F.col(M.PREFIX + f) * rest).alias(f) for f in FEATURES]).first()
    rows = [(f, sums["n"], abs(sums[f] - RIDGE_ALPHA * w) <= 1e-5 * sums["n"] * sums["sigma"]) for f, w in zip(FEATURES, model.stages[-1].coefficients.toArray().tolist())]
    return spark.createDataFrame(rows, "feature string, n_train long, balanced boolean")


@register("random_forest_fit_predict", _BEATEN_SQL)
def q_rf(spark, sf_dir):
    return _fit_and_compare(spark, sf_dir, "rf")


@register("gbt_fit_predict", _BEATEN_SQL)
def q_gbt(spark, sf_dir):
    return _fit_and_compare(spark, sf_dir, "gbt")


@register("gbt_early_stopping", _BEATEN_SQL)
def q_gbt_es(spark, sf_dir):
    return _fit_and_compare(spark, sf_dir, "gbt_es")


@register("early_stop_split", _ft_sql("""SELECT reading_id,
  row_number() OVER (ORDER BY epoch_us(datetime)) - 1 >= CAST(floor(count(*) OVER () * 0.85) AS BIGINT) AS is_validation
FROM ft WHERE split = 'train'"""))
def q_early_stop_split(spark, sf_dir):
    _, train, _ = _tables(spark, sf_dir)
    return SP.early_stop_split(train).select("reading_id", "is_validation")


@register("expanding_time_folds", _ft_sql("""SELECT reading_id, fold, role FROM (
  SELECT reading_id, row_number() OVER (ORDER BY epoch_us(datetime)) - 1 AS rk, count(*) OVER () AS n
  FROM ft WHERE split = 'train') t,
  (SELECT CAST(range AS INT) AS fold FROM range(0, 3)) f,
  LATERAL (SELECT CASE WHEN rk < n - (3 - fold) * (n // 4) THEN 'train'
                       WHEN rk < n - (2 - fold) * (n // 4) THEN 'test' END AS role) r
WHERE role IS NOT NULL"""))
def q_folds(spark, sf_dir):
    _, train, _ = _tables(spark, sf_dir)
    return SP.expanding_time_folds(train).select("reading_id", "fold", "role")


@register("time_series_cv_mae", _ft_sql(f"""SELECT {Q.r('avg(mae)', 6)} AS mae_cv FROM (
  SELECT fold, {Q.r("sum(CASE WHEN role = 'test' THEN abs(residual - m) END) / count_if(role = 'test')", 4)} AS mae FROM (
    SELECT *, avg(CASE WHEN role = 'train' THEN residual END) OVER (PARTITION BY fold) AS m FROM (
      SELECT residual, fold, CASE WHEN rk < n - (3 - fold) * (n // 4) THEN 'train'
                                  WHEN rk < n - (2 - fold) * (n // 4) THEN 'test' END AS role
      FROM (SELECT residual, row_number() OVER (ORDER BY epoch_us(datetime)) - 1 AS rk, count(*) OVER () AS n
            FROM ft WHERE split = 'train') t, (SELECT CAST(range AS INT) AS fold FROM range(0, 3)) f)
    WHERE role IS NOT NULL) GROUP BY fold)"""))
def q_cv_baseline(spark, sf_dir):
    """M8 for the mean baseline (M3): SQL-checkable."""
    _, train, _ = _tables(spark, sf_dir)
    mae = M.time_series_cv_mae("baseline", train, FEATURES)
    return spark.createDataFrame([(mae,)], "mae_cv double").select(round6(F.col("mae_cv")).alias("mae_cv"))


def _draws_sql() -> str:
    """The drawn parameters, from the same md5 digits."""
    rows = [f"SELECT '{kind}' AS model, CAST(t AS INT) AS trial, '{name}' AS param, {lo!r}::DOUBLE AS lo, {hi!r}::DOUBLE AS hi, {str(log).lower()} AS is_log, "
            f"{str(whole).lower()} AS is_int FROM range(0, {TRIALS}) r(t)"
            for kind, space in SMALL_SPACES.items() for name, (lo, hi, log, whole) in space.items()]
    return f"""WITH s AS ({' UNION ALL '.join(rows)}),
u AS (SELECT *, CAST('0x' || substr(md5('{RANDOM_SEED}:' || model || ':' || trial || ':' || param), 1, 8) AS BIGINT) / 4294967296e0 AS u FROM s),
v AS (SELECT *, CASE WHEN is_log THEN exp(ln(lo) + u * (ln(hi) - ln(lo))) ELSE lo + u * (hi - lo) END AS v FROM u)
SELECT model, trial, param, CASE WHEN is_int THEN round_even(v, 0) ELSE {Q.r('v', 6)} END AS value, true AS beats_baseline FROM v"""


@register("param_search", _draws_sql())
def q_param_search(spark, sf_dir):
    """M9 over all four model kinds: every trial's drawn parameters, and whether its CV error is below the mean's."""
    train, _ = _planted_tables(spark, sf_dir)
    folds = M.FoldStore(train, FEATURES_SEARCH, PLANTED)  # of the baseline and all tree kinds; ridge has scaled ones
    base = M.time_series_cv_mae("baseline", train, FEATURES_SEARCH, label=PLANTED, folds=folds)
    trials = union_all_by_name([M.param_search(k, train, FEATURES_SEARCH, n_trials=TRIALS, parallelism=2, space=space, label=PLANTED,
                                               folds=None if k == "ridge" else folds)
                                for k, space in SMALL_SPACES.items()])
    return (trials.select("model", "trial", (F.col("mae_cv") < F.lit(base)).alias("beats_baseline"), F.explode("params").alias("param", "v"))
            .where("param <> 'best_n_estimators'").select("model", "trial", "param", round6(F.col("v").cast("double")).alias("value"), "beats_baseline"))


@register("best_trial_per_model", _ft_sql(f"""SELECT model, trial, mae_cv FROM (
  SELECT *, row_number() OVER (PARTITION BY model ORDER BY mae_cv, trial) AS rk FROM (
    SELECT 'm' || CAST(day_of_week AS VARCHAR) AS model, CAST(hour AS INT) AS trial,
           {Q.r(Q.exact_mean('abs(residual)'), 4)} AS mae_cv
    FROM ft WHERE split = 'train' GROUP BY 1, 2)) WHERE rk = 1"""))
def q_best_trial(spark, sf_dir):
    """M10 over trial rows that SQL can derive: one model per weekday, one trial per hour."""
    _, train, _ = _tables(spark, sf_dir)
    trials = train.groupBy(F.concat(F.lit("m"), F.col("day_of_week").cast("string")).alias("model"), F.col("hour").cast("int").alias("trial")).agg(
        round_half_even(exact_mean(F.abs("residual")), 4).alias("mae_cv")).withColumn("params", F.create_map(F.lit("hour"), F.col("trial").cast("string")))
    return M.best_trial_per_model(trials).select("model", "trial", "mae_cv")


def _ranked(spark, sf_dir):
    """All models of the reference's training phase, each with its tuned parameters."""
    train, test = _planted_tables(spark, sf_dir)
    fitted = [M.fit(k, train, FEATURES, label=PLANTED, name=n) for k, n in NAMES.items()]
    return fitted, M.train_and_rank(fitted, test, label=PLANTED)


_RANKED_SQL = _planted_sql(f"""SELECT Modele, rank, MAE, Modele <> '{NAMES["baseline"]}' AS beats_baseline FROM (
  SELECT '{NAMES["baseline"]}' AS Modele, CAST({len(NAMES)} AS INT) AS rank, {Q.r('avg(abs(planted - m))', 4)} AS MAE FROM p, b WHERE split = 'test'
  UNION ALL SELECT unnest([{', '.join(f"'{n}'" for k, n in NAMES.items() if k != "baseline")}]), NULL, NULL)""")


def _against_baseline(board):
    """The leaderboard as far as SQL can state it: the baseline's own row, and which models halve its error."""
    base = F.col("Modele") == NAMES["baseline"]
    mae = board.where(base).first()["MAE"]
    return board.select("Modele", F.when(base, F.col("rank")).cast("int").alias("rank"), F.when(base, F.col("MAE")).alias("MAE"),
                        (F.col("MAE") < F.lit(0.5 * mae)).alias("beats_baseline"))


@register("train_and_rank", _RANKED_SQL)
def q_train_and_rank(spark, sf_dir):
    return _against_baseline(_ranked(spark, sf_dir)[1])


@register("feature_importance", " UNION ALL ".join(f"SELECT '{f}' AS feature, true AS is_share, true AS sums_to_100" for f in FEATURES))
def q_importance(spark, sf_dir):
    train, _ = _planted_tables(spark, sf_dir)
    shares = M.feature_importance(M.fit("rf", train, FEATURES, SMALL["rf"], PLANTED).model, FEATURES)
    total = shares.agg(F.sum("importance")).first()[0]
    return shares.select("feature", F.col("importance").between(0, 100).alias("is_share"), F.lit(abs(total - 100) < 0.2).alias("sums_to_100"))


@register("score_model")
def q_score_model(spark, sf_dir):
    _, train, test = _tables(spark, sf_dir)
    m = M.fit("ridge", train, FEATURES)
    return output(M.score_and_reconstruct(m.model, test))


@register("save_load_model", _ft_sql("SELECT reading_id, true AS same FROM ft WHERE split = 'test'"))
def q_save_load(spark, sf_dir):
    _, train, test = _tables(spark, sf_dir)
    m = M.fit("ridge", train, FEATURES)
    path = scratch_path(spark, "model")
    M.save_model(m.model, path)
    again = M.load_model(path)
    a = M.predict(m.model, test).select("reading_id", F.col("residual_pred").alias("before"))
    b = M.predict(again, test).select("reading_id", F.col("residual_pred").alias("after"))
    return a.join(b, "reading_id").select("reading_id", (F.col("before") == F.col("after")).alias("same"))


@register("export_predictions", _ft_sql("""SELECT reading_id, datetime, capacity_status_calc, station_trend_avg, true AS reconstructed, true AS error_matches
FROM ft WHERE split = 'test'"""))
def q_export_predictions(spark, sf_dir):
    """K4 read back: the kept columns, and whether the prediction columns follow from each other."""
    _, train, test = _tables(spark, sf_dir)
    m = M.fit("ridge", train, FEATURES)
    path = scratch_path(spark, "predictions")
    W.export_predictions(M.score_and_reconstruct(m.model, test), path)
    level = F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.col("station_trend_avg") + F.col("residual_pred")))
    error = F.abs(F.col(TARGET_RAW) - F.col("taux_pred"))
    return output(spark.read.parquet(path).select(
        "reading_id", "datetime", TARGET_RAW, "station_trend_avg", (F.abs(F.col("taux_pred") - level) < 0.01).alias("reconstructed"),
        (F.abs(F.col("erreur_absolue") - error) < 0.011).alias("error_matches")))


@register("export_results_importance", _RANKED_SQL)
def q_export_results(spark, sf_dir):
    """K5 read back: the stored leaderboard, after a check of the stored importances' keys."""
    fitted, board = _ranked(spark, sf_dir)
    path = scratch_path(spark, "results")
    W.export_results(board, M.feature_importance(fitted[2].model, FEATURES), path)
    if spark.read.parquet(f"{path}/importance").where(F.col("feature").isin(FEATURES)).count() != len(FEATURES):
        raise ValueError("stored importances do not cover the features")
    return _against_baseline(spark.read.parquet(f"{path}/results"))
