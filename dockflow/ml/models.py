"""Model operators on ``pyspark.ml``.

Pre-processing is fitted in one aggregation each and frozen into a built-in
``SQLTransformer`` (median imputation M1, population-sigma scaling M2), so a
fitted ``PipelineModel`` is made of stock stages only and saves / loads with
the standard writers (M14). Models are Spark estimators; only metric rows
and parameter maps reach the driver.
"""

from __future__ import annotations

import hashlib
import math
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import (GBTRegressionModel, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import round_half_even
from ..operators import evaluate as E
from ..operators import split as SP
from ..session import materialize
from ..schema import (BASELINE_NAME, GBT_PARAMS, RANDOM_SEED, RF_PARAMS, RIDGE_ALPHA, SEARCH_SPACES,
                      TARGET, TARGET_RAW, XGB_PARAMS)

PREFIX = "f__"
# Boosting rounds grown between two looks at the holdout (M7).
BLOCK_ROUNDS = 25


def _q(name: str) -> str:
    return f"`{name}`"


# ---------------------------------------------------------------------------
# M1 / M2: fitted statistics
# ---------------------------------------------------------------------------

def fit_medians(train: DataFrame, features: Sequence[str]) -> dict[str, float | None]:
    """M1: exact median (linear interpolation) of each feature on the training rows.

    One pass: rows are unpivoted to (feature, value), reduced to distinct
    (feature, value, count) map-side, and each feature's percentile runs on
    those counts. Features are rounded to 2 digits by K1, so each buffer is
    bounded by the value range, not by the row count.
    """
    stack = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"),
                                         F.col(f).cast("double").alias("v")) for f in features]))
    pairs = (train.select(stack.alias("p")).select("p.*").where(F.col("v").isNotNull())
             .groupBy("feature", "v").agg(F.count(F.lit(1)).alias("c")))
    med = pairs.groupBy("feature").agg(F.percentile("v", F.lit(0.5), F.col("c")).alias("median"))
    got = {r["feature"]: r["median"] for r in med.collect()}  # one row per feature
    return {f: got.get(f) for f in features}


def fit_scaling(train: DataFrame, features: Sequence[str], medians: dict) -> dict[str, tuple[float, float]]:
    """M2: mean and population sigma of each (imputed) feature; sigma 0 -> 1."""
    aggs = []
    for f in features:
        x = F.coalesce(F.col(f).cast("double"), F.lit(medians.get(f)))
        aggs += [F.avg(x).alias(f"m_{f}"), F.stddev_pop(x).alias(f"s_{f}")]
    row = train.agg(*aggs).first()
    out = {}
    for f in features:
        m, s = row[f"m_{f}"], row[f"s_{f}"]
        out[f] = (m or 0.0, s if s else 1.0)
    return out


def fit_preprocessing(train: DataFrame, features: Sequence[str], label: str | None = None,
                      scale: bool = True):
    """M1 + M2 (+ label moments) in one aggregation.

    One pass takes count, mean and population variance of every column (Spark
    merges centred moments, so large means lose nothing) and each feature's
    exact median, whose buffer holds its distinct values with counts (bounded
    by the value range, as in ``fit_medians``). Mean and sigma after median
    imputation follow from these: the NULLs are
    ``n_null`` copies of the median. Returns
    ``(medians, scaling or None, (n, sigma_label) or None)``.
    """
    cols = list(features) + ([label] if label else [])
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"k{i}"), F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}")]
        if i < len(features):
            aggs.append(F.percentile(x, F.lit(0.5)).alias(f"d{i}"))
    moments = train.agg(*aggs).first()
    n = moments["n"]
    medians = {f: moments[f"d{i}"] for i, f in enumerate(features)}
    scaling = {} if scale else None
    for i, f in enumerate(features if scale else ()):
        k, m, v, med = moments[f"k{i}"], moments[f"m{i}"], moments[f"v{i}"], medians[f]
        if not k:
            scaling[f] = (0.0, 1.0)
            continue
        mean = m + (med - m) * (n - k) / n
        var = (k * (v + (m - mean) ** 2) + (n - k) * (med - mean) ** 2) / n
        scaling[f] = (mean, math.sqrt(var) if var > 0 else 1.0)
    label_stats = None
    if label:
        i = len(features)
        if moments[f"k{i}"]:
            label_stats = (moments[f"k{i}"], math.sqrt(moments[f"v{i}"]))
    return medians, scaling, label_stats


def preprocess_stage(features: Sequence[str], medians: dict, scaling: dict | None) -> SQLTransformer:
    """Frozen M1 (+ M2) as a SQL stage producing ``f__<feature>`` columns."""
    exprs = []
    for f in features:
        med = medians.get(f)
        x = f"COALESCE(CAST({_q(f)} AS DOUBLE), {repr(float(med)) if med is not None else 'CAST(NULL AS DOUBLE)'})"
        if scaling is not None:
            m, s = scaling[f]
            x = f"(({x}) - ({float(m)!r})) / ({float(s)!r})"
        exprs.append(f"{x} AS {_q(PREFIX + f)}")
    return SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__")


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=[PREFIX + f for f in features], outputCol="features",
                           handleInvalid="keep")


# ---------------------------------------------------------------------------
# Model builders (M3-M7)
# ---------------------------------------------------------------------------

@dataclass
class Fitted:
    name: str
    model: PipelineModel
    seconds: float
    info: dict


def mean_baseline(train: DataFrame, label: str = TARGET) -> PipelineModel:
    """M3: predict the training mean of the label (a frozen SQL stage)."""
    m = train.agg(F.avg(label)).first()[0]
    stage = SQLTransformer(statement=f"SELECT *, CAST({float(m)!r} AS DOUBLE) AS prediction FROM __THIS__")
    return PipelineModel(stages=[stage])


def build_pipeline(kind: str, train: DataFrame, features: Sequence[str], params: dict | None = None,
                   label: str = TARGET, seed: int = RANDOM_SEED) -> Pipeline:
    """Imputer (+ scaler for the linear model) -> assembler -> regressor."""
    medians, scaling, label_stats = fit_preprocessing(train, features, label if kind in ("ridge", "gbt_es") else None,
                                                      scale=kind == "ridge")
    return Pipeline(stages=[preprocess_stage(features, medians, scaling), assembler(features),
                            regressor(kind, params, label, label_stats, seed)])


def regressor(kind: str, params: dict | None, label: str = TARGET, label_stats: tuple[int, float] | None = None,
              seed: int = RANDOM_SEED):
    """The estimator of a model kind over assembled ``features``; ``label_stats``: count and sigma of the label."""
    params = dict(params or {})
    if kind == "ridge":
        alpha = params.get("alpha", RIDGE_ALPHA)
        n_y, s_y = label_stats if label_stats else (1, 1.0)
        # sklearn Ridge(alpha) = Spark regParam alpha / n * sigma_pop(y) .
        reg = LinearRegression(labelCol=label, featuresCol="features", solver="normal",
                               elasticNetParam=0.0, standardization=False, fitIntercept=True,
                               regParam=alpha / n_y * (s_y or 1.0))
    elif kind == "rf":
        p = {**RF_PARAMS, **params}
        reg = RandomForestRegressor(labelCol=label, featuresCol="features", seed=seed,
                                    numTrees=int(p["n_estimators"]), maxDepth=int(p["max_depth"]),
                                    minInstancesPerNode=int(p["min_samples_leaf"]),
                                    featureSubsetStrategy=str(float(p["max_features"])),
                                    maxBins=int(p.get("max_bins", 32)),
                                    # every task of an executor holds a batch of node statistics of this size;
                                    # node ids cached for deep trees (2x faster at depth 15)
                                    maxMemoryInMB=int(p.get("max_memory_mb", 256)), cacheNodeIds=True)
    elif kind == "gbt":
        p = {**GBT_PARAMS, **params}
        reg = GBTRegressor(labelCol=label, featuresCol="features", seed=seed,
                           maxIter=int(p["n_estimators"]), maxDepth=int(p["max_depth"]),
                           stepSize=float(p["learning_rate"]), subsamplingRate=float(p["subsample"]),
                           minInstancesPerNode=int(p.get("min_samples_leaf", 1)),
                           featureSubsetStrategy=str(float(p.get("max_features", 1.0))),
                           maxMemoryInMB=int(p.get("max_memory_mb", 1024)), cacheNodeIds=True)
    elif kind == "gbt_es":
        # XGBoost-like boosting (M7); the number of rounds is chosen afterwards
        # on a time-ordered holdout by ``fit`` (patience, MAE). A split's loss
        # reduction (gamma) is summed over rows there, a mean per row here.
        p = {**XGB_PARAMS, **params}
        columns = float(p.get("colsample_bytree", 1.0)) * float(p.get("colsample_bylevel", 1.0))
        n_fit = label_stats[0] if label_stats else 1
        reg = GBTRegressor(labelCol=label, featuresCol="features", seed=seed,
                           maxIter=int(p["n_estimators"]), maxDepth=int(p["max_depth"]),
                           stepSize=float(p["learning_rate"]), subsamplingRate=float(p["subsample"]),
                           minInstancesPerNode=int(p.get("min_child_weight", 1)),
                           featureSubsetStrategy=str(columns) if columns < 1 else "all",
                           minInfoGain=2 * float(p.get("gamma", 0.0)) / n_fit,
                           lossType=str(p.get("loss", "squared")),
                           maxMemoryInMB=int(p.get("max_memory_mb", 1024)), cacheNodeIds=True)
    else:
        raise KeyError(kind)
    return reg


def fit(kind: str, train: DataFrame, features: Sequence[str], params: dict | None = None,
        label: str = TARGET, name: str | None = None) -> Fitted:
    """Fit one model and time it. ``gbt_es`` adds the 85/15 time holdout."""
    t0 = time.time()
    if kind == "baseline":
        model = mean_baseline(train, label)
        return Fitted(name or BASELINE_NAME, model, time.time() - t0, {})
    if kind == "gbt_es":
        model, info = _fit_early_stopped(train, features, params, label)
        return Fitted(name or kind, model, time.time() - t0, info)
    model = build_pipeline(kind, train, features, params, label).fit(train)
    info = {}
    last = model.stages[-1]
    if hasattr(last, "getNumTrees"):
        info["n_trees"] = last.getNumTrees
    return Fitted(name or kind, model, time.time() - t0, info)


def best_rounds(errors: Sequence[float], patience: int) -> int:
    """Rounds kept by early stopping: the best iteration seen before
    ``patience`` rounds pass without improvement (1-based count)."""
    best, best_i = math.inf, 0
    for i, e in enumerate(errors):
        if e < best:
            best, best_i = e, i
        elif i - best_i >= patience:
            break
    return best_i + 1


def joined_trees(parts: Sequence[GBTRegressionModel], keep: int) -> GBTRegressionModel:
    """One boosted model of the first ``keep`` trees of several, in order, with the columns of the first."""
    sc = SparkContext.getOrCreate()  # the active session is not known in a search's threads
    jvm, first = sc._jvm, parts[0]
    grown = [(t, w) for p in parts for t, w in zip(p._java_obj.trees(), p.treeWeights, strict=True)][:keep]
    trees = sc._gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(grown))
    weights = sc._gateway.new_array(jvm.double, len(grown))
    for i, (t, w) in enumerate(grown):
        trees[i] = t
        weights[i] = float(w)
    cut = jvm.org.apache.spark.ml.regression.GBTRegressionModel(f"{first.uid}_{keep}", trees, weights, int(first.numFeatures))
    out = GBTRegressionModel(cut)
    out._resetUid(cut.uid())
    for name in ("labelCol", "featuresCol", "predictionCol"):
        value = first.getOrDefault(name)
        cut.set(cut.getParam(name), value)
        out._set(**{name: value})
    return out


def first_trees(gbt: GBTRegressionModel, keep: int) -> GBTRegressionModel:
    """The boosted model cut to its first ``keep`` trees, with the same columns."""
    return joined_trees([gbt], keep)


@dataclass
class Holdout:
    """M7's preprocessed rows, written once: assembled training rows before the cut (W5) and validation rows behind it."""

    stages: list
    rows: DataFrame
    holdout: DataFrame | None
    label_stats: tuple[int, float] | None


def hold_out(train: DataFrame, features: Sequence[str], label: str = TARGET, ratio: float = 0.85, ts: str = "datetime") -> Holdout:
    """The last part of the training time is held out; medians come from the rows before it."""
    cut = SP.early_stop_cutoff(train, ts, ratio)
    early = train if cut is None else train.where(SP.before(cut, ts))
    if early.limit(1).count() == 0:
        raise ValueError("too few training rows for the 85/15 early-stopping split")
    medians, _, stats = fit_preprocessing(early, features, label, scale=False)
    stages = [preprocess_stage(features, medians, None), assembler(features)]
    ready = PipelineModel(stages=stages)
    rows = lambda df: materialize(ready.transform(df).select("features", label), "boost")
    return Holdout(stages, rows(early), None if cut is None else rows(train.where(~SP.before(cut, ts))), stats)


def _fit_early_stopped(train: DataFrame | None, features: Sequence[str], params: dict | None,
                       label: str, patience: int = 50, ratio: float = 0.85, held: Holdout | None = None):
    """M7: boosting stopped on the last 15 % of the training time.

    Trees are grown in blocks of ``BLOCK_ROUNDS``. Between blocks the rows are
    written with the residual that is left, and the next block boosts that
    residual (its first tree takes a full step, as the first tree of any
    ``GBTRegressor`` does). ``evaluateEachIteration`` gives the holdout MAE
    after each round of a block. A block never reaches further than
    ``patience`` rounds behind the best one, so at most that many rounds are
    grown in vain. The model is that of the best round; its count is
    returned, not the upper bound. A search passes ``held`` to share the
    prepared rows between trials.
    """
    p = {**XGB_PARAMS, **(params or {})}
    patience, n_max = int(p.get("early_stopping_rounds", patience)), int(p["n_estimators"])
    held = held or hold_out(train, features, label, ratio)
    rows, holdout = held.rows, held.holdout
    blocks, errors, grown, keep = [], [], 0, 0
    while grown < n_max:
        size = min(BLOCK_ROUNDS, n_max - grown, keep + patience - grown) if errors else min(BLOCK_ROUNDS, n_max)
        if holdout is None:
            size = n_max
        if size <= 0:
            break
        model = regressor("gbt_es", {**p, "n_estimators": size}, label, held.label_stats, RANDOM_SEED + grown).fit(rows)
        blocks.append(model)
        grown += size
        keep = grown
        if holdout is not None:
            errors += model.evaluateEachIteration(holdout, "absolute")
            keep = best_rounds(errors, patience)
        if grown < n_max and grown < keep + patience:
            left = lambda df: materialize(model.transform(df).select("features", (F.col(label) - F.col("prediction")).alias(label)), "boost")  # noqa: B023, E731
            rows, holdout = left(rows), left(holdout)
    return PipelineModel(stages=[*held.stages, joined_trees(blocks, keep)]), {
        "n_trees": keep, "n_max": n_max, "n_grown": grown, "holdout_mae": float(errors[keep - 1]) if errors else None}


# ---------------------------------------------------------------------------
# M11-M14
# ---------------------------------------------------------------------------

def predict(model: PipelineModel, df: DataFrame, out: str = "residual_pred") -> DataFrame:
    p = model.transform(df).withColumnRenamed("prediction", out)
    return p.drop("features", *[c for c in p.columns if c.startswith(PREFIX)])


def train_and_rank(models: Sequence[Fitted], test: DataFrame, label: str = TARGET,
                   truth: str = TARGET_RAW) -> DataFrame:
    """Residual metrics, reconstructed R2 and fit time per model, ranked."""
    spark = test.sparkSession
    rows = []
    for m in models:
        p = E.reconstruct(predict(m.model, test))
        res = E.regression_metrics(p, label, "residual_pred", exact=False).first()
        rec = E.regression_metrics(p, truth, "taux_pred", exact=False).first()
        rows.append((m.name, res["MAE"], res["RMSE"], res["R2"], rec["R2"], round(m.seconds, 1)))
    results = spark.createDataFrame(
        rows, "Modele string, MAE double, RMSE double, R2 double, R2_reconstruit double, Temps double")
    return E.leaderboard(results)


def feature_importance(model: PipelineModel, features: Sequence[str]) -> DataFrame | None:
    """Tree impurity shares, or |coef| normalised for linear models; x100, 2 digits."""
    spark = SparkSession.getActiveSession()
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        imp = last.featureImportances.toArray()
    elif hasattr(last, "coefficients"):
        c = np.abs(last.coefficients.toArray())
        imp = c / c.sum() if c.sum() else c
    else:
        return None
    rows = [(f, float(v) * 100.0) for f, v in zip(features, imp)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.select("feature", round_half_even("importance", 2).alias("importance")) \
        .orderBy(F.desc("importance"), "feature")


def score_and_reconstruct(model: PipelineModel, test: DataFrame) -> DataFrame:
    """residual_pred, taux_pred = clip(trend + residual_pred), erreur_absolue."""
    return E.prediction_columns(predict(model, test))


def save_model(model: PipelineModel, path: str) -> None:
    """M14."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# ---------------------------------------------------------------------------
# Time-series CV, search, best trial
# ---------------------------------------------------------------------------

@dataclass
class Fold:
    train: DataFrame
    test: DataFrame
    label_stats: tuple[int, float] | None
    mean: float


class FoldStore:
    """W4's folds ready for fitting: each fold's rows imputed (and scaled), assembled and written once.

    Folds are time ranges of ``train``, so each is read by a pushed-down
    filter. Medians and scales are those of the fold's own training rows.
    Trials only fit and score; they share what is written here.
    """

    def __init__(self, train: DataFrame, features: Sequence[str], label: str = TARGET, n_splits: int = 3, scale: bool = False,
                 ts: str = "datetime"):
        self.folds = []
        for lo, end in SP.fold_cutoffs(train, ts, n_splits):
            past, block = train.where(SP.before(lo, ts)), train.where(~SP.before(lo, ts))
            block = block if end is None else block.where(SP.before(end, ts))
            medians, scaling, stats = fit_preprocessing(past, features, label, scale=scale)
            ready = PipelineModel(stages=[preprocess_stage(features, medians, scaling), assembler(features)])
            rows = [materialize(ready.transform(df).select("features", label), "fold") for df in (past, block)]
            self.folds.append(Fold(*rows, stats, past.agg(F.avg(label)).first()[0]))


def time_series_cv_mae(kind: str, train: DataFrame | None, features: Sequence[str], params: dict | None = None,
                       label: str = TARGET, n_splits: int = 3, folds: FoldStore | None = None) -> float:
    """M8: mean MAE over expanding time folds (W4); fit on a fold's past, score its block."""
    folds = folds or FoldStore(train, features, label, n_splits, kind == "ridge")
    maes = []
    for f in folds.folds:
        if kind == "baseline":
            p = f.test.withColumn("prediction", F.lit(f.mean))
        else:
            p = regressor(kind, params, label, f.label_stats).fit(f.train).transform(f.test)
        maes.append(E.regression_metrics(p, label, "prediction", exact=False).first()["MAE"])
    return float(np.mean(maes))


def uniform(seed: int, kind: str, trial: int, name: str) -> float:
    """A repeatable draw from [0, 1): the first 8 hex digits of md5('seed:kind:trial:name')."""
    return int(hashlib.md5(f"{seed}:{kind}:{trial}:{name}".encode()).hexdigest()[:8], 16) / 2 ** 32


def draw_params(kind: str, n: int, seed: int = RANDOM_SEED, space: dict | None = None) -> list[dict]:
    """Seeded random draws from a search space of (low, high, log scale, integer), log-uniform where marked.

    A trial's parameters depend on nothing but seed, kind, trial and name.
    """
    out = []
    for i in range(n):
        p = {}
        for k, (lo, hi, log, integer) in (space or SEARCH_SPACES[kind]).items():
            u = uniform(seed, kind, i, k)
            v = math.exp(math.log(lo) + u * (math.log(hi) - math.log(lo))) if log else lo + u * (hi - lo)
            p[k] = int(round(v)) if integer else float(v)
        out.append(p)
    return out


TRIALS_SCHEMA = "model string, trial int, params map<string,string>, mae_cv double"


def param_search(kind: str, train: DataFrame, features: Sequence[str], n_trials: int,
                 seed: int = RANDOM_SEED, parallelism: int = 2, space: dict | None = None,
                 label: str = TARGET, done: Sequence[int] = (),
                 on_trial: Callable[[DataFrame], None] | None = None, folds: FoldStore | None = None) -> DataFrame:
    """M9: trials table (model, trial, params, mae_cv); candidates run as
    concurrent Spark jobs from a small driver thread pool.

    Trial i has the same parameters whatever ran before, so a search resumes
    with the trials that are not ``done``. ``on_trial`` gets each finished
    trial as a one-row frame (to store it at once). A trial of the
    early-stopped booster first finds its number of trees (M7), is then
    cross-validated with it and records it as ``best_n_estimators``. Searches
    of several kinds may share ``folds`` (scaled ones for ridge only).
    """
    spark = train.sparkSession
    folds = folds or FoldStore(train, features, label, scale=kind == "ridge")
    held = hold_out(train, features, label) if kind == "gbt_es" else None
    trials = [(i, p) for i, p in enumerate(draw_params(kind, n_trials, seed, space)) if i not in set(done)]

    def run(i_p):
        i, p = i_p
        cv = p
        if kind == "gbt_es":
            _, info = _fit_early_stopped(None, features, p, label, held=held)
            p = {**p, "best_n_estimators": info["n_trees"]}
            cv = {**p, "n_estimators": info["n_trees"]}
        row = (kind, i, {k: repr(v) for k, v in p.items()},
               time_series_cv_mae(kind, train, features, cv, label, folds=folds))
        if on_trial:
            on_trial(spark.createDataFrame([row], TRIALS_SCHEMA))
        return row

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        rows = list(pool.map(run, trials))
    return spark.createDataFrame(rows, TRIALS_SCHEMA)


def read_trials(spark: SparkSession, path: str) -> DataFrame:
    """All stored trials below ``path`` (one folder per trial)."""
    return spark.read.schema(TRIALS_SCHEMA).option("recursiveFileLookup", True).parquet(path)


def best_trial_per_model(trials: DataFrame) -> DataFrame:
    """Best trial per model by CV MAE (ties by trial number)."""
    best = trials.groupBy("model").agg(
        F.min_by(F.struct("trial", "params", "mae_cv"), F.struct("mae_cv", "trial")).alias("b"))
    return best.select("model", "b.trial", "b.params", "b.mae_cv")


def models_to_tune(requested: DataFrame, trials: DataFrame) -> DataFrame:
    """M10 resume: models without any trial yet (left anti join)."""
    return requested.join(trials.select("model").distinct(), "model", "left_anti")
