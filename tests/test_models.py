"""M1/M2/M4 against numpy, trees beat the mean baseline on a planted signal, M14 reload."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockflow.ml import models as M
from dockflow.operators import evaluate as E
from dockflow.session import scratch_path

FEATS = ["x1", "x2", "x3"]


def _planted(spark, n=2000, seed=11):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(0, 1, (n, 3)) * [1, 2, 3], 2)
    y = np.round(3 * x[:, 0] - 2 * x[:, 1] + 0.5 * x[:, 2] + 7 + rng.normal(0, 0.3, n), 2)
    rows = [(float(a), float(b), float(c), float(t)) for (a, b, c), t in zip(x, y)]
    rows[0] = (None, rows[0][1], rows[0][2], rows[0][3])           # one missing value
    df = spark.createDataFrame(rows, "x1 double, x2 double, x3 double, residual double")
    return df, x, y


def test_median_and_scaling(spark):
    df, x, _ = _planted(spark)
    med = M.fit_medians(df, FEATS)
    assert med["x2"] == pytest.approx(float(np.median(x[:, 1])))
    assert med["x1"] == pytest.approx(float(np.median(x[1:, 0])))
    sc = M.fit_scaling(df, FEATS, med)
    assert sc["x3"][1] == pytest.approx(float(np.std(x[:, 2])), rel=1e-12)


def test_ridge_matches_closed_form(spark):
    df, x, y = _planted(spark)
    alpha = 50.0
    m = M.fit("ridge", df, FEATS, {"alpha": alpha})
    coef = m.model.stages[-1].coefficients.toArray()
    # closed form on the same imputed + standardized design
    med = M.fit_medians(df, FEATS)
    X = x.copy()
    X[0, 0] = med["x1"]
    Z = (X - X.mean(0)) / X.std(0)
    yc = y - y.mean()
    w = np.linalg.solve(Z.T @ Z + alpha * np.eye(3), Z.T @ yc)
    assert np.allclose(coef, w, rtol=1e-6, atol=1e-8)


def test_trees_beat_baseline_and_reload(spark):
    df, _, _ = _planted(spark)
    train, test = df.limit(1500), df.subtract(df.limit(1500))
    base = M.fit("baseline", train, FEATS)
    small = {"n_estimators": 15, "max_depth": 5, "min_samples_leaf": 5, "max_features": 1.0}
    rf = M.fit("rf", train, FEATS, small)
    gbt = M.fit("gbt", train, FEATS, {"n_estimators": 15, "max_depth": 3, "learning_rate": 0.3,
                                      "subsample": 1.0})

    def mae(model):
        p = M.predict(model, test)
        return E.regression_metrics(p, "residual", "residual_pred", exact=False).first().MAE
    mb = mae(base.model)
    assert mae(rf.model) < mb and mae(gbt.model) < mb
    path = scratch_path(spark, "t-model")
    M.save_model(rf.model, path)
    again = M.load_model(path)
    a = M.predict(rf.model, test).select("x1", "x2", "x3", F.col("residual_pred").alias("a"))
    b = M.predict(again, test).select("x1", "x2", "x3", F.col("residual_pred").alias("b"))
    assert a.join(b, ["x1", "x2", "x3"]).where(F.col("a") != F.col("b")).count() == 0
    imp = M.feature_importance(rf.model, FEATS).collect()
    assert imp[0].feature == "x3" or imp[0].feature == "x2"
    assert sum(r.importance for r in imp) == pytest.approx(100.0, abs=0.05)


def test_best_rounds_patience():
    assert M.best_rounds([5, 4, 3, 3.5, 3.2, 3.1, 2.9], 50) == 7
    assert M.best_rounds([5, 4, 3, 3.5, 3.6, 3.7, 2.0], 3) == 3     # stopped before the late dip
    assert M.best_rounds([1.0], 50) == 1


def test_gbt_early_stopping_keeps_best_count(spark):
    df, _, _ = _planted(spark)
    df = df.withColumn("datetime", F.timestamp_seconds(F.monotonically_increasing_id()))
    m = M.fit("gbt_es", df, FEATS, {"n_estimators": 30, "max_depth": 3, "learning_rate": 0.3,
                                    "subsample": 1.0, "min_child_weight": 5, "early_stopping_rounds": 5})
    assert 1 <= m.info["n_trees"] <= m.info["n_max"] == 30
    assert len(m.model.stages[-1].trees) == m.info["n_trees"]
    assert m.info["n_trees"] <= m.info["n_grown"] <= m.info["n_trees"] + 5


def test_boosting_in_blocks_stops_saves_and_scores(spark, monkeypatch, tmp_path):
    """Noise behind a step: a few rounds help, then the holdout gets worse; grown rounds stay within the patience."""
    monkeypatch.setattr(M, "BLOCK_ROUNDS", 4)
    rng = np.random.default_rng(5)
    x = np.round(rng.uniform(-1, 1, (600, 3)), 2)
    rows = [(float(a), float(b), float(c), float(10 * (a > 0) + rng.normal(0, 3))) for a, b, c in x]
    df = spark.createDataFrame(rows, "x1 double, x2 double, x3 double, residual double").withColumn("datetime", F.timestamp_seconds(F.monotonically_increasing_id()))
    df = M.materialize(df, "t-rows")
    p = {"n_estimators": 60, "max_depth": 4, "learning_rate": 0.3, "subsample": 1.0, "min_child_weight": 2, "gamma": 0.0, "early_stopping_rounds": 6,
         "colsample_bytree": 1.0, "colsample_bylevel": 1.0}
    m = M.fit("gbt_es", df, FEATS, p)
    keep, grown = m.info["n_trees"], m.info["n_grown"]
    assert keep <= grown <= keep + 6 and grown < 60
    cut = M.SP.early_stop_cutoff(df)
    hold = df.where(~M.SP.before(cut))
    scored = m.model.transform(hold)
    assert scored.select(F.avg(F.abs(F.col("residual") - F.col("prediction")))).first()[0] == pytest.approx(m.info["holdout_mae"])
    m.model.write().overwrite().save(str(tmp_path / "m"))
    again = M.PipelineModel.load(str(tmp_path / "m")).transform(hold)
    assert [r.prediction for r in again.select("prediction").collect()] == pytest.approx([r.prediction for r in scored.select("prediction").collect()])


def test_fold_store_equals_fits_of_each_fold(spark):
    df, _, _ = _planted(spark, 400)
    df = M.materialize(df.withColumn("datetime", F.timestamp_seconds(F.monotonically_increasing_id() % 97)), "t-rows")
    folds = M.SP.expanding_time_folds(df)
    for kind, params in (("ridge", {"alpha": 5.0}), ("baseline", None)):
        want = []
        for i in range(3):
            tr, te = (folds.where((F.col("fold") == i) & (F.col("role") == r)) for r in ("train", "test"))
            p = M.predict(M.fit(kind, tr, FEATS, params).model, te)
            want.append(E.regression_metrics(p, "residual", "residual_pred", exact=False).first()["MAE"])
        assert M.time_series_cv_mae(kind, df, FEATS, params) == pytest.approx(np.mean(want), rel=1e-6)
    plan = df.where(M.SP.before(M.SP.fold_cutoffs(df)[0][0]))._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(datetime), LessThan(datetime" in plan


def test_preprocessing_keeps_digits_of_large_means(spark):
    rows = [(1e9, 1.0, 0.5), (1e9 + 1, None, 1.5), (1e9 + 2, 5.0, 2.5), (None, 9.0, None)]
    med, sc, label = M.fit_preprocessing(spark.createDataFrame(rows, "a double, b double, y double"), ["a", "b"], "y")
    a = np.array([1e9, 1e9 + 1, 1e9 + 2, 1e9 + 1]) - 1e9
    assert med == {"a": 1e9 + 1, "b": 5.0}
    assert sc["a"] == pytest.approx((1e9 + a.mean(), a.std()), rel=1e-9)
    assert sc["b"] == pytest.approx((5.0, np.std([1, 5, 5, 9])))
    assert label == (3, pytest.approx(np.std([0.5, 1.5, 2.5])))


def test_truncated_booster_is_the_first_trees(spark, tmp_path):
    rng = np.random.default_rng(3)
    x = rng.uniform(-1, 1, (400, 2))
    df = spark.createDataFrame([(float(a), float(b), float(a * a + b)) for a, b in x], "a double, b double, y double")
    full = M.build_pipeline("gbt_es", df, ["a", "b"], {"n_estimators": 6, "max_depth": 2, "subsample": 1.0, "min_child_weight": 1,
                                                       "colsample_bytree": 1.0, "colsample_bylevel": 1.0, "gamma": 0.0}, "y").fit(df)
    gbt = full.stages[-1]
    cut = M.PipelineModel(stages=[*full.stages[:-1], M.first_trees(gbt, 3)])
    got = [r.prediction for r in cut.transform(df).select("prediction").collect()]
    part = full.transform(df).select("features").collect()
    want = [sum(w * t.predict(r.features) for t, w in zip(gbt.trees[:3], gbt.treeWeights[:3])) for r in part[:20]]
    assert got[:20] == pytest.approx(want)
    cut.write().overwrite().save(str(tmp_path / "m"))
    again = M.PipelineModel.load(str(tmp_path / "m"))
    assert [r.prediction for r in again.transform(df).select("prediction").collect()] == pytest.approx(got)
    assert len(again.stages[-1].trees) == 3


def test_search_of_the_early_stopped_booster(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(minutes=i), float(i % 7), float(i % 7) + 0.1 * (i % 3)) for i in range(240)]
    df = spark.createDataFrame(rows, "datetime timestamp, a double, residual double")
    space = {k: (2, 3, False, True) if k in ("n_estimators", "max_depth") else v for k, v in M.SEARCH_SPACES["gbt_es"].items()}
    seen = []
    out = M.param_search("gbt_es", df, ["a"], 2, space=space, label="residual", parallelism=1, done=[0], on_trial=lambda r: seen.append(r.first()["trial"]))
    r = out.collect()
    assert [x.trial for x in r] == [1] == seen and 1 <= int(r[0].params["best_n_estimators"]) <= 3


def test_searches_share_folds(spark, monkeypatch):
    """A search with given folds writes none of its own and finds the same errors."""
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(minutes=i), float(i % 7), float(i % 7) + 0.1 * (i % 3)) for i in range(240)]
    df = spark.createDataFrame(rows, "datetime timestamp, a double, residual double")
    space = {"n_estimators": (2, 3, False, True), "max_depth": (2, 3, False, True)}
    own = M.param_search("rf", df, ["a"], 1, space=space, label="residual").first()
    folds = M.FoldStore(df, ["a"], "residual")
    monkeypatch.setattr(M, "FoldStore", None)
    shared = M.param_search("rf", df, ["a"], 1, space=space, label="residual", folds=folds).first()
    assert shared["params"] == own["params"] and shared["mae_cv"] == pytest.approx(own["mae_cv"], rel=0.05)


def test_preprocessing_takes_one_aggregation(spark):
    """Medians come from the pass over the moments, equal to those of ``fit_medians``; a column without values has none."""
    class Once:
        def __init__(self, df):
            self.df, self.passes = df, 0

        def agg(self, *a):
            self.passes += 1
            return self.df.agg(*a)
    df = _planted(spark)[0].withColumn("x4", F.lit(None).cast("double"))
    seen = Once(df)
    med, _, stats = M.fit_preprocessing(seen, [*FEATS, "x4"], "residual")
    assert med == M.fit_medians(df, [*FEATS, "x4"]) and med["x4"] is None
    assert seen.passes == 1 and stats[0] == 2000


def test_ranking_fits_the_tuned_models(spark, monkeypatch):
    """The four models of the ranking have the reference's parameters and get all rows."""
    from dockflow.plans import models as P
    from dockflow.schema import RF_PARAMS, RIDGE_ALPHA, XGB_PARAMS
    train, test = spark.range(50).toDF("i"), spark.range(7).toDF("i")
    built, seen = {}, []

    def fit(kind, rows, features, params=None, label=None, name=None):
        seen.append((kind, rows.count(), len(features), label))
        if kind != "baseline":
            built[kind] = M.regressor(kind, params, label)
        return M.Fitted(name, None, 0.0, {})
    monkeypatch.setattr(P, "_planted_tables", lambda *_: (train, test))
    monkeypatch.setattr(M, "fit", fit)
    monkeypatch.setattr(M, "train_and_rank", lambda fitted, rows, label: rows.count())
    fitted, scored = P._ranked(spark, "")
    assert [f.name for f in fitted] == list(P.NAMES.values()) and scored == 7
    assert seen == [(k, 50, 24, P.PLANTED) for k in ("baseline", "ridge", "rf", "gbt_es")]
    rf, boosted = built["rf"], built["gbt_es"]
    assert built["ridge"].getRegParam() == RIDGE_ALPHA
    assert (rf.getNumTrees(), rf.getMaxDepth(), rf.getMinInstancesPerNode()) == (RF_PARAMS["n_estimators"], RF_PARAMS["max_depth"], RF_PARAMS["min_samples_leaf"]) == (468, 15, 146)
    assert (boosted.getMaxIter(), boosted.getMaxDepth(), boosted.getMinInstancesPerNode()) == (XGB_PARAMS["n_estimators"], XGB_PARAMS["max_depth"], XGB_PARAMS["min_child_weight"]) == (232, 6, 21)
    assert rf.getMaxMemoryInMB() <= 256      # four tasks fit a heap of 3 GB
