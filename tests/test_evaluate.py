"""Evaluation: metrics vs numpy, constant predictor, leaderboard, histograms."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockflow.operators import evaluate as E
from dockflow.operators.explore import equiwidth_histogram, fill_band_counts


def _np_metrics(y, p):
    e = y - p
    mae = np.mean(np.abs(e))
    rmse = np.sqrt(np.mean(e ** 2))
    r2 = 1 - np.sum(e ** 2) / np.sum((y - y.mean()) ** 2)
    return round(mae, 4), round(rmse, 4), round(r2, 4)


def test_regression_metrics(spark):
    rng = np.random.default_rng(4)
    y = np.round(rng.uniform(-30, 30, 500), 2)
    p = np.round(y + rng.normal(0, 5, 500), 2)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    for exact in (True, False):
        r = E.regression_metrics(df, "y", "p", exact=exact).first()
        assert (r.MAE, r.RMSE, r.R2) == pytest.approx(_np_metrics(y, p), abs=1e-4)
    m = float(y[:100].mean())
    c = E.constant_metrics(df, "y", m).first()
    assert (c.MAE, c.RMSE, c.R2) == pytest.approx(_np_metrics(y, np.full_like(y, m)), abs=1e-4)
    g = E.gain_vs_mean_baseline(df, "y", "p").first()
    base = np.mean(np.abs(y - y.mean()))
    assert g.baseline_mae == pytest.approx(round(base, 4), abs=1e-4)


def test_leaderboard_fallback_and_tie(spark):
    res = spark.createDataFrame([("B", 2.0, 0.0, 0.0), ("A", 2.0, 0.0, 0.0), ("Baseline (moyenne)", 4.0, 0.0, 0.0)],
                                "Modele string, MAE double, RMSE double, R2 double")
    board = {r.Modele: r for r in E.leaderboard(res).collect()}
    assert board["A"].rank == 1 and board["A"].is_best and board["B"].rank == 2
    assert board["A"].gain_pct == 50.0
    one = spark.createDataFrame([("A", 9.9, 0.0, 0.0)], "Modele string, MAE double, RMSE double, R2 double")
    b1 = E.leaderboard(one)
    assert b1.first().gain_pct == pytest.approx(90.0)          # 99.0 fallback baseline
    assert E.gap_to_second(b1).first().gap is None
    assert E.gap_to_second(E.leaderboard(res)).first().gap == 0.0


def test_error_histogram_sums(spark):
    rng = np.random.default_rng(5)
    y = rng.uniform(0, 100, 1000)
    p = np.clip(y + rng.normal(0, 20, 1000), 0, 100)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    h = E.error_histogram(df, "y", "p").collect()
    assert len(h) == 12
    assert sum(r.n for r in h) == 1000
    assert sum(r.share for r in h) == pytest.approx(100.0)
    assert [r.label for r in sorted(h, key=lambda r: r.bin)][0] == "<-30"


def test_histogram_and_bands(spark):
    vals = [0.0, 0.01, 20.0, 20.01, 55.5, 100.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    h = equiwidth_histogram(df, "x", 10).collect()
    assert len(h) == 10 and sum(r.n for r in h) == 6
    bands = {r.band: r.n for r in fill_band_counts(df, "x").collect()}
    assert bands == {"0-20": 2, "20-40": 1, "40-60": 1, "80-100": 1}       # exact 0 in no band
    incl = {r.band: r.n for r in fill_band_counts(df, "x", include_lowest=True).collect()}
    assert incl["0-20"] == 3


def test_metrics_of_unrounded_values(spark):
    rows = [(0.001, 0.004), (0.002, 0.001), (0.003, 0.002)]
    df = spark.createDataFrame(rows, "y double, p double")
    y, p = np.array(rows).T
    r = df.agg(*E.metric_aggs("y", "p", digits=8)).first()
    assert r.MAE == pytest.approx(np.mean(np.abs(y - p)), abs=1e-8)
    assert r.RMSE == pytest.approx(np.sqrt(np.mean((y - p) ** 2)), abs=1e-8)
    big = spark.createDataFrame([(1e9 + a, 1e9 + b) for a, b in rows], "y double, p double")
    assert E.regression_metrics(big, "y", "p").first().R2 < 0
    g = E.gain_vs_mean_baseline(df.selectExpr("y * 1000.125 AS y", "p * 1000.125 AS p"), "y", "p").first()
    assert g.baseline_mae == pytest.approx(np.mean(np.abs(y - y.mean())) * 1000.125, abs=1e-4)
