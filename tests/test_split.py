"""Exact order statistics, temporal split, folds, early-stop split."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockflow.operators import split as SP


@pytest.mark.parametrize("max_collect,fanout", [(20_000, 4096), (50, 8), (10, 2)])
def test_order_statistics_refinement(spark, max_collect, fanout):
    rng = np.random.default_rng(1)
    xs = np.concatenate([rng.integers(0, 10**12, 2000), np.full(300, 5 * 10**11)])  # heavy tie
    df = spark.createDataFrame([(int(x),) for x in xs], "x long")
    ranks = [0, 1, 999, 1150, 1999, 2299]
    got = SP.order_statistics(df, F.col("x"), ranks, max_collect=max_collect, fanout=fanout)
    s = np.sort(xs)
    assert got == {r: int(s[r]) for r in ranks}


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(2)
    xs = rng.integers(0, 10**15, 1001)
    df = spark.createDataFrame([(int(x),) for x in xs], "x long")
    q = SP.exact_quantiles(df, F.col("x"), [0.0, 0.25, 0.8, 1.0], max_collect=40, fanout=16)
    for p, v in q.items():
        assert v == pytest.approx(float(np.quantile(xs, p)), rel=1e-15, abs=1.0)


def _times(spark, n=500, seed=3):
    rng = np.random.default_rng(seed)
    t0 = dt.datetime(2024, 1, 1)
    us = np.sort(rng.choice(10**11, n, replace=False))
    rows = [(i, t0 + dt.timedelta(microseconds=int(u))) for i, u in enumerate(us)]
    return spark.createDataFrame(rows, "rid long, datetime timestamp"), us


def test_temporal_split_partitions(spark):
    df, us = _times(spark)
    out, cutoff = SP.temporal_split(df)
    rows = out.collect()
    assert len(rows) == len(us)
    train = [r for r in rows if r.split == "train"]
    test = [r for r in rows if r.split == "test"]
    assert max(r.datetime for r in train) < min(r.datetime for r in test)
    assert len(train) == int(np.sum(us <= np.quantile(us, 0.8)))


def test_expanding_folds_positional(spark):
    df, us = _times(spark, n=403)
    out = SP.expanding_time_folds(df).collect()
    n, size = 403, 403 // 4
    for i in range(3):
        start = n - (3 - i) * size
        tr = sorted(r.rid for r in out if r.fold == i and r.role == "train")
        te = sorted(r.rid for r in out if r.fold == i and r.role == "test")
        assert tr == list(range(0, start))
        assert te == list(range(start, start + size))


def test_early_stop_split(spark):
    df, us = _times(spark, n=200)
    out = SP.early_stop_split(df).collect()
    val = sorted(r.rid for r in out if r.is_validation)
    assert val == list(range(int(200 * 0.85), 200))


def test_null_time_in_no_split(spark):
    rows = [(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2)), (3, None)]
    df = spark.createDataFrame(rows, "rid long, datetime timestamp")
    out = {r.rid: r.split for r in SP.temporal_split(df)[0].collect()}
    assert out == {1: "train", 2: "test", 3: None}


def test_train_condition_equals_label(spark):
    df, us = _times(spark, n=777, seed=9)
    labelled, cutoff = SP.temporal_split(df, q=0.37)
    a = sorted(r.rid for r in labelled.where(F.col("split") == "train").collect())
    b = sorted(r.rid for r in df.where(SP.train_condition(cutoff)).collect())
    assert a == b and len(a) == int(np.sum(us <= np.quantile(us, 0.37)))
