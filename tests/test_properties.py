"""Property tests (hypothesis): rounding, order statistics, as-of lag, dedup."""

import datetime as dt

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dockflow.functions import round_half_even
from dockflow.operators import split as SP
from dockflow.operators.asof import asof_lag
from dockflow.operators.setops import dedup_keep_first

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])


@SETTINGS
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=50))
def test_rounding_is_numpy_round(spark, xs):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = [r[0] for r in df.select(round_half_even("x", 2)).collect()]
    assert got == [float(np.round(x, 2)) + 0.0 for x in xs]


@SETTINGS
@given(st.lists(st.integers(min_value=0, max_value=10**9), min_size=1, max_size=300),
       st.integers(min_value=2, max_value=16), st.integers(min_value=1, max_value=30))
def test_order_statistics(spark, xs, fanout, max_collect):
    df = spark.createDataFrame([(x,) for x in xs], "x long")
    s = sorted(xs)
    ranks = sorted({0, len(xs) - 1, len(xs) // 2})
    got = SP.order_statistics(df, F.col("x"), ranks, max_collect=max_collect, fanout=fanout)
    assert got == {r: s[r] for r in ranks}


T0 = dt.datetime(2024, 5, 1)


def _brute(rows, lag, tol):
    out = {}
    for rid, sid, t, v in rows:
        lo, hi = t - dt.timedelta(minutes=lag), t - dt.timedelta(minutes=lag - tol)
        cands = sorted((t2, v2) for _, s2, t2, v2 in rows if s2 == sid and lo <= t2 <= hi)
        out[rid] = cands[0][1] if cands else None
    return out


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 24 * 60 * 3)), min_size=1, max_size=60, unique=True),
       st.sampled_from([None, 17, 60, 24 * 60, "auto"]))
def test_asof_brute_force(spark, pts, bucket):
    rows = [(i, sid, T0 + dt.timedelta(minutes=m), float(i)) for i, (sid, m) in enumerate(pts)]
    df = spark.createDataFrame(rows, "rid long, station_id int, datetime timestamp, v double")
    kw = {"target_rows": 3, "max_hot": 1} if bucket == "auto" else {}
    out = asof_lag(df, value="v", lags={"a": 60, "b": 240}, bucket_minutes=bucket, **kw).collect()
    ea, eb = _brute(rows, 60, 30), _brute(rows, 240, 30)
    assert len(out) == len(rows)
    for r in out:
        assert r.a == ea[r.rid] and r.b == eb[r.rid]


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(0, 5)), min_size=1, max_size=40))
def test_dedup_keeps_first_and_is_idempotent(spark, rows):
    df = spark.createDataFrame([(k, t, o, f"{k}-{t}-{o}") for k, t, o in rows], "k int, t int, o int, v string")
    once = dedup_keep_first(df, ["k", "t"], ["o", "v"])
    got = {(r.k, r.t): r.v for r in once.collect()}
    exp = {}
    for k, t, o in sorted(rows, key=lambda x: (x[2], f"{x[0]}-{x[1]}-{x[2]}")):
        exp.setdefault((k, t), f"{k}-{t}-{o}")
    assert got == exp
    twice = dedup_keep_first(once, ["k", "t"], ["o", "v"])
    assert sorted(twice.collect()) == sorted(once.collect())


@SETTINGS
@given(st.integers(min_value=4, max_value=120), st.integers(min_value=2, max_value=4))
def test_expanding_folds_positional(spark, n, n_splits):
    rows = [(i, T0 + dt.timedelta(seconds=7 * i)) for i in range(n)]
    df = spark.createDataFrame(rows, "rid long, datetime timestamp")
    size = n // (n_splits + 1)
    if size == 0:
        return
    got = {}
    for r in SP.expanding_time_folds(df, n_splits=n_splits).collect():
        got.setdefault((r.fold, r.role), []).append(r.rid)
    for i in range(n_splits):
        start = n - (n_splits - i) * size
        assert sorted(got.get((i, "train"), [])) == list(range(start))
        assert sorted(got.get((i, "test"), [])) == list(range(start, start + size))
