"""J1 as-of lag: hand-built edges and equality with pandas merge_asof (brute force)."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dockflow.operators.asof import asof_lag

T0 = dt.datetime(2024, 3, 1, 12, 0, 0)
US = dt.timedelta(microseconds=1)
MIN = dt.timedelta(minutes=1)


def _frame(spark, rows):
    return spark.createDataFrame(rows, "station_id int, datetime timestamp, v double")


@pytest.mark.parametrize("bucket", [None, 24 * 60, 45, 7, "auto"])
def test_edges(spark, bucket):
    t = T0
    rows = [
        (1, t, 0.0),
        (1, t - 60 * MIN, 1.0),            # exactly t - L: inside (inclusive)
        (1, t - 60 * MIN - US, 2.0),       # 1 us before t - L: outside
        (1, t - 30 * MIN, 3.0),            # exactly t - L + 30 min: inside
        (1, t - 30 * MIN + US, 4.0),       # 1 us after: outside
        (2, t, 5.0),                       # lone row: no lag
    ]
    out = asof_lag(_frame(spark, rows), value="v", lags={"lag": 60}, bucket_minutes=bucket)
    got = {(r.station_id, r.v): r.lag for r in out.collect()}
    assert got[(1, 0.0)] == 1.0            # earliest in [t-60, t-30]
    assert got[(2, 5.0)] is None
    # every other row against a brute-force range scan
    pdf = pd.DataFrame(rows, columns=["station_id", "datetime", "v"])
    exp = _brute(pdf, 60, 30)
    for (sid, v), lag in got.items():
        e = exp[(sid, v)]
        assert (lag is None and e is None) or lag == e, (sid, v, lag, e)


def _brute(pdf, lag_min, tol_min):
    out = {}
    for _, r in pdf.iterrows():
        lo = r.datetime - pd.Timedelta(minutes=lag_min)
        hi = lo + pd.Timedelta(minutes=tol_min)
        c = pdf[(pdf.station_id == r.station_id) & (pdf.datetime >= lo) & (pdf.datetime <= hi)]
        out[(r.station_id, r.v)] = None if c.empty else float(c.sort_values("datetime").iloc[0].v)
    return out


def _merge_asof(pdf, minutes, name):
    res = []
    for _, g in pdf.groupby("station_id", sort=False):
        g = g.sort_values("datetime")
        ref = g[["datetime", "v"]].copy()
        ref["datetime"] = ref["datetime"] + pd.Timedelta(minutes=minutes)
        m = pd.merge_asof(g[["datetime", "v", "rid"]], ref.rename(columns={"v": name}), on="datetime",
                          direction="forward", tolerance=pd.Timedelta(minutes=30))
        res.append(m[["rid", name]])
    return pd.concat(res).set_index("rid")[name]


@pytest.mark.parametrize("bucket,target_rows,max_hot", [
    (None, 0, 0), (24 * 60, 0, 0), (90, 0, 0), (20, 0, 0),
    ("auto", 500_000, 1000),      # ordinary keys: one-day buckets
    ("auto", 40, 2),              # two hot keys get narrow widths, the rest a derived default
    ("auto", 5, 10),              # every key narrower than a day, clamped at the tolerance
])
def test_matches_merge_asof(spark, bucket, target_rows, max_hot):
    rng = np.random.default_rng(7)
    n = 3000
    sid = rng.integers(0, 6, n)
    # irregular polls: 0..30 hours, microsecond resolution, unique per station
    secs = np.sort(rng.choice(30 * 3600 * 1_000_000, n, replace=False))
    ts = [T0 + dt.timedelta(microseconds=int(s)) for s in secs]
    pdf = pd.DataFrame({"rid": np.arange(n), "station_id": sid.astype(int), "datetime": ts,
                        "v": np.round(rng.uniform(0, 100, n), 2)})
    sdf = spark.createDataFrame(pdf, "rid long, station_id int, datetime timestamp, v double")
    kw = {"target_rows": target_rows, "max_hot": max_hot} if bucket == "auto" else {}
    out = asof_lag(sdf, value="v", lags={"lag_60min": 60, "lag_240min": 240}, bucket_minutes=bucket, **kw)
    got = out.toPandas().set_index("rid").sort_index()
    for name, minutes in (("lag_60min", 60), ("lag_240min", 240)):
        exp = _merge_asof(pdf, minutes, name).sort_index()
        a, b = got[name].to_numpy(dtype=float), exp.to_numpy(dtype=float)
        assert np.array_equal(np.isnan(a), np.isnan(b)), name
        assert np.allclose(a[~np.isnan(a)], b[~np.isnan(b)], rtol=0, atol=0), name
    assert len(got) == n


@pytest.mark.parametrize("bucket", [None, "auto"])
def test_duplicates_dropped_before_lag(spark, bucket):
    t = T0
    rows = [(1, t - 60 * MIN, 5.0), (1, t - 60 * MIN, 2.0),      # duplicate poll: keep the first by v
            (1, t, 9.0), (1, t, 9.0)]
    out = asof_lag(_frame(spark, rows), value="v", lags={"lag": 60}, bucket_minutes=bucket,
                   dedup_order=["v"]).collect()
    assert sorted((r.v, r.lag) for r in out) == [(2.0, None), (9.0, 2.0)]


def test_sparse_stations_do_not_narrow_the_buckets(spark):
    from dockflow.operators import asof
    steady = [(k, T0 + dt.timedelta(minutes=5 * i), float(i)) for k in range(10) for i in range(200)]
    lone = [(1000 + k, T0, 1.0) for k in range(1500)]
    burst = [(7777, T0 + dt.timedelta(seconds=i), 1.0) for i in range(900)]
    frame = spark.createDataFrame(steady + lone + burst, "station_id int, datetime timestamp, v double")
    base = frame.withColumn("_us", F.unix_micros("datetime"))
    day = asof.MAX_BUCKET_MINUTES * 60 * 1_000_000
    with_width, width = asof._adaptive_width(base, "station_id", 30, target_rows=500)
    got = {r[0]: r[1] for r in with_width.select("station_id", width.alias("w")).distinct().collect()}
    assert got.pop(7777) < day and set(got.values()) == {day}
    copies = asof._bucketed(base, "station_id", "v", {"lag": 240}, 30, F.lit(day))
    assert copies.count() == frame.count()
