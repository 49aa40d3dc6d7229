import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from hypothesis.extra import numpy as hn
from pyspark.sql import functions as F

from dockflow.llm import queries as Q
from dockflow.llm import whitening as W

from ..conftest import SF_SMALL


def brute(vectors, components=16):
    """(n, deviation, whitened up to sign, explained) of integer vectors by numpy's dense solver."""
    x = np.array(vectors, np.int64)
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(0)
    y = (n * u - s) / n
    v = y.T @ y / n
    e, q = np.linalg.eigh(v)
    keep = [i for i in range(len(e) - 1, -1, -1) if e[i] > 1e-12 * np.trace(v)][:components]
    white = (n * x - s) / n @ q[:, keep] / np.sqrt(e[keep])
    return n, ((n * x - s) ** 2).sum(1), white, e[keep] / np.trace(v), e[keep]


def check(rows, got, tol=1e-7):
    """``got`` rows against the brute force over rows (vec_id, integer vector) with unique ids."""
    n, dev, white, share, _ = brute([v for _, v in rows])
    by = {(r["vec_id"], r["component"]): r for r in got}
    assert len(by) == len(got) == len(rows) * len(share)
    for k in range(len(share)):
        mine = np.array([by[i, k + 1]["whitened"] for i, _ in rows])
        sign = np.sign(mine @ white[:, k])
        assert np.abs(mine - sign * white[:, k]).max() < tol
        for (i, _), d in zip(rows, dev, strict=True):
            r = by[i, k + 1]
            assert (r["n"], r["deviation"]) == (n, d) and abs(r["explained"] / share[k] - 1) < 1e-9 and r["identity_error"] < 1e-8


def test_query_equals_dense_decomposition(spark):
    t = pq.read_table(f"{SF_SMALL}/embeddings.parquet").to_pydict()
    rows = [(i, np.floor(64 * np.array(v, float)).astype(np.int64) + 1_000_000) for i, v in zip(t["vec_id"], t["embedding"], strict=True)]
    check(rows, Q.QUERIES["op13_whitening"](spark, SF_SMALL).collect())


def test_many_partitions_merge_to_the_same_components(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(e) for e in rng.normal(size=6) * [9, 5, 3, 2, 1, 0.5]]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(37)
    check([(i, np.floor(64 * np.array(v)).astype(np.int64) + 1_000_000) for i, v in rows], W.whiten(df).collect())


def test_odd_rows(spark):
    rng = np.random.default_rng(6)
    good = [(i, [float(e) for e in rng.normal(size=3)] + [0.5]) for i in range(20)]
    nan, inf = float("nan"), float("inf")
    rows = [*good, (100, None), (101, [1.0, None, 2.0, 3.0]), (102, [nan, 1.0, 1.0, 1.0]), (103, [1.0, inf, 1.0, 1.0]), (104, [1.0, -inf, 0.0, 0.0]),
            (105, []), (106, [1.0, 2.0]), (107, [1e30, 0.0, 0.0, 0.0])]
    same = [(200, good[0][1]), (201, good[0][1])]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows + same], "vec_id long, embedding array<double>, x string, part int, blob int")
    kept = [(i, np.floor(64 * np.array(v)).astype(np.int64) + 1_000_000) for i, v in good + same]
    got = W.whiten(df).collect()
    check(kept, got)
    assert {r["component"] for r in got} == {1, 2, 3} and got[0]["n"] == 20  # a constant dimension has no component
    nulls = df.withColumn("vec_id", F.when(F.col("vec_id") < 200, F.col("vec_id")))
    assert W.whiten(nulls).where("vec_id IS NULL").count() == 2 * 3


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_tables_without_components(spark, rows):
    assert W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect() == []


def test_deviation_beyond_long_is_null(spark):
    rows = [(i, [float(i % 7) * 1e8, float(i)]) for i in range(40)]
    got = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["deviation"] for r in got if r["vec_id"] % 7 == 0} == {None}
    _, _, white, share, _ = brute([[int(64 * a) + 1_000_000, int(64 * b) + 1_000_000] for _, (a, b) in rows])
    assert len(got) == 40 * len(share)


ints = hn.arrays(np.int64, st.tuples(st.integers(1, 25), st.integers(1, 7)), elements=st.integers(-3, 3))


@settings(max_examples=150, deadline=None)
@given(ints, st.integers(0, 25))
def test_rank_one_updates_with_ties_and_zeros(x, cut):
    x = x.astype(float)
    one, a, b = (W.Spectrum(x.shape[1]) for _ in range(3))
    for i, r in enumerate(x):
        one.add(r)
        (a if i < cut else b).add(r)
    a.merge(b)
    scatter = (x - x.mean(0)).T @ (x - x.mean(0))
    for s in (one, a):
        assert np.abs(s.vectors @ np.diag(s.values) @ s.vectors.T - scatter).max() < 1e-8
        assert np.abs(s.vectors.T @ s.vectors - np.eye(x.shape[1])).max() < 1e-9
        assert s.n == len(x)
