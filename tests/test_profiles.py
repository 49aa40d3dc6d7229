"""Profiles fitted on train only: fallbacks, support, ratio edges, unseen keys, no leakage."""

import datetime as dt

from pyspark.sql import functions as F

from dockflow.operators import profiles as PR

COLS = "station_id int, day_of_week int, hour int, month int, capacity_status_calc double, apparent_temperature double"


def _train(spark):
    rows = []
    # station 1: combo (d0,h8,m1) x 4 rows, (d0,h8,m2) x 2 rows, evening rows
    rows += [(1, 0, 8, 1, v, 5.0) for v in (10.0, 20.0, 30.0, 40.0)]
    rows += [(1, 0, 8, 2, v, 7.0) for v in (50.0, 60.0)]
    rows += [(1, 0, 18, 1, 20.0, 5.0)]
    # station 2: morning only -> no ratio
    rows += [(2, 1, 7, 1, 30.0, 1.0)] * 3
    # station 3: evening mean 0 -> no ratio
    rows += [(3, 2, 8, 1, 10.0, 1.0), (3, 2, 17, 1, 0.0, 1.0)]
    # station 4: combos with 1, 2, 3 rows
    rows += [(4, 3, 10, 1, 1.0, 1.0)] + [(4, 3, 11, 1, 2.0, 1.0)] * 2 + [(4, 3, 12, 1, 3.0, 1.0)] * 3
    return spark.createDataFrame(rows, COLS)


def test_support_and_levels(spark):
    p = PR.fit_profiles(_train(spark), persist=False)
    l1 = {(r.station_id, r.day_of_week, r.hour, r.month): r.station_trend_avg for r in p.level1.collect()}
    assert l1 == {(1, 0, 8, 1): 25.0, (2, 1, 7, 1): 30.0, (4, 3, 12, 1): 3.0}
    l2 = {(r.station_id, r.day_of_week, r.hour): r.station_trend_fallback for r in p.level2.collect()}
    assert l2[(1, 0, 8)] == 35.0
    audit = PR.trend_support_audit(p).first()
    assert (audit.n_ignored, audit.n_valid) == (6, 3)


def test_ratio_edges_and_defaults(spark):
    p = PR.fit_profiles(_train(spark), persist=False)
    ratio = {r.station_id: r.ratio for r in p.ratio.collect()}
    assert ratio == {1: round(((10 + 20 + 30 + 40 + 50 + 60) / 6) / 20.0, 3)}
    new = spark.createDataFrame(
        [(1, 0, 8, 1, 40.0, 6.0), (2, 0, 8, 1, 40.0, 6.0), (3, 0, 8, 1, 40.0, 6.0),
         (9, 6, 23, 12, 40.0, 6.0)], COLS)
    out = PR.apply_normal(PR.apply_ratio(PR.apply_trend(new, p), p), p)
    got = {r.station_id: r for r in out.collect()}
    assert got[1].morning_evening_ratio == ratio[1]
    assert got[2].morning_evening_ratio == 1.0 and got[3].morning_evening_ratio == 1.0
    # unseen station and month: global mean, NULL anomaly
    assert got[9].station_trend_avg == p.global_mean
    assert got[9].temp_anomalie is None
    assert got[1].station_trend_avg == 25.0


def test_no_leakage(spark):
    train = _train(spark).withColumn("split", F.lit("train"))
    test_a = spark.createDataFrame([(1, 0, 8, 1, 99.0, 30.0)], COLS).withColumn("split", F.lit("test"))
    test_b = spark.createDataFrame([(1, 0, 8, 1, 0.0, -9.0), (5, 0, 8, 1, 1.0, 1.0)], COLS) \
        .withColumn("split", F.lit("test"))
    fits = [PR.fit_profiles(train.unionByName(t).where(F.col("split") == "train"), persist=False)
            for t in (test_a, test_b)]
    p1, p2 = fits
    for a, b in ((p1.level1, p2.level1), (p1.level2, p2.level2), (p1.ratio, p2.ratio), (p1.normal, p2.normal)):
        assert sorted(a.collect()) == sorted(b.collect())
    assert p1.global_mean == p2.global_mean
