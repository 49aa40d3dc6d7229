"""Nested JSON (P14, P15, S3, S4), dedup (U2), append sink (K3) and rotated scan."""

import json

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from dockflow.operators.setops import dedup_keep_first
from dockflow.session import scratch_path
from dockflow.sinks import writers as W
from dockflow.sources import snapshots as S
from dockflow.sources.files import scan_rotated_files


def _docs(spark, docs):
    return (spark.createDataFrame([(json.dumps(d),) for d in docs], "value string")
            .select(F.from_json("value", S.STATUS_SCHEMA).alias("j")).select("j.*"))


def test_status_explode_keys(spark):
    doc = {"last_updated": "2024-01-02T03:04:05.000006Z", "data": {"stations": [
        {"station_id": 1, "num_bikes_available_types": [{"mechanical": 2}, {"ebike": 3}, {"mechanical": 5}],
         "num_docks_available": 7, "is_renting": 1},
        {"station_id": 2, "numDocksAvailable": 4, "is_renting": 0},
        {"station_id": 3, "num_bikes_available_types": [], "num_docks_available": 1},
    ]}}
    rows = {r.station_id: r for r in S.explode_status(_docs(spark, [doc])).collect()}
    assert (rows[1].bikes_mechanical, rows[1].bikes_ebike, rows[1].numdocksavailable) == (5, 3, 7)
    assert (rows[2].bikes_mechanical, rows[2].bikes_ebike, rows[2].numdocksavailable) == (0, 0, 4)
    assert rows[2].is_renting is False and rows[3].is_renting is True      # default 1
    assert rows[1].datetime.microsecond == 6


def test_info_last_duplicate_wins(spark):
    docs = [{"last_updated": "2024-01-01T00:00:00Z", "data": {"stations": [
                {"station_id": 1, "name": "a", "capacity": 10},
                {"station_id": 1, "name": "b"}]}},
            {"last_updated": "2023-12-31T00:00:00Z", "data": {"stations": [
                {"station_id": 1, "name": "old", "capacity": 99}, {"station_id": 2}]}}]
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "value string") \
        .select(F.from_json("value", S.INFO_SCHEMA).alias("j")).select("j.*")
    rows = {r.station_id: r for r in S.station_info_dim(df).collect()}
    assert (rows[1].name, rows[1].capacity, rows[1].lat) == ("b", 0, 0.0)
    assert (rows[2].name, rows[2].capacity) == ("", 0)
    status = spark.createDataFrame([(1,), (3,)], "station_id int")
    enriched = {r.station_id: r for r in S.enrich_status(status, S.station_info_dim(df)).collect()}
    assert enriched[3].name == "" and enriched[3].capacity == 0 and enriched[3].lat is None


def test_dedup_idempotent_and_first(spark):
    df = spark.createDataFrame([(1, 1, 0, "a"), (1, 1, 1, "b"), (2, 1, 1, "c"), (2, 1, 0, "d")],
                               "k int, t int, src int, v string")
    once = dedup_keep_first(df, ["k", "t"], ["src"])
    twice = dedup_keep_first(once.withColumn("src", F.lit(0)), ["k", "t"], ["src"])
    assert sorted((r.k, r.v) for r in once.collect()) == [(1, "a"), (2, "d")]
    assert sorted((r.k, r.v) for r in twice.collect()) == [(1, "a"), (2, "d")]


def test_append_dedup_idempotent(spark):
    path = scratch_path(spark, "t-append")
    rows = [(i % 3, f"2024-01-0{1 + i % 2} 00:00:0{i}", i) for i in range(6)]
    b = spark.createDataFrame(rows, "station_id int, ts string, v int") \
        .withColumn("datetime", F.to_timestamp("ts")).drop("ts")
    r1 = W.append_dedup(b, path, ["v"])
    r2 = W.append_dedup(b, path, ["v"])
    assert (r1.n_new, r1.n_total) == (6, 6)
    assert (r2.n_new, r2.n_dup, r2.n_total) == (0, 6, 6)


def test_rotated_gap_rule(spark):
    base = scratch_path(spark, "t-rot")
    mk = lambda v: spark.createDataFrame([(1, v)], "station_id int, v int") \
        .withColumn("datetime", F.to_timestamp(F.lit("2024-01-01 00:00:00")))
    mk(1).write.parquet(f"{base}/raw_01")
    mk(2).write.parquet(f"{base}/raw_02")
    mk(9).write.parquet(f"{base}/raw_04")          # after the gap: ignored
    out = scan_rotated_files(spark, base, "raw_").collect()
    assert [r.v for r in out] == [1]                 # first file wins


def test_more_than_a_hundred_rotated_datasets(spark):
    base = scratch_path(spark, "t-rot-many")
    df = spark.createDataFrame([(1,)], "v int").coalesce(1)
    for i in range(1, 103):
        df.select((F.col("v") * i).alias("station_id"), F.lit(i).alias("v"), F.to_timestamp(F.lit("2024-01-01")).alias("datetime")) \
            .write.parquet(f"{base}/raw_{i:02d}")
    assert scan_rotated_files(spark, base, "raw_").count() == 102


def test_document_times(spark):
    docs = [{"last_updated": t, "data": {"stations": [{"station_id": i}]}} for i, t in enumerate(
        ["2024-01-02T03:04:05Z", "1704164645", 1704164645, 1704164645000, None, "soon"])]
    polled = _docs(spark, docs).withColumn(S.POLL_TIME, F.to_timestamp(F.lit("2024-05-05 00:00:00")))
    got = {r.station_id: str(r.datetime) for r in S.explode_status(polled).withColumn("datetime", F.col("datetime").cast("string")).collect()}
    assert [got[i] for i in range(4)] == ["2024-01-02 03:04:05"] * 4
    assert got[4] == got[5] == "2024-05-05 00:00:00"
    bare = S.explode_status(_docs(spark, docs)).where("datetime IS NULL").count()
    assert bare == 2


def test_weather_is_the_latest_at_or_before_the_poll(spark):
    ts = "datetime timestamp, apparent_temperature double, weather_code int"
    mk = lambda rows, schema: spark.createDataFrame(rows, schema.replace("timestamp", "string")).withColumn("datetime", F.to_timestamp("datetime"))
    docs = [("2024-01-01T10:00:00Z", 5.0, 1), ("2024-01-01T10:00:00Z", 5.0, 1), ("2024-01-01T12:00:00Z", 7.0, 2), ("2024-01-04T00:00:00Z", 1.0, 3)]
    js = [json.dumps({"time": t, "current": {"apparent_temperature": a, "weather_code": c}}) for t, a, c in docs]
    w = S.weather_context(spark.createDataFrame([(j,) for j in js], "value string").select(F.from_json("value", S.WEATHER_SCHEMA).alias("j")).select("j.*"))
    assert w.count() == 3
    polls = ["2024-01-01 09:59:59", "2024-01-01 10:00:05", "2024-01-01 23:00:00", "2024-01-03 08:00:00", "2024-01-04 00:00:00", "2024-01-01 10:00:05"]
    status = mk([(p, i) for i, p in enumerate(polls)], "datetime timestamp, station_id int")
    got = {r.station_id: (r.apparent_temperature, r.weather_code) for r in S.attach_weather(status, w).collect()}
    assert [got[i] for i in range(6)] == [(0.0, 0), (5.0, 1), (7.0, 2), (7.0, 2), (1.0, 3), (5.0, 1)]


def test_weather_of_a_dense_day_and_of_gaps(spark):
    """100,000 polls and 50,000 weather times in one day, then sparse ones with empty days between, against merge_asof."""
    rng = np.random.default_rng(7)
    day, us = 86_400_000_000, 1_704_067_200_000_000
    polls = np.unique(np.concatenate([us + rng.integers(0, day, 100_000), us + day * rng.integers(-3, 40, 300) + rng.integers(0, day, 300)]))
    times = np.unique(np.concatenate([us + rng.integers(day // 4, day, 50_000), us + day * rng.integers(0, 30, 20) + rng.integers(0, day, 20)]))
    at = lambda v: pd.to_datetime(v, unit="us", utc=True)
    weather = pd.DataFrame({"datetime": at(times), "apparent_temperature": np.arange(len(times), dtype=float), "weather_code": np.arange(len(times)) % 90})
    want = pd.merge_asof(pd.DataFrame({"datetime": at(polls)}), weather, on="datetime")
    frame = lambda t: spark.createDataFrame(t.assign(datetime=t["datetime"].dt.tz_localize(None)))
    got = S.weather_at(frame(pd.DataFrame({"datetime": at(polls)})), frame(weather))
    got = got.select(F.unix_micros("datetime").alias("us"), "apparent_temperature").toPandas().sort_values("us")
    assert (got["us"].to_numpy() == polls).all()
    np.testing.assert_array_equal(got["apparent_temperature"].to_numpy(float), want["apparent_temperature"].to_numpy())
    plan = got_plan(S.weather_at(frame(pd.DataFrame({"datetime": at(polls[:5])})), frame(weather[:5])))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def got_plan(df):
    return df._jdf.queryExecution().toString()
