"""ST1-ST3: late files kept, repeats dropped, replays exact around every crash point."""

import json
import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from dockflow.plans import streams as PS
from dockflow.plans.ingest import land_text, status_documents
from dockflow.session import scratch_path
from dockflow.sinks import writers as W
from dockflow.sources.tables import readings
from dockflow.streaming import ingest as ST
from dockflow.streaming.context import ContextTables

from .conftest import SF_SMALL


def _three_months(spark):
    r = readings(spark, SF_SMALL).limit(90)
    return r.withColumn("datetime", F.expr("datetime + make_interval(0, 0, 0, cast(pmod(reading_id, 3) * 31 as int))"))


def _run(spark, status_dir, paths, **kw):
    target, metrics, ckpt = paths
    ST.append_sink(ST.snapshot_stream(spark, status_dir, 8), target, metrics, ckpt, **kw).awaitTermination()


def test_late_documents_are_kept_and_restart_adds_nothing(spark):
    r = _three_months(spark).cache()
    keys = r.select("station_id", "datetime").distinct().count()
    status_dir = scratch_path(spark, "t-status")
    PS.land_status_weekly(r, status_dir)
    paths = [scratch_path(spark, n) for n in ("t-target", "t-metrics", "t-ckpt")]
    _run(spark, status_dir, paths)
    assert spark.read.parquet(paths[0]).count() == keys
    land_text(status_documents(r), status_dir)
    _run(spark, status_dir, paths)
    assert spark.read.parquet(paths[0]).count() == keys
    m = ST.read_metrics(spark, paths[1])
    assert m.agg(F.sum("n_new")).first()[0] == keys
    assert m.agg(F.max("n_total")).first()[0] == keys
    assert m.select("batch_id").distinct().count() == m.count()
    # a second query on the same metrics table starts its own batch ids
    _run(spark, status_dir, [paths[0], paths[1], scratch_path(spark, "t-ckpt2")])
    assert spark.read.parquet(paths[0]).count() == keys


@pytest.mark.parametrize("crash", ["write_new", "metrics_row", "remove_path"])
def test_replay_after_a_crash(spark, monkeypatch, crash):
    r = readings(spark, SF_SMALL).limit(60).cache()
    keys = r.select("station_id", "datetime").distinct().count()
    status_dir = scratch_path(spark, "t-status")
    land_text(status_documents(r), status_dir)
    paths = [scratch_path(spark, n) for n in ("t-target", "t-metrics", "t-ckpt")]

    def boom(*a, **k):
        raise RuntimeError("crash")
    with monkeypatch.context() as m:
        m.setattr(ST if crash == "remove_path" else W, crash, boom)
        with pytest.raises(Exception, match="crash"):
            _run(spark, status_dir, paths)
    _run(spark, status_dir, paths)
    assert spark.read.parquet(paths[0]).count() == keys
    rows = ST.read_metrics(spark, paths[1]).collect()
    assert sum(x["n_new"] for x in rows) == keys and len({x["batch_id"] for x in rows}) == len(rows)


def _land(spark, path, docs):
    land_text(spark.createDataFrame([(json.dumps(d),) for d in docs], "value string").coalesce(1), path)


def _status(t, *stations):
    return {"last_updated": t, "data": {"stations": [{"station_id": s, "num_docks_available": 1} for s in stations]}}


def _info(t, **names):
    return {"last_updated": t, "data": {"stations": [{"station_id": int(k[1:]), "name": v, "capacity": 9} for k, v in names.items()]}}


def _weather(t, temp):
    return {"time": t, "current": {"apparent_temperature": temp, "weather_code": 3}}


def _wait(condition, seconds=60):
    until = time.time() + seconds
    while not condition():
        assert time.time() < until
        time.sleep(0.3)


def test_context_that_lands_while_the_stream_runs(spark):
    base = scratch_path(spark, "t-live")
    status, info, weather = (f"{base}/{k}" for k in ("status", "info", "weather"))
    _land(spark, info, [_info("2024-03-01T00:00:00Z", s1="one")])
    _land(spark, weather, [_weather("2024-03-01T08:00:00Z", 4.0)])
    _land(spark, status, [_status("2024-03-01T09:00:00Z", 1, 2)])
    context = ContextTables(f"{base}/context")
    q = ST.append_sink(ST.snapshot_stream(spark, status, None, info, weather), f"{base}/t", f"{base}/m", f"{base}/c", context=context,
                       transform=ST.snapshot_enrichment(context.info, context.weather, None, None), available_now=False, processing_time="1 seconds")
    rows = lambda: {(r["station_id"], str(r["datetime"])[:16]): (r["name"], r["apparent_temperature"])
                    for r in spark.read.parquet(f"{base}/t").withColumn("datetime", F.col("datetime").cast("string")).collect()}
    done = lambda n: W._exists(spark, f"{base}/m") and (ST.read_metrics(spark, f"{base}/m").agg(F.max("n_total")).first()[0] or 0) >= n
    try:
        _wait(lambda: done(2))
        _land(spark, weather, [_weather("2024-03-01T10:00:00Z", 6.0), _weather("2024-03-02T23:00:00Z", 8.0)])
        _land(spark, info, [_info("2024-03-02T00:00:00Z", s2="two")])
        _wait(lambda: context.weather(spark, [date(2024, 3, 2)]) is not None and context.weather(spark, [date(2024, 3, 2)]).count() == 3)
        _wait(lambda: context.info(spark, [date(2024, 3, 2)]).count() == 2)
        _land(spark, status, [_status("2024-03-01T11:00:00Z", 1, 2), _status("2024-03-09T11:00:00Z", 1, 2), _status("2024-02-01T00:00:00Z", 2)])
        _wait(lambda: done(7))
    finally:
        q.stop()
    assert rows() == {(1, "2024-03-01 09:00"): ("one", 4.0), (2, "2024-03-01 09:00"): ("", 4.0), (1, "2024-03-01 11:00"): ("one", 6.0),
                      (2, "2024-03-01 11:00"): ("two", 6.0), (1, "2024-03-09 11:00"): ("one", 8.0), (2, "2024-03-09 11:00"): ("two", 8.0),
                      (2, "2024-02-01 00:00"): ("two", 0.0)}


def test_a_batch_runs_its_sources_and_its_transform_once(spark):
    base = scratch_path(spark, "t-once")
    _land(spark, f"{base}/status", [_status(f"2024-03-0{d}T0{h}:00:00Z", 1, 2, 3) for d in (1, 2, 3) for h in range(9)])
    read, made = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def counting(acc):
        def run(batches):
            for b in batches:
                acc.add(b.num_rows)
                yield b
        return run
    stream = ST.snapshot_stream(spark, f"{base}/status")
    stream = stream.mapInArrow(counting(read), stream.schema)
    once = lambda rows, days: rows.mapInArrow(counting(made), rows.schema)
    ST.append_sink(stream, f"{base}/t", f"{base}/m", f"{base}/c", transform=once).awaitTermination()
    assert (read.value, made.value) == (81, 81)
    # keys that the table already holds are not transformed at all, and the size is carried, not recounted
    _land(spark, f"{base}/status", [_status("2024-03-01T00:00:00Z", 1, 2, 3, 4)])
    ST.append_sink(stream, f"{base}/t", f"{base}/m", f"{base}/c", transform=once).awaitTermination()
    assert (read.value, made.value) == (85, 82)
    last = ST.read_metrics(spark, f"{base}/m").orderBy(F.desc("batch_id")).first()
    assert (last["n_batch"], last["n_new"], last["n_dup"], last["n_total"]) == (4, 1, 3, 82)
