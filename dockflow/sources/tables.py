"""Readers for the parquet test tables and the ``readings`` fact view over them.

``readings`` is the fixture view of FIXTURES.md §2.1: every column is derived
from ``events`` (and ``part`` for name/capacity), so its size grows with the
given tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import join_bounded

# ``station_id`` rule: the correctness fixture folds users onto 10 stations;
# the bench uses one station per user to have many keys.
STATION_RULES = ("mod10", "user")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str, stations: str = "mod10") -> DataFrame:
    """Raw readings derived from ``events`` ⟕ ``part`` (same SQL as the oracle view)."""
    if stations not in STATION_RULES:
        raise ValueError(f"stations must be one of {STATION_RULES}")
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    # The join key user_id % 10 + 1 lies in [-8, 10]: this bounded range
    # filter reaches the parquet scan and keeps the part side at <= 19 keys.
    p = (table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
         .where(F.col("p_partkey").between(-8, 10)))
    sid = (F.col("user_id") % 10) if stations == "mod10" else F.col("user_id")
    # Broadcast after a measured bound (part's key is unique, so this is <= 19
    # rows); without it a large ``part`` could turn this into a shuffle of events.
    joined = join_bounded(e, p, (F.col("user_id") % 10 + 1) == F.col("p_partkey"), "left",
                          proven_rows=None)
    day = F.dayofmonth("ts")
    return joined.select(
        F.col("event_id").alias("reading_id"),
        sid.cast("int").alias("station_id"),
        F.col("p_name").alias("name"),
        (F.col("p_size") + 10).cast("int").alias("capacity"),
        F.col("ts").cast("timestamp").alias("datetime"),
        (F.floor("value").cast("int") % 21).alias("bikes_mechanical"),
        (F.col("event_id") % 7).cast("int").alias("bikes_ebike"),
        ((F.col("event_id") * 7 + F.col("user_id")) % 26).cast("int").alias("numdocksavailable"),
        F.when(F.col("event_type") == "error", "f").otherwise("t").alias("is_renting"),
        F.when(day.isin(1, 15), "t").otherwise("f").alias("is_holiday"),
        F.when(day.between(10, 20), "t").otherwise("f").alias("is_vacation"),
        ((F.col("event_id") % 251).cast("double") / F.lit(10.0) - F.lit(5.0))
        .alias("apparent_temperature"),
        (F.col("event_id") % 100).cast("int").alias("weather_code"),
    )


# SQL text of the same view, valid in Spark SQL and DuckDB.
def readings_sql(stations: str = "mod10") -> str:
    sid = "e.user_id % 10" if stations == "mod10" else "e.user_id"
    return f"""SELECT e.event_id AS reading_id, CAST({sid} AS INT) AS station_id, p.p_name AS name,
  CAST(p.p_size + 10 AS INT) AS capacity, e.ts AS datetime,
  CAST(FLOOR(e.value) AS INT) % 21 AS bikes_mechanical, CAST(e.event_id % 7 AS INT) AS bikes_ebike,
  CAST((e.event_id * 7 + e.user_id) % 26 AS INT) AS numdocksavailable,
  CASE WHEN e.event_type='error' THEN 'f' ELSE 't' END AS is_renting,
  CASE WHEN day(e.ts) IN (1,15) THEN 't' ELSE 'f' END AS is_holiday,
  CASE WHEN day(e.ts) BETWEEN 10 AND 20 THEN 't' ELSE 'f' END AS is_vacation,
  CAST(e.event_id % 251 AS DOUBLE) / CAST(10 AS DOUBLE) - CAST(5 AS DOUBLE) AS apparent_temperature,
  CAST(e.event_id % 100 AS INT) AS weather_code
FROM events e LEFT JOIN part p ON p.p_partkey = e.user_id % 10 + 1"""
