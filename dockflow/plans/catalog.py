"""Registry of named queries and their DuckDB oracle SQL.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the given parquet
tables. SQL texts are ANSI-ish and run in DuckDB against the same tables.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}


def prepare(spark: SparkSession) -> None:
    """Engine requirements for any session that runs a registered query.

    Hours, days and calendar dates are UTC in the reference, so the session
    zone is pinned to UTC; the shared checkpoint folder is resolved (see
    ``dockflow.session.ensure_checkpoint_dir``).
    """
    from ..session import ensure_checkpoint_dir
    if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)


def register(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        QUERIES[key] = run
        if sql is not None:
            SQL[key] = sql
        return fn
    return deco


def output(df: DataFrame) -> DataFrame:
    """Final projection of a registered query: timestamps leave as TIMESTAMP_NTZ.

    A naive UTC wall clock compares equal to DuckDB's TIMESTAMP whatever the
    time zone of the process that collects the rows.
    """
    casts = {f.name: df[f.name].cast(T.TimestampNTZType())
             for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)}
    return df.withColumns(casts) if casts else df
