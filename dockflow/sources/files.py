"""File sources: readings scan with an explicit schema (S1) and rotated
datasets ``prefix_01, prefix_02, ...`` (S2)."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.setops import dedup_keep_first
from ..session import path_exists
from ..schema import KEY, READINGS_SCHEMA

# ISO-8601 with microseconds and offset, as the collector writes ``datetime``.
ISO_TS = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX"


def scan_readings(spark: SparkSession, path: str, fmt: str = "csv",
                  schema: T.StructType = READINGS_SCHEMA) -> DataFrame:
    """Header CSV (or parquet/json) with a declared schema, ``datetime`` parsed.

    No schema inference: a declared schema is one pass less over the files
    and keeps types stable across files.
    """
    r = spark.read.schema(schema)
    if fmt == "csv":
        return (r.option("header", True).option("mode", "PERMISSIVE")
                .option("timestampFormat", ISO_TS).csv(path))
    return r.format(fmt).load(path)


def _exists(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, path)


def rotated_paths(spark: SparkSession, base: str, prefix: str, suffix: str = "") -> list[str]:
    """Numbered paths from 01 upwards (100 and on with three digits), stopping only at
    the first missing number."""
    out = []
    for i in itertools.count(1):
        p = f"{base.rstrip('/')}/{prefix}{i:02d}{suffix}"
        if not _exists(spark, p):
            break
        out.append(p)
    return out


def scan_rotated_files(spark: SparkSession, base: str, prefix: str, fmt: str = "parquet",
                       schema: T.StructType | None = None, key=tuple(KEY), suffix: str = "") -> DataFrame:
    """Read every rotated dataset, UNION ALL, one row per key (first file wins).

    One scan over all paths; the file number comes from the hidden
    ``_metadata.file_path`` column and orders duplicates (U2). Sorting is left
    to the writer (T1), the scan does not sort.
    """
    paths = rotated_paths(spark, base, prefix, suffix)
    if not paths:
        raise FileNotFoundError(f"no {prefix}NN dataset under {base}")
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", True)
    df = r.load(paths)
    num = F.regexp_extract(F.col("_metadata.file_path"), rf"{prefix}(\d+)", 1).cast("int")
    tagged = df.withColumn("_src", num)
    out = dedup_keep_first(tagged, list(key), ["_src"])
    return out.drop("_src")


def rotated_summary(df: DataFrame, ts: str = "datetime") -> DataFrame:
    """S2 report: rows, first/last time, distinct stations."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("first_ts"),
                  F.max(ts).alias("last_ts"), F.count_distinct("station_id").alias("n_stations"))
