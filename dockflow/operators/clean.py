"""Cleaning: totals, validity filters, fill rate (P3-P7) and the cleaning audit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import capacity_group, round_half_even, truthy
from ..schema import TARGET_RAW


def bike_totals(df: DataFrame) -> DataFrame:
    """total_bikes = mechanical + ebike; total_capacity = total_bikes + free docks."""
    return (df.withColumn("total_bikes", F.col("bikes_mechanical") + F.col("bikes_ebike"))
              .withColumn("total_capacity", F.col("total_bikes") + F.col("numdocksavailable")))


def filter_positive_capacity(df: DataFrame) -> DataFrame:
    """Keep total_capacity > 0 (NULL dropped)."""
    return df.where(F.col("total_capacity") > 0)


def filter_in_service(df: DataFrame, col: str = "is_renting") -> DataFrame:
    """P5: keep rows whose renting flag is truthy, when the column exists."""
    if col not in df.columns:
        return df
    return df.where(truthy(col))


def fill_rate(df: DataFrame, out: str = TARGET_RAW) -> DataFrame:
    """round(total_bikes / total_capacity * 100, 2), half to even."""
    return df.withColumn(
        out, round_half_even(F.col("total_bikes") / F.col("total_capacity") * F.lit(100.0), 2))


def fill_rate_guarded(bikes, docks) -> F.Column:
    """Unrounded percentage, 0.0 when the total is 0 (ingest variant)."""
    total = bikes + docks
    return F.when(total > 0, bikes / total * F.lit(100.0)).otherwise(F.lit(0.0))


def clean_readings(df: DataFrame) -> DataFrame:
    """C1 = P3, P4, P5, P6 (P2 decoding for the renting flag, quirk 8.2#1 fixed)."""
    return fill_rate(filter_in_service(filter_positive_capacity(bike_totals(df))))


def cleaning_audit(df: DataFrame) -> DataFrame:
    """Rows in, zero-capacity removed, out-of-service removed, rows kept, and kept
    rows with a capacity outside the bins (one pass)."""
    t = bike_totals(df)
    positive = F.col("total_capacity") > 0
    in_service = truthy("is_renting") if "is_renting" in df.columns else F.lit(True)
    return t.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(F.col("total_capacity") == 0).alias("zero_capacity_removed"),
        F.count_if(positive & ~in_service).alias("out_of_service_removed"),
        F.count_if(positive & in_service).alias("rows_kept"),
        # kept rows whose capacity lies outside the size bins (NULL group, §8.2 #5)
        F.count_if(positive & in_service & capacity_group("capacity").isNull()).alias("capacity_out_of_bins"),
    )
