"""Row-local features (P8-P13, P2 on calendar flags): C2 without any shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (capacity_group, cyclic, day_of_week, hour, is_friday_evening, is_frozen,
                         is_monday_morning, is_peak_hour, is_stormy, month, truthy_flag,
                         weather_severity)


def date_parts(df: DataFrame, ts: str = "datetime") -> DataFrame:
    """Hour, day_of_week (Mon=0), month."""
    return df.withColumns({"hour": hour(ts), "day_of_week": day_of_week(ts), "month": month(ts)})


def temporal_features(df: DataFrame, ts: str = "datetime") -> DataFrame:
    """P8 + P9 + P10."""
    d = date_parts(df, ts)
    return d.withColumns({
        "hour_sin": cyclic("hour", 24, "sin"),
        "hour_cos": cyclic("hour", 24, "cos"),
        "dow_sin": cyclic("day_of_week", 7, "sin"),
        "dow_cos": cyclic("day_of_week", 7, "cos"),
        "is_peak_hour": is_peak_hour("hour"),
        "is_friday_evening": is_friday_evening("day_of_week", "hour"),
        "is_monday_morning": is_monday_morning("day_of_week", "hour"),
    })


def station_size(df: DataFrame) -> DataFrame:
    """P11."""
    return df.withColumn("capacity_group", capacity_group("capacity"))


def weather_features(df: DataFrame) -> DataFrame:
    """P12 + P13."""
    return df.withColumns({
        "weather_severity": weather_severity("weather_code"),
        "is_frozen": is_frozen("weather_code"),
        "is_stormy": is_stormy("weather_code"),
    })


def encode_calendar(df: DataFrame, cols=("is_holiday", "is_vacation")) -> DataFrame:
    """P2 on calendar flags -> 0/1 int, where present."""
    present = {c: truthy_flag(c) for c in cols if c in df.columns}
    return df.withColumns(present) if present else df


def row_features(df: DataFrame) -> DataFrame:
    """C2 row part: all features computable from one row."""
    return encode_calendar(weather_features(station_size(temporal_features(df))))


def monthly_anomaly_transform(df: DataFrame, value: str = "apparent_temperature",
                              out: str = "temp_anom") -> DataFrame:
    """Value minus the mean of its month, all rows kept (exploration form).

    The month mean is a 12-row aggregate joined back, not a window over a
    month partition: a window would send every row of a month to one task.
    """
    from ..functions import exact_mean
    from ..operators.joins import join_bounded
    means = df.groupBy("month").agg(exact_mean(value).alias("_month_mean"))
    out_df = join_bounded(df, means, ["month"], "left", proven_rows=13)   # 12 months + NULL
    return out_df.withColumn(out, F.col(value) - F.col("_month_mean")).drop("_month_mean")
