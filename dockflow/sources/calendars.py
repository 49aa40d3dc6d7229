"""Calendar context: school vacations (S6) and public holidays.

Both are tiny dimension tables. The vacation ranges are expanded to one row
per (distinct) day, which turns the range condition into an equi-join, so no
nested-loop or cross join is planned; the expanded table is bounded by the
days of the calendar and is broadcast after a size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_bounded


def vacation_days(calendar: DataFrame, location: str = "Paris") -> DataFrame:
    """Distinct days covered by any [start_date, end_date] of ``location``."""
    return (calendar.where(F.col("location") == location)
            .select(F.explode(F.sequence(F.col("start_date").cast("date"),
                                         F.col("end_date").cast("date"))).alias("day"))
            .distinct())


def vacation_flag(df: DataFrame, calendar: DataFrame | None, ts: str = "datetime",
                  location: str = "Paris", out: str = "is_vacation") -> DataFrame:
    """Is the UTC date inside a vacation range of ``location``; False without a calendar."""
    if calendar is None:
        return df.withColumn(out, F.lit(False))
    days = vacation_days(calendar, location).withColumn("_v", F.lit(True))
    j = join_bounded(df.withColumn("_day", F.to_date(ts)),
                     days.withColumnRenamed("day", "_day"), "_day", "left")
    return j.withColumn(out, F.coalesce(F.col("_v"), F.lit(False))).drop("_day", "_v")


def holiday_flag(df: DataFrame, holidays: DataFrame | None, ts: str = "datetime",
                 out: str = "is_holiday") -> DataFrame:
    """Is the UTC date a public holiday (left equi-join on the day)."""
    if holidays is None:
        return df.withColumn(out, F.lit(False))
    h = holidays.select(F.col("day").cast("date").alias("_day")).distinct().withColumn("_h", F.lit(True))
    j = join_bounded(df.withColumn("_day", F.to_date(ts)), h, "_day", "left")
    return j.withColumn(out, F.coalesce(F.col("_h"), F.lit(False))).drop("_day", "_h")


def calendars_from_events(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calendars derived from the months present in ``events`` (fixture rule).

    Vacation: days 10..20 of each month in 'Paris' (plus a range elsewhere
    that must be ignored); holidays: days 1 and 15 of each month. These are
    the rules behind the fixture's ``is_vacation`` / ``is_holiday`` columns.
    """
    months = events.select(F.trunc(F.to_date("ts"), "month").alias("m")).distinct()
    cal = months.select(
        F.explode(F.array(
            F.struct(F.date_add("m", 9).alias("start_date"), F.date_add("m", 19).alias("end_date"),
                     F.lit("Paris").alias("location")),
            F.struct(F.date_add("m", 0).alias("start_date"), F.date_add("m", 27).alias("end_date"),
                     F.lit("Lyon").alias("location")))).alias("c")).select("c.*")
    hol = months.select(F.explode(F.array(F.col("m"), F.date_add("m", 14))).alias("day")) \
        .withColumn("label", F.lit("holiday"))
    return cal, hol
