"""Leak-free historical profiles: fit on train, apply to any split.

Fitted tables (A1 trend level 1, A2 level 2, A3 global mean, A4 morning /
evening ratio, A5 monthly temperature normal) are computed in **one** pass
over the training rows with ``GROUPING SETS``: one scan, one Expand, partial
aggregation before a single shuffle. The result is small (bounded by
stations x 7 x 24 x 12 + stations + 13 + 1 rows), is written once to the
shared checkpoint folder, and attached to data-sized frames with joins that
broadcast only after a size check (J2-J5).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exact_mean, round_half_even, safe_ratio
from ..schema import EVENING_HOURS, MIN_TREND_SUPPORT, MORNING_HOURS, TARGET_RAW
from ..session import materialize
from .joins import join_bounded

L1 = ["station_id", "day_of_week", "hour", "month"]
L2 = ["station_id", "day_of_week", "hour"]


@dataclass
class Profiles:
    """Fitted lookup tables plus the global mean scalar."""
    level1: DataFrame        # L1 keys, station_trend_avg (n >= support), n
    level2: DataFrame        # L2 keys, station_trend_fallback
    ratio: DataFrame         # station_id, ratio (3 digits)
    normal: DataFrame        # month, monthly_temp
    global_mean: float | None
    support: DataFrame       # all level-1 combinations with n (for A24)
    sizes: dict | None = None  # row counts of the lookup tables (broadcast bound)


def fit_profiles(train: DataFrame, value: str = TARGET_RAW, temp: str = "apparent_temperature",
                 min_support: int = MIN_TREND_SUPPORT, persist: bool = True) -> Profiles:
    """A1-A5 in one grouping-sets aggregation over the training rows."""
    h = F.col("hour")
    t = train.select(*L1, value, temp)
    g = t.groupingSets(
        [L1, L2, ["station_id"], ["month"], []], *L1
    ).agg(
        F.grouping_id().alias("_gid"),
        F.count(F.col(value)).alias("n"),
        exact_mean(value).alias("mean"),
        exact_mean(F.when(h.isin(MORNING_HOURS), F.col(value))).alias("morning"),
        exact_mean(F.when(h.isin(EVENING_HOURS), F.col(value))).alias("evening"),
        exact_mean(temp).alias("temp_mean"),
    )
    if persist:
        g = materialize(g, "profiles")
    # grouping_id bit order follows L1: station(8) dow(4) hour(2) month(1).
    gid = F.col("_gid")
    lvl1_all = g.where((gid == 0) & F.col("station_id").isNotNull() & F.col("day_of_week").isNotNull()
                       & F.col("hour").isNotNull() & F.col("month").isNotNull())
    level1 = (lvl1_all.where(F.col("n") >= min_support)
              .select(*L1, round_half_even("mean", 2).alias("station_trend_avg")))
    level2 = (g.where((gid == 1) & F.col("station_id").isNotNull() & F.col("day_of_week").isNotNull()
                      & F.col("hour").isNotNull())
              .select(*L2, round_half_even("mean", 2).alias("station_trend_fallback")))
    ratio = (g.where((gid == 7) & F.col("station_id").isNotNull())
             .select("station_id", round_half_even(safe_ratio(F.col("morning"), F.col("evening")), 3)
                     .alias("ratio"))
             .where(F.col("ratio").isNotNull()))
    normal = (g.where((gid == 14) & F.col("month").isNotNull())
              .select("month", F.col("temp_mean").alias("monthly_temp")))
    support = lvl1_all.select(*L1, "n")
    # One job over the small fitted table: exact sizes of every lookup (the
    # broadcast bound used by the joins) and the global mean scalar.
    keys_ok = {0: L1, 1: L2, 7: ["station_id"], 14: ["month"]}

    def nonnull(cols):
        c = F.lit(True)
        for k in cols:
            c = c & F.col(k).isNotNull()
        return c
    row = g.agg(
        F.count_if((gid == 0) & nonnull(keys_ok[0]) & (F.col("n") >= min_support)).alias("level1"),
        F.count_if((gid == 1) & nonnull(keys_ok[1])).alias("level2"),
        F.count_if((gid == 7) & nonnull(keys_ok[7]) & safe_ratio(F.col("morning"), F.col("evening")).isNotNull())
        .alias("ratio"),
        F.count_if((gid == 14) & nonnull(keys_ok[14])).alias("normal"),
        F.max(F.when(gid == 15, F.col("mean"))).alias("global_mean"),
    ).first()
    sizes = {k: row[k] for k in ("level1", "level2", "ratio", "normal")}
    return Profiles(level1, level2, ratio, normal, row["global_mean"], support, sizes)


def apply_trend(df: DataFrame, p: Profiles) -> DataFrame:
    """J2 + J5 + P19: level 1, else level 2, else the global train mean."""
    sz = p.sizes or {}
    out = join_bounded(df, p.level1, L1, "left", proven_rows=sz.get("level1"))
    out = join_bounded(out, p.level2, L2, "left", proven_rows=sz.get("level2"))
    gm = F.lit(p.global_mean).cast("double")
    return (out.withColumn("station_trend_avg",
                           F.coalesce(F.col("station_trend_avg"), F.col("station_trend_fallback"), gm))
            .drop("station_trend_fallback"))


def apply_ratio(df: DataFrame, p: Profiles, default: float = 1.0) -> DataFrame:
    """Station -> ratio, 1.0 when unknown, rounded to 3 digits."""
    out = join_bounded(df, p.ratio, "station_id", "left", proven_rows=(p.sizes or {}).get("ratio"))
    return (out.withColumn("morning_evening_ratio",
                           round_half_even(F.coalesce(F.col("ratio"), F.lit(default)), 3))
            .drop("ratio"))


def apply_normal(df: DataFrame, p: Profiles, temp: str = "apparent_temperature") -> DataFrame:
    """J4 + W2: temp_anomalie = round(temp - normal of the month, 2); unseen month -> NULL."""
    out = join_bounded(df, p.normal, "month", "left", proven_rows=13)
    return (out.withColumn("temp_anomalie", round_half_even(F.col(temp) - F.col("monthly_temp"), 2))
            .drop("monthly_temp"))


def residual_target(df: DataFrame, value: str = TARGET_RAW) -> DataFrame:
    """lag_res_240min = round(lag_240 - trend, 2); residual = round(fill - trend, 2)."""
    return df.withColumns({
        "lag_res_240min": round_half_even(F.col("lag_240min") - F.col("station_trend_avg"), 2),
        "residual": round_half_even(F.col(value) - F.col("station_trend_avg"), 2),
    })


def trend_support_audit(p: Profiles, min_support: int = MIN_TREND_SUPPORT) -> DataFrame:
    """Number of level-1 combinations below / at or above the support."""
    return p.support.agg(F.count_if(F.col("n") < min_support).alias("n_ignored"),
                         F.count_if(F.col("n") >= min_support).alias("n_valid"))
