"""Schemas, feature lists and the fixed values the reference defines.

Values under "fixed values" must equal the reference's for identical results.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Raw readings (one row per station per poll)
# ---------------------------------------------------------------------------
READINGS_SCHEMA = T.StructType([
    T.StructField("station_id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("capacity", T.IntegerType()),
    T.StructField("datetime", T.TimestampType()),
    T.StructField("bikes_mechanical", T.IntegerType()),
    T.StructField("bikes_ebike", T.IntegerType()),
    T.StructField("numdocksavailable", T.IntegerType()),
    T.StructField("is_renting", T.StringType()),
    T.StructField("capacity_status", T.DoubleType()),
    T.StructField("is_holiday", T.StringType()),
    T.StructField("is_vacation", T.StringType()),
    T.StructField("apparent_temperature", T.DoubleType()),
    T.StructField("weather_code", T.IntegerType()),
])

KEY = ["station_id", "datetime"]

TARGET_RAW = "capacity_status_calc"
TARGET = "residual"

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's)
# ---------------------------------------------------------------------------
# The 24 model features, in the reference's order.
FEATURES = [
    "station_trend_avg", "hour", "day_of_week", "month",
    "hour_sin", "hour_cos", "dow_sin", "dow_cos",
    "is_holiday", "is_vacation",
    "apparent_temperature", "weather_severity", "is_frozen", "is_stormy",
    "capacity", "capacity_group",
    "lag_60min", "lag_240min", "lag_res_240min",
    "temp_anomalie", "is_peak_hour", "is_friday_evening", "is_monday_morning",
    "morning_evening_ratio",
]
# Features used during the hyper-parameter search (fitted ones left out).
FEATURES_SEARCH = [f for f in FEATURES if f not in ("station_trend_avg", "lag_res_240min")]

PEAK_HOURS = [7, 8, 9, 17, 18, 19]
MORNING_HOURS = [7, 8, 9]
EVENING_HOURS = [17, 18, 19]
# Capacity bins, right-closed: (0,20] (20,35] (35,50] (50,999] -> 0..3
CAPACITY_EDGES = [0, 20, 35, 50, 999]
# WMO weather code -> severity, by inclusive ranges; later rules win.
SEVERITY_RULES = [
    (1, [(4, 19)]),
    (2, [(20, 29), (40, 59)]),
    (3, [(60, 69), (80, 84)]),
    (4, [(30, 39), (70, 79), (85, None)]),
]
FROZEN_CODES = [56, 57, 66, 67, 70, 71, 72, 73, 74, 75, 76, 77, 78, 79, 85, 86]
STORMY_CODES = [17, 18, 19, 29, 90, 91, 92, 93, 94, 95, 96, 97, 98, 99]
SEVERITY_LABELS = ["Clair", "Nuageux", "Pluie légère", "Pluie forte", "Extrême"]
WEEKDAY_LABELS = ["Lun", "Mar", "Mer", "Jeu", "Ven", "Sam", "Dim"]
# Station profile thresholds on the morning/evening ratio.
RESIDENTIAL_ABOVE = 1.2
OFFICE_BELOW = 0.8
# Signed-error histogram edges of the evaluation report (plus open ends).
ERROR_EDGES = [-30, -20, -10, -5, -2, 0, 2, 5, 10, 20, 30]
# Fill-rate bands of the dashboard, right-closed.
FILL_BANDS = [0, 20, 40, 60, 80, 100]
# As-of lag: lags in minutes and forward tolerance.
LAG_MINUTES = [60, 240]
LAG_TOLERANCE_MINUTES = 30
TRAIN_QUANTILE = 0.80
MIN_TREND_SUPPORT = 3
BASELINE_NAME = "Baseline (moyenne)"
BASELINE_MAE_FALLBACK = 99.0
# Default model parameters.
RIDGE_ALPHA = 990.4792
RF_PARAMS = {"n_estimators": 468, "max_depth": 15, "min_samples_leaf": 146,
             "max_features": 0.9825487423645705}
GBT_PARAMS = {"n_estimators": 237, "max_depth": 7, "learning_rate": 0.011993285040303257,
              "subsample": 0.9654593914385029, "min_samples_leaf": 97,
              "max_features": 0.9991537490907574}
# XGBoost settings mapped onto Spark's GBT: column sampling -> feature subset per
# node, gamma -> minimum gain, min_child_weight -> minimum rows per node; the
# L1/L2 terms have no counterpart.
XGB_PARAMS = {"n_estimators": 232, "max_depth": 6, "learning_rate": 0.12272662063860754,
              "subsample": 0.9372938568071518, "colsample_bytree": 0.5236769398724859,
              "colsample_bylevel": 0.562214355487758, "min_child_weight": 21, "gamma": 0.7759872843048987}
# Search spaces: name -> (low, high, log scale, integer).
SEARCH_SPACES = {
    "ridge": {"alpha": (1e-4, 1e3, True, False)},
    "rf": {"n_estimators": (100, 500, False, True), "max_depth": (4, 15, False, True),
           "min_samples_leaf": (5, 150, False, True), "max_features": (0.3, 1.0, False, False)},
    "gbt": {"n_estimators": (100, 500, False, True), "max_depth": (3, 7, False, True),
            "learning_rate": (0.01, 0.3, True, False), "subsample": (0.5, 1.0, False, False),
            "min_samples_leaf": (10, 150, False, True), "max_features": (0.3, 1.0, False, False)},
    "gbt_es": {"n_estimators": (200, 800, False, True), "max_depth": (3, 9, False, True),
               "learning_rate": (0.01, 0.3, True, False), "subsample": (0.5, 1.0, False, False),
               "colsample_bytree": (0.5, 1.0, False, False), "colsample_bylevel": (0.5, 1.0, False, False),
               "min_child_weight": (1, 30, False, True), "gamma": (1e-5, 5.0, True, False)},
}
RANDOM_SEED = 42
