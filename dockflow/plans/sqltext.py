"""SQL building blocks shared by the oracle texts (valid in DuckDB).

They restate, in SQL, the same definitions the DataFrame operators use, so
the two engines can be compared value by value.
"""

from __future__ import annotations

from ..schema import (CAPACITY_EDGES, FROZEN_CODES, LAG_TOLERANCE_MINUTES, STORMY_CODES)
from ..sources.tables import readings_sql


def r(x: str, digits: int = 2) -> str:
    """numpy-style rounding: round_even(x * 10^d) / 10^d (+0 clears -0.0)."""
    s = f"1e{digits}"
    return f"(round_even(({x}) * {s}, 0) / {s} + 0e0)"


def no_nan(x: str) -> str:
    """DuckDB gives NaN where Spark gives NULL (e.g. corr of one row)."""
    return f"(CASE WHEN isnan({x}) THEN NULL ELSE {x} END)"


def truthy(c: str) -> str:
    return f"coalesce(lower(CAST({c} AS VARCHAR)) IN ('true','t','1'), false)"


def exact_mean(c: str) -> str:
    return f"(CAST(sum(CAST({c} AS DECIMAL(18,2))) AS DOUBLE) / count({c}))"


def exact_sum(c: str) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(18,2))) AS DOUBLE)"


def severity(c: str = "weather_code") -> str:
    return (f"CASE WHEN {c} BETWEEN 30 AND 39 OR {c} BETWEEN 70 AND 79 OR {c} >= 85 THEN 4 "
            f"WHEN {c} BETWEEN 60 AND 69 OR {c} BETWEEN 80 AND 84 THEN 3 "
            f"WHEN {c} BETWEEN 20 AND 29 OR {c} BETWEEN 40 AND 59 THEN 2 "
            f"WHEN {c} BETWEEN 4 AND 19 THEN 1 ELSE 0 END")


def capacity_group(c: str = "capacity") -> str:
    e = CAPACITY_EDGES
    parts = " ".join(f"WHEN {c} > {e[i]} AND {c} <= {e[i + 1]} THEN {i}" for i in range(len(e) - 1))
    return f"CASE {parts} END"


def in_list(c: str, values) -> str:
    return f"CAST(coalesce({c} IN ({', '.join(map(str, values))}), false) AS INT)"


def cyc(c: str, period: int, fn: str) -> str:
    return r(f"{fn}(2e0 * pi() * {c} / {period}e0)", 4)


READINGS = f"readings AS ({readings_sql()})"

# Clean readings.
CLEAN = f"""{READINGS},
tot AS (SELECT *, bikes_mechanical + bikes_ebike AS total_bikes,
               bikes_mechanical + bikes_ebike + numdocksavailable AS total_capacity
        FROM readings),
clean AS (SELECT *, {r('total_bikes / total_capacity * 100e0')} AS capacity_status_calc
          FROM tot WHERE total_capacity > 0 AND {truthy('is_renting')})"""

# Row features on top of C1.
ROWFEAT = f"""{CLEAN},
dp AS (SELECT *, CAST(hour(datetime) AS INT) AS hour, CAST(isodow(datetime) - 1 AS INT) AS day_of_week,
              CAST(month(datetime) AS INT) AS month FROM clean),
feat AS (SELECT * REPLACE (CAST({truthy('is_holiday')} AS INT) AS is_holiday,
                           CAST({truthy('is_vacation')} AS INT) AS is_vacation),
         {cyc('hour', 24, 'sin')} AS hour_sin, {cyc('hour', 24, 'cos')} AS hour_cos,
         {cyc('day_of_week', 7, 'sin')} AS dow_sin, {cyc('day_of_week', 7, 'cos')} AS dow_cos,
         CAST(hour IN (7,8,9,17,18,19) AS INT) AS is_peak_hour,
         CAST(day_of_week = 4 AND hour >= 17 AS INT) AS is_friday_evening,
         CAST(day_of_week = 0 AND hour < 10 AS INT) AS is_monday_morning,
         {capacity_group()} AS capacity_group,
         {severity()} AS weather_severity,
         {in_list('weather_code', FROZEN_CODES)} AS is_frozen,
         {in_list('weather_code', STORMY_CODES)} AS is_stormy
         FROM dp)"""

# Exploration prep (fill rate, date parts, severity).
VIZ = f"""{CLEAN},
viz AS (SELECT *, CAST(hour(datetime) AS INT) AS hour, CAST(isodow(datetime) - 1 AS INT) AS day_of_week,
               CAST(month(datetime) AS INT) AS month, {severity()} AS weather_severity FROM clean)"""

_TOL_US = LAG_TOLERANCE_MINUTES * 60 * 1_000_000


def lag_expr(minutes: int, name: str) -> str:
    lo = minutes * 60 * 1_000_000
    hi = lo - _TOL_US
    return (f"first_value(capacity_status_calc) OVER (PARTITION BY station_id ORDER BY us "
            f"RANGE BETWEEN {lo} PRECEDING AND {hi} PRECEDING) AS {name}")


# Lagged features (J1 x2 + P20).
LAGGED = f"""{ROWFEAT},
withus AS (SELECT *, epoch_us(datetime) AS us FROM feat),
lagged_all AS (SELECT *, {lag_expr(60, 'lag_60min')}, {lag_expr(240, 'lag_240min')} FROM withus),
lagged AS (SELECT * FROM lagged_all WHERE lag_60min IS NOT NULL AND lag_240min IS NOT NULL)"""
