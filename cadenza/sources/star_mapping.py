"""How the star-schema test tables stand in for raw tables.

Column name to SQL text. The text is read by Spark and by the SQL engine that checks
it, so it keeps to what both understand: integer arithmetic, CASE, casts, and double
literals written with an exponent. ``k`` is the order key, ``c`` the customer key,
``ts`` the start time, ``d`` the day, ``h`` a per-day number, ``q`` a quantity.
"""

from __future__ import annotations

from cadenza import constants as K

# The day after the last order.
AS_OF = "2001-08-02"
# Load time given to tables the queries write.
LOADED_AT = "2001-08-02 06:00:00"


def whole(num: str, den: int) -> str:
    """Integer division of a non-negative number."""
    return f"CAST((({num}) - ({num}) % {den}) / {den} AS BIGINT)"


def half_up(x: str, places: int) -> str:
    """Round a value that is never negative."""
    return f"(floor({x} * 1e{places} + 0.5e0) / 1e{places})"


ATHLETE = whole("c", 30)

# Race lengths by order: 5 km, 10 km, half, marathon, 15 km, 50 km, each up to 60 m over.
_RACE_METRES = (
    "(CASE {n} WHEN 0 THEN 5000 WHEN 1 THEN 10100 WHEN 2 THEN 21100"
    " WHEN 3 THEN 42300 WHEN 4 THEN 15000 ELSE 50000 END + (k % 7) * 10)"
).format(n=f"({whole('k', 25)} % 6)")

# Columns built on the order row.
ACTIVITY_BASE = {
    "athlete_id": ATHLETE,
    "activity_id": "CAST(k AS STRING)",
    "activity_name": (
        "CASE k % 50 WHEN 1 THEN 'City Half' WHEN 2 THEN 'Trail Loop'"
        " WHEN 3 THEN 'Park 10K' WHEN 4 THEN NULL ELSE 'Morning Run' END"
    ),
    "activity_date": "ts",
    "start_time_local": "ts",
    "start_time_gmt": "ts - INTERVAL '1' HOUR",
    "activity_type": (
        "CASE k % 10 WHEN 0 THEN 'cycling' WHEN 5 THEN 'walking' ELSE 'running' END"
    ),
    "event_type": "CASE k % 25 WHEN 7 THEN 'race' WHEN 9 THEN 'training' ELSE NULL END",
    "device_name": "CASE k % 4 WHEN 0 THEN NULL ELSE 'Watch ' || CAST(k % 4 AS STRING) END",
    "location_name": "'City ' || CAST(c % 25 AS STRING)",
    "distance_m": (
        "CASE WHEN k % 97 = 0 THEN 0e0 WHEN k % 89 = 0 THEN NULL"
        f" WHEN k % 25 = 7 THEN CAST({_RACE_METRES} AS DOUBLE)"
        " ELSE CAST(2000 + (k * 7919) % 18000 AS DOUBLE) END"
    ),
    "avg_heart_rate": "CASE WHEN k % 17 = 0 THEN NULL ELSE CAST(110 + (k * 13) % 75 AS INT) END",
    "elevation_gain_m": "CASE WHEN k % 19 = 0 THEN NULL ELSE CAST((k * 29) % 400 AS DOUBLE) END",
    "elevation_loss_m": "CASE WHEN k % 23 = 0 THEN NULL ELSE CAST((k * 23) % 380 AS DOUBLE) END",
    "min_elevation_m": "CAST(k % 100 AS DOUBLE)",
    "max_elevation_m": "CAST(k % 100 + (k * 29) % 400 AS DOUBLE)",
    "calories": "CAST(200 + k % 700 AS INT)",
    "avg_cadence": "CAST(150 + k % 40 AS INT)",
    "max_cadence": "CAST(165 + k % 40 AS INT)",
    "aerobic_training_effect": "CAST(k % 50 AS DOUBLE) / 1e1",
    "anaerobic_training_effect": (
        "CASE WHEN k % 13 = 0 THEN NULL ELSE CAST(k % 30 AS DOUBLE) / 1e1 END"
    ),
    "weather_temp_c": (
        "CASE WHEN k % 3 = 0 THEN NULL ELSE CAST((k * 3) % 350 AS DOUBLE) / 1e1 - 3e0 END"
    ),
    "weather_humidity_pct": "CAST(30 + k % 60 AS INT)",
    "weather_wind_speed_ms": "CAST((k * 7) % 120 AS DOUBLE) / 1e1",
    "weather_condition": (
        "CASE k % 6 WHEN 0 THEN 'CLEAR' WHEN 1 THEN 'PARTLY_CLOUDY' WHEN 2 THEN 'RAIN'"
        " WHEN 3 THEN 'SNOW' WHEN 4 THEN 'FOG' ELSE 'WINDY' END"
    ),
    "weather_precipitation_mm": (
        "CASE WHEN k % 4 = 0 THEN CAST(k % 60 AS DOUBLE) / 1e1 ELSE 0e0 END"
    ),
    "inserted_at": "order_ts + INTERVAL '1' DAY",
    "updated_at": "order_ts + INTERVAL '1' DAY",
}
# Columns built on the columns above, in steps.
ACTIVITY_STEPS = [
    {
        "duration_seconds": "distance_m * (250 + (k * 31) % 200) / 1e3",
        "distance_km": half_up("distance_m / 1e3", 2),
        "max_heart_rate": "CAST(avg_heart_rate + 10 + k % 20 AS INT)",
        "weather_feels_like_c": "weather_temp_c - 1e0",
    },
    {
        "duration_minutes": half_up("duration_seconds / 6e1", 2),
        "moving_duration_seconds": "CASE WHEN k % 11 = 0 THEN NULL ELSE duration_seconds * 0.95e0 END",
        "avg_speed_mps": "distance_m / nullif(duration_seconds, 0e0)",
        "max_speed_mps": "distance_m / nullif(duration_seconds, 0e0) * 1.3e0",
    },
    {
        "avg_pace_min_km": (
            "CASE WHEN k % 43 = 0 THEN NULL WHEN k % 41 = 0 THEN CAST(avg_heart_rate AS DOUBLE)"
            f" ELSE {half_up('duration_minutes / nullif(distance_km, 0e0)', 2)} END"
        ),
    },
]

# Every tenth athlete sleeps badly and stays tired.
_TIRED = "athlete_id % 10 = 3"
_SLEEP = f"CAST(CASE WHEN {_TIRED} THEN 3600 + h % 7200 ELSE 14400 + (h * 101) % 18000 END AS INT)"
_STEPS = "CAST((h * 13) % 15000 + q AS INT)"
HEALTH_BASE = {
    "athlete_id": "athlete_id",
    "date": "d",
    "steps": f"CASE WHEN h % 29 = 0 THEN NULL ELSE {_STEPS} END",
    "sleep_seconds": f"CASE WHEN h % 13 = 0 THEN NULL ELSE {_SLEEP} END",
    "resting_heart_rate": "CASE WHEN h % 31 = 0 THEN NULL ELSE CAST(42 + (h * 3) % 35 AS INT) END",
    "min_heart_rate": "CAST(38 + h % 20 AS INT)",
    "max_heart_rate": "CAST(120 + h % 70 AS INT)",
    "hrv_avg": "CASE WHEN h % 7 = 0 THEN NULL ELSE 15e0 + CAST((h * 11) % 600 AS DOUBLE) / 1e1 END",
    "hrv_status": (
        "CASE h % 4 WHEN 0 THEN 'BALANCED' WHEN 1 THEN 'UNBALANCED' WHEN 2 THEN 'LOW' ELSE 'POOR' END"
    ),
    "awake_seconds": "CAST((h * 7) % 3600 AS INT)",
    "stress_avg": (
        f"CASE WHEN h % 23 = 0 THEN NULL WHEN {_TIRED} THEN CAST(60 + h % 40 AS INT)"
        " ELSE CAST((h * 19) % 100 AS INT) END"
    ),
    "body_battery_charged": "CAST(h % 80 AS INT)",
    "body_battery_drained": (
        f"CAST(CASE WHEN {_TIRED} THEN 80 + h % 20 ELSE (h * 5) % 80 END AS INT)"
    ),
    "body_battery_high": "CASE WHEN h % 37 = 0 THEN NULL ELSE CAST(20 + (h * 3) % 80 AS INT) END",
    "body_battery_low": "CAST(h % 20 AS INT)",
    "active_calories": "CAST(h % 900 AS INT)",
    "bmr_calories": "CAST(1500 + h % 300 AS INT)",
    "avg_waking_respiration_rate": "13e0 + CAST(h % 40 AS DOUBLE) / 1e1",
    "avg_sleep_respiration_rate": "12e0 + CAST(h % 40 AS DOUBLE) / 1e1",
    "inserted_at": "CAST(d AS TIMESTAMP{ntz}) + INTERVAL '1' DAY",
    "updated_at": "CAST(d AS TIMESTAMP{ntz}) + INTERVAL '1' DAY",
}
HEALTH_STEPS = [
    {
        "distance_m": "steps * 0.75e0",
        "deep_sleep_seconds": f"CAST({whole('sleep_seconds', 5)} AS INT)",
        "rem_sleep_seconds": f"CAST({whole('sleep_seconds', 4)} AS INT)",
    },
    {"light_sleep_seconds": "sleep_seconds - deep_sleep_seconds - rem_sleep_seconds"},
]

_NO_DISTANCE = "k % 9 = 0"
CALENDAR_BASE = {
    "athlete_id": ATHLETE,
    "event_uuid": "CAST(k AS STRING)",
    "title": "CASE WHEN k % 21 = 0 THEN NULL ELSE 'Race ' || CAST(k AS STRING) END",
    "event_date": "CAST(order_ts AS DATE) + 200",
    "location": "CASE WHEN k % 8 = 0 THEN NULL ELSE 'City ' || CAST(c % 25 AS STRING) END",
    "distance_m": f"CASE WHEN {_NO_DISTANCE} THEN NULL ELSE CAST({_RACE_METRES} AS DOUBLE) END",
    "start_time": "'0' || CAST(6 + k % 4 AS STRING) || ':30'",
    "timezone": "'Europe/Paris'",
    "is_race": "TRUE",
    "subscribed": "k % 3 = 0",
    "url": "CASE WHEN k % 4 = 0 THEN NULL ELSE 'https://races.example/' || CAST(k AS STRING) END",
    "inserted_at": "order_ts + INTERVAL '1' DAY",
    "updated_at": "order_ts + INTERVAL '1' DAY",
}
CALENDAR_STEPS = [
    {"distance_km": half_up("distance_m / 1e3", 3)},
    {
        "race_distance_category": (
            "CASE "
            + " ".join(f"WHEN distance_km BETWEEN {lo}e0 AND {hi}e0 THEN '{label}'" for label, lo, hi in K.DISTANCE_BANDS)
            + f" WHEN distance_km > {K.ULTRA_ABOVE_KM}e0 THEN '{K.ULTRA_LABEL}' ELSE NULL END"
        )
    },
]
CALENDAR_FILTER = "o_orderpriority = '1-URGENT'"

# One goal per athlete and day: the least over its tagged races of every second kind.
GOAL_FILTER = "k % 50 = 7 AND duration_seconds > 0"
GOAL_SECONDS = "CAST(floor(duration_seconds * (0.9e0 + (k % 20) / 1e2)) AS INT)"

LOG_BASE = {
    "athlete_id": ATHLETE,
    "analysis_id": "'A' || CAST(k AS STRING)",
    "generated_at": "ts",
    "goal_distance": (
        f"CASE k % {len(K.DISTANCE_LABELS)} "
        + " ".join(f"WHEN {i} THEN '{label}'" for i, label in enumerate(K.DISTANCE_LABELS))
        + " END"
    ),
    "goal_hours": "CAST(CASE WHEN k % 3 = 0 THEN 0 ELSE k % 5 END AS INT)",
    "goal_minutes": "CAST(20 + k % 40 AS INT)",
    "race_date": "CAST(order_ts AS DATE) + 120",
    "city_name": "CASE WHEN k % 3 = 0 THEN NULL ELSE 'City ' || CAST(c % 25 AS STRING) END",
    "prompt_context": "'context of order ' || CAST(k AS STRING)",
    "response_md": "'response to order ' || CAST(k AS STRING)",
    "model_used": "'model-' || CAST(k % 3 AS STRING)",
    "saved_at": "ts + INTERVAL '1' HOUR",
}
LOG_FILTER = "o_orderpriority = '2-HIGH'"
