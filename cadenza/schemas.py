"""Declared schemas of the raw tables and of the landed payloads.

Every table leads with ``athlete_id``; keys are checked invariants, see
``operators.keyed`` and ``operators.quality``.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(),
    "str": T.StringType(),
    "ts": T.TimestampNTZType(),
    "date": T.DateType(),
    "dbl": T.DoubleType(),
    "int": T.IntegerType(),
    "bool": T.BooleanType(),
}


def _schema(spec: str) -> T.StructType:
    """Schema of lines ``type: name name ...``."""
    fields = []
    for line in spec.strip().splitlines():
        kind, names = line.split(":")
        fields += [T.StructField(n, _TYPES[kind.strip()]) for n in names.split()]
    return T.StructType(fields)


ACTIVITIES = _schema(
    """
    long: athlete_id
    str: activity_id activity_name
    ts: activity_date start_time_local start_time_gmt
    str: activity_type event_type device_name location_name
    dbl: distance_m distance_km duration_seconds duration_minutes moving_duration_seconds
    dbl: avg_speed_mps max_speed_mps avg_pace_min_km
    int: avg_heart_rate max_heart_rate
    dbl: elevation_gain_m elevation_loss_m min_elevation_m max_elevation_m
    int: calories avg_cadence max_cadence
    dbl: aerobic_training_effect anaerobic_training_effect
    dbl: weather_temp_c weather_feels_like_c
    int: weather_humidity_pct
    dbl: weather_wind_speed_ms
    str: weather_condition
    dbl: weather_precipitation_mm
    ts: inserted_at updated_at
    """
)
DAILY_HEALTH = _schema(
    """
    long: athlete_id
    date: date
    int: steps
    dbl: distance_m
    int: active_calories bmr_calories resting_heart_rate min_heart_rate max_heart_rate
    dbl: hrv_avg
    str: hrv_status
    int: sleep_seconds deep_sleep_seconds light_sleep_seconds rem_sleep_seconds awake_seconds
    int: stress_avg body_battery_charged body_battery_drained body_battery_high body_battery_low
    dbl: avg_waking_respiration_rate avg_sleep_respiration_rate
    ts: inserted_at updated_at
    """
)
CALENDAR_EVENTS = _schema(
    """
    long: athlete_id
    str: event_uuid title
    date: event_date
    str: location
    dbl: distance_m distance_km
    str: race_distance_category start_time timezone
    bool: is_race subscribed
    str: url
    ts: inserted_at updated_at
    """
)
RACE_GOALS = _schema(
    """
    long: athlete_id
    date: race_date
    str: race_name race_distance_category
    dbl: distance_km
    int: goal_time_seconds
    str: goal_time_formatted notes
    """
)
ANALYSIS_LOG = _schema(
    """
    long: athlete_id
    str: analysis_id
    ts: generated_at
    str: goal_distance
    int: goal_hours goal_minutes
    date: race_date
    str: city_name prompt_context response_md model_used
    ts: saved_at
    """
)

KEYS = {
    "activities": ["athlete_id", "activity_id"],
    "daily_health": ["athlete_id", "date"],
    "calendar_events": ["athlete_id", "event_uuid"],
    "race_goals": ["athlete_id", "race_date"],
    "analysis_log": ["athlete_id", "analysis_id"],
}
TABLES = {
    "activities": ACTIVITIES,
    "daily_health": DAILY_HEALTH,
    "calendar_events": CALENDAR_EVENTS,
    "race_goals": RACE_GOALS,
    "analysis_log": ANALYSIS_LOG,
}

# Landed JSON, one record per line, as DDL. ``athlete_id`` and the key of the request
# (activity, day or month) are added when a payload is landed.
ACTIVITY_PAYLOAD = """
    athlete_id BIGINT, activityId BIGINT, activityName STRING,
    startTimeLocal STRING, startTimeGMT STRING,
    activityType STRUCT<typeKey: STRING>, eventType STRUCT<typeKey: STRING>,
    distance DOUBLE, duration DOUBLE, movingDuration DOUBLE,
    averageSpeed DOUBLE, maxSpeed DOUBLE, averageHR DOUBLE, maxHR DOUBLE,
    elevationGain DOUBLE, elevationLoss DOUBLE, minElevation DOUBLE, maxElevation DOUBLE,
    calories DOUBLE, averageRunningCadenceInStepsPerMinute DOUBLE,
    maxRunningCadenceInStepsPerMinute DOUBLE,
    aerobicTrainingEffect DOUBLE, anaerobicTrainingEffect DOUBLE,
    deviceName STRING, locationName STRING
"""
# The payload is an array or a single object; Spark reads both as an array.
WEATHER_PAYLOAD = """
    ARRAY<STRUCT<
        temp: DOUBLE, apparentTemp: DOUBLE, relativeHumidity: INT, windSpeed: DOUBLE,
        weatherTypeDTO: STRUCT<desc: STRING>, weatherType: STRING, condition: STRING,
        precipitation: DOUBLE>>
"""
STATS_PAYLOAD = """
    athlete_id BIGINT, date DATE, totalSteps INT, totalDistanceMeters DOUBLE,
    activeKilocalories DOUBLE, bmrKilocalories DOUBLE,
    restingHeartRate INT, minHeartRate INT, maxHeartRate INT, averageStressLevel INT,
    bodyBatteryChargedValue INT, bodyBatteryDrainedValue INT,
    bodyBatteryHighestValue INT, bodyBatteryLowestValue INT,
    avgWakingRespirationValue DOUBLE, avgSleepRespirationValue DOUBLE
"""
HRV_PAYLOAD = "athlete_id BIGINT, date DATE, lastNightAvg DOUBLE, status STRING"
SLEEP_PAYLOAD = """
    athlete_id BIGINT, date DATE,
    dailySleepDTO STRUCT<
        sleepTimeSeconds: INT, deepSleepSeconds: INT, lightSleepSeconds: INT,
        remSleepSeconds: INT, awakeSleepSeconds: INT>
"""
CALENDAR_PAYLOAD = """
    athlete_id BIGINT, month STRING,
    calendarItems ARRAY<STRUCT<
        isRace: BOOLEAN, shareableEventUuid: STRING, id: STRING, title: STRING,
        date: STRING, location: STRING,
        completionTarget: STRUCT<value: DOUBLE, unit: STRING, unitType: STRING>,
        eventTimeLocal: STRUCT<startTimeHhMm: STRING, timeZoneId: STRING>,
        subscribed: BOOLEAN, url: STRING>>
"""
FORECAST_PAYLOAD = """
    athlete_id BIGINT, city STRING,
    daily STRUCT<
        time: ARRAY<STRING>, temperature_2m_min: ARRAY<DOUBLE>,
        temperature_2m_max: ARRAY<DOUBLE>, precipitation_sum: ARRAY<DOUBLE>,
        windspeed_10m_max: ARRAY<DOUBLE>, weathercode: ARRAY<INT>>
"""
