"""One SQL text per query, over the named subqueries of ``oracles.base``."""

from __future__ import annotations

import re

from cadenza import quality_specs, schemas
from cadenza.catalog import ROUNDED
from cadenza.sources import star_batches as B
from cadenza.sources import star_mapping as M

from oracles import values as K
from oracles.base import TODAY, X, assemble, listed, quote, r, s

SQL: dict[str, str] = {}


def choose(name: str, source: str, columns: str) -> None:
    SQL[name] = f"SELECT {', '.join(columns.split())} FROM {source}"


ACT = "athlete_id activity_id "
WEEK = "athlete_id week_start_date "
RACE = "athlete_id race_id "
EVENT = "athlete_id event_uuid "


def names(table: str, skip: tuple[str, ...] = ()) -> str:
    return ", ".join(f.name for f in schemas.TABLES[table].fields if f.name not in skip)


def newest(source: str, n: int, order: str, keys: str = "athlete_id") -> str:
    return (
        f"SELECT * FROM {source} QUALIFY row_number() OVER"
        f" (PARTITION BY {keys} ORDER BY {order}) <= {n}"
    )


LOADED = f"TIMESTAMP '{M.LOADED_AT}'"
AUDIT = ("inserted_at", "updated_at")

# -- sources, normalisation, loads, sinks -------------------------------------------

SQL["src_activities"] = f"SELECT {names('activities')} FROM x_activities"
SQL["src_daily_health"] = f"SELECT {names('daily_health')} FROM x_daily_health"
SQL["src_calendar"] = f"SELECT {names('calendar_events')} FROM x_calendar"
SQL["src_goals_csv"] = f"SELECT {names('race_goals')} FROM x_goals"

_pace = r("(duration_minutes / nullif(distance_km, 0))", 2)
SQL["norm_activities"] = f"""
SELECT {names('activities', (*K.WEATHER_FIELDS, *AUDIT, 'distance_m', 'distance_km',
                             'duration_seconds', 'duration_minutes',
                             'moving_duration_seconds', 'avg_pace_min_km'))},
  coalesce(distance_m, 0) AS distance_m, coalesce(distance_km, 0) AS distance_km,
  coalesce(duration_seconds, 0) AS duration_seconds,
  coalesce(duration_minutes, 0) AS duration_minutes,
  coalesce(moving_duration_seconds, 0) AS moving_duration_seconds,
  CASE WHEN distance_km > 0 AND duration_minutes > 0 THEN {_pace} END AS avg_pace_min_km
FROM x_activities
"""
_sleep_columns = [
    "sleep_seconds",
    "deep_sleep_seconds",
    "light_sleep_seconds",
    "rem_sleep_seconds",
    "awake_seconds",
]
SQL["norm_daily_health"] = f"""
SELECT {names('daily_health', (*AUDIT, 'hrv_avg', 'hrv_status', *_sleep_columns))},
  CASE WHEN h % 7 <> 0 THEN hrv_avg END AS hrv_avg,
  CASE WHEN h % 7 <> 0 THEN hrv_status END AS hrv_status,
  {', '.join(f"CASE WHEN h % 13 <> 0 THEN {n} END AS {n}" for n in _sleep_columns)}
FROM x_daily_health
"""
SQL["norm_calendar"] = f"""
SELECT {names('calendar_events', AUDIT)} FROM x_calendar
"""
X["x_weather"] = f"""
SELECT athlete_id, activity_id, k, {r('((f - 32) / 1.8e0)', 1)} AS weather_temp_c,
  {r('((feels - 32) / 1.8e0)', 1)} AS weather_feels_like_c,
  CASE WHEN known THEN CAST(30 + k % 60 AS INTEGER) END AS weather_humidity_pct,
  CASE WHEN known THEN {r('(CAST((k * 3) % 50 AS DOUBLE) / 3.6e0)', 2)} END
    AS weather_wind_speed_ms,
  CASE WHEN known THEN CASE k % 6 WHEN 0 THEN 'FAIR' WHEN 1 THEN 'PARTLY_CLOUDY'
    WHEN 2 THEN 'LIGHT_RAIN' WHEN 3 THEN 'SNOW' WHEN 4 THEN 'FOG' ELSE 'WINDY_DAY' END END
    AS weather_condition,
  CASE WHEN known AND k % 5 = 0 THEN CAST(k % 60 AS DOUBLE) / 10 END AS weather_precipitation_mm
FROM (SELECT *, CASE WHEN known THEN CAST(20 + (k * 7) % 80 AS DOUBLE) END AS f,
        CASE WHEN known AND k % 5 <> 0 THEN CAST(18 + (k * 7) % 80 AS DOUBLE) END AS feels
      FROM (SELECT athlete_id, activity_id, k, k % 3 <> 0 AND k % 21 <> 7 AS known
            FROM x_activities))
"""
SQL["norm_weather"] = "SELECT * EXCLUDE (k) FROM x_weather"
_codes = " ".join(f"WHEN {code} THEN {quote(label)}" for code, label in K.WEATHER_CODES.items())
X["x_forecast"] = f"""
SELECT athlete_id, city, day AS date, dayname(day) AS day_name,
  {r('low', 1)} AS temp_min_c, {r('high', 1)} AS temp_max_c,
  CASE code {_codes} ELSE 'Code ' || CAST(code AS VARCHAR) END AS condition,
  wind AS wind_kmh, {r('rain', 1)} AS precipitation_mm
FROM (
  SELECT {M.whole('c_custkey', 30)} AS athlete_id, 'City ' || CAST(c_custkey AS VARCHAR) AS city,
    {TODAY} + CAST(i AS INTEGER) AS day,
    CASE WHEN (c_custkey + i) % 11 = 0 THEN 0e0
      ELSE CAST((c_custkey * 3 + i * 5) % 40 - 5 AS DOUBLE) + 0.25e0 END AS low,
    CAST((c_custkey * 3 + i * 5) % 40 + 5 AS DOUBLE) + 0.25e0 AS high,
    CAST((c_custkey + i * 7) % 80 AS DOUBLE) / 1e1 AS rain,
    CAST((c_custkey * 2 + i) % 45 AS DOUBLE) AS wind,
    [0, 1, 2, 3, 45, 61, 95, 7][CAST((c_custkey + i) % 8 AS INTEGER) + 1] AS code
  FROM customer, range({B.FORECAST_DAYS}) days(i))
"""
SQL["norm_forecast"] = "SELECT * FROM x_forecast"
SQL["clean_activities"] = """
SELECT athlete_id, activity_id, CAST(CASE WHEN k % 4 = 0 THEN 1 ELSE 0 END AS INTEGER) AS fetch,
  CASE WHEN k % 4 = 0 THEN 'Renamed' ELSE activity_name END AS activity_name,
  CASE WHEN k % 16 <> 0 THEN activity_date END AS activity_date
FROM x_activities
"""
SQL["flatten_nested"] = """
SELECT athlete_id, k AS activityId, activity_type AS activityType_typeKey,
  event_type AS place_eventType_typeKey, location_name AS place_locationName
FROM x_activities
"""
SQL["conform_schema"] = """
SELECT athlete_id, activity_id, CAST(NULL AS VARCHAR) AS event_type, distance_km,
  CAST(NULL AS DOUBLE) AS weather_temp_c, weather_condition
FROM x_activities
"""

X["x_stored"] = f"SELECT * FROM x_activities WHERE activity_date < DATE '{B.STORED_UNTIL}'"
X["x_batch"] = f"""
SELECT * REPLACE ('Fetched again' AS activity_name,
    coalesce(weather_temp_c, CASE WHEN k % 2 = 0 THEN 11.5e0 END) AS weather_temp_c,
    CAST(CASE WHEN k % 2 = 0 THEN 77 END AS INTEGER) AS weather_humidity_pct,
    CASE WHEN k % 12 <> 3 THEN 'FOUND' END AS weather_condition,
    CAST(NULL AS DOUBLE) AS weather_feels_like_c, CAST(NULL AS DOUBLE) AS weather_wind_speed_ms,
    CAST(NULL AS DOUBLE) AS weather_precipitation_mm,
    {LOADED} AS inserted_at, {LOADED} AS updated_at)
FROM x_activities WHERE activity_date >= DATE '{B.REFETCH_FROM}'
"""
_loaded = """athlete_id, activity_id, activity_name, activity_date, distance_km, weather_temp_c,
weather_humidity_pct, weather_wind_speed_ms, weather_condition, inserted_at, updated_at"""
SQL["load_replace"] = f"SELECT {_loaded} FROM x_batch"
SQL["load_append"] = f"""
SELECT {_loaded} FROM x_stored UNION ALL
SELECT {_loaded.replace('inserted_at, updated_at', f'{LOADED}, {LOADED}')} FROM x_activities
WHERE activity_date >= DATE '{B.STORED_UNTIL}'
"""
_unseen = "WHERE k NOT IN (SELECT k FROM x_stored)"
SQL["load_upsert_new"] = f"""
SELECT {_loaded} FROM x_stored UNION ALL SELECT {_loaded} FROM x_batch {_unseen}
"""


def _filled(batch: str) -> str:
    """Stored rows with the weather of a batch where theirs has no temperature."""
    fields = ["weather_temp_c", "weather_humidity_pct", "weather_wind_speed_ms", "weather_condition"]
    some = " OR ".join(f"b.{f} IS NOT NULL" for f in K.WEATHER_FIELDS)
    gap = f"s.weather_temp_c IS NULL AND ({some})"
    taken = ", ".join(f"CASE WHEN {gap} THEN coalesce(b.{f}, s.{f}) ELSE s.{f} END AS {f}" for f in fields)
    return f"""
SELECT s.athlete_id, s.activity_id, s.activity_name, s.activity_date, s.distance_km, {taken},
  s.inserted_at, CASE WHEN {gap} THEN {LOADED} ELSE s.updated_at END AS updated_at
FROM {{stored}} s LEFT JOIN {batch} b USING (k)
"""


SQL["backfill_weather"] = _filled("x_batch").format(stored="x_stored")
X["x_landed"] = f"""
SELECT * REPLACE (coalesce(distance_km, 0) AS distance_km, {LOADED} AS inserted_at,
    {LOADED} AS updated_at, {', '.join(f'CAST(NULL AS {t}) AS {n}' for n, t in [
      ('weather_temp_c', 'DOUBLE'), ('weather_feels_like_c', 'DOUBLE'),
      ('weather_humidity_pct', 'INTEGER'), ('weather_wind_speed_ms', 'DOUBLE'),
      ('weather_condition', 'VARCHAR'), ('weather_precipitation_mm', 'DOUBLE')])})
FROM x_activities
"""
X["x_first_drop"] = f"SELECT * FROM x_landed WHERE activity_date < DATE '{B.STORED_UNTIL}'"
X["x_second_weather"] = f"""
SELECT w.* FROM x_weather w JOIN x_activities a USING (k)
WHERE a.activity_date >= DATE '{B.REFETCH_FROM}'
"""
SQL["ingest_incremental"] = f"""
{_filled('x_second_weather').format(stored='x_first_drop')}
UNION ALL
SELECT a.athlete_id, a.activity_id, a.activity_name, a.activity_date, a.distance_km,
  w.weather_temp_c, w.weather_humidity_pct, w.weather_wind_speed_ms, w.weather_condition,
  a.inserted_at, a.updated_at
FROM x_landed a JOIN x_weather w USING (k) WHERE a.activity_date >= DATE '{B.STORED_UNTIL}'
"""
_moved = f"""
SELECT * REPLACE ('Updated ' || event_uuid AS title,
  CASE WHEN k % 5 = 0 THEN event_date + 40 ELSE event_date END AS event_date,
  {LOADED} AS inserted_at, {LOADED} AS updated_at)
FROM x_calendar WHERE event_date >= DATE '{B.EVENTS_FROM}'
"""
SQL["load_replace_by_key"] = f"""
SELECT {names('calendar_events')} FROM x_calendar WHERE event_date < DATE '{B.EVENTS_FROM}'
UNION ALL SELECT {names('calendar_events')} FROM ({_moved})
"""
_stamped = f"{LOADED} AS inserted_at, {LOADED} AS updated_at"
SQL["ingest_health"] = f"""
SELECT * REPLACE (CASE WHEN date >= DATE '{B.STORED_UNTIL}' THEN steps + 1000 ELSE steps END AS steps), {_stamped}
FROM ({SQL['norm_daily_health']})
"""
SQL["ingest_calendar"] = f"""
SELECT * REPLACE ({_stamped})
FROM ({SQL['load_replace_by_key']})
"""
SQL["delete_by_key"] = f"SELECT {names('analysis_log')} FROM x_log WHERE model_used <> 'model-1'"

SQL["sink_marts"] = (
    "SELECT athlete_id, week_start_date, total_activities, total_distance_km FROM x_mt"
)
choose("sink_mart_health", "x_mh", "athlete_id date recovery_score training_readiness")
for _name in ("sink_mart_race", "sink_mart_changes"):
    choose(_name, "x_mr", RACE + "race_number is_personal_record training_runs_30d")
SQL["sink_views"] = (
    "SELECT athlete_id, effort_level, count(*) AS activities FROM x_stg GROUP BY 1, 2"
)
_YEAR_BACK = f"BETWEEN CAST({TODAY} - INTERVAL 12 MONTH AS DATE) AND {TODAY}"
SQL["sink_csv"] = f"""
SELECT athlete_id, date, recovery_score, training_readiness FROM x_mh WHERE date {_YEAR_BACK}
"""
SQL["table_counts"] = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {x}"
    for n, x in [
        ("activities", "x_activities"),
        ("daily_health", "x_daily_health"),
        ("calendar_events", "x_calendar"),
    ]
)
SQL["table_newest"] = """
SELECT athlete_id, activity_id, activity_name, activity_date FROM x_activities
ORDER BY activity_date DESC, activity_id DESC LIMIT 20
"""

# -- staging ------------------------------------------------------------------------

for _name, _columns in {
    "act_time_parts": "activity_date start_hour day_of_week",
    "act_distance_default": "distance_km",
    "act_moving_pause": "moving_duration_minutes pause_duration_minutes",
    "act_pace_sanity": "avg_pace_min_km",
    "act_speed_kmh": "avg_speed_kmh max_speed_kmh",
    "act_hr_delta": "avg_heart_rate max_heart_rate hr_delta",
    "act_elevation": "net_elevation_m elevation_range_m",
    "act_training_effect": "total_training_effect",
    "act_is_race": "is_race",
    "act_distance_category": "race_distance_category",
    "act_pace_zone": "pace_zone",
    "act_hr_zone": "hr_zone",
    "act_effort_level": "effort_level",
    "act_training_load": "training_load",
    "act_terrain": "terrain_type",
    "act_time_of_day": "time_of_day",
    "act_is_weekend": "is_weekend",
    "act_quality_flags": "has_data_quality_issues is_very_short has_unrealistic_pace",
}.items():
    choose(_name, "x_act", ACT + _columns)
choose("act_valid_filter", "x_stg", ACT + "distance_km duration_minutes")
SQL["stg_activities"] = "SELECT * FROM x_stg"

DAY = "athlete_id health_date "
for _name, _columns in {
    "hlt_date_dims": "day_of_week week_of_year month_number year_number",
    "hlt_movement": "steps daily_distance_km active_calories bmr_calories total_calories",
    "hlt_sleep_hours": "sleep_hours deep_sleep_hours light_sleep_hours rem_sleep_hours awake_hours",
    "hlt_sleep_efficiency": "sleep_efficiency_pct",
    "hlt_stage_pct": "deep_sleep_pct rem_sleep_pct",
    "hlt_battery_net": "body_battery_net",
    "hlt_is_weekend": "is_weekend",
    "hlt_sleep_quality": "sleep_quality",
    "hlt_stress_category": "stress_category",
    "hlt_battery_status": "body_battery_status",
    "hlt_hrv_category": "hrv_category",
    "hlt_steps_goal": "steps_goal_met",
    "hlt_recovery_score": "recovery_score",
    "hlt_missing_flags": "has_missing_sleep has_missing_hr",
}.items():
    choose(_name, "x_hlt", DAY + _columns)
choose("hlt_valid_filter", "x_stgh", DAY + "steps sleep_hours")
SQL["stg_health"] = "SELECT * FROM x_stgh"
choose("cal_dates", "x_cal", EVENT + "event_year event_month")
choose("cal_days_until", "x_cal", EVENT + "days_until_race is_upcoming")
choose("cal_season", "x_cal", EVENT + "race_season")
SQL["stg_calendar"] = "SELECT * FROM x_cal"

choose(
    "uni_join_health",
    "x_uni",
    ACT + "recovery_score pre_run_sleep_hours daily_resting_hr is_missing_health_context",
)
choose("uni_readiness", "x_uni", ACT + "training_readiness")
choose("uni_ran_while_tired", "x_uni", ACT + "ran_while_tired")
choose("uni_workout_context", "x_uni", ACT + "workout_context")
choose("uni_source_tag", "x_uni", ACT + "data_source")
SQL["int_unified"] = "SELECT * FROM x_uni"

# -- joins --------------------------------------------------------------------------

SQL["join_week_spine"] = """
SELECT sp.athlete_id, sp.week_start_date, m.year, m.week_number, m.week_label,
  w.n AS total_activities, w.km AS total_distance_km
FROM (SELECT DISTINCT athlete_id, CAST(date_trunc('week', activity_date) AS DATE) AS week_start_date
      FROM x_stg WHERE activity_type = 'running') sp
JOIN x_mt m USING (athlete_id, week_start_date)
LEFT JOIN x_week w USING (athlete_id, week_start_date)
"""
SQL["join_pr"] = """
SELECT athlete_id, race_id, race_distance_category, pr_minutes AS pr_duration_minutes,
  pr_pace AS pr_pace_min_per_km FROM x_rmet
"""
SQL["join_training_context_rows"] = """
SELECT athlete_id, race_id, pace_30d AS avg_training_pace_30d,
  km_30d AS total_training_distance_30d, runs_30d AS training_runs_30d FROM x_train
"""
SQL["join_goals"] = """
SELECT athlete_id, race_id, race_date, goal_race_name, goal_time_seconds, notes AS goal_notes
FROM x_rmet
"""
SQL["join_range_30d"] = """
SELECT athlete_id, race_id, r.race_date, matched_30d AS matched_runs_30d,
  km_30d AS total_training_distance_30d FROM x_train JOIN x_race r USING (athlete_id, race_id)
"""
SQL["join_upcoming_goals"] = """
SELECT e.athlete_id, e.event_uuid, e.title, e.event_date, g.race_name AS goal_name,
  g.race_distance_category AS goal_dist_cat, g.goal_time_formatted AS goal_time,
  g.notes AS goal_notes
FROM x_cal e LEFT JOIN x_goals g ON g.athlete_id = e.athlete_id AND g.race_date = e.event_date
WHERE e.is_upcoming
"""
X["x_runs"] = """
SELECT athlete_id, CAST(date_trunc('week', activity_date) AS DATE) AS week_start_date,
  count(*) AS total_runs FROM x_stg WHERE activity_type = 'running' GROUP BY 1, 2
"""
X["x_mt_runs"] = """
SELECT m.*, coalesce(total_runs, 0) AS total_runs, total_duration_minutes / 60 AS total_duration_hours
FROM x_mt m LEFT JOIN x_runs USING (athlete_id, week_start_date)
"""
choose("join_runs_per_week", "x_mt_runs", WEEK + "total_activities total_runs total_duration_hours")

_repaired = f"""CASE WHEN avg_pace_min_km BETWEEN 2 AND 20 THEN avg_pace_min_km
  WHEN distance_km > 0 THEN {r('(duration_minutes / nullif(distance_km, 0))', 3)} END"""
X["x_wact"] = f"""
SELECT athlete_id, activity_id, activity_name, CAST(activity_date AS DATE) AS activity_date,
  activity_date AS started_at, activity_type, distance_km, duration_minutes,
  {_repaired} AS avg_pace_min_km, avg_heart_rate, {r('weather_temp_c', 1)} AS temp_c,
  weather_temp_c AS temp_raw, weather_humidity_pct AS humidity_pct,
  {r('(weather_wind_speed_ms * 3.6)', 1)} AS wind_kmh, weather_condition,
  weather_precipitation_mm AS precipitation_mm
FROM x_activities
WHERE weather_temp_c IS NOT NULL AND distance_km > 0 AND duration_minutes >= 5
"""
X["x_recent"] = f"""
SELECT athlete_id, activity_id, activity_date, activity_name, activity_type, distance_km,
  duration_minutes, {r('(duration_minutes / distance_km)', 3)} AS pace_min_km, avg_heart_rate,
  elevation_gain_m, training_load, pace_zone
FROM ({newest('x_stg', 10, 'activity_date DESC, activity_id DESC')})
"""
SQL["join_recent_weather"] = f"""
SELECT a.athlete_id, a.activity_id, a.activity_date, w.temp_c, w.weather_condition
FROM x_recent a LEFT JOIN (
  {newest('x_wact', 1, 'started_at DESC, activity_id DESC', 'athlete_id, activity_date')}) w
ON w.athlete_id = a.athlete_id AND w.activity_date = a.activity_date
"""
SQL["join_week_training_health"] = f"""
SELECT * FROM (
  SELECT t.athlete_id, t.week_start_date, {s('avg(t.total_distance_km)', 1)} AS avg_distance,
    {s('avg(h.recovery_score)', 1)} AS avg_recovery, {s('avg(h.total_sleep_hours)', 1)} AS avg_sleep
  FROM x_mt t JOIN x_mh h ON h.athlete_id = t.athlete_id AND h.week_start_date = t.week_start_date
  GROUP BY 1, 2)
QUALIFY row_number() OVER (PARTITION BY athlete_id ORDER BY week_start_date DESC) <= 4
"""
SQL["join_day_workouts"] = f"""
SELECT h.athlete_id, h.date, h.recovery_score, h.training_readiness,
  count(a.activity_id) AS num_workouts, {s('coalesce(sum(a.distance_km), 0)', 1)} AS total_distance
FROM ({newest('x_mh', 7, 'date DESC')}) h
LEFT JOIN x_stg a ON a.athlete_id = h.athlete_id AND a.activity_date = h.date
GROUP BY 1, 2, 3, 4
"""
SQL["join_pre_race_health"] = """
SELECT r.athlete_id, r.race_id, r.race_date, r.finish_time_formatted,
  h.recovery_score AS pre_race_recovery, h.total_sleep_hours AS pre_race_sleep
FROM x_mr r LEFT JOIN x_mh h ON h.athlete_id = r.athlete_id AND r.race_date = h.date + 1
"""
SQL["anti_new_keys"] = f"SELECT athlete_id, activity_id, activity_name FROM x_batch {_unseen}"
SQL["semi_null_weather"] = """
SELECT athlete_id, activity_id, weather_temp_c, weather_condition FROM x_batch
WHERE k IN (SELECT k FROM x_stored WHERE weather_temp_c IS NULL)
  AND (weather_temp_c IS NOT NULL OR weather_humidity_pct IS NOT NULL
    OR weather_condition IS NOT NULL)
"""

# -- aggregations -------------------------------------------------------------------

_KEY = "SELECT athlete_id, week_start_date,"
SQL["agg_week_counts"] = f"{_KEY} n AS total_activities, races AS total_races FROM x_week"
SQL["agg_week_distance"] = f"""{_KEY} km AS total_distance_km,
  km_mean AS avg_distance_per_activity_km, km_max AS max_distance_km,
  minutes AS total_duration_minutes, minutes_mean AS avg_duration_per_activity_minutes FROM x_week"""
SQL["agg_weighted_pace"] = f"{_KEY} pace AS avg_pace_min_per_km FROM x_week"
SQL["agg_week_hr"] = f"{_KEY} hr AS avg_heart_rate_bpm, hr_max AS max_heart_rate_bpm FROM x_week"
SQL["agg_week_elevation"] = f"""{_KEY} gain AS total_elevation_gain_m,
  gain_mean AS avg_elevation_per_activity_m FROM x_week"""
SQL["agg_effort_avg"] = f"{_KEY} effort AS avg_effort_level FROM x_week"
SQL["agg_week_load"] = f"{_KEY} load AS total_training_load FROM x_week"
SQL["agg_zone_share"] = f"""{_KEY} z1 AS pct_zone1_easy, z2 AS pct_zone2_moderate,
  z3 AS pct_zone3_tempo, z4 AS pct_zone4_threshold, z5 AS pct_zone5_max,
  z5_actual AS pct_zone5_actual FROM x_week"""
SQL["agg_pr"] = """
SELECT athlete_id, race_distance_category, pr_minutes AS pr_duration_minutes,
  pr_pace AS pr_pace_min_per_km FROM x_pr
"""
SQL["agg_training_context"] = """
SELECT DISTINCT t.athlete_id, r.race_date, round(pace_30d, 9) AS avg_training_pace_30d,
  round(km_30d, 9) AS total_training_distance_30d, runs_30d AS training_runs_30d
FROM x_train t JOIN x_race r ON r.athlete_id = t.athlete_id AND r.race_id = t.race_id
"""
SQL["agg_activity_overview"] = f"""
SELECT athlete_id, count(*) AS total_runs, {s('sum(distance_km)', 2)} AS total_distance_km,
  {s('avg(distance_km)', 2)} AS avg_distance_km, {s('(sum(duration_minutes) / 60)', 1)} AS total_hours,
  {s('avg(avg_heart_rate)', 0)} AS avg_heart_rate, {s('avg(avg_pace_min_km)', 2)} AS avg_pace_min_km,
  min(activity_date) AS first_activity, max(activity_date) AS last_activity
FROM x_activities GROUP BY 1
"""
SQL["agg_health_overview"] = f"""
SELECT athlete_id, count(*) AS total_days, {s('avg(steps)', 0)} AS avg_steps,
  {s('avg(resting_heart_rate)', 0)} AS avg_resting_hr, {s('avg(hrv_avg)', 0)} AS avg_hrv,
  {s('(avg(sleep_seconds) / 3600)', 1)} AS avg_sleep_hours, {s('avg(stress_avg)', 0)} AS avg_stress,
  min(date) AS first_record, max(date) AS last_record
FROM x_daily_health GROUP BY 1
"""
SQL["agg_activity_types"] = f"""
SELECT athlete_id, activity_type, count(*) AS activities,
  {s('sum(distance_km)', 2)} AS total_distance_km FROM x_activities GROUP BY 1, 2
"""
SQL["agg_runs_per_week"] = "SELECT * FROM x_runs"
SQL["agg_null_coverage"] = """
SELECT athlete_id, count(*) AS total, count(weather_temp_c) AS non_null,
  count(*) FILTER (weather_temp_c IS NULL) AS nulls FROM x_activities GROUP BY 1
"""
SQL["agg_date_range"] = """
SELECT athlete_id, min(week_start_date) AS min_date, max(week_start_date) AS max_date
FROM x_week GROUP BY 1
"""
SQL["agg_effort_totals"] = """
SELECT athlete_id, effort_level, count(*) AS num_activities, sum(distance_km) AS total_distance
FROM x_stg WHERE activity_type = 'running' GROUP BY 1, 2
"""
SQL["agg_weekend_split"] = """
SELECT athlete_id, is_weekend, avg(distance_km) AS avg_distance, avg(avg_pace_min_km) AS avg_pace
FROM x_stg WHERE activity_type = 'running' GROUP BY 1, 2
"""
SQL["agg_iso_week_recovery"] = """
SELECT athlete_id, year_number, week_of_year, avg(recovery_score) AS avg_recovery,
  avg(sleep_hours) AS avg_sleep, avg(resting_heart_rate) AS avg_rhr
FROM x_stgh GROUP BY 1, 2, 3
"""
_week_days = K.WEEKDAYS[1:] + K.WEEKDAYS[:1]
SQL["agg_weekday_profile"] = f"""
SELECT athlete_id, day_of_week, count(*) AS days, {s('avg(recovery_score)', 1)} AS avg_score,
  {s('avg(total_sleep_hours)', 2)} AS avg_sleep,
  {s("(avg(CAST(sleep_quality_category = 'excellent' AS INTEGER)) * 100)", 1)} AS pct_excellent,
  {s('avg(sleep_debt_hours)', 2)} AS avg_debt, avg(average_stress_level) AS avg_stress,
  CAST(list_position([{listed(_week_days)}], day_of_week) AS INTEGER) AS weekday_order
FROM x_mh GROUP BY 1, 2
"""
SQL["agg_week_health"] = f"""
SELECT * FROM (
  SELECT athlete_id, week_start_date, {s('avg(recovery_score)', 1)} AS avg_recovery,
    {s('avg(total_sleep_hours)', 1)} AS avg_sleep, {s('avg(resting_heart_rate)', 1)} AS avg_rhr
  FROM x_mh GROUP BY 1, 2)
QUALIFY row_number() OVER (PARTITION BY athlete_id ORDER BY week_start_date DESC) <= 4
"""
SQL["agg_rhr_week_spread"] = """
SELECT athlete_id, week_start_date, avg(resting_heart_rate) AS week_avg_rhr,
  min(resting_heart_rate) AS lowest_rhr, max(resting_heart_rate) AS highest_rhr,
  avg(rhr_vs_7day_avg) AS avg_deviation
FROM x_mh GROUP BY 1, 2
"""
SQL["agg_readiness_distribution"] = f"""
SELECT athlete_id, training_readiness, count(*) AS days, {s('avg(recovery_score)', 1)} AS avg_score,
  {s('avg(total_sleep_hours)', 1)} AS avg_sleep, {s('avg(resting_heart_rate)', 1)} AS avg_rhr,
  {s('(count(*) / CAST(sum(count(*)) OVER (PARTITION BY athlete_id) AS DOUBLE) * 100)', 1)}
    AS pct_of_days,
  CAST(list_position([{listed(K.READINESS_ORDER)}], training_readiness) AS INTEGER) AS level_order
FROM x_mh GROUP BY 1, 2
"""
SQL["agg_health_extremes"] = """
SELECT athlete_id, min(recovery_score) AS min_score, max(recovery_score) AS max_score,
  min(resting_heart_rate) AS min_rhr, max(resting_heart_rate) AS max_rhr,
  min(total_sleep_hours) AS min_sleep, max(total_sleep_hours) AS max_sleep
FROM x_mh GROUP BY 1
"""
choose("distinct_weeks", "x_mt", WEEK + "year week_number")

# -- windows ------------------------------------------------------------------------

for _n in (4, 8):
    SQL[f"win_roll_{_n}wk"] = f"""{_KEY} km{_n} AS rolling_{_n}wk_avg_distance_km,
  n{_n} AS rolling_{_n}wk_avg_activities, minutes{_n} AS rolling_{_n}wk_avg_duration_minutes,
  load{_n} AS rolling_{_n}wk_avg_training_load FROM x_roll"""
SQL["win_prev_week"] = f"""{_KEY} km_before AS prev_week_distance_km,
  n_before AS prev_week_activities, pace_before AS prev_week_avg_pace FROM x_roll"""
_HKEY = "SELECT athlete_id, health_date,"
SQL["win_roll_7day"] = f"""{_HKEY} sleep7 AS sleep_7day_avg, deep7 AS deep_sleep_7day_avg,
  rhr7 AS rhr_7day_avg, hrv7 AS hrv_7day_avg, stress7 AS stress_7day_avg,
  steps7 AS steps_7day_avg FROM x_hroll"""
SQL["win_roll_28day"] = f"{_HKEY} sleep28 AS sleep_28day_avg, rhr28 AS rhr_28day_avg FROM x_hroll"
SQL["win_prev_day"] = f"""{_HKEY} sleep_1 AS prev_day_sleep_hours, rhr_1 AS prev_day_rhr,
  stress_1 AS prev_day_stress, battery_1 AS prev_day_battery_change FROM x_hroll"""
SQL["win_prev_7rows"] = f"""{_HKEY} sleep_7 AS prev_week_sleep_hours,
  rhr_7 AS prev_week_rhr FROM x_hroll"""
SQL["win_sleep_debt_7"] = f"{_HKEY} debt7 AS sleep_debt_7day_cumulative FROM x_hroll"
choose(
    "win_week_partition",
    "x_mh",
    "athlete_id date week_avg_sleep week_avg_rhr week_avg_stress week_total_steps",
)
SQL["win_days_since_race"] = """
SELECT athlete_id, race_id, race_date, CAST(gap_days AS INTEGER) AS days_since_last_race FROM x_race
"""
choose("win_race_number", "x_race", RACE + "race_number race_number_this_year")
SQL["win_pace_ma3"] = "SELECT athlete_id, race_id, pace_ma3 AS pace_ma_3_races FROM x_rmet"
SQL["win_pace_change"] = (
    "SELECT athlete_id, race_id, pace_change AS pace_change_vs_last_race FROM x_rmet"
)
SQL["win_days_since_pr"] = """
SELECT athlete_id, race_id, is_pr AS is_personal_record,
  CAST(race_date - first_value(race_date) OVER (
    PARTITION BY athlete_id, race_distance_category, is_pr ORDER BY race_date, race_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER) AS days_since_pr
FROM x_rmet
"""
SQL["win_running_total"] = """
SELECT athlete_id, week_start_date, total_distance_km,
  sum(total_distance_km) OVER (PARTITION BY athlete_id ORDER BY week_start_date
    ROWS UNBOUNDED PRECEDING) AS running_distance_km
FROM x_mt
"""
SQL["win_score_ma7_30d"] = f"""
SELECT athlete_id, date, recovery_score, avg(recovery_score) OVER (PARTITION BY athlete_id
  ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS score_7day_ma
FROM x_mh WHERE date >= {TODAY} - 30
"""

# -- marts --------------------------------------------------------------------------

choose(
    "trn_pct_change",
    "x_mt",
    WEEK + "distance_vs_prev_week_pct activities_vs_prev_week_pct distance_vs_4wk_avg_pct",
)
choose("trn_trend_flag", "x_mt", WEEK + "distance_trend_4wk training_load_trend_4wk")
choose("trn_week_label", "x_mt", WEEK + "year week_number week_label")
SQL["mart_training"] = "SELECT * FROM x_mt"
SQL["hth_day_name"] = """
SELECT athlete_id, date AS health_date, day_of_week AS day_name, week_start_date, month_start_date
FROM x_mh
"""
choose(
    "hth_changes",
    "x_mh",
    "athlete_id date sleep_change_vs_prev_day sleep_change_vs_prev_week sleep_vs_7day_avg"
    " rhr_vs_7day_avg stress_vs_7day_avg rhr_change_vs_prev_day rhr_change_vs_prev_week"
    " stress_change_vs_prev_day",
)
choose("hth_recovery_score", "x_mh", "athlete_id date recovery_score")
choose("hth_readiness", "x_mh", "athlete_id date training_readiness")
choose("hth_sleep_debt", "x_mh", "athlete_id date sleep_debt_hours")
SQL["mart_health"] = "SELECT * FROM x_mh"
for _name, _columns in {
    "rac_calendar_parts": "race_year race_month race_quarter race_season distance_meters",
    "rac_goal_gap": "seconds_vs_goal goal_achievement",
    "rac_pr_gap": "is_personal_record minutes_off_pr pct_off_pr",
    "rac_pace_vs_training": "race_vs_training_pace_diff",
    "rac_readiness_score": "race_readiness_score",
    "rac_finish_time": "finish_time_formatted",
    "rac_rating": "performance_rating",
    "rac_pacing": "pacing_assessment",
    "rac_recovery_status": "recovery_status",
}.items():
    choose(_name, "x_mr", RACE + _columns)
SQL["mart_race"] = "SELECT * FROM x_mr"

# -- dashboard ----------------------------------------------------------------------

SQL["qry_weather_activities"] = "SELECT * FROM x_wact"
SQL["qry_recent_activities"] = "SELECT * FROM x_recent"
choose(
    "qry_calendar",
    "x_cal",
    EVENT + "title event_date location distance_km race_distance_category is_upcoming"
    " days_until_race race_season start_time url",
)
SQL["qry_upcoming_top4"] = """
SELECT athlete_id, rank, event_uuid, coalesce(title, 'Race') AS title, event_date,
  coalesce(race_distance_category, '') AS race_distance_category, coalesce(location, '') AS location,
  days_until_race,
  CASE WHEN days_until_race <= 14 THEN 'urgent' WHEN days_until_race <= 30 THEN 'soon'
    ELSE 'later' END AS urgency,
  CASE days_until_race WHEN 0 THEN 'TODAY' WHEN 1 THEN 'In 1 day'
    ELSE 'In ' || CAST(days_until_race AS VARCHAR) || ' days' END AS countdown
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY athlete_id ORDER BY event_date, event_uuid)
        AS INTEGER) AS rank FROM x_cal WHERE is_upcoming)
WHERE rank <= 4
"""
SQL["qry_all_time"] = """
SELECT athlete_id, coalesce(km, 0) AS total_km, CAST(coalesce(n, 0) AS BIGINT) AS total_runs,
  coalesce(minutes, 0) / 60 AS total_hours, coalesce(races, 0) AS total_races
FROM (SELECT athlete_id, sum(km) AS km, sum(n) AS n, sum(minutes) AS minutes FROM x_week GROUP BY 1)
FULL JOIN (SELECT athlete_id, count(*) AS races FROM x_race GROUP BY 1) USING (athlete_id)
"""


def _nth(column: str, n: int) -> str:
    return (
        f"(array_agg({column} ORDER BY week_start_date DESC)"
        f" FILTER ({column} IS NOT NULL))[{n}]"
    )


_km, _load = "total_distance_km", "total_training_load"
SQL["qry_latest_and_previous"] = f"""
SELECT athlete_id, {_nth(_km, 1)} AS current_distance,
  {_nth('total_duration_minutes', 1)} AS current_duration, {_nth(_load, 1)} AS current_load,
  {_nth('avg_heart_rate_bpm', 1)} AS current_heart_rate,
  {_nth(_km, 2)} AS previous_distance, {_nth(_km, 1)} - {_nth(_km, 2)} AS distance_delta,
  {_nth(_load, 2)} AS previous_load, {_nth(_load, 1)} - {_nth(_load, 2)} AS load_delta
FROM ({newest('x_mt', 4, 'week_start_date DESC')}) GROUP BY 1
"""
_cards = " ".join(
    f"WHEN {quote(k)} THEN {{}}".replace("{}", "{" + str(i) + "}")
    for i, k in enumerate(K.READINESS_CARDS)
)


def _whole(x: str) -> str:
    """Whole number as text, halves to even."""
    return f"CAST(CAST(round_even({x}, 0) AS BIGINT) AS VARCHAR)"


def _fixed(x: str, places: int) -> str:
    """The exact binary value, halves to even, as the engine prints it."""
    return f"printf('%.{places}f', CAST({x} AS DOUBLE))"


SQL["qry_recovery_today"] = f"""
SELECT athlete_id, date, {_whole('recovery_score')} || ' / 100' AS recovery_text,
  CASE training_readiness {_cards.format(*[quote(v[0]) for v in K.READINESS_CARDS.values()])} END
    AS readiness_label,
  CASE training_readiness {_cards.format(*[quote(v[1]) for v in K.READINESS_CARDS.values()])} END
    AS readiness_message,
  CASE WHEN total_sleep_hours <> 0 THEN {_fixed('total_sleep_hours', 1)} || ' h' ELSE '—' END
    AS sleep_text,
  CASE WHEN resting_heart_rate > 0 THEN CAST(resting_heart_rate AS VARCHAR) || ' bpm' ELSE '—' END
    AS resting_hr_text
FROM ({newest('x_mh', 1, 'date DESC')})
"""
SQL["qry_race_highlights"] = """
SELECT athlete_id, count(*) AS total_races, max(race_date) FILTER (is_personal_record) AS last_pr_date,
  min(pace_min_per_km) FILTER (race_distance_category = '10K') AS best_10k_pace,
  min(pace_min_per_km) FILTER (race_distance_category = 'Half Marathon') AS best_half_pace
FROM x_mr GROUP BY 1
"""
SQL["qry_last_n_weeks"] = f"""
SELECT athlete_id, week_start_date, avg_pace_min_per_km, total_training_load
FROM ({newest('x_mt', 12, 'week_start_date DESC')}) WHERE avg_pace_min_per_km IS NOT NULL
"""
_type_arms = " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in K.ACTIVITY_LABELS.items())
SQL["qry_type_filter"] = f"""
SELECT athlete_id, activity_id, activity_type,
  CASE lower(activity_type) {_type_arms} ELSE '⚡ ' || activity_type END AS type_label
FROM x_stg WHERE lower(activity_type) IN ('running', 'cycling')
"""
_group_arms = " ".join(
    "WHEN " + " OR ".join(f"contains(lower(weather_condition), '{w}')" for w in words)
    + f" THEN {quote(label)}"
    for label, words in K.WEATHER_GROUPS
)
SQL["qry_weather_label"] = f"""
SELECT athlete_id, activity_id, weather_condition,
  CASE WHEN coalesce(weather_condition, '') = '' THEN '—' {_group_arms}
    ELSE upper(weather_condition[1]) || lower(weather_condition[2:]) END AS weather_label
FROM x_activities
"""
SQL["qry_period_filter"] = f"""
SELECT athlete_id, week_start_date, total_distance_km FROM x_mt
WHERE week_start_date BETWEEN CAST({TODAY} - INTERVAL 3 MONTH AS DATE) AND {TODAY}
"""
X["x_year"] = f"SELECT * FROM x_mt_runs WHERE week_start_date {_YEAR_BACK}"
X["x_hyear"] = f"SELECT * FROM x_mh WHERE date {_YEAR_BACK}"
SQL["qry_period_totals"] = """
SELECT athlete_id, CAST(sum(total_runs) AS BIGINT) AS total_runs,
  sum(total_distance_km) AS total_distance, sum(total_duration_hours) AS total_hours,
  avg(total_distance_km) AS avg_weekly_distance, sum(total_training_load) AS total_load
FROM x_year GROUP BY 1
"""


def _half(x: str) -> str:
    first, second = f"avg({x}) FILTER (nth <= weeks // 2)", f"avg({x}) FILTER (nth > weeks // 2)"
    return f"coalesce(CASE WHEN {first} > 0 THEN ({second} - {first}) / {first} * 100 END, 0)"


SQL["qry_half_over_half"] = f"""
SELECT athlete_id, count(*) AS weeks, {_half('total_distance_km')} AS distance_delta_pct,
  {_half('total_training_load')} AS load_delta_pct
FROM (SELECT *, row_number() OVER (PARTITION BY athlete_id ORDER BY week_start_date) AS nth,
        count(*) OVER (PARTITION BY athlete_id) AS weeks FROM x_year)
GROUP BY 1
"""
SQL["qry_zone_profile"] = f"""
SELECT *, CASE WHEN {s('easy_pct', 6)} >= 70 THEN 'great aerobic base'
  WHEN {s('easy_pct', 6)} >= 50 THEN 'consider slowing down'
  ELSE 'injury risk if sustained' END AS verdict
FROM (SELECT athlete_id, avg(pct_zone1_easy) AS pct_zone1_easy,
  avg(pct_zone2_moderate) AS pct_zone2_moderate, avg(pct_zone3_tempo) AS pct_zone3_tempo,
  avg(pct_zone4_threshold) AS pct_zone4_threshold, avg(pct_zone5_max) AS pct_zone5_max,
  avg(pct_zone1_easy) + avg(pct_zone2_moderate) AS easy_pct FROM x_year GROUP BY 1)
"""
SQL["qry_run_scatter"] = f"""
SELECT athlete_id, activity_id, activity_name, activity_date, event_type, distance_km,
  duration_minutes, moving_duration_minutes, {_repaired} AS avg_pace_min_km, avg_speed_kmh,
  avg_heart_rate, max_heart_rate, elevation_gain_m, elevation_loss_m, calories, training_load,
  effort_level, pace_zone, hr_zone, is_race, race_distance_category, terrain_type, time_of_day,
  is_weekend, has_data_quality_issues, has_unrealistic_pace
FROM x_stg WHERE activity_type = 'running'
"""
SQL["qry_weather_kpis"] = f"""
SELECT athlete_id, avg(temp_c) AS avg_temp, avg(humidity_pct) AS avg_humidity,
  avg(wind_kmh) AS avg_wind, count(*) AS n_runs
FROM x_wact WHERE activity_type = 'running' AND activity_date {_YEAR_BACK} GROUP BY 1
"""
SQL["qry_temp_pace_trend"] = f"""
SELECT *, slope * temp_min + intercept AS pace_at_min, slope * temp_max + intercept AS pace_at_max
FROM (SELECT athlete_id, count(*) AS n_runs, regr_slope(avg_pace_min_km, temp_c) AS slope,
        regr_intercept(avg_pace_min_km, temp_c) AS intercept, min(temp_c) AS temp_min,
        max(temp_c) AS temp_max
      FROM x_wact WHERE activity_type = 'running' AND avg_pace_min_km IS NOT NULL
        AND activity_date <= {TODAY} GROUP BY 1)
WHERE n_runs >= 3
"""
SQL["qry_race_filters"] = """
SELECT athlete_id, race_id, race_year, race_distance_category FROM x_mr
WHERE race_year IN (1999, 2000) AND race_distance_category IN ('10K', 'Half Marathon')
"""
SQL["qry_race_years"] = "SELECT DISTINCT athlete_id, race_year FROM x_mr"
SQL["qry_race_kpis"] = """
SELECT athlete_id, total_races, total_prs, distances_run, best_10k_pace, top_rating
FROM (SELECT athlete_id, count(*) AS total_races,
    count(*) FILTER (is_personal_record) AS total_prs,
    CAST(count(DISTINCT race_distance_category) AS INTEGER) AS distances_run,
    min(pace_min_per_km) FILTER (race_distance_category = '10K') AS best_10k_pace
  FROM x_mr GROUP BY 1)
JOIN (SELECT athlete_id, performance_rating AS top_rating FROM x_mr GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY athlete_id
    ORDER BY count(*) DESC, performance_rating) = 1) USING (athlete_id)
"""
SQL["qry_race_history"] = f"""
SELECT athlete_id, race_id, strftime(race_date, '%b %d, %Y') AS date_text,
  race_distance_category AS distance, distance_km, finish_time_formatted, pace_min_per_km,
  avg_heart_rate_bpm, performance_rating, CASE WHEN is_personal_record THEN '🥇' ELSE '' END AS pr_mark,
  CASE WHEN pct_off_pr > 0 THEN '+' || {_fixed('pct_off_pr', 1)} || '%'
    WHEN pct_off_pr IS NOT NULL THEN 'PR' ELSE '—' END AS pct_off_pr_text,
  race_readiness_score, recovery_status, race_date
FROM x_mr
"""
X["x_graded"] = """
SELECT * FROM x_mr WHERE race_distance_category IS NOT NULL AND pace_min_per_km IS NOT NULL
"""
SQL["qry_pr_lines"] = """
SELECT athlete_id, race_distance_category, min(pace_min_per_km) AS pr_pace FROM x_graded GROUP BY 1, 2
"""
SQL["qry_pr_cards"] = f"""
SELECT athlete_id, race_distance_category, pace_min_per_km, race_date, race_id,
  finish_time_formatted, distance_km,
  CAST(list_position([{listed(K.DISTANCE_LABELS)}], race_distance_category) AS INTEGER)
    AS distance_order
FROM ({newest('x_graded', 1, 'pace_min_per_km, race_date, race_id', 'athlete_id, race_distance_category')})
"""
SQL["qry_goal_summary"] = f"""
SELECT athlete_id, count(*) AS goals_set,
  count(*) FILTER (goal_achievement = {quote(K.GOAL_ACHIEVED)}) AS achieved,
  count(*) FILTER (goal_achievement NOT IN ({quote(K.GOAL_ACHIEVED)}, {quote(K.GOAL_JUST_MISSED)}))
    AS missed
FROM x_mr WHERE goal_race_name IS NOT NULL GROUP BY 1
"""
SQL["qry_goal_gaps"] = """
SELECT athlete_id, race_id, race_date, goal_race_name, finish_time_formatted,
  goal_time_formatted_target, goal_achievement,
  coalesce(CASE WHEN gap > 0 THEN '+' ELSE '' END || CAST(abs(gap) // 60 AS VARCHAR) || ':'
    || lpad(CAST(abs(gap) % 60 AS VARCHAR), 2, '0'), '—') AS gap_text
FROM (SELECT *, CAST(seconds_vs_goal AS BIGINT) AS gap FROM x_mr WHERE goal_race_name IS NOT NULL)
"""
SQL["qry_readiness_context"] = """
SELECT athlete_id, race_id, race_date, race_readiness_score,
  CASE WHEN race_readiness_score >= 8 THEN 'success' WHEN race_readiness_score >= 6 THEN 'warning'
    ELSE 'danger' END AS tier, CAST(race_readiness_score AS VARCHAR) || ' / 10' AS score_text,
  total_training_distance_30d, training_runs_30d, avg_training_pace_30d,
  race_vs_training_pace_diff, pacing_assessment
FROM x_mr
"""
SQL["qry_health_kpis"] = """
SELECT athlete_id, avg(total_sleep_hours) AS avg_sleep, avg(resting_heart_rate) AS avg_rhr,
  avg(hrv_numeric) AS avg_hrv, avg(average_stress_level) AS avg_stress,
  avg(recovery_score) AS avg_recovery, avg(total_steps) AS avg_steps,
  arg_max(training_readiness, date) AS readiness_now
FROM x_hyear GROUP BY 1
"""
SQL["qry_health_tiers"] = """
SELECT athlete_id, date,
  CASE WHEN total_sleep_hours < 6 THEN 'danger' WHEN total_sleep_hours < 7.5 THEN 'warning'
    ELSE 'success' END AS sleep_tier,
  CASE WHEN average_stress_level >= 75 THEN 'danger' WHEN average_stress_level >= 50 THEN 'accent'
    WHEN average_stress_level >= 25 THEN 'warning' WHEN average_stress_level < 25 THEN 'success'
    END AS stress_tier,
  CASE WHEN total_steps < 7500 THEN 'danger' WHEN total_steps < 10000 THEN 'warning'
    ELSE 'success' END AS steps_tier
FROM x_mh
"""
SQL["qry_sleep_stages_7"] = f"""
SELECT athlete_id, date, deep_sleep_hours, rem_sleep_hours, light_sleep_hours, awake_hours
FROM ({newest('x_hyear', 7, 'date DESC')})
"""
SQL["qry_coverage"] = """
SELECT athlete_id, min(date) AS data_min, max(date) AS data_max, count(*) AS data_days,
  FALSE AS starts_before_data
FROM x_mh GROUP BY 1
"""
SQL["qry_week_overall"] = f"""
SELECT athlete_id, count(*) AS weeks, CAST(sum(total_activities) AS BIGINT) AS total_activities,
  sum(total_distance_km) AS total_distance_km, sum(total_duration_minutes) AS total_duration_minutes,
  sum(total_duration_minutes) / 60 AS total_hours, avg(total_distance_km) AS avg_weekly_km,
  avg(total_activities) AS avg_weekly_activities, avg(total_training_load) AS avg_weekly_load,
  arg_max(week_label, peak) AS peak_week, max(km6) AS peak_km,
  arg_max(total_activities, peak) AS peak_activities
FROM (SELECT *, {s('total_distance_km', 6)} AS km6,
        row_number() OVER (PARTITION BY athlete_id
          ORDER BY {s('total_distance_km', 6)}, week_start_date) AS peak FROM x_mt)
GROUP BY 1
"""
SQL["qry_analysis_history"] = f"SELECT {names('analysis_log')} FROM x_log"
SQL["qry_analysis_goals"] = """
SELECT athlete_id, goal_distance, count(*) AS analyses FROM x_log GROUP BY 1, 2
"""

# -- published look-ups -------------------------------------------------------------

SQL["ck_peak_week"] = f"""
SELECT athlete_id, week_start_date, week_label, {s('total_distance_km', 6)} AS total_distance_km,
  total_training_load, total_activities FROM x_mt
QUALIFY row_number() OVER (PARTITION BY athlete_id
  ORDER BY {s('total_distance_km', 6)} DESC, week_start_date DESC) = 1
"""
SQL["ck_above_average_weeks"] = f"""
SELECT athlete_id, week_start_date, week_label, total_distance_km, rolling_4wk_avg_distance_km,
  distance_vs_4wk_avg_pct FROM x_mt
WHERE {s('total_distance_km', 6)} > rolling_4wk_avg_distance_km
"""
SQL["ck_zone_history"] = f"""
SELECT athlete_id, week_start_date, week_label, pct_zone1_easy, pct_zone2_moderate, pct_zone3_tempo,
  pct_zone4_threshold, pct_zone5_max FROM ({newest('x_mt', 10, 'week_start_date DESC')})
"""
choose(
    "ck_load_trend",
    "x_mt",
    WEEK + "week_label total_training_load rolling_4wk_avg_training_load training_load_trend_4wk",
)
SQL["ck_recent_weeks"] = f"""
SELECT athlete_id, week_start_date, week_label, total_activities, total_distance_km,
  rolling_4wk_avg_distance_km, distance_vs_4wk_avg_pct, distance_trend_4wk
FROM ({newest('x_mt', 5, 'week_start_date DESC')})
"""


def _ranked(side: str, order: str) -> str:
    return f"""
SELECT athlete_id, date, recovery_score, training_readiness, '{side}' AS side,
  CAST(row_number() OVER (PARTITION BY athlete_id ORDER BY recovery_score {order}, date DESC)
    AS INTEGER) AS rank
FROM x_mh QUALIFY rank <= 5"""


SQL["ck_best_worst_recovery"] = (
    _ranked("best", "DESC") + " UNION ALL " + _ranked("worst", "ASC")
)
SQL["ck_sleep_debt_alert"] = f"""
SELECT athlete_id, date, sleep_debt_7day_cumulative, total_sleep_hours, sleep_quality_category
FROM x_mh WHERE {s('sleep_debt_7day_cumulative', 6)} > 5
"""
SQL["ck_rhr_trend_label"] = f"""
SELECT athlete_id, date, resting_heart_rate, rhr_7day_avg, rhr_vs_7day_avg,
  CASE sign(rhr_vs_7day_avg) WHEN 1 THEN '⬆️ Above avg' WHEN -1 THEN '⬇️ Below avg'
    ELSE '➡️ At avg' END AS trend
FROM ({newest('x_mh', 7, 'date DESC')})
"""
SQL["ck_battery_label"] = f"""
SELECT athlete_id, date, body_battery_charged, body_battery_drained, body_battery_net_change,
  CASE WHEN body_battery_net_change < 0 THEN '⚠️ Deficit'
    WHEN body_battery_net_change < 20 THEN '✅ Positive' ELSE '🔋 Great recovery' END AS battery_status
FROM ({newest('x_mh', 7, 'date DESC')})
"""
SQL["ck_null_audit"] = """
SELECT athlete_id, count(*) AS total_rows, count(*) FILTER (recovery_score IS NULL) AS null_recovery,
  count(*) FILTER (training_readiness IS NULL) AS null_readiness
FROM x_mh GROUP BY 1
"""
SQL["ck_debt_validation"] = f"""
SELECT athlete_id, date, total_sleep_hours, 8 - total_sleep_hours AS calculated_debt,
  sleep_debt_hours,
  CASE WHEN abs(8 - total_sleep_hours - sleep_debt_hours) < 0.01 THEN '✓' ELSE '✗' END AS validation
FROM ({newest('x_mh', 5, 'date DESC')})
"""
SQL["ck_overreaching"] = """
SELECT athlete_id, activity_id, activity_date, activity_name, effort_level, recovery_score
FROM x_uni WHERE workout_context = 'overreaching'
"""
SQL["ck_current_prs"] = """
SELECT athlete_id, race_distance_category, race_id, race_date, finish_time_formatted, pace_min_per_km
FROM x_mr WHERE is_personal_record
"""
choose(
    "ck_race_calendar",
    "x_mr",
    RACE + "race_date race_distance_category finish_time_formatted performance_rating"
    " days_since_last_race",
)
choose(
    "ck_readiness_vs_result",
    "x_mr",
    RACE + "race_date race_readiness_score total_training_distance_30d performance_rating pct_off_pr",
)
SQL["ck_10k_progression"] = """
SELECT athlete_id, race_id, race_date, pace_min_per_km, pace_ma_3_races, is_personal_record,
  pct_off_pr FROM x_mr WHERE race_distance_category = '10K'
"""
SQL["ck_pacing_analysis"] = """
SELECT athlete_id, race_id, race_date, race_distance_category, avg_training_pace_30d,
  pace_min_per_km AS race_pace, race_vs_training_pace_diff, pacing_assessment, performance_rating
FROM x_mr
"""
SQL["ck_best_races"] = f"""
SELECT athlete_id, race_id, race_date, race_distance_category, finish_time_formatted,
  pace_min_per_km, performance_rating
FROM ({newest('x_mr', 5, 'pct_off_pr ASC NULLS LAST, race_date, race_id')})
"""
SQL["ck_restless_days"] = """
SELECT athlete_id, health_date, stress_category, sleep_quality, recovery_score FROM x_stgh
WHERE sleep_quality IN ('poor', 'fair') OR stress_category IN ('high', 'very_high')
"""

# -- coaching -----------------------------------------------------------------------

X["x_load"] = f"""
SELECT athlete_id, {s('km', 1)} AS avg_weekly_km, {s('load', 1)} AS avg_weekly_load,
  {s('coalesce(CASE WHEN base > 0 THEN (load - base) / base * 100 END, 0)', 1)} AS load_trend_pct,
  {s('CASE WHEN load > 0 THEN latest / load ELSE 1e0 END', 2)} AS acwr,
  {s('pace', 2)} AS avg_pace_min_per_km, {s('easy', 1)} AS pct_easy,
  {s('(100 - easy)', 1)} AS pct_hard
FROM (SELECT athlete_id, avg(total_distance_km) FILTER (nth <= 4) AS km,
    avg(total_training_load) FILTER (nth <= 4) AS load,
    coalesce(avg(total_training_load) FILTER (nth > 4),
      avg(total_training_load) FILTER (nth <= 4)) AS base,
    max(total_training_load) FILTER (nth = 1) AS latest,
    avg(avg_pace_min_per_km) FILTER (nth <= 4) AS pace,
    avg(pct_zone1_easy) FILTER (nth <= 4) + avg(pct_zone2_moderate) FILTER (nth <= 4) AS easy
  FROM (SELECT *, row_number() OVER (PARTITION BY athlete_id ORDER BY week_start_date DESC) AS nth
        FROM x_mt) WHERE nth <= 8 GROUP BY 1)
"""
X["x_state"] = f"""
SELECT athlete_id, {s('coalesce(sleep, 0)', 1)} AS avg_sleep_hours, {s('hrv', 1)} AS avg_hrv,
  CASE WHEN hrv28 > 0 THEN {s('((hrv - hrv28) / hrv28 * 100)', 1)} END AS hrv_trend_pct,
  {s('rhr', 0)} AS avg_resting_hr, {s('stress', 0)} AS avg_stress,
  {s('score', 0)} AS avg_recovery_score, CAST(NULL AS DOUBLE) AS avg_readiness
FROM (SELECT athlete_id, avg(total_sleep_hours) FILTER (nth <= 7) AS sleep,
    avg(hrv_numeric) FILTER (nth <= 7) AS hrv, avg(hrv_numeric) AS hrv28,
    avg(resting_heart_rate) FILTER (nth <= 7) AS rhr,
    avg(average_stress_level) FILTER (nth <= 7) AS stress,
    avg(recovery_score) FILTER (nth <= 7) AS score
  FROM (SELECT *, row_number() OVER (PARTITION BY athlete_id ORDER BY date DESC) AS nth FROM x_mh)
  WHERE nth <= 28 GROUP BY 1)
"""


def _best(category: str) -> str:
    return f"min(pace_min_per_km) FILTER (race_distance_category = '{category}')"


X["x_past"] = f"""
SELECT athlete_id, arg_max_null(race_distance_category, race_number) AS last_race_distance,
  arg_max_null(pace_min_per_km, race_number) AS last_race_pace_min_per_km,
  {_best('5K')} AS pr_5k_pace, {_best('10K')} AS pr_10k_pace,
  {_best('Half Marathon')} AS pr_half_pace, {_best('Marathon')} AS pr_marathon_pace
FROM x_mr GROUP BY 1
"""
_goal_km = "CASE goal_distance " + " ".join(
    f"WHEN {quote(d)} THEN {quote(km)}" for d, km in K.GOAL_KM.items()
) + f" ELSE {quote(K.GOAL_KM_DEFAULT)} END"
X["x_goal"] = f"""
SELECT athlete_id, goal_distance, goal_time_minutes,
  {s(f'(goal_time_minutes / {_goal_km})', 2)} AS goal_pace_min_per_km,
  CAST(greatest(0, floor((race_date - {TODAY}) / 7e0)) AS INTEGER) AS weeks_to_race
FROM (SELECT *, CAST(goal_hours * 60 + goal_minutes AS DOUBLE) AS goal_time_minutes
      FROM ({newest('x_log', 1, 'generated_at DESC, analysis_id DESC')}))
"""
X["x_ctx"] = """
SELECT athlete_id, goal_distance, goal_time_minutes, goal_pace_min_per_km, weeks_to_race,
  coalesce(avg_weekly_km, 0) AS avg_weekly_km,
  coalesce(avg_weekly_load, 0) AS avg_weekly_load, coalesce(load_trend_pct, 0) AS load_trend_pct,
  coalesce(acwr, 1) AS acwr, avg_pace_min_per_km, coalesce(pct_easy, 0) AS pct_easy,
  coalesce(pct_hard, 100) AS pct_hard, coalesce(avg_sleep_hours, 0) AS avg_sleep_hours, avg_hrv,
  hrv_trend_pct, avg_resting_hr, avg_stress, avg_recovery_score, avg_readiness,
  last_race_distance, last_race_pace_min_per_km, pr_5k_pace, pr_10k_pace, pr_half_pace,
  pr_marathon_pace
FROM (SELECT athlete_id FROM x_goal UNION SELECT athlete_id FROM x_load
  UNION SELECT athlete_id FROM x_state UNION SELECT athlete_id FROM x_past)
LEFT JOIN x_goal USING (athlete_id) LEFT JOIN x_load USING (athlete_id)
LEFT JOIN x_state USING (athlete_id) LEFT JOIN x_past USING (athlete_id)
"""
SQL["ctx_acute_chronic"] = "SELECT * EXCLUDE (acwr, pct_easy, pct_hard) FROM x_load"
SQL["ctx_acwr"] = "SELECT athlete_id, acwr FROM x_load"
SQL["ctx_zone_split"] = "SELECT athlete_id, pct_easy, pct_hard FROM x_load"
SQL["ctx_health_7d"] = "SELECT * EXCLUDE (hrv_trend_pct) FROM x_state"
SQL["ctx_hrv_trend"] = "SELECT athlete_id, hrv_trend_pct FROM x_state"
SQL["ctx_pr_paces"] = "SELECT * FROM x_past"
SQL["ctx_goal"] = "SELECT * FROM x_goal"
SQL["coaching_context"] = "SELECT * FROM x_ctx"


def _uncarried(p: str) -> str:
    """m:ss where rounding may print :60."""
    seconds = f"round_even(({p} - floor({p})) * 60, 0)"
    return (
        f"(CAST(CAST(floor({p}) AS BIGINT) AS VARCHAR) || ':'"
        f" || lpad(CAST(CAST({seconds} AS BIGINT) AS VARCHAR), 2, '0'))"
    )


_now = """coalesce(CASE goal_distance WHEN '5K' THEN pr_5k_pace WHEN '10K' THEN pr_10k_pace
  WHEN 'Half Marathon' THEN pr_half_pace WHEN 'Marathon' THEN pr_marathon_pace END,
  last_race_pace_min_per_km)"""
_gap = f"((goal_pace_min_per_km - {_now}) / {_now} * 100)"


def _fill(template: str, values: dict[str, str]) -> str:
    """SQL text of a template of ``cadenza.constants``."""
    parts = re.split(r"\{(\w+)\}", template)
    cells = [f"({values[p]})" if i % 2 else quote(p) for i, p in enumerate(parts)]
    return " || ".join(cells)


_WORDS = {
    "acwr": _fixed("acwr", 2),
    "acwr_pct": _whole("(acwr * 100)"),
    "drop": _whole("abs(hrv_trend_pct)"),
    "trend": _whole("hrv_trend_pct"),
    "hrv": _whole("avg_hrv"),
    "hours": _fixed("avg_sleep_hours", 1),
    "score": _whole("avg_recovery_score"),
    "distance": "goal_distance",
    "now": _uncarried(_now),
    "goal": _uncarried("goal_pace_min_per_km"),
    "gap": _fixed(f"abs({_gap})", 0),
}
_CONDITIONS = {
    "load": ["acwr > 1.5", "acwr > 1.3"],
    "hrv": ["hrv_trend_pct < -20", "hrv_trend_pct < -10"],
    "sleep": ["avg_sleep_hours < 5", "avg_sleep_hours < 6.5"],
    "recovery": ["avg_recovery_score < 40"],
    "goal_gap": [f"{_gap} < -25"],
}
_RULES = {
    name: [
        (when, level, emoji, _fill(text, _WORDS))
        for when, (level, emoji, text) in zip(tests, K.ALERT_TEXTS[name], strict=True)
    ]
    for name, tests in _CONDITIONS.items()
}


def _rule(name: str, order: int) -> str:
    arms = _RULES[name]

    def case(i: int) -> str:
        return "CASE " + " ".join(
            f"WHEN {a[0]} THEN {a[i] if i == 3 else quote(a[i])}" for a in arms
        ) + " END"

    return f"""SELECT * FROM (SELECT athlete_id, {order} AS place, {case(1)} AS level,
  {case(2)} AS emoji, {case(3)} AS message FROM x_ctx) WHERE level IS NOT NULL"""


for _i, _name in enumerate(_RULES):
    SQL[f"alert_{_name}"] = f"SELECT * EXCLUDE (place) FROM ({_rule(_name, _i)})"
_all_rules = " UNION ALL ".join(_rule(n, i) for i, n in enumerate(_RULES))
SQL["alerts"] = f"""
SELECT athlete_id, CAST(row_number() OVER (PARTITION BY athlete_id
    ORDER BY level <> 'red', place) - 1 AS INTEGER) AS position, level, emoji, message
FROM ({_all_rules})
"""


def _or_na(x: str, unit: str = "") -> str:
    return f"coalesce(CAST({x} AS VARCHAR) || '{unit}', 'N/A')"


def _pace_or_na(x: str) -> str:
    return f"coalesce({_uncarried(x)}, 'N/A')"


_PROMPT = {
    "weekly_km": "CAST(avg_weekly_km AS VARCHAR)",
    "weekly_load": "CAST(avg_weekly_load AS VARCHAR)",
    "load_trend": "CASE WHEN load_trend_pct < 0 THEN '-' ELSE '+' END || "
    + _whole("abs(load_trend_pct)"),
    "acwr": "CAST(acwr AS VARCHAR)",
    "pace": _pace_or_na("CASE WHEN avg_pace_min_per_km > 0 THEN avg_pace_min_per_km END"),
    "easy": _whole("pct_easy"),
    "hard": _whole("pct_hard"),
    "sleep": "CAST(avg_sleep_hours AS VARCHAR)",
    "hrv": _or_na("avg_hrv", "ms"),
    "hrv_trend": _or_na("hrv_trend_pct", "%"),
    "resting_hr": _or_na("avg_resting_hr", " bpm"),
    "stress": _or_na("avg_stress", "/100"),
    "recovery": _or_na("avg_recovery_score", "/100"),
    "readiness": "'N/A'",
    "last_distance": "coalesce(last_race_distance, 'N/A')",
    "last_pace": _pace_or_na("last_race_pace_min_per_km"),
    "pr_5k": _pace_or_na("pr_5k_pace"),
    "pr_10k": _pace_or_na("pr_10k_pace"),
    "pr_half": _pace_or_na("pr_half_pace"),
    "pr_marathon": _pace_or_na("pr_marathon_pace"),
    "goal": _or_na("goal_distance"),
    "goal_hours": _or_na("(CAST(goal_time_minutes AS BIGINT) // 60)"),
    "goal_minutes": _or_na("lpad(CAST(CAST(goal_time_minutes AS BIGINT) % 60 AS VARCHAR), 2, '0')"),
    "goal_pace": _pace_or_na("goal_pace_min_per_km"),
    "weeks": _or_na("weeks_to_race"),
}
_text = " || chr(10) || ".join(f"({_fill(line, _PROMPT)})" for line in K.PROMPT_LINES)
SQL["prompt_text"] = f"SELECT athlete_id, {_text} AS prompt FROM x_ctx"

# -- weather ------------------------------------------------------------------------

_raw_pace = "duration_minutes / nullif(distance_km, 0)"
X["x_wruns"] = f"""
SELECT athlete_id, activity_id, {r('(' + _raw_pace + ')', 2)} AS pace, weather_temp_c AS temp,
  weather_wind_speed_ms * 3.6 AS wind_kmh, weather_precipitation_mm AS rain
FROM x_activities
WHERE distance_km > 1 AND duration_minutes > 5 AND weather_temp_c IS NOT NULL
  AND {_raw_pace} BETWEEN 2.5 AND 20 AND activity_type ILIKE '%run%'
QUALIFY row_number() OVER (PARTITION BY athlete_id
  ORDER BY x_activities.activity_date DESC, activity_id DESC) <= 200
"""
_bucket = "CASE WHEN temp < 5 THEN {} WHEN temp < 15 THEN {} WHEN temp < 22 THEN {} ELSE {} END".format(
    *[quote(b[0]) for b in K.TEMP_BUCKETS]
)
_bucket_line = _fill(
    K.WEATHER_BUCKET,
    {"bucket": "bucket", "pace": _uncarried(s("avg_pace", 6)), "n": "CAST(n_runs AS VARCHAR)"},
)
X["x_buckets"] = f"""
SELECT *, {_bucket_line} AS line FROM (
  SELECT athlete_id, {_bucket} AS bucket, count(*) AS n_runs, avg(pace) AS avg_pace
  FROM x_wruns GROUP BY 1, 2 HAVING count(*) >= 3)
"""


def _impact(bad: str, good: str) -> str:
    return f"""
SELECT *, CASE WHEN {s('diff_s_per_km', 6)} > 0 THEN 'slower' ELSE 'faster' END AS direction
FROM (SELECT athlete_id, (avg(pace) FILTER ({bad}) - avg(pace) FILTER ({good})) * 60 AS diff_s_per_km,
        count(*) FILTER ({bad}) AS n_bad, count(*) FILTER ({good}) AS n_good
      FROM x_wruns GROUP BY 1)
WHERE n_bad >= 3 AND n_good >= 3
"""


X["x_wind"] = _impact("wind_kmh >= 25", "wind_kmh < 15")
X["x_rain"] = _impact("rain >= 2", "rain < 0.5")
SQL["wx_temp_buckets"] = "SELECT * FROM x_buckets"
SQL["wx_wind_impact"] = "SELECT * FROM x_wind"
SQL["wx_rain_impact"] = "SELECT * FROM x_rain"


def _impact_line(table: str, template: str) -> str:
    size = _fixed(f"abs({s(table + '.diff_s_per_km', 0)})", 0)
    return _fill(template, {"size": size, "direction": f"{table}.direction"})


_order = f"list_position([{listed(b[0] for b in K.TEMP_BUCKETS)}], bucket)"
X["x_wsum"] = f"""
SELECT a.athlete_id, a.n_runs, CASE WHEN a.n_runs >= 5 THEN concat_ws(chr(10),
  {_fill(K.WEATHER_HEAD, {"n": "CAST(a.n_runs AS VARCHAR)"})},
  CASE WHEN b.lines IS NOT NULL THEN {quote(K.WEATHER_TEMP_HEAD)} END, b.lines,
  {_impact_line('x_wind', K.WEATHER_WIND)}, {_impact_line('x_rain', K.WEATHER_RAIN)})
  END AS summary
FROM (SELECT athlete_id, count(*) AS n_runs FROM x_wruns GROUP BY 1) a
LEFT JOIN (SELECT athlete_id, string_agg(line, chr(10) ORDER BY {_order}) AS lines
           FROM x_buckets GROUP BY 1) b USING (athlete_id)
LEFT JOIN x_wind USING (athlete_id) LEFT JOIN x_rain USING (athlete_id)
"""
SQL["wx_summary"] = "SELECT * FROM x_wsum"
# The same over all runs instead of the newest 200 of an athlete.
_impact_parts = ("x_wruns", "x_buckets", "x_wind", "x_rain", "x_wsum")
for _part in _impact_parts:
    _all = re.sub(rf"\b({'|'.join(_impact_parts)})\b", r"\1_all", X[_part])
    X[f"{_part}_all"] = re.sub(r"QUALIFY row_number[^=]*<= 200", "", _all)
SQL["wx_summary_all"] = "SELECT * FROM x_wsum_all"
_day = {
    "day": "day_name",
    "date": "CAST(date AS VARCHAR)",
    "low": "CAST(temp_min_c AS VARCHAR)",
    "high": "CAST(temp_max_c AS VARCHAR)",
    "condition": "condition",
    "flags": "CASE WHEN flags <> '' THEN ' [' || flags || ']' ELSE '' END",
}
X["x_flags"] = f"""
SELECT *, {_fill(K.FORECAST_DAY, _day)} AS line
FROM (SELECT *, concat_ws(', ',
    CASE WHEN precipitation_mm >= 5 THEN 'rain ' || precipitation_mm || 'mm'
      WHEN precipitation_mm >= 1 THEN 'light rain ' || precipitation_mm || 'mm' END,
    CASE WHEN wind_kmh >= 30 THEN 'strong wind ' || wind_kmh || 'km/h'
      WHEN wind_kmh >= 20 THEN 'wind ' || wind_kmh || 'km/h' END,
    CASE WHEN temp_max_c >= 28 THEN '⚠️ heat' WHEN temp_min_c <= 0 THEN '⚠️ frost' END) AS flags
  FROM x_forecast)
"""
choose("wx_forecast_flags", "x_flags", "athlete_id city date flags line")
SQL["wx_prompt_block"] = f"""
SELECT f.athlete_id, f.city, {_fill(K.FORECAST_HEAD, {'city': 'f.city'})} || chr(10) || f.days
  || coalesce(chr(10) || chr(10) || summary, '') AS weather_text
FROM (SELECT athlete_id, city, string_agg(line, chr(10) ORDER BY date) AS days
      FROM x_flags GROUP BY 1, 2) f
LEFT JOIN x_wsum USING (athlete_id)
"""

_block = SQL["wx_prompt_block"]
SQL["prompt_with_weather"] = f"""
SELECT athlete_id, {_text} || coalesce(chr(10) || chr(10) || chr(10) || weather_text, '') AS prompt
FROM x_ctx LEFT JOIN ({_block}) USING (athlete_id)
"""

# -- periods ------------------------------------------------------------------------

for _name, _range in {
    "all": f"<= {TODAY}",
    "2_weeks": f"BETWEEN {TODAY} - 14 AND {TODAY}",
    "4_weeks": f"BETWEEN {TODAY} - 28 AND {TODAY}",
    "6_months": f"BETWEEN {TODAY} - INTERVAL 6 MONTH AND {TODAY}",
    "custom": "BETWEEN DATE '1995-01-01' AND DATE '1996-06-30'",
}.items():
    SQL[f"qry_period_{_name}"] = f"""
SELECT athlete_id, count(*) AS days, min(date) AS first_day, max(date) AS last_day
FROM x_mh WHERE date {_range} GROUP BY 1
"""

# -- data tests ---------------------------------------------------------------------

_TESTED = {
    "activities": "x_activities",
    "calendar_events": "x_calendar",
    "daily_health": "x_daily_health",
    "race_goals": "x_goals",
    "stg_activities": "x_stg",
    "stg_health": "x_stgh",
    "stg_calendar": "x_cal",
    "int_unified": "x_uni",
    "mart_training": "x_mt",
    "mart_race": "x_mr",
    "mart_health": "x_mh",
}


def _violation(t) -> str:
    x = t.column
    if t.kind == "not_null":
        return f"{x} IS NULL"
    if t.kind == "accepted_values":
        return f"{x} NOT IN ({listed(t.arg)})"
    if t.kind == "expression":
        return f"NOT ({x} {t.arg})"
    low, high = t.arg
    sides = [f"{x} < {low}"] if low is not None else []
    sides += [f"{x} > {high}"] if high is not None else []
    return " OR ".join(sides)


def _test(t) -> str:
    source = _TESTED[t.table]
    if t.kind == "unique":
        inner = f"SELECT 1 FROM {source} GROUP BY athlete_id, {t.column} HAVING count(*) > 1"
        failures = f"(SELECT count(*) FROM ({inner}))"
    else:
        cut = f" AND ({t.where})" if t.where else ""
        failures = f"(SELECT count(*) FROM {source} WHERE ({_violation(t)}){cut})"
    return (
        f"SELECT {quote(t.table)} AS table_name, {quote(t.column)} AS column_name,"
        f" {quote(t.kind)} AS test_name, {quote(t.where or '')} AS where_clause,"
        f" {quote(t.severity)} AS severity, {failures} AS failures"
    )


def _report(tests) -> str:
    union = " UNION ALL ".join(_test(t) for t in tests)
    return f"SELECT *, CASE failures WHEN 0 THEN 'pass' ELSE severity END AS status FROM ({union})"


for _kind in ("not_null", "unique", "accepted_values", "expression", "accepted_range"):
    SQL[f"dq_{_kind}"] = _report([t for t in quality_specs.TESTS if t.kind == _kind])
SQL["dq_where_severity"] = _report(
    [t for t in quality_specs.TESTS if t.where or t.severity == "error"]
)
SQL["dq_report"] = _report(quality_specs.TESTS)


def _age(table: str, warn: int, error: int | None) -> str:
    arms = f"WHEN age_days > {error} THEN 'error' " if error is not None else ""
    return f"""SELECT *, CASE {arms}WHEN age_days > {warn} THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT '{table}' AS table_name, max(inserted_at) AS newest_load,
  CAST({TODAY} - CAST(max(inserted_at) AS DATE) AS INTEGER) AS age_days FROM {_TESTED[table]})"""


SQL["dq_freshness"] = " UNION ALL ".join(
    _age(t, *limits) for t, limits in quality_specs.FRESHNESS.items()
)

# -- sorts, top-n, sets, functions --------------------------------------------------

choose("sort_marts", "x_mr", RACE + "race_date performance_rating")
SQL["topn_per_athlete"] = f"""
SELECT athlete_id, activity_id, activity_date, distance_km
FROM ({newest('x_activities', 5, 'activity_date DESC, activity_id DESC')})
"""
SQL["set_distinct"] = "SELECT DISTINCT athlete_id, activity_type, pace_zone FROM x_stg"
SQL["set_union_sources"] = """
SELECT athlete_id, activity_id,
  CASE activity_type WHEN 'cycling' THEN 'strava' ELSE 'garmin' END AS data_source,
  CASE WHEN activity_type <> 'cycling' THEN device_name END AS device_name, distance_km
FROM x_stg
"""
SQL["set_except_keys"] = """
SELECT athlete_id, activity_id FROM x_activities EXCEPT SELECT athlete_id, activity_id FROM x_stored
"""
SQL["fn_dates"] = f"""
SELECT athlete_id, activity_id, strftime(activity_date, '%Y-%m-%d') AS date_text,
  CAST(activity_date AS DATE) AS parsed_date,
  CAST(activity_date AS DATE) BETWEEN {TODAY} - 30 AND {TODAY} AS in_last_30_days,
  timezone('Europe/Paris', timezone('UTC', start_time_gmt)) AS local_time
FROM x_activities
"""
_ratio_arms = " ".join(
    f"WHEN share >= {quote(lo)} AND share < {quote(hi)} THEN {quote(n)}"
    for n, lo, hi in K.HR_RATIO_ZONES
)
SQL["fn_hr_zone_pct"] = f"""
SELECT athlete_id, activity_id, CASE {_ratio_arms} ELSE 'Unknown' END AS hr_ratio_zone
FROM (SELECT *, avg_heart_rate / CAST(max_heart_rate AS DOUBLE) AS share FROM x_activities)
"""
SQL["fn_safe_divide"] = """
SELECT athlete_id, activity_id,
  CASE WHEN distance_km = 0 THEN 0 ELSE duration_minutes / distance_km END AS minutes_per_km
FROM x_activities
"""


def _clock(total: str) -> str:
    return f"(CAST({total} // 60 AS VARCHAR) || ':' || lpad(CAST({total} % 60 AS VARCHAR), 2, '0'))"


def _secs(x: str) -> str:
    return f"CAST(round_even({x}, 0) AS BIGINT)"


_pace_total = f"(CAST(floor(p) AS BIGINT) * 60 + {_secs('((p - floor(p)) * 60)')})"
_dur_total = _secs("(m * 60)")
_dur_min = "CAST(round_even(m, 0) AS BIGINT)"
SQL["fn_format_metrics"] = f"""
SELECT athlete_id, activity_id,
  coalesce({_clock(_pace_total)} || ' /km', '—') AS pace_text,
  coalesce({_clock(_pace_total)}, '—') AS pace_short_text,
  CAST(CAST(floor(p) AS BIGINT) AS VARCHAR) || ':'
    || lpad(CAST(CAST(floor((p - floor(p)) * 60) AS BIGINT) AS VARCHAR), 2, '0') || ' /km'
    AS pace_truncated_text,
  {_uncarried('p')} AS pace_uncarried_text,
  CASE WHEN {_dur_total} >= 3600 THEN CAST({_dur_total} // 3600 AS VARCHAR) || 'h'
      || lpad(CAST({_dur_total} % 3600 // 60 AS VARCHAR), 2, '0') || ':'
      || lpad(CAST({_dur_total} % 60 AS VARCHAR), 2, '0')
    ELSE {_clock(_dur_total)} END AS duration_text,
  CASE WHEN {_dur_min} >= 60 THEN CAST({_dur_min} // 60 AS VARCHAR) || 'h '
      || lpad(CAST({_dur_min} % 60 AS VARCHAR), 2, '0') || 'min'
    ELSE CAST({_dur_min} AS VARCHAR) || 'min' END AS duration_short_text,
  {_fixed('km', 1)} || ' km' AS distance_text,
  CASE WHEN km * 10 >= 100 THEN {_whole('(km * 10)')} ELSE {_fixed('(km * 10)', 1)} END || ' km'
    AS distance_short_text,
  coalesce(CAST(avg_heart_rate AS VARCHAR) || ' bpm', '—') AS hr_text,
  coalesce({_whole('training_load')}, '—') AS load_text,
  coalesce({_whole('elevation_gain_m')} || ' / 100', '—') AS score_text,
  strftime(activity_date, '%d %b %Y') AS date_text, strftime(activity_date, '%b %d') AS week_text,
  CASE WHEN km >= km0 THEN '+' ELSE '-' END || {_fixed('abs(km - km0)', 1)} || ' km'
    AS delta_distance_text,
  CASE WHEN p >= p0 THEN '+' ELSE '-' END || {_clock(_secs('(abs(p - p0) * 60)'))} AS delta_pace_text
FROM (SELECT *, avg_pace_min_km AS p, duration_minutes AS m, distance_km AS km,
        lag(distance_km) OVER d AS km0, lag(avg_pace_min_km) OVER d AS p0
      FROM x_stg WINDOW d AS (PARTITION BY athlete_id, activity_date ORDER BY activity_id))
"""


def _cut(sql: str, columns: list[str]) -> str:
    """Round the columns the query rounds."""
    if not columns:
        return sql
    replaced = ", ".join(f"{s(n, 6)} AS {n}" for n in columns)
    return f"SELECT * REPLACE ({replaced}) FROM ({sql})"


ORACLES = {name: assemble(_cut(sql, ROUNDED[name])) for name, sql in SQL.items()}
