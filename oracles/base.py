"""Shared parts of the check SQL: helpers and named subqueries (``x_...``).

A query names the subqueries it needs; :func:`assemble` puts them in front of it.
The models are written here as single-engine SQL over whole tables (windows over one
athlete, a range join for the 30 days before a race), apart from the Spark plans.
"""

from __future__ import annotations

import re

from cadenza.sources import star_mapping as M

from oracles import values as K

TODAY = f"DATE '{M.AS_OF}'"


def r(x: str, places: int) -> str:
    """Round a row value, halves away from zero."""
    return f"(sign({x}) * floor(abs({x}) * 1e{places} + 0.5e0) / 1e{places} + 0e0)"


def s(x: str, places: int) -> str:
    """Round an aggregate; ties lifted so that summing order does not matter."""
    return f"(sign({x}) * floor(abs({x}) * 1e{places} + 0.500001e0) / 1e{places} + 0e0)"


def quote(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return f"CAST({v} AS DOUBLE)" if isinstance(v, float) else str(v)


def ladder(x: str, steps: list, test: str, missing=None) -> str:
    """CASE over a band list of ``oracles.values``."""
    out = "CASE"
    if missing is not None:
        out += f" WHEN {x} IS NULL THEN {quote(missing)}"
    for label, bound in steps[:-1]:
        out += f" WHEN {x} {test} {quote(bound)} THEN {quote(label)}"
    return f"{out} ELSE {quote(steps[-1][0])} END"


def listed(values) -> str:
    return ", ".join(quote(v) for v in values)


def distance_class(km: str) -> str:
    arms = "".join(
        f" WHEN {km} >= {quote(lo)} AND {km} <= {quote(hi)} THEN {quote(label)}"
        for label, lo, hi in K.DISTANCE_BANDS
    )
    return f"CASE{arms} WHEN {km} > {quote(K.ULTRA_ABOVE_KM)} THEN {quote(K.ULTRA_LABEL)} END"


def seasons(d: str) -> str:
    arms = "".join(
        f" WHEN month({d}) IN ({listed(months)}) THEN {quote(name)}"
        for name, months in K.SEASON_MONTHS.items()
    )
    return f"CASE{arms} END"


def _columns(base: dict[str, str]) -> str:
    return ", ".join(f"{t.replace('{ntz}', '')} AS {n}" for n, t in base.items())


def _mapped(source: str, base: dict[str, str], steps: list[dict[str, str]], keep: str) -> str:
    sql = f"SELECT {keep}, {_columns(base)} FROM {source}"
    for step in steps:
        sql = f"SELECT *, {_columns(step)} FROM ({sql})"
    return sql


X: dict[str, str] = {}

X["x_orders"] = """
SELECT o_orderpriority, o_orderkey AS k, o_custkey AS c, o_orderdate AS order_ts,
       o_orderdate + to_seconds((o_orderkey * 37) % 86400) AS ts
FROM orders
"""
X["x_activities"] = _mapped("x_orders", M.ACTIVITY_BASE, M.ACTIVITY_STEPS, "k, c, order_ts")
X["x_health_days"] = f"""
SELECT *, athlete_id * 31 + date_diff('day', DATE '1970-01-01', d) * 17 AS h FROM (
  SELECT {M.whole('o_custkey', 30)} AS athlete_id, CAST(l_shipdate AS DATE) AS d,
         CAST(sum(l_quantity) AS BIGINT) AS q
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL)
"""
X["x_daily_health"] = _mapped("x_health_days", M.HEALTH_BASE, M.HEALTH_STEPS, "h")
X["x_calendar"] = _mapped(
    f"(SELECT * FROM x_orders WHERE {M.CALENDAR_FILTER})", M.CALENDAR_BASE, M.CALENDAR_STEPS, "k"
)
X["x_goals"] = f"""
SELECT athlete_id, race_date, 'Goal ' || CAST(gk AS VARCHAR) AS race_name,
       {distance_class('distance_km')} AS race_distance_category, distance_km, goal_time_seconds,
       CAST(goal_time_seconds // 3600 AS VARCHAR) || ':'
         || lpad(CAST(goal_time_seconds % 3600 // 60 AS VARCHAR), 2, '0') || ':'
         || lpad(CAST(goal_time_seconds % 60 AS VARCHAR), 2, '0') AS goal_time_formatted,
       CASE WHEN gk % 4 <> 3 THEN 'steady start' END AS notes
FROM (SELECT athlete_id, CAST(activity_date AS DATE) AS race_date, min(k) AS gk,
             min({M.GOAL_SECONDS}) AS goal_time_seconds, min(distance_km) AS distance_km
      FROM x_activities WHERE {M.GOAL_FILTER} GROUP BY 1, 2)
"""
X["x_log"] = _mapped(
    f"(SELECT * FROM x_orders WHERE {M.LOG_FILTER})", M.LOG_BASE, [], "k"
)

_race_words = " OR ".join(f"contains(label_text, '{w}')" for w in K.RACE_WORDS)
X["x_act"] = f"""
SELECT *,
  CASE WHEN tag_text = 'race' OR {_race_words} THEN TRUE ELSE FALSE END AS is_race,
  {distance_class('distance_km')} AS race_distance_category,
  {ladder('avg_pace_min_km', K.PACE_ZONES, '<', 'no_data')} AS pace_zone,
  {ladder('avg_heart_rate', K.HR_ZONES, '<', 'no_hr_data')} AS hr_zone,
  CASE WHEN avg_heart_rate IS NULL THEN 'unknown'
       WHEN avg_pace_min_km > 6.5 AND avg_heart_rate < 130 THEN 'easy'
       WHEN avg_pace_min_km >= 5.5 AND avg_pace_min_km <= 6.5 AND avg_heart_rate < 150
         THEN 'moderate'
       WHEN avg_pace_min_km < 5.5 OR avg_heart_rate >= 150 THEN 'hard'
       ELSE 'moderate' END AS effort_level,
  {r('(duration_minutes * ' + ladder('avg_heart_rate', K.LOAD_FACTORS, '<', K.LOAD_FACTOR_NO_HR) + ')', 2)}
    AS training_load,
  {ladder('elevation_gain_m', K.TERRAINS, '<', 'unknown')} AS terrain_type,
  CASE WHEN start_hour >= 5 AND start_hour < 12 THEN 'morning'
       WHEN start_hour >= 12 AND start_hour < 18 THEN 'afternoon'
       WHEN start_hour >= 18 AND start_hour < 22 THEN 'evening' ELSE 'night' END AS time_of_day,
  coalesce(day_of_week IN (0, 6), FALSE) AS is_weekend,
  coalesce(distance_km = 0, TRUE) OR coalesce(duration_minutes = 0, TRUE)
    AS has_data_quality_issues,
  coalesce(duration_minutes < 5, FALSE) AS is_very_short,
  coalesce(avg_pace_min_km < 2 OR avg_pace_min_km > 20, FALSE) AS has_unrealistic_pace
FROM (
  SELECT athlete_id, activity_id, activity_name, CAST(activity_date AS DATE) AS activity_date,
    start_time_local AS activity_start_time, CAST(hour(start_time_local) AS INTEGER) AS start_hour,
    CAST(extract(dow FROM start_time_local) AS INTEGER) AS day_of_week,
    activity_type, event_type, device_name, location_name,
    coalesce(distance_km, 0) AS distance_km, duration_minutes,
    {r('(moving_duration_seconds / 60)', 2)} AS moving_duration_minutes,
    {r('((duration_seconds - coalesce(moving_duration_seconds, duration_seconds)) / 60)', 2)}
      AS pause_duration_minutes,
    CASE WHEN avg_pace_min_km IS NOT NULL AND distance_km <> 0 THEN
      CASE WHEN avg_pace_min_km BETWEEN 2 AND 20 THEN avg_pace_min_km
           ELSE {r('(duration_minutes / nullif(distance_km, 0))', 3)} END END AS avg_pace_min_km,
    {r('(avg_speed_mps * 3.6)', 2)} AS avg_speed_kmh,
    {r('(max_speed_mps * 3.6)', 2)} AS max_speed_kmh,
    avg_heart_rate, max_heart_rate, max_heart_rate - avg_heart_rate AS hr_delta,
    elevation_gain_m, elevation_loss_m,
    elevation_gain_m - coalesce(elevation_loss_m, 0) AS net_elevation_m,
    max_elevation_m - coalesce(min_elevation_m, 0) AS elevation_range_m,
    calories, aerobic_training_effect, anaerobic_training_effect,
    coalesce(aerobic_training_effect, 0) + coalesce(anaerobic_training_effect, 0)
      AS total_training_effect,
    avg_cadence AS avg_cadence_spm, max_cadence AS max_cadence_spm,
    inserted_at AS loaded_at, updated_at,
    lower(coalesce(event_type, '')) AS tag_text, lower(coalesce(activity_name, '')) AS label_text
  FROM x_activities)
"""
X["x_stg"] = """
SELECT * EXCLUDE (tag_text, label_text) FROM x_act
WHERE distance_km > 0 AND duration_minutes >= 5
"""


def _score_sum() -> str:
    n = K.DAY_SCORE_NEUTRAL
    return " + ".join(
        [
            ladder("sleep_hours", K.DAY_SCORE_SLEEP, ">=", 0),
            ladder("stress_avg", K.DAY_SCORE_STRESS, "<=", n["stress"]),
            ladder("body_battery_high", K.DAY_SCORE_BATTERY, ">=", n["battery"]),
            ladder("resting_heart_rate", K.DAY_SCORE_RHR, "<", n["rhr"]),
        ]
    )


def _hours(x: str) -> str:
    return r(f"(coalesce({x}, 0) / 3600e0)", 2)


X["x_hlt"] = f"""
SELECT *,
  day_of_week IN (0, 6) AS is_weekend,
  CASE WHEN sleep_hours = 0 THEN 'no_data'
       ELSE {ladder('sleep_hours', K.SLEEP_QUALITIES, '<')} END AS sleep_quality,
  {ladder('stress_avg', K.STRESS_LEVELS, '<=', 'no_data')} AS stress_category,
  {ladder('body_battery_high', K.BATTERY_LEVELS, '>=', 'no_data')} AS body_battery_status,
  {ladder('hrv_avg', K.HRV_LEVELS, '>=', 'no_data')} AS hrv_category,
  steps >= 10000 AS steps_goal_met,
  CAST({_score_sum()} AS DOUBLE) AS recovery_score,
  sleep_hours = 0 AS has_missing_sleep,
  resting_heart_rate IS NULL AS has_missing_hr
FROM (
  SELECT athlete_id, date AS health_date,
    CAST(extract(dow FROM date) AS INTEGER) AS day_of_week,
    CAST(extract(week FROM date) AS INTEGER) AS week_of_year,
    CAST(month(date) AS INTEGER) AS month_number, CAST(year(date) AS INTEGER) AS year_number,
    coalesce(steps, 0) AS steps,
    {r('(coalesce(distance_m, 0) / 1000e0)', 2)} AS daily_distance_km,
    coalesce(active_calories, 0) AS active_calories, coalesce(bmr_calories, 0) AS bmr_calories,
    coalesce(active_calories, 0) + coalesce(bmr_calories, 0) AS total_calories,
    resting_heart_rate, min_heart_rate, max_heart_rate, hrv_avg, hrv_status,
    {_hours('sleep_seconds')} AS sleep_hours, {_hours('deep_sleep_seconds')} AS deep_sleep_hours,
    {_hours('light_sleep_seconds')} AS light_sleep_hours,
    {_hours('rem_sleep_seconds')} AS rem_sleep_hours, {_hours('awake_seconds')} AS awake_hours,
    {r('(sleep_seconds * 100e0 / nullif(sleep_seconds + coalesce(awake_seconds, 0), 0))', 1)}
      AS sleep_efficiency_pct,
    {r('(deep_sleep_seconds * 100e0 / nullif(sleep_seconds, 0))', 1)} AS deep_sleep_pct,
    {r('(rem_sleep_seconds * 100e0 / nullif(sleep_seconds, 0))', 1)} AS rem_sleep_pct,
    stress_avg, coalesce(body_battery_charged, 0) AS body_battery_charged,
    coalesce(body_battery_drained, 0) AS body_battery_drained, body_battery_high, body_battery_low,
    coalesce(body_battery_charged, 0) - coalesce(body_battery_drained, 0) AS body_battery_net,
    avg_waking_respiration_rate, avg_sleep_respiration_rate,
    inserted_at AS loaded_at, updated_at
  FROM x_daily_health)
"""
X["x_stgh"] = "SELECT * FROM x_hlt WHERE steps > 0 OR sleep_hours > 0"
X["x_cal"] = f"""
SELECT athlete_id, event_uuid, title, event_date,
  CAST(year(event_date) AS INTEGER) AS event_year, CAST(month(event_date) AS INTEGER) AS event_month,
  CAST(date_diff('day', {TODAY}, event_date) AS INTEGER) AS days_until_race,
  event_date >= {TODAY} AS is_upcoming, {seasons('event_date')} AS race_season,
  start_time, timezone, location, distance_m, distance_km, race_distance_category,
  is_race, subscribed, url, inserted_at AS loaded_at, updated_at
FROM x_calendar
"""
X["x_uni"] = """
SELECT *,
  CASE WHEN is_missing_health_context THEN 'no_data' WHEN effort_level = 'easy' THEN 'easy_day'
       WHEN effort_level = 'hard' THEN CASE training_readiness WHEN 'high' THEN 'well_executed'
         WHEN 'low' THEN 'overreaching' ELSE 'normal' END
       ELSE 'normal' END AS workout_context
FROM (
  SELECT a.* EXCLUDE (event_type, has_data_quality_issues, is_very_short, has_unrealistic_pace),
    'garmin' AS data_source,
    h.recovery_score, h.sleep_hours AS pre_run_sleep_hours,
    h.sleep_quality AS pre_run_sleep_quality,
    h.sleep_efficiency_pct AS pre_run_sleep_efficiency_pct,
    h.resting_heart_rate AS daily_resting_hr, h.hrv_avg, h.hrv_category, h.stress_avg,
    h.stress_category, h.body_battery_high, h.body_battery_low, h.body_battery_net,
    h.body_battery_status, h.health_date IS NULL AS is_missing_health_context,
    CASE WHEN h.health_date IS NULL THEN 'no_data' WHEN h.recovery_score >= 70 THEN 'high'
         WHEN h.recovery_score >= 40 THEN 'moderate' ELSE 'low' END AS training_readiness,
    a.effort_level = 'hard' AND (coalesce(h.sleep_quality IN ('poor', 'fair'), FALSE)
      OR coalesce(h.recovery_score < 40, FALSE)) AS ran_while_tired
  FROM x_stg a LEFT JOIN x_stgh h
    ON h.athlete_id = a.athlete_id AND h.health_date = a.activity_date)
"""

_zone_means = ", ".join(
    f"avg(CAST(hr_zone = '{zone}' AS INTEGER)) AS {name}"
    for zone, name in [
        ("zone_1_recovery", "z1"),
        ("zone_2_base", "z2"),
        ("zone_3_tempo", "z3"),
        ("zone_4_threshold", "z4"),
        ("zone_5_vo2max", "z5"),
        ("zone_5_max", "z5_actual"),
    ]
)
X["x_week"] = f"""
SELECT athlete_id, CAST(date_trunc('week', activity_date) AS DATE) AS week_start_date,
  count(*) AS n, count(*) FILTER (is_race) AS races, sum(distance_km) AS km,
  avg(distance_km) AS km_mean, max(distance_km) AS km_max, sum(duration_minutes) AS minutes,
  avg(duration_minutes) AS minutes_mean,
  sum(avg_pace_min_km * distance_km) / nullif(sum(distance_km), 0) AS pace,
  avg(avg_heart_rate) AS hr, max(max_heart_rate) AS hr_max, sum(elevation_gain_m) AS gain,
  avg(elevation_gain_m) AS gain_mean,
  avg(CASE effort_level WHEN 'hard' THEN 3 WHEN 'moderate' THEN 2 WHEN 'easy' THEN 1 END) AS effort,
  sum(training_load) AS load, {_zone_means}
FROM x_stg WHERE activity_type = 'running' GROUP BY 1, 2
"""
X["x_roll"] = """
SELECT *, avg(km) OVER m4 AS km4, avg(n) OVER m4 AS n4, avg(minutes) OVER m4 AS minutes4,
  avg(load) OVER m4 AS load4, avg(km) OVER m8 AS km8, avg(n) OVER m8 AS n8,
  avg(minutes) OVER m8 AS minutes8, avg(load) OVER m8 AS load8,
  lag(km) OVER w AS km_before, lag(n) OVER w AS n_before, lag(pace) OVER w AS pace_before
FROM x_week
WINDOW w AS (PARTITION BY athlete_id ORDER BY week_start_date),
  m4 AS (PARTITION BY athlete_id ORDER BY week_start_date ROWS BETWEEN 3 PRECEDING AND CURRENT ROW),
  m8 AS (PARTITION BY athlete_id ORDER BY week_start_date ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)
"""


def _trend(x: str, mean: str) -> str:
    return (
        f"CASE WHEN {x} = {mean} THEN 'Stable' WHEN {x} > {mean} THEN 'Increasing'"
        " ELSE 'Decreasing' END"
    )


def _week_label(monday: str) -> str:
    return (
        f"'Week ' || CAST(extract(week FROM {monday}) AS VARCHAR) || ', '"
        f" || CAST(year({monday}) AS VARCHAR)"
    )


X["x_mt"] = f"""
SELECT athlete_id, week_start_date, CAST(year(week_start_date) AS INTEGER) AS year,
  CAST(extract(week FROM week_start_date) AS INTEGER) AS week_number,
  {_week_label('week_start_date')} AS week_label,
  n AS total_activities, races AS total_races, km AS total_distance_km,
  km_mean AS avg_distance_per_activity_km, km_max AS max_distance_km,
  minutes AS total_duration_minutes, minutes_mean AS avg_duration_per_activity_minutes,
  {s('pace', 2)} AS avg_pace_min_per_km, {s('hr', 0)} AS avg_heart_rate_bpm,
  hr_max AS max_heart_rate_bpm, gain AS total_elevation_gain_m,
  {s('gain_mean', 0)} AS avg_elevation_per_activity_m, {s('effort', 1)} AS avg_effort_level,
  {s('load', 1)} AS total_training_load,
  {s('(z1 * 100)', 1)} AS pct_zone1_easy, {s('(z2 * 100)', 1)} AS pct_zone2_moderate,
  {s('(z3 * 100)', 1)} AS pct_zone3_tempo, {s('(z4 * 100)', 1)} AS pct_zone4_threshold,
  {s('(z5 * 100)', 1)} AS pct_zone5_max, {s('(z5_actual * 100)', 1)} AS pct_zone5_actual,
  {s('km4', 2)} AS rolling_4wk_avg_distance_km, {s('n4', 1)} AS rolling_4wk_avg_activities,
  {s('minutes4', 0)} AS rolling_4wk_avg_duration_minutes,
  {s('load4', 1)} AS rolling_4wk_avg_training_load,
  {s('km8', 2)} AS rolling_8wk_avg_distance_km, {s('n8', 1)} AS rolling_8wk_avg_activities,
  {s('minutes8', 0)} AS rolling_8wk_avg_duration_minutes,
  {s('load8', 1)} AS rolling_8wk_avg_training_load,
  CASE WHEN km_before > 0 THEN {s('((km - km_before) / km_before * 100)', 1)} END
    AS distance_vs_prev_week_pct,
  CASE WHEN n_before > 0 THEN {s('((n - n_before) / CAST(n_before AS DOUBLE) * 100)', 1)} END
    AS activities_vs_prev_week_pct,
  CASE WHEN km4 > 0 THEN {s('((km - km4) / km4 * 100)', 1)} END AS distance_vs_4wk_avg_pct,
  {_trend('km', 'km4')} AS distance_trend_4wk, {_trend('load', 'load4')} AS training_load_trend_4wk
FROM x_roll
"""

X["x_hroll"] = """
SELECT *,
  avg(sleep_hours) OVER f7 AS sleep7, avg(deep_sleep_hours) OVER f7 AS deep7,
  avg(resting_heart_rate) OVER f7 AS rhr7, avg(hrv_avg) OVER f7 AS hrv7,
  avg(stress_avg) OVER f7 AS stress7, avg(steps) OVER f7 AS steps7,
  avg(sleep_hours) OVER f28 AS sleep28, avg(resting_heart_rate) OVER f28 AS rhr28,
  lag(sleep_hours) OVER o AS sleep_1, lag(resting_heart_rate) OVER o AS rhr_1,
  lag(stress_avg) OVER o AS stress_1, lag(body_battery_net) OVER o AS battery_1,
  lag(sleep_hours, 7) OVER o AS sleep_7, lag(resting_heart_rate, 7) OVER o AS rhr_7,
  sum(8 - sleep_hours) OVER f7 AS debt7,
  avg(sleep_hours) OVER wk AS week_sleep, avg(resting_heart_rate) OVER wk AS week_rhr,
  avg(stress_avg) OVER wk AS week_stress, CAST(sum(steps) OVER wk AS BIGINT) AS week_steps
FROM (SELECT *, CAST(date_trunc('week', health_date) AS DATE) AS week_start_date FROM x_stgh)
WINDOW o AS (PARTITION BY athlete_id ORDER BY health_date),
  f7 AS (PARTITION BY athlete_id ORDER BY health_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
  f28 AS (PARTITION BY athlete_id ORDER BY health_date ROWS BETWEEN 27 PRECEDING AND CURRENT ROW),
  wk AS (PARTITION BY athlete_id, week_start_date)
"""
_heart = " ".join(
    f"WHEN resting_heart_rate <= rhr7 * {quote(factor)} THEN {points}"
    for points, factor in K.TREND_RHR[:-1]
)
_trend_points = " + ".join(
    [
        "least(40e0, sleep_hours / 8e0 * 40)",
        f"CASE WHEN resting_heart_rate IS NULL OR rhr7 IS NULL THEN 10 {_heart} ELSE 5 END",
        ladder("stress_avg", K.TREND_STRESS, "<=", K.TREND_NEUTRAL),
        ladder("body_battery_net", K.TREND_BATTERY, ">=", K.TREND_NEUTRAL),
    ]
)
_weekday = "CASE day_of_week " + " ".join(
    f"WHEN {i} THEN {quote(n)}" for i, n in enumerate(K.WEEKDAYS)
) + " END"
X["x_mh"] = f"""
SELECT athlete_id, health_date AS date, {_weekday} AS day_of_week, week_start_date,
  CAST(date_trunc('month', health_date) AS DATE) AS month_start_date,
  sleep_hours AS total_sleep_hours, deep_sleep_hours, light_sleep_hours, rem_sleep_hours,
  awake_hours, sleep_quality AS sleep_quality_category, sleep_efficiency_pct,
  {r('(8e0 - sleep_hours)', 2)} AS sleep_debt_hours, debt7 AS sleep_debt_7day_cumulative,
  sleep7 AS sleep_7day_avg, sleep28 AS sleep_28day_avg,
  sleep_hours - sleep_1 AS sleep_change_vs_prev_day,
  sleep_hours - sleep_7 AS sleep_change_vs_prev_week, sleep_hours - sleep7 AS sleep_vs_7day_avg,
  resting_heart_rate, min_heart_rate, max_heart_rate, rhr7 AS rhr_7day_avg, rhr28 AS rhr_28day_avg,
  resting_heart_rate - rhr_1 AS rhr_change_vs_prev_day,
  resting_heart_rate - rhr_7 AS rhr_change_vs_prev_week,
  resting_heart_rate - rhr7 AS rhr_vs_7day_avg,
  hrv_avg AS hrv_numeric, hrv7 AS hrv_7day_avg, hrv_status, hrv_category,
  stress_avg AS average_stress_level, stress_category, stress7 AS stress_7day_avg,
  stress_avg - stress_1 AS stress_change_vs_prev_day, stress_avg - stress7 AS stress_vs_7day_avg,
  body_battery_charged, body_battery_drained, body_battery_high, body_battery_low,
  body_battery_net AS body_battery_net_change, body_battery_status,
  steps AS total_steps, daily_distance_km, steps7 AS steps_7day_avg,
  {r('(' + _trend_points + ')', 0)} AS recovery_score,
  CASE WHEN sleep_hours >= 7
         AND (rhr7 IS NULL OR resting_heart_rate <= rhr7 * 1.05e0)
         AND coalesce(stress_avg, 0) <= 40 AND coalesce(body_battery_net, 0) >= 0 THEN 'optimal'
       WHEN sleep_hours >= 6 AND (rhr7 IS NULL OR resting_heart_rate <= rhr7 * 1.10e0)
         AND coalesce(stress_avg, 0) <= 55 THEN 'good'
       WHEN sleep_hours >= 5 THEN 'moderate' ELSE 'low' END AS training_readiness,
  week_sleep AS week_avg_sleep, week_rhr AS week_avg_rhr, week_stress AS week_avg_stress,
  week_steps AS week_total_steps
FROM x_hroll
"""

X["x_race"] = """
SELECT *, race_date - lag(race_date) OVER o AS gap_days,
  row_number() OVER o AS race_number,
  row_number() OVER (PARTITION BY athlete_id, year(race_date) ORDER BY race_date, race_id)
    AS race_number_this_year
FROM (
  SELECT athlete_id, activity_id AS race_id, activity_date AS race_date, race_distance_category,
    distance_km, duration_minutes, avg_pace_min_km AS pace, avg_heart_rate, max_heart_rate,
    elevation_gain_m, training_load, effort_level
  FROM x_stg WHERE is_race)
WINDOW o AS (PARTITION BY athlete_id ORDER BY race_date, race_id)
"""
X["x_pr"] = """
SELECT athlete_id, race_distance_category, min(duration_minutes) AS pr_minutes, min(pace) AS pr_pace
FROM x_race WHERE race_distance_category IS NOT NULL GROUP BY 1, 2
"""
X["x_train"] = """
SELECT r.athlete_id, r.race_id, avg(t.avg_pace_min_km) AS pace_30d, sum(t.distance_km) AS km_30d,
  count(*) AS runs_30d, count(t.activity_id) AS matched_30d,
  min(t.activity_date) AS first_30d, max(t.activity_date) AS last_30d
FROM x_race r LEFT JOIN x_stg t ON t.athlete_id = r.athlete_id AND NOT t.is_race
  AND t.activity_date >= r.race_date - 30 AND t.activity_date <= r.race_date - 1
GROUP BY 1, 2
"""
X["x_rmet"] = f"""
SELECT r.*, pr.pr_minutes, pr.pr_pace, t.pace_30d, t.km_30d, t.runs_30d,
  coalesce(r.duration_minutes = pr.pr_minutes, FALSE) AS is_pr,
  r.duration_minutes - pr.pr_minutes AS off_minutes,
  CASE WHEN pr.pr_minutes > 0 THEN
    {r('((r.duration_minutes - pr.pr_minutes) / pr.pr_minutes * 100)', 1)} END AS off_pct,
  {s('(r.pace - t.pace_30d)', 2)} AS pace_diff,
  g.race_name AS goal_race_name, g.goal_time_seconds, g.goal_time_formatted, g.notes,
  avg(r.pace) OVER (PARTITION BY r.athlete_id, r.race_distance_category
    ORDER BY r.race_date, r.race_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS pace_ma3,
  r.pace - lag(r.pace) OVER (PARTITION BY r.athlete_id, r.race_distance_category
    ORDER BY r.race_date, r.race_id) AS pace_change
FROM x_race r
LEFT JOIN x_pr pr USING (athlete_id, race_distance_category)
LEFT JOIN x_train t ON t.athlete_id = r.athlete_id AND t.race_id = r.race_id
LEFT JOIN x_goals g ON g.athlete_id = r.athlete_id AND g.race_date = r.race_date
"""


def _rested(days: int | None) -> str:
    return "" if days is None else f" AND coalesce(gap_days, {days}) >= {days}"


_readiness = " ".join(
    f"WHEN {s('km_30d', 6)} >= {km}{_rested(days)} THEN {score}"
    for score, km, days in K.RACE_READINESS
)
_goal_arms = " ".join(
    f"WHEN duration_minutes * 60 <= goal_time_seconds * {quote(f)} THEN {quote(label)}"
    for label, f in K.GOAL_BANDS[:-1]
)
FINISH = (
    "CAST(CAST(floor(duration_minutes / 60) AS BIGINT) AS VARCHAR) || ':'"
    " || lpad(CAST(CAST(floor(duration_minutes % 60) AS BIGINT) AS VARCHAR), 2, '0') || ':'"
    " || lpad(CAST(CAST(floor(duration_minutes % 1 * 60) AS BIGINT) AS VARCHAR), 2, '0')"
)
X["x_mr"] = f"""
SELECT athlete_id, race_id, race_date, CAST(year(race_date) AS INTEGER) AS race_year,
  CAST(month(race_date) AS INTEGER) AS race_month,
  CAST(quarter(race_date) AS INTEGER) AS race_quarter, {seasons('race_date')} AS race_season,
  race_number, race_number_this_year, race_distance_category,
  {r('distance_km', 2)} AS distance_km, {r('(distance_km * 1000)', 0)} AS distance_meters,
  {r('duration_minutes', 1)} AS duration_minutes, {FINISH} AS finish_time_formatted,
  {r('pace', 2)} AS pace_min_per_km, CAST(avg_heart_rate AS DOUBLE) AS avg_heart_rate_bpm,
  max_heart_rate AS max_heart_rate_bpm, {r('elevation_gain_m', 0)} AS elevation_gain_m,
  {r('training_load', 1)} AS training_load, effort_level,
  is_pr AS is_personal_record, {r('pr_minutes', 1)} AS pr_duration_minutes,
  {r('pr_pace', 2)} AS pr_pace_min_per_km, {r('off_minutes', 1)} AS minutes_off_pr,
  off_pct AS pct_off_pr, {s('pace_30d', 2)} AS avg_training_pace_30d,
  {s('km_30d', 1)} AS total_training_distance_30d, runs_30d AS training_runs_30d,
  pace_diff AS race_vs_training_pace_diff,
  CAST(CASE {_readiness} ELSE 5 END AS INTEGER) AS race_readiness_score,
  CAST(gap_days AS INTEGER) AS days_since_last_race,
  goal_race_name, goal_time_formatted AS goal_time_formatted_target, goal_time_seconds,
  {r('(duration_minutes * 60 - goal_time_seconds)', 0)} AS seconds_vs_goal,
  CASE WHEN goal_time_seconds IS NULL THEN {quote(K.GOAL_NONE)} {_goal_arms}
    ELSE {quote(K.GOAL_BANDS[-1][0])} END AS goal_achievement,
  notes AS goal_notes, {s('pace_ma3', 2)} AS pace_ma_3_races,
  {s('pace_change', 2)} AS pace_change_vs_last_race,
  CASE WHEN is_pr THEN 'PR' ELSE {ladder('off_pct', K.RATINGS, '<=')} END AS performance_rating,
  CASE WHEN pace_diff IS NULL THEN 'No training data'
       WHEN pace_diff > 0.5 THEN 'Slower than training'
       WHEN pace_diff >= -0.5 THEN 'Consistent with training'
       WHEN pace_diff >= -1.0 THEN 'Faster than training'
       ELSE 'Much faster than training' END AS pacing_assessment,
  CASE WHEN gap_days IS NULL THEN 'First race' WHEN gap_days > 14 THEN 'Well rested'
       WHEN gap_days >= 7 THEN 'Standard recovery' ELSE 'Quick turnaround' END AS recovery_status
FROM x_rmet
"""

_NAME = re.compile(r"\bx_\w+")


def assemble(sql: str) -> str:
    """Put the named subqueries a query needs, and theirs, in front of it."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in _NAME.findall(text):
            if name in X and name not in ordered:
                visit(X[name])
                ordered.append(name)

    visit(sql)
    if not ordered:
        return sql.strip()
    parts = ",\n".join(f"{n} AS ({X[n].strip()})" for n in ordered)
    return f"WITH {parts}\n{sql.strip()}"
