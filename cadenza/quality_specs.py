"""The declared data tests. Everything in this module is a fixed value."""

from __future__ import annotations

from cadenza import constants as K
from cadenza.operators.quality import ColumnTest

_FLAG = (True, False)
_DISTANCES = tuple(K.DISTANCE_LABELS)
_SEASONS = ("Spring", "Summer", "Fall", "Winter")
_TYPES = (
    "running",
    "cycling",
    "swimming",
    "walking",
    "hiking",
    "strength_training",
    "yoga",
    "other",
)
_EFFORTS = ("easy", "moderate", "hard", "unknown")
_HRV = ("excellent", "good", "moderate", "low", "no_data")
_SLEEP = ("excellent", "good", "fair", "poor", "no_data")
_STRESS = ("low", "moderate", "high", "very_high", "no_data")
_BATTERY = ("high", "moderate", "low", "depleted", "no_data")
_TRENDS = ("Increasing", "Decreasing", "Stable")


def _tests(
    table: str,
    unique: str = "",
    not_null: str = "",
    values: dict | None = None,
    ranges: dict | None = None,
    expressions: dict | None = None,
    where: dict | None = None,
    errors: tuple = (),
) -> list[ColumnTest]:
    where = where or {}
    out = [ColumnTest(table, c, "unique") for c in unique.split()]
    out += [ColumnTest(table, c, "not_null") for c in not_null.split()]
    out += [
        ColumnTest(table, c, "accepted_values", tuple(v), where.get(c)) for c, v in (values or {}).items()
    ]
    out += [ColumnTest(table, c, "accepted_range", r, where.get(c)) for c, r in (ranges or {}).items()]
    out += [
        ColumnTest(table, c, "expression", e, None, "error" if c in errors else "warn")
        for c, e in (expressions or {}).items()
    ]
    return out


def _present(*columns: str) -> dict:
    return {c: f"{c} is not null" for c in columns}


TESTS: list[ColumnTest] = [
    *_tests(
        "activities",
        unique="activity_id",
        not_null="activity_id activity_date start_time_local activity_type distance_m"
        " duration_seconds inserted_at",
        values={"activity_type": _TYPES},
    ),
    *_tests(
        "calendar_events",
        unique="event_uuid",
        not_null="event_uuid title event_date inserted_at",
    ),
    *_tests(
        "daily_health",
        unique="date",
        not_null="date steps resting_heart_rate sleep_seconds inserted_at",
    ),
    *_tests(
        "race_goals",
        unique="race_date",
        not_null="race_date race_name race_distance_category distance_km goal_time_seconds",
        values={"race_distance_category": _DISTANCES},
    ),
    *_tests(
        "stg_activities",
        unique="activity_id",
        not_null="activity_id activity_date activity_type distance_km duration_minutes is_race"
        " pace_zone hr_zone effort_level terrain_type time_of_day is_weekend"
        " has_data_quality_issues is_very_short has_unrealistic_pace loaded_at",
        values={
            "activity_type": _TYPES,
            "is_race": _FLAG,
            "race_distance_category": _DISTANCES,
            "pace_zone": ("elite", "fast", "moderate", "easy", "recovery", "no_data"),
            "hr_zone": (
                "zone_1_recovery",
                "zone_2_base",
                "zone_3_tempo",
                "zone_4_threshold",
                "zone_5_max",
                "no_hr_data",
            ),
            "effort_level": _EFFORTS,
            "terrain_type": ("flat", "rolling", "hilly", "mountainous", "unknown"),
            "time_of_day": ("morning", "afternoon", "evening", "night"),
            "is_weekend": _FLAG,
            "has_data_quality_issues": _FLAG,
            "is_very_short": _FLAG,
            "has_unrealistic_pace": _FLAG,
        },
        expressions={"distance_km": ">= 0", "duration_minutes": ">= 5"},
        where=_present("race_distance_category"),
        errors=("distance_km",),
    ),
    *_tests(
        "stg_health",
        unique="health_date",
        not_null="health_date is_weekend steps daily_distance_km steps_goal_met has_missing_hr"
        " hrv_category sleep_hours sleep_quality has_missing_sleep stress_category"
        " body_battery_status recovery_score loaded_at",
        values={
            "is_weekend": _FLAG,
            "steps_goal_met": _FLAG,
            "has_missing_hr": _FLAG,
            "has_missing_sleep": _FLAG,
            "hrv_category": _HRV,
            "sleep_quality": _SLEEP,
            "stress_category": _STRESS,
            "body_battery_status": _BATTERY,
        },
        expressions={
            "steps": ">= 0",
            "daily_distance_km": ">= 0",
            "sleep_hours": ">= 0",
            "recovery_score": "BETWEEN 0 AND 100",
        },
    ),
    *_tests(
        "stg_calendar",
        unique="event_uuid",
        not_null="event_uuid title event_date is_upcoming race_season is_race loaded_at",
        values={
            "is_upcoming": _FLAG,
            "race_season": _SEASONS,
            "race_distance_category": _DISTANCES,
            "is_race": (True,),
        },
        where=_present("race_distance_category"),
    ),
    *_tests(
        "int_unified",
        unique="activity_id",
        not_null="data_source activity_id activity_date is_weekend activity_type is_race"
        " distance_km duration_minutes pace_zone hr_zone effort_level training_load"
        " is_missing_health_context training_readiness ran_while_tired workout_context loaded_at",
        values={
            "data_source": ("garmin", "strava"),
            "is_weekend": _FLAG,
            "is_race": _FLAG,
            "effort_level": _EFFORTS,
            "is_missing_health_context": _FLAG,
            "training_readiness": ("high", "moderate", "low", "no_data"),
            "ran_while_tired": _FLAG,
            "workout_context": ("well_executed", "normal", "overreaching", "easy_day", "no_data"),
        },
        expressions={"distance_km": "> 0", "duration_minutes": ">= 5", "training_load": "> 0"},
    ),
    *_tests(
        "mart_training",
        unique="week_start_date",
        not_null="week_start_date year week_number week_label total_activities total_races"
        " total_distance_km total_duration_minutes total_elevation_gain_m total_training_load"
        " distance_trend_4wk training_load_trend_4wk",
        values={"distance_trend_4wk": _TRENDS, "training_load_trend_4wk": _TRENDS},
        ranges={
            "total_activities": (0, None),
            "total_races": (0, None),
            "total_distance_km": (0, 300),
            "avg_distance_per_activity_km": (0, 50),
            "max_distance_km": (0, 50),
            "total_duration_minutes": (0, 1800),
            "avg_duration_per_activity_minutes": (0, 300),
            "avg_pace_min_per_km": (3, 15),
            "avg_heart_rate_bpm": (100, 200),
            "max_heart_rate_bpm": (100, 220),
            "total_elevation_gain_m": (0, None),
            "avg_elevation_per_activity_m": (0, 2000),
            "avg_effort_level": (1, 10),
            "total_training_load": (0, None),
            "pct_zone1_easy": (0, 100),
            "pct_zone2_moderate": (0, 100),
            "pct_zone3_tempo": (0, 100),
            "pct_zone4_threshold": (0, 100),
            "pct_zone5_max": (0, 100),
            "rolling_4wk_avg_distance_km": (0, 300),
            "rolling_4wk_avg_activities": (0, 20),
            "rolling_4wk_avg_duration_minutes": (0, 1800),
            "rolling_4wk_avg_training_load": (0, None),
            "rolling_8wk_avg_distance_km": (0, 300),
            "rolling_8wk_avg_activities": (0, 20),
            "rolling_8wk_avg_duration_minutes": (0, 1800),
            "rolling_8wk_avg_training_load": (0, None),
            "distance_vs_prev_week_pct": (-100, 500),
            "activities_vs_prev_week_pct": (-100, 500),
            "distance_vs_4wk_avg_pct": (-100, 500),
        },
    ),
    *_tests(
        "mart_race",
        unique="race_id",
        not_null="race_id race_date race_year race_season distance_km duration_minutes"
        " pace_min_per_km is_personal_record performance_rating race_readiness_score"
        " pacing_assessment recovery_status",
        values={
            "race_season": _SEASONS,
            "race_distance_category": _DISTANCES,
            "is_personal_record": _FLAG,
            "performance_rating": ("PR", "Near PR", "Good", "Fair", "Off Day"),
            "pacing_assessment": tuple(K.PACING_LABELS),
            "recovery_status": tuple(K.RECOVERY_LABELS),
        },
        ranges={
            "distance_km": (3, 100),
            "duration_minutes": (10, 600),
            "pace_min_per_km": (3, 10),
            "pr_pace_min_per_km": (3, 10),
            "minutes_off_pr": (0, 120),
            "pct_off_pr": (0, 100),
            "avg_training_pace_30d": (3, 15),
            "total_training_distance_30d": (0, 500),
            "training_runs_30d": (0, 50),
            "race_vs_training_pace_diff": (-5, 5),
            "race_readiness_score": (1, 10),
            "days_since_last_race": (0, 365),
            "pace_ma_3_races": (3, 10),
            "pace_change_vs_last_race": (-3, 3),
        },
    ),
    *_tests(
        "mart_health",
        unique="date",
        not_null="date day_of_week week_start_date month_start_date total_sleep_hours"
        " deep_sleep_hours light_sleep_hours rem_sleep_hours awake_hours sleep_quality_category"
        " sleep_debt_hours sleep_debt_7day_cumulative sleep_7day_avg sleep_28day_avg"
        " resting_heart_rate rhr_7day_avg rhr_28day_avg average_stress_level stress_7day_avg"
        " body_battery_charged body_battery_drained body_battery_net_change total_steps"
        " steps_7day_avg recovery_score training_readiness week_avg_sleep week_avg_rhr"
        " week_avg_stress week_total_steps",
        values={
            "day_of_week": tuple(K.WEEKDAYS),
            "sleep_quality_category": _SLEEP,
            "hrv_category": _HRV,
            "stress_category": _STRESS,
            "body_battery_status": _BATTERY,
            "training_readiness": tuple(K.READINESS_ORDER),
        },
        ranges={
            "total_sleep_hours": (0, 16),
            "deep_sleep_hours": (0, 5),
            "light_sleep_hours": (0, 12),
            "rem_sleep_hours": (0, 4),
            "awake_hours": (0, 4),
            "sleep_efficiency_pct": (0, 100),
            "resting_heart_rate": (30, 100),
            "min_heart_rate": (30, 100),
            "max_heart_rate": (40, 220),
            "hrv_numeric": (0, 200),
            "average_stress_level": (0, 100),
            "body_battery_charged": (0, 100),
            "body_battery_drained": (0, 100),
            "body_battery_high": (0, 100),
            "body_battery_low": (0, 100),
            "total_steps": (0, 100000),
            "daily_distance_km": (0, 100),
            "recovery_score": (0, 100),
        },
        where=_present(
            "min_heart_rate",
            "max_heart_rate",
            "hrv_numeric",
            "hrv_category",
            "stress_category",
            "body_battery_high",
            "body_battery_low",
            "body_battery_status",
        ),
    ),
]

# Warn and error age in days of the newest load.
FRESHNESS = {"activities": (2, 7), "daily_health": (2, 7), "calendar_events": (7, None)}
