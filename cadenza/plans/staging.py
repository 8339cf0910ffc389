"""Raw tables to clean, classified tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza import constants as K
from cadenza.functions import activity as A
from cadenza.functions import dates as D
from cadenza.functions import health as H
from cadenza.functions.numeric import or_zero, rnd, rnd_pos
from cadenza.functions.reuse import reusable

c = F.col


@reusable
def _activity_measures() -> list[Column | str]:
    km = F.coalesce(c("distance_km"), F.lit(0.0))
    moving = F.coalesce(c("moving_duration_seconds"), c("duration_seconds"))
    return [
        "athlete_id",
        "activity_id",
        "activity_name",
        F.to_date("activity_date").alias("activity_date"),
        c("start_time_local").alias("activity_start_time"),
        F.hour("start_time_local").alias("start_hour"),
        D.dow(c("start_time_local")).alias("day_of_week"),
        "activity_type",
        "event_type",
        "device_name",
        "location_name",
        km.alias("distance_km"),
        "duration_minutes",
        rnd_pos(c("moving_duration_seconds") / 60, 2).alias("moving_duration_minutes"),
        rnd((c("duration_seconds") - moving) / 60, 2).alias("pause_duration_minutes"),
        A.sane_pace(c("avg_pace_min_km"), c("distance_km"), c("duration_minutes")).alias(
            "avg_pace_min_km"
        ),
        rnd_pos(c("avg_speed_mps") * 3.6, 2).alias("avg_speed_kmh"),
        rnd_pos(c("max_speed_mps") * 3.6, 2).alias("max_speed_kmh"),
        "avg_heart_rate",
        "max_heart_rate",
        (c("max_heart_rate") - c("avg_heart_rate")).alias("hr_delta"),
        "elevation_gain_m",
        "elevation_loss_m",
        (c("elevation_gain_m") - or_zero(c("elevation_loss_m"))).alias("net_elevation_m"),
        (c("max_elevation_m") - or_zero(c("min_elevation_m"))).alias("elevation_range_m"),
        "calories",
        "aerobic_training_effect",
        "anaerobic_training_effect",
        (
            or_zero(c("aerobic_training_effect")) + or_zero(c("anaerobic_training_effect"))
        ).alias("total_training_effect"),
        c("avg_cadence").alias("avg_cadence_spm"),
        c("max_cadence").alias("max_cadence_spm"),
        c("inserted_at").alias("loaded_at"),
        "updated_at",
    ]


@reusable
def _activity_labels() -> dict[str, Column]:
    pace, hr, minutes = c("avg_pace_min_km"), c("avg_heart_rate"), c("duration_minutes")
    return {
        "is_race": A.is_race(c("event_type"), c("activity_name")),
        "race_distance_category": A.distance_category(c("distance_km")),
        "pace_zone": A.pace_zone(pace),
        "hr_zone": A.hr_zone(hr),
        "effort_level": A.effort_level(hr, pace),
        "training_load": A.training_load(minutes, hr),
        "terrain_type": A.terrain(c("elevation_gain_m")),
        "time_of_day": A.time_of_day(c("start_hour")),
        "is_weekend": F.coalesce(D.is_weekend(c("day_of_week")), F.lit(False)),
        "has_data_quality_issues": A.zero_or_missing(c("distance_km"))
        | A.zero_or_missing(minutes),
        "is_very_short": F.coalesce(minutes < K.MIN_DURATION_MINUTES, F.lit(False)),
        "has_unrealistic_pace": F.coalesce(
            ~pace.between(K.PACE_MIN, K.PACE_MAX), F.lit(False)
        ),
    }


def enrich_activities(raw: DataFrame) -> DataFrame:
    """Every raw activity with its derived measures and labels."""
    return raw.select(*_activity_measures()).withColumns(_activity_labels())


def valid_activities(raw: DataFrame) -> DataFrame:
    """Raw activities with a distance and at least five minutes. The test is on raw
    columns, so it reaches the scan."""
    return raw.filter(
        (c("distance_km") > 0) & (c("duration_minutes") >= K.MIN_DURATION_MINUTES)
    )


def stage_activities(raw: DataFrame) -> DataFrame:
    return enrich_activities(valid_activities(raw))


@reusable
def _health_measures() -> list[Column | str]:
    day = c("date")
    sleep, awake = c("sleep_seconds"), c("awake_seconds")
    charged, drained = or_zero(c("body_battery_charged")), or_zero(c("body_battery_drained"))
    return [
        "athlete_id",
        day.alias("health_date"),
        D.dow(day).alias("day_of_week"),
        F.weekofyear(day).alias("week_of_year"),
        F.month(day).alias("month_number"),
        F.year(day).alias("year_number"),
        or_zero(c("steps")).alias("steps"),
        rnd_pos(or_zero(c("distance_m")) / 1000, 2).alias("daily_distance_km"),
        or_zero(c("active_calories")).alias("active_calories"),
        or_zero(c("bmr_calories")).alias("bmr_calories"),
        (or_zero(c("active_calories")) + or_zero(c("bmr_calories"))).alias("total_calories"),
        "resting_heart_rate",
        "min_heart_rate",
        "max_heart_rate",
        "hrv_avg",
        "hrv_status",
        H.hours(sleep).alias("sleep_hours"),
        H.hours(c("deep_sleep_seconds")).alias("deep_sleep_hours"),
        H.hours(c("light_sleep_seconds")).alias("light_sleep_hours"),
        H.hours(c("rem_sleep_seconds")).alias("rem_sleep_hours"),
        H.hours(awake).alias("awake_hours"),
        H.sleep_efficiency(sleep, awake).alias("sleep_efficiency_pct"),
        H.stage_share(c("deep_sleep_seconds"), sleep).alias("deep_sleep_pct"),
        H.stage_share(c("rem_sleep_seconds"), sleep).alias("rem_sleep_pct"),
        "stress_avg",
        charged.alias("body_battery_charged"),
        drained.alias("body_battery_drained"),
        "body_battery_high",
        "body_battery_low",
        (charged - drained).alias("body_battery_net"),
        "avg_waking_respiration_rate",
        "avg_sleep_respiration_rate",
        c("inserted_at").alias("loaded_at"),
        "updated_at",
    ]


@reusable
def _health_labels() -> dict[str, Column]:
    stress, peak, rhr = c("stress_avg"), c("body_battery_high"), c("resting_heart_rate")
    return {
        "is_weekend": D.is_weekend(c("day_of_week")),
        "sleep_quality": H.sleep_quality(c("sleep_hours")),
        "stress_category": H.stress_category(stress),
        "body_battery_status": H.battery_status(peak),
        "hrv_category": H.hrv_category(c("hrv_avg")),
        "steps_goal_met": c("steps") >= K.STEPS_GOAL,
        "recovery_score": H.day_score(c("sleep_hours"), stress, peak, rhr),
        "has_missing_sleep": A.zero_or_missing(c("sleep_hours")),
        "has_missing_hr": rhr.isNull(),
    }


def enrich_health(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every raw health day with its derived measures and labels. ``keep`` names columns to carry along."""
    return raw.select(*_health_measures(), *keep).withColumns(_health_labels())


def stage_health(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Health days with steps or sleep."""
    return enrich_health(raw, keep).filter((c("steps") > 0) | (c("sleep_hours") > 0))


def stage_calendar(raw: DataFrame, as_of: dt.date) -> DataFrame:
    """Race events with season and countdown to ``as_of``."""
    day, today = c("event_date"), D.as_date(as_of)
    return raw.select(
        "athlete_id",
        "event_uuid",
        "title",
        "event_date",
        F.year(day).alias("event_year"),
        F.month(day).alias("event_month"),
        F.date_diff(day, today).alias("days_until_race"),
        F.coalesce(day >= today, F.lit(False)).alias("is_upcoming"),
        F.coalesce(D.season(day), F.lit("Winter")).alias("race_season"),
        "start_time",
        "timezone",
        "location",
        "distance_m",
        "distance_km",
        "race_distance_category",
        "is_race",
        "subscribed",
        "url",
        c("inserted_at").alias("loaded_at"),
        "updated_at",
    )
