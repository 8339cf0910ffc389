"""The published look-ups over the marts: peaks, alerts, labels, audits.

Where the original lists the newest or best rows of its one athlete, these list them per
athlete.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions import dates as D
from cadenza.functions.numeric import first_match, rnd_agg
from cadenza.operators.windows import last_rows, newest, newest_ranked

c = F.col
ATHLETE = "athlete_id"


def peak_week(training: DataFrame) -> DataFrame:
    """The week with most km, the newest of equals."""
    km = rnd_agg(c("total_distance_km"), 6)
    return newest(
        training.select(
            ATHLETE,
            "week_start_date",
            "week_label",
            km.alias("total_distance_km"),
            "total_training_load",
            "total_activities",
        ),
        1,
        c("total_distance_km").desc(),
        c("week_start_date").desc(),
    )


def above_average_weeks(training: DataFrame) -> DataFrame:
    return training.filter(
        rnd_agg(c("total_distance_km"), 6) > c("rolling_4wk_avg_distance_km")
    ).select(
        ATHLETE,
        "week_start_date",
        "week_label",
        "total_distance_km",
        "rolling_4wk_avg_distance_km",
        "distance_vs_4wk_avg_pct",
    )


def zone_history(training: DataFrame, weeks: int = 10) -> DataFrame:
    return newest(training, weeks, c("week_start_date").desc()).select(
        ATHLETE,
        "week_start_date",
        "week_label",
        "pct_zone1_easy",
        "pct_zone2_moderate",
        "pct_zone3_tempo",
        "pct_zone4_threshold",
        "pct_zone5_max",
    )


def load_trend(training: DataFrame) -> DataFrame:
    return training.select(
        ATHLETE,
        "week_start_date",
        "week_label",
        "total_training_load",
        "rolling_4wk_avg_training_load",
        "training_load_trend_4wk",
    ).orderBy(ATHLETE, "week_start_date")


def recent_weeks(training: DataFrame, weeks: int = 5) -> DataFrame:
    return newest(training, weeks, c("week_start_date").desc()).select(
        ATHLETE,
        "week_start_date",
        "week_label",
        "total_activities",
        "total_distance_km",
        "rolling_4wk_avg_distance_km",
        "distance_vs_4wk_avg_pct",
        "distance_trend_4wk",
    )


def best_worst_recovery(health: DataFrame, n: int = 5) -> DataFrame:
    """The n best and n worst days by score, the newest of equals first."""
    slim = health.select(ATHLETE, "date", "recovery_score", "training_readiness")
    newer = c("date").desc()
    best = newest_ranked(slim, n, c("recovery_score").desc_nulls_last(), newer)
    worst = newest_ranked(slim, n, c("recovery_score").asc_nulls_last(), newer)
    return best.withColumn("side", F.lit("best")).unionByName(
        worst.withColumn("side", F.lit("worst"))
    )


def sleep_debt_alert(health: DataFrame, hours: float = 5.0) -> DataFrame:
    debt = rnd_agg(c("sleep_debt_7day_cumulative"), 6)
    return health.filter(debt > hours).select(
        ATHLETE,
        "date",
        "sleep_debt_7day_cumulative",
        "total_sleep_hours",
        "sleep_quality_category",
    )


def rhr_trend_label(health: DataFrame, days: int = 7) -> DataFrame:
    off = c("rhr_vs_7day_avg")
    return newest(health, days, c("date").desc()).select(
        ATHLETE,
        "date",
        "resting_heart_rate",
        "rhr_7day_avg",
        "rhr_vs_7day_avg",
        first_match(
            [(off > 0, F.lit("⬆️ Above avg")), (off < 0, F.lit("⬇️ Below avg"))],
            F.lit("➡️ At avg"),
        ).alias("trend"),
    )


def battery_label(health: DataFrame, days: int = 7) -> DataFrame:
    net = c("body_battery_net_change")
    return newest(health, days, c("date").desc()).select(
        ATHLETE,
        "date",
        "body_battery_charged",
        "body_battery_drained",
        "body_battery_net_change",
        first_match(
            [(net >= 20, F.lit("🔋 Great recovery")), (net >= 0, F.lit("✅ Positive"))],
            F.lit("⚠️ Deficit"),
        ).alias("battery_status"),
    )


def null_audit(health: DataFrame) -> DataFrame:
    return health.groupBy(ATHLETE).agg(
        F.count("*").alias("total_rows"),
        F.count_if(c("recovery_score").isNull()).alias("null_recovery"),
        F.count_if(c("training_readiness").isNull()).alias("null_readiness"),
    )


def debt_validation(health: DataFrame, days: int = 5) -> DataFrame:
    debt = F.lit(8.0) - c("total_sleep_hours")
    return newest(health, days, c("date").desc()).select(
        ATHLETE,
        "date",
        "total_sleep_hours",
        debt.alias("calculated_debt"),
        "sleep_debt_hours",
        F.when(F.abs(debt - c("sleep_debt_hours")) < 0.01, F.lit("✓"))
        .otherwise(F.lit("✗"))
        .alias("validation"),
    )


def overreaching(unified: DataFrame) -> DataFrame:
    return unified.filter(c("workout_context") == "overreaching").select(
        ATHLETE, "activity_id", "activity_date", "activity_name", "effort_level", "recovery_score"
    )


def current_records(race: DataFrame) -> DataFrame:
    return (
        race.filter("is_personal_record")
        .select(
            ATHLETE,
            "race_distance_category",
            "race_id",
            "race_date",
            "finish_time_formatted",
            "pace_min_per_km",
        )
        .orderBy(ATHLETE, "race_distance_category", "race_date")
    )


def race_calendar(race: DataFrame) -> DataFrame:
    return race.select(
        ATHLETE,
        "race_id",
        "race_date",
        "race_distance_category",
        "finish_time_formatted",
        "performance_rating",
        "days_since_last_race",
    ).orderBy(c("race_date").desc(), ATHLETE, "race_id")


def readiness_vs_result(race: DataFrame) -> DataFrame:
    return race.select(
        ATHLETE,
        "race_id",
        "race_date",
        "race_readiness_score",
        "total_training_distance_30d",
        "performance_rating",
        "pct_off_pr",
    )


def ten_k_progression(race: DataFrame) -> DataFrame:
    return race.filter(c("race_distance_category") == "10K").select(
        ATHLETE,
        "race_id",
        "race_date",
        "pace_min_per_km",
        "pace_ma_3_races",
        "is_personal_record",
        "pct_off_pr",
    )


def pacing_analysis(race: DataFrame) -> DataFrame:
    return race.select(
        ATHLETE,
        "race_id",
        "race_date",
        "race_distance_category",
        "avg_training_pace_30d",
        c("pace_min_per_km").alias("race_pace"),
        "race_vs_training_pace_diff",
        "pacing_assessment",
        "performance_rating",
    )


def best_races(race: DataFrame, n: int = 5) -> DataFrame:
    """The n races closest to their record."""
    closest = (c("pct_off_pr").asc_nulls_last(), c("race_date"), c("race_id"))
    best = newest(race, n, *closest, spread_by="race_id")
    return best.select(
        ATHLETE,
        "race_id",
        "race_date",
        "race_distance_category",
        "finish_time_formatted",
        "pace_min_per_km",
        "performance_rating",
    )


def score_trend(health: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    """7-row mean of the recovery score over the last days."""
    start = F.date_sub(D.as_date(as_of), days)
    return health.filter(c("date") >= start).select(
        ATHLETE,
        "date",
        "recovery_score",
        F.avg("recovery_score").over(last_rows("date", 7)).alias("score_7day_ma"),
    )


def restless_days(health: DataFrame) -> DataFrame:
    """Staged days with high stress or short sleep."""
    return health.filter(
        c("stress_category").isin("high", "very_high") | c("sleep_quality").isin("poor", "fair")
    ).select(ATHLETE, "health_date", "stress_category", "sleep_quality", "recovery_score")
