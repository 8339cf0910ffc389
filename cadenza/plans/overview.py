"""Totals and profiles per athlete over raw, staged and mart tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza import constants as K
from cadenza.functions import dates as D
from cadenza.functions.numeric import rnd_agg
from cadenza.operators.windows import newest
from cadenza.plans.training import runs_by_week

c = F.col
ATHLETE = "athlete_id"


def mean(name: str, places: int):
    return rnd_agg(F.avg(name), places)


def activity_overview(raw: DataFrame) -> DataFrame:
    return raw.groupBy(ATHLETE).agg(
        F.count("*").alias("total_runs"),
        rnd_agg(F.sum("distance_km"), 2).alias("total_distance_km"),
        mean("distance_km", 2).alias("avg_distance_km"),
        rnd_agg(F.sum("duration_minutes") / 60, 1).alias("total_hours"),
        mean("avg_heart_rate", 0).alias("avg_heart_rate"),
        mean("avg_pace_min_km", 2).alias("avg_pace_min_km"),
        F.min("activity_date").alias("first_activity"),
        F.max("activity_date").alias("last_activity"),
    )


def health_overview(raw: DataFrame) -> DataFrame:
    return raw.groupBy(ATHLETE).agg(
        F.count("*").alias("total_days"),
        mean("steps", 0).alias("avg_steps"),
        mean("resting_heart_rate", 0).alias("avg_resting_hr"),
        mean("hrv_avg", 0).alias("avg_hrv"),
        rnd_agg(F.avg("sleep_seconds") / 3600, 1).alias("avg_sleep_hours"),
        mean("stress_avg", 0).alias("avg_stress"),
        F.min("date").alias("first_record"),
        F.max("date").alias("last_record"),
    )


def activity_types(raw: DataFrame) -> DataFrame:
    """Activities and km by type, most frequent first."""
    return (
        raw.groupBy(ATHLETE, "activity_type")
        .agg(
            F.count("*").alias("activities"),
            rnd_agg(F.sum("distance_km"), 2).alias("total_distance_km"),
        )
        .orderBy(ATHLETE, c("activities").desc(), "activity_type")
    )


def runs_per_week(activities: DataFrame) -> DataFrame:
    return runs_by_week(activities).groupBy(ATHLETE, "week_start_date").agg(
        F.count("*").alias("total_runs")
    )


def with_runs_per_week(mart: DataFrame, activities: DataFrame) -> DataFrame:
    """Weekly rows with their run count, 0 where there is none."""
    joined = mart.join(runs_per_week(activities), [ATHLETE, "week_start_date"], "left")
    return joined.withColumns(
        {
            "total_runs": F.coalesce("total_runs", F.lit(0)),
            "total_duration_hours": c("total_duration_minutes") / 60,
        }
    )


def null_coverage(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(ATHLETE).agg(
        F.count("*").alias("total"),
        F.count(column).alias("non_null"),
        F.count_if(c(column).isNull()).alias("nulls"),
    )


def week_range(mart: DataFrame) -> DataFrame:
    return mart.groupBy(ATHLETE).agg(
        F.min("week_start_date").alias("min_date"), F.max("week_start_date").alias("max_date")
    )


def effort_totals(activities: DataFrame) -> DataFrame:
    return (
        activities.filter(c("activity_type") == "running")
        .groupBy(ATHLETE, "effort_level")
        .agg(F.count("*").alias("num_activities"), F.sum("distance_km").alias("total_distance"))
    )


def weekend_split(activities: DataFrame) -> DataFrame:
    return (
        activities.filter(c("activity_type") == "running")
        .groupBy(ATHLETE, "is_weekend")
        .agg(F.avg("distance_km").alias("avg_distance"), F.avg("avg_pace_min_km").alias("avg_pace"))
    )


def iso_week_recovery(health: DataFrame) -> DataFrame:
    return health.groupBy(ATHLETE, "year_number", "week_of_year").agg(
        F.avg("recovery_score").alias("avg_recovery"),
        F.avg("sleep_hours").alias("avg_sleep"),
        F.avg("resting_heart_rate").alias("avg_rhr"),
    )


def weekday_profile(mart: DataFrame) -> DataFrame:
    """Means by weekday, Monday first."""
    excellent = F.when(c("sleep_quality_category") == "excellent", 1.0).otherwise(0.0)
    return (
        mart.groupBy(ATHLETE, "day_of_week")
        .agg(
            F.count("*").alias("days"),
            mean("recovery_score", 1).alias("avg_score"),
            mean("total_sleep_hours", 2).alias("avg_sleep"),
            rnd_agg(F.avg(excellent) * 100, 1).alias("pct_excellent"),
            mean("sleep_debt_hours", 2).alias("avg_debt"),
            F.avg("average_stress_level").alias("avg_stress"),
        )
        .withColumn("weekday_order", D.day_name_order(c("day_of_week")))
        .orderBy(ATHLETE, "weekday_order")
    )


def weekly_health(mart: DataFrame) -> DataFrame:
    return mart.groupBy(ATHLETE, "week_start_date").agg(
        mean("recovery_score", 1).alias("avg_recovery"),
        mean("total_sleep_hours", 1).alias("avg_sleep"),
        mean("resting_heart_rate", 1).alias("avg_rhr"),
    )


def recent_weekly_health(mart: DataFrame, weeks: int = 4) -> DataFrame:
    """The newest weeks per athlete. Their days are found first, by a rank that every map partition cuts, so that only
    they are shuffled and summed, not the whole history."""
    by_week = Window.partitionBy(ATHLETE).orderBy(c("week_start_date").desc())
    days = mart.withColumn("_week", F.dense_rank().over(by_week)).filter(c("_week") <= weeks)
    return weekly_health(days)


def rhr_week_spread(mart: DataFrame) -> DataFrame:
    return mart.groupBy(ATHLETE, "week_start_date", "week_avg_rhr").agg(
        F.min("resting_heart_rate").alias("lowest_rhr"),
        F.max("resting_heart_rate").alias("highest_rhr"),
        F.avg("rhr_vs_7day_avg").alias("avg_deviation"),
    )


def readiness_distribution(mart: DataFrame) -> DataFrame:
    """Days and means per readiness level in fixed order, with the share of all days."""
    days = mart.groupBy(ATHLETE, "training_readiness").agg(
        F.count("*").alias("days"),
        mean("recovery_score", 1).alias("avg_score"),
        mean("total_sleep_hours", 1).alias("avg_sleep"),
        mean("resting_heart_rate", 1).alias("avg_rhr"),
    )
    order = F.array(*[F.lit(level) for level in K.READINESS_ORDER])
    total = F.sum("days").over(Window.partitionBy(ATHLETE))
    return days.withColumns(
        {
            "pct_of_days": rnd_agg(c("days") / total * 100, 1),
            "level_order": F.array_position(order, c("training_readiness")).cast("int"),
        }
    ).orderBy(ATHLETE, "level_order")


def health_extremes(mart: DataFrame) -> DataFrame:
    return mart.groupBy(ATHLETE).agg(
        F.min("recovery_score").alias("min_score"),
        F.max("recovery_score").alias("max_score"),
        F.min("resting_heart_rate").alias("min_rhr"),
        F.max("resting_heart_rate").alias("max_rhr"),
        F.min("total_sleep_hours").alias("min_sleep"),
        F.max("total_sleep_hours").alias("max_sleep"),
    )


def distinct_weeks(activities: DataFrame) -> DataFrame:
    monday = c("week_start_date")
    weeks = runs_by_week(activities).select(ATHLETE, "week_start_date").distinct()
    return weeks.withColumns({"year": F.year(monday), "week_number": F.weekofyear(monday)})


def training_with_health(training: DataFrame, health: DataFrame, weeks: int = 4) -> DataFrame:
    """Weekly distance next to the week's health, of the newest weeks that have both.

    Which weeks these are is found on the weekly training rows; only their health days are summed. Health is
    cut to one row per week before the last join, so neither side fans out."""
    week = [ATHLETE, "week_start_date"]
    both = training.select(*week, "total_distance_km").join(health.select(*week), week, "left_semi")
    shown = newest(both, weeks, c("week_start_date").desc())
    days = health.join(shown.select(*week), week, "left_semi")
    return shown.join(weekly_health(days).drop("avg_rhr"), week).select(
        *week, rnd_agg(c("total_distance_km"), 1).alias("avg_distance"), "avg_recovery", "avg_sleep"
    )


def days_with_workouts(health: DataFrame, activities: DataFrame, days: int = 7) -> DataFrame:
    """The newest health days with count and km of their workouts."""
    recent = newest(
        health.select(ATHLETE, "date", "recovery_score", "training_readiness"),
        days,
        c("date").desc(),
    )
    done = activities.withColumnRenamed("activity_date", "date").select(ATHLETE, "date", "distance_km")
    workouts = done.join(recent.select(ATHLETE, "date"), [ATHLETE, "date"], "left_semi").groupBy(ATHLETE, "date").agg(
        F.count("*").alias("n"), F.sum("distance_km").alias("km")
    )
    return recent.join(workouts, [ATHLETE, "date"], "left").select(
        ATHLETE,
        "date",
        "recovery_score",
        "training_readiness",
        F.coalesce("n", F.lit(0)).alias("num_workouts"),
        rnd_agg(F.coalesce("km", F.lit(0.0)), 1).alias("total_distance"),
    )


def races_with_eve_health(race: DataFrame, health: DataFrame) -> DataFrame:
    """Races with the health of the day before."""
    eve = health.select(
        ATHLETE,
        F.date_add("date", 1).alias("race_date"),
        c("recovery_score").alias("pre_race_recovery"),
        c("total_sleep_hours").alias("pre_race_sleep"),
    )
    return race.select(ATHLETE, "race_id", "race_date", "finish_time_formatted").join(
        eve, [ATHLETE, "race_date"], "left"
    )


def running_total(mart: DataFrame) -> DataFrame:
    """Cumulative distance by week."""
    frame = (
        Window.partitionBy(ATHLETE)
        .orderBy("week_start_date")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return mart.select(
        ATHLETE,
        "week_start_date",
        "total_distance_km",
        F.sum("total_distance_km").over(frame).alias("running_distance_km"),
    )
