"""Activities joined with the athlete's state on the same day."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions import health as H
from cadenza.functions.reuse import reusable

c = F.col

# Health columns an activity carries, with the name they get there.
DAY_CONTEXT = {
    "recovery_score": "recovery_score",
    "sleep_hours": "pre_run_sleep_hours",
    "sleep_quality": "pre_run_sleep_quality",
    "sleep_efficiency_pct": "pre_run_sleep_efficiency_pct",
    "resting_heart_rate": "daily_resting_hr",
    "hrv_avg": "hrv_avg",
    "hrv_category": "hrv_category",
    "stress_avg": "stress_avg",
    "stress_category": "stress_category",
    "body_battery_high": "body_battery_high",
    "body_battery_low": "body_battery_low",
    "body_battery_net": "body_battery_net",
    "body_battery_status": "body_battery_status",
}
# Staging columns that stop here.
_NOT_CARRIED = [
    "event_type",
    "has_data_quality_issues",
    "is_very_short",
    "has_unrealistic_pace",
]


def tag_source(activities: DataFrame, source: str) -> DataFrame:
    return activities.withColumn("data_source", F.lit(source))


def union_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """Activities of several sources as one table, each row tagged."""
    tagged = [tag_source(df, name) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def join_day(activities: DataFrame, health: DataFrame) -> DataFrame:
    """Each activity with its day's health.

    The join key is (athlete, day), not athlete alone, so an athlete with very many
    activities is spread over the days; health has one row per key.
    """
    slim = health.select(
        "athlete_id",
        c("health_date").alias("activity_date"),
        *[c(old).alias(new) for old, new in DAY_CONTEXT.items()],
        F.lit(True).alias("_has_day"),
    )
    joined = activities.join(slim, ["athlete_id", "activity_date"], "left")
    return joined.withColumn("is_missing_health_context", c("_has_day").isNull()).drop("_has_day")


@reusable
def _readiness() -> Column:
    return H.readiness_for(c("is_missing_health_context"), c("recovery_score"))


@reusable
def _workout() -> dict[str, Column]:
    missing, effort = c("is_missing_health_context"), c("effort_level")
    return {
        "ran_while_tired": H.ran_while_tired(
            effort, c("pre_run_sleep_quality"), c("recovery_score")
        ),
        "workout_context": H.workout_context(missing, effort, c("training_readiness")),
    }


def unify(activities: DataFrame, health: DataFrame, source: str = "garmin") -> DataFrame:
    """Staged activities with same-day health, readiness and workout context."""
    carried = activities.drop(*_NOT_CARRIED)
    joined = join_day(tag_source(carried, source), health)
    return joined.withColumn("training_readiness", _readiness()).withColumns(_workout())
