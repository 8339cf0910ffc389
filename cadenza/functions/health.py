"""Expressions over one day of health readings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadenza import constants as K
from cadenza.functions.numeric import band, first_match, or_zero, rnd_pos


def hours(seconds: Column) -> Column:
    return rnd_pos(or_zero(seconds) / 3600.0, 2)


def sleep_efficiency(sleep_s: Column, awake_s: Column) -> Column:
    """Share of the night asleep in percent; null without sleep reading."""
    night = sleep_s + or_zero(awake_s)
    return F.when(night != 0, rnd_pos(sleep_s * 100.0 / F.nullif(night, F.lit(0)), 1))


def stage_share(stage_s: Column, sleep_s: Column) -> Column:
    return rnd_pos(stage_s * 100.0 / F.nullif(sleep_s, F.lit(0)), 1)


def sleep_quality(sleep_hours: Column) -> Column:
    return F.when(sleep_hours == 0, F.lit("no_data")).otherwise(
        band(sleep_hours, K.SLEEP_QUALITIES, "<", missing="no_data")
    )


def stress_category(stress: Column) -> Column:
    return band(stress, K.STRESS_LEVELS, "<=", missing="no_data")


def battery_status(peak: Column) -> Column:
    return band(peak, K.BATTERY_LEVELS, ">=", missing="no_data")


def hrv_category(hrv: Column) -> Column:
    return band(hrv, K.HRV_LEVELS, ">=", missing="no_data")


def day_score(sleep_hours: Column, stress: Column, battery_peak: Column, rhr: Column) -> Column:
    """Recovery score of one day, 0-100."""
    neutral = K.DAY_SCORE_NEUTRAL
    return (
        band(sleep_hours, K.DAY_SCORE_SLEEP, ">=", missing=0)
        + band(stress, K.DAY_SCORE_STRESS, "<=", missing=neutral["stress"])
        + band(battery_peak, K.DAY_SCORE_BATTERY, ">=", missing=neutral["battery"])
        + band(rhr, K.DAY_SCORE_RHR, "<", missing=neutral["rhr"])
    ).cast("double")


def trend_score(
    sleep_hours: Column, rhr: Column, rhr_mean: Column, stress: Column, battery_net: Column
) -> Column:
    """Recovery score against the athlete's own 7-row mean, 0-100."""
    sleep = F.least(
        F.lit(float(K.TREND_SLEEP_POINTS)),
        sleep_hours / K.TREND_SLEEP_TARGET_HOURS * K.TREND_SLEEP_POINTS,
    )
    *near, (far, _) = K.TREND_RHR
    heart = first_match(
        [
            (rhr.isNull() | rhr_mean.isNull(), F.lit(K.TREND_NEUTRAL)),
            *[(rhr <= rhr_mean * factor, F.lit(points)) for points, factor in near],
        ],
        F.lit(far),
    )
    calm = band(stress, K.TREND_STRESS, "<=", missing=K.TREND_NEUTRAL)
    charge = band(battery_net, K.TREND_BATTERY, ">=", missing=K.TREND_NEUTRAL)
    return rnd_pos(sleep + heart + calm + charge, 0)


def trend_readiness(
    sleep_hours: Column, rhr: Column, rhr_mean: Column, stress: Column, battery_net: Column
) -> Column:
    """optimal / good / moderate / low. A missing stress or battery reading passes; a
    missing resting heart rate with a known mean does not."""

    def heart_within(factor: float) -> Column:
        return rhr_mean.isNull() | (rhr <= rhr_mean * factor)

    def calm_within(limit: int) -> Column:
        return stress.isNull() | (stress <= limit)

    charged = battery_net.isNull() | (battery_net >= 0)
    return first_match(
        [
            (
                (sleep_hours >= 7) & heart_within(1.05) & calm_within(40) & charged,
                F.lit("optimal"),
            ),
            ((sleep_hours >= 6) & heart_within(1.10) & calm_within(55), F.lit("good")),
            (sleep_hours >= 5, F.lit("moderate")),
        ],
        F.lit("low"),
    )


def readiness_for(missing: Column, score: Column) -> Column:
    """Training readiness of an activity from its day's score."""
    return F.when(missing, F.lit("no_data")).otherwise(band(score, K.READINESS_LEVELS, ">="))


def workout_context(missing: Column, effort: Column, readiness: Column) -> Column:
    hard = effort == "hard"
    return first_match(
        [
            (missing, F.lit("no_data")),
            (effort == "easy", F.lit("easy_day")),
            (hard & (readiness == "high"), F.lit("well_executed")),
            (hard & (readiness == "low"), F.lit("overreaching")),
        ],
        F.lit("normal"),
    )


def ran_while_tired(effort: Column, sleep_quality_: Column, score: Column) -> Column:
    tired = F.coalesce(sleep_quality_.isin("poor", "fair"), F.lit(False)) | F.coalesce(
        score < 40, F.lit(False)
    )
    return (effort == "hard") & tired
