"""Expressions over one race."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadenza import constants as K
from cadenza.functions.numeric import band, first_match


def goal_outcome(minutes: Column, goal_seconds: Column) -> Column:
    actual = minutes * 60
    *bounded, (rest, _) = K.GOAL_BANDS
    return first_match(
        [
            (goal_seconds.isNull(), F.lit(K.GOAL_NONE)),
            *[(actual <= goal_seconds * factor, F.lit(label)) for label, factor in bounded],
        ],
        F.lit(rest),
    )


def readiness_score(km_30d: Column, days_since: Column) -> Column:
    """5 to 9 by volume of the last 30 days and rest since the last race."""

    def rested(days: int | None) -> Column:
        if days is None:
            return F.lit(True)
        return days_since.isNull() | (days_since >= days)

    return first_match(
        [
            ((km_30d >= km) & rested(days), F.lit(score))
            for score, km, days in K.RACE_READINESS
        ],
        F.lit(K.RACE_READINESS_BASE),
    )


def finish_time(minutes: Column) -> Column:
    """H:MM:SS of decimal minutes; part seconds are dropped."""

    def two(x: Column) -> Column:
        return F.lpad(F.floor(x).cast("string"), 2, "0")

    return F.concat_ws(
        ":",
        F.floor(minutes / 60).cast("string"),
        two(minutes % 60),
        two(minutes % 1 * 60),
    )


def rating(is_pr: Column, pct_off: Column) -> Column:
    return F.when(is_pr, F.lit(K.RATING_PR)).otherwise(band(pct_off, K.RATINGS, "<="))


def pacing(diff: Column) -> Column:
    much_faster, faster, same, slower, unknown = map(F.lit, K.PACING_LABELS)
    return first_match(
        [(diff < -1.0, much_faster), (diff < -0.5, faster), (diff <= 0.5, same), (diff > 0.5, slower)],
        unknown,
    )


def recovery_status(days_since: Column) -> Column:
    first, quick, standard, rested = map(F.lit, K.RECOVERY_LABELS)
    return first_match(
        [(days_since.isNull(), first), (days_since < 7, quick), (days_since <= 14, standard)],
        rested,
    )
