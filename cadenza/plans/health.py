"""Daily health trends per athlete."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions import dates as D
from cadenza.functions import health as H
from cadenza.functions.numeric import rnd
from cadenza.functions.reuse import reusable
from cadenza.operators.windows import calendar_window, last_rows, whole

c = F.col

DAY = ["athlete_id", "health_date"]
# Weeks rise with days, so this is the order of the days; the windows over a week find it as they need it.
_BY_DAY = ("week_start_date", "health_date")
TARGET_SLEEP_HOURS = 8.0

# Staging column to mart column.
_RENAMED = {
    "sleep_hours": "total_sleep_hours",
    "sleep_quality": "sleep_quality_category",
    "stress_avg": "average_stress_level",
    "body_battery_net": "body_battery_net_change",
    "steps": "total_steps",
    "day_name": "day_of_week",
}
# Mean column and the staging column it is taken of.
_MEANS_7 = {
    "sleep_7day_avg": "sleep_hours",
    "deep_sleep_7day_avg": "deep_sleep_hours",
    "rhr_7day_avg": "resting_heart_rate",
    "hrv_7day_avg": "hrv_avg",
    "stress_7day_avg": "stress_avg",
    "steps_7day_avg": "steps",
}
_MEANS_28 = {"sleep_28day_avg": "sleep_hours", "rhr_28day_avg": "resting_heart_rate"}
_LAGS = {
    "prev_day_sleep_hours": ("sleep_hours", 1),
    "prev_day_rhr": ("resting_heart_rate", 1),
    "prev_day_stress": ("stress_avg", 1),
    "prev_day_battery_change": ("body_battery_net", 1),
    "prev_week_sleep_hours": ("sleep_hours", 7),
    "prev_week_rhr": ("resting_heart_rate", 7),
}


@reusable
def _calendar_parts() -> dict[str, Column]:
    day = c("health_date")
    return {
        "day_name": D.day_name(c("day_of_week")),
        "week_start_date": D.week_start(day),
        "month_start_date": D.month_start(day),
    }


def calendar_parts(health: DataFrame) -> DataFrame:
    return health.withColumns(_calendar_parts())


@reusable
def _rolling(dealt: tuple[str, ...]) -> dict[str, Column]:
    week, four_weeks = (last_rows(_BY_DAY, n, dealt=dealt) for n in (7, 28))
    by_day = calendar_window(_BY_DAY, dealt=dealt)
    debt = F.lit(TARGET_SLEEP_HOURS) - c("sleep_hours")
    return {
        **{name: F.avg(source).over(week) for name, source in _MEANS_7.items()},
        **{name: F.avg(source).over(four_weeks) for name, source in _MEANS_28.items()},
        **{name: F.lag(source, n).over(by_day) for name, (source, n) in _LAGS.items()},
        "sleep_debt_7day_cumulative": F.sum(debt).over(week),
    }


def rolling(health: DataFrame, dealt: tuple[str, ...] = ()) -> DataFrame:
    """7- and 28-row means and lags, of days with their calendar parts. Frames count rows: a gap in the days
    reaches further back."""
    return health.withColumns(_rolling(dealt))


@reusable
def _changes() -> dict[str, Column]:
    sleep, rhr, stress = c("sleep_hours"), c("resting_heart_rate"), c("stress_avg")
    return {
        "sleep_change_vs_prev_day": sleep - c("prev_day_sleep_hours"),
        "rhr_change_vs_prev_day": rhr - c("prev_day_rhr"),
        "stress_change_vs_prev_day": stress - c("prev_day_stress"),
        "sleep_change_vs_prev_week": sleep - c("prev_week_sleep_hours"),
        "rhr_change_vs_prev_week": rhr - c("prev_week_rhr"),
        "sleep_vs_7day_avg": sleep - c("sleep_7day_avg"),
        "rhr_vs_7day_avg": rhr - c("rhr_7day_avg"),
        "stress_vs_7day_avg": stress - c("stress_7day_avg"),
    }


def changes(rolled: DataFrame) -> DataFrame:
    """Differences to the day before, to 7 rows ago and to the 7-row mean."""
    return rolled.withColumns(_changes())


@reusable
def _recovery() -> dict[str, Column]:
    readings = (
        c("sleep_hours"),
        c("resting_heart_rate"),
        c("rhr_7day_avg"),
        c("stress_avg"),
        c("body_battery_net"),
    )
    return {
        "recovery_score": H.trend_score(*readings),
        "training_readiness": H.trend_readiness(*readings),
        "sleep_debt_hours": rnd(F.lit(TARGET_SLEEP_HOURS) - c("sleep_hours"), 2),
    }


def recovery(changed: DataFrame) -> DataFrame:
    """Score and readiness against the athlete's own mean, and the night's sleep debt."""
    return changed.withColumns(_recovery())


@reusable
def _week_context(dealt: tuple[str, ...]) -> dict[str, Column]:
    week = whole("week_start_date", dealt=dealt)
    return {
        "week_avg_sleep": F.avg("sleep_hours").over(week),
        "week_avg_rhr": F.avg("resting_heart_rate").over(week),
        "week_avg_stress": F.avg("stress_avg").over(week),
        "week_total_steps": F.sum("steps").over(week),
    }


def week_context(days: DataFrame, dealt: tuple[str, ...] = ()) -> DataFrame:
    """Means and steps of the whole calendar week on each of its days."""
    return days.withColumns(_week_context(dealt))


@reusable
def _output() -> list[Column | str]:
    columns = """
        day_name week_start_date month_start_date
        sleep_hours deep_sleep_hours light_sleep_hours rem_sleep_hours awake_hours
        sleep_quality sleep_efficiency_pct sleep_debt_hours sleep_debt_7day_cumulative
        sleep_7day_avg sleep_28day_avg
        sleep_change_vs_prev_day sleep_change_vs_prev_week sleep_vs_7day_avg
        resting_heart_rate min_heart_rate max_heart_rate rhr_7day_avg rhr_28day_avg
        rhr_change_vs_prev_day rhr_change_vs_prev_week rhr_vs_7day_avg
        hrv_avg hrv_7day_avg hrv_status hrv_category
        stress_avg stress_category
        stress_7day_avg stress_change_vs_prev_day stress_vs_7day_avg
        body_battery_charged body_battery_drained body_battery_high body_battery_low
        body_battery_net body_battery_status
        steps daily_distance_km steps_7day_avg
        recovery_score training_readiness
        week_avg_sleep week_avg_rhr week_avg_stress week_total_steps
    """.split()
    names = {**_RENAMED, "hrv_avg": "hrv_numeric"}
    day = c("health_date").alias("date")
    return ["athlete_id", day, *[c(n).alias(names.get(n, n)) for n in columns]]


def mart_health(health: DataFrame, dealt: tuple[str, ...] = ()) -> DataFrame:
    """One row per athlete and day. All windows share one exchange and one sort.

    ``dealt`` names columns of ``health`` that depend on the athlete only and that its rows are dealt out by; they
    are kept at the end, and the rows come sorted by them and the athlete.
    """
    rolled = rolling(calendar_parts(health), dealt)
    return week_context(recovery(changes(rolled)), dealt).select(*_output(), *dealt)
