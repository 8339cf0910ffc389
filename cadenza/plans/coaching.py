"""Coaching context, alerts and prompt text: one row per athlete."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza import constants as K
from cadenza.functions import dates as D
from cadenza.functions import text as T
from cadenza.functions.numeric import first_match, rnd_agg
from cadenza.functions.reuse import reusable
from cadenza.operators.windows import newest_ranked

c = F.col
ATHLETE = "athlete_id"
_PR_NAMES = {
    "5K": "pr_5k_pace",
    "10K": "pr_10k_pace",
    "Half Marathon": "pr_half_pace",
    "Marathon": "pr_marathon_pace",
}


def _mean_where(keep: Column, column: str) -> Column:
    return F.avg(F.when(keep, c(column)))


@reusable
def _load_means() -> list[Column]:
    acute, chronic = c("rank") <= 4, c("rank") > 4
    zones = _mean_where(acute, "pct_zone1_easy") + _mean_where(acute, "pct_zone2_moderate")
    return [
        _mean_where(acute, "total_distance_km").alias("_km"),
        _mean_where(acute, "total_training_load").alias("_load"),
        F.coalesce(
            _mean_where(chronic, "total_training_load"), _mean_where(acute, "total_training_load")
        ).alias("_base"),
        F.max(F.when(c("rank") == 1, c("total_training_load"))).alias("_now"),
        _mean_where(acute, "avg_pace_min_per_km").alias("_pace"),
        zones.alias("_easy"),
    ]


@reusable
def _load_columns() -> list[Column]:
    trend = F.when(c("_base") > 0, (c("_load") - c("_base")) / c("_base") * 100)
    return [
        rnd_agg(c("_km"), 1).alias("avg_weekly_km"),
        rnd_agg(c("_load"), 1).alias("avg_weekly_load"),
        rnd_agg(F.coalesce(trend, F.lit(0.0)), 1).alias("load_trend_pct"),
        rnd_agg(
            F.coalesce(F.when(c("_load") > 0, c("_now") / c("_load")), F.lit(1.0)), 2
        ).alias("acwr"),
        rnd_agg(c("_pace"), 2).alias("avg_pace_min_per_km"),
        rnd_agg(c("_easy"), 1).alias("pct_easy"),
        rnd_agg(100.0 - c("_easy"), 1).alias("pct_hard"),
    ]


def load_context(training: DataFrame) -> DataFrame:
    """Newest 4 weeks against the 4 before: volume, load, pace, ACWR and zone split."""
    weeks = newest_ranked(training, 8, c("week_start_date").desc())
    return weeks.groupBy(ATHLETE).agg(*_load_means()).select(ATHLETE, *_load_columns())


@reusable
def _health_means() -> list[Column]:
    week = c("rank") <= 7
    label = F.when(week, c("training_readiness").try_cast("double"))
    return [
        _mean_where(week, "total_sleep_hours").alias("_sleep"),
        _mean_where(week, "hrv_numeric").alias("_hrv"),
        F.avg("hrv_numeric").alias("_hrv_28"),
        _mean_where(week, "resting_heart_rate").alias("_rhr"),
        _mean_where(week, "average_stress_level").alias("_stress"),
        _mean_where(week, "recovery_score").alias("_score"),
        F.avg(label).alias("_readiness"),
    ]


@reusable
def _health_columns() -> list[Column]:
    trend = F.when(c("_hrv_28") > 0, (c("_hrv") - c("_hrv_28")) / c("_hrv_28") * 100)
    return [
        rnd_agg(F.coalesce("_sleep", F.lit(0.0)), 1).alias("avg_sleep_hours"),
        rnd_agg(c("_hrv"), 1).alias("avg_hrv"),
        rnd_agg(trend, 1).alias("hrv_trend_pct"),
        rnd_agg(c("_rhr"), 0).alias("avg_resting_hr"),
        rnd_agg(c("_stress"), 0).alias("avg_stress"),
        rnd_agg(c("_score"), 0).alias("avg_recovery_score"),
        rnd_agg(c("_readiness"), 0).alias("avg_readiness"),
    ]


def health_context(health: DataFrame) -> DataFrame:
    """Means of the newest 7 days and the HRV trend against the newest 28.

    ``avg_readiness`` is the mean of a text label, which has no numbers: always null.
    """
    days = newest_ranked(health, 28, c("date").desc())
    return days.groupBy(ATHLETE).agg(*_health_means()).select(ATHLETE, *_health_columns())


def race_context(race: DataFrame) -> DataFrame:
    """Best pace per distance and the last race."""
    last = F.max(F.struct("race_number", "race_distance_category", "pace_min_per_km")).alias("_l")
    best = [
        F.min(F.when(c("race_distance_category") == label, c("pace_min_per_km"))).alias(name)
        for label, name in _PR_NAMES.items()
    ]
    return race.groupBy(ATHLETE).agg(last, *best).select(
        ATHLETE,
        c("_l.race_distance_category").alias("last_race_distance"),
        c("_l.pace_min_per_km").alias("last_race_pace_min_per_km"),
        *_PR_NAMES.values(),
    )


def goal_context(goals: DataFrame, as_of: dt.date) -> DataFrame:
    """Required pace and whole weeks left of a goal (distance, minutes, race date)."""
    km = first_match(
        [(c("goal_distance") == d, F.lit(x)) for d, x in K.GOAL_KM.items()],
        F.lit(K.GOAL_KM_DEFAULT),
    )
    left = F.floor(F.date_diff(c("race_date"), D.as_date(as_of)) / 7)
    return goals.select(
        ATHLETE,
        "goal_distance",
        "goal_time_minutes",
        rnd_agg(c("goal_time_minutes") / km, 2).alias("goal_pace_min_per_km"),
        F.greatest(F.lit(0), left).cast("int").alias("weeks_to_race"),
    )


def newest_goal(log: DataFrame) -> DataFrame:
    """The goal of each athlete's newest saved analysis."""
    fields = ("generated_at", "analysis_id", "goal_distance", "goal_hours", "goal_minutes", "race_date")
    last = log.groupBy(ATHLETE).agg(F.max(F.struct(*fields)).alias("_g"))
    return last.select(
        ATHLETE,
        "_g.goal_distance",
        (c("_g.goal_hours") * 60 + c("_g.goal_minutes")).cast("double").alias("goal_time_minutes"),
        "_g.race_date",
    )


def coaching_context(
    training: DataFrame, health: DataFrame, race: DataFrame, goals: DataFrame, as_of: dt.date
) -> DataFrame:
    """One wide row per athlete with a goal, training, health or a race. Missing history reads
    as the neutral value for loads and sleep, else as null; without a goal its columns are null."""
    parts = [
        goal_context(goals, as_of),
        load_context(training),
        health_context(health),
        race_context(race),
    ]
    joined = reduce(lambda a, b: a.join(b, ATHLETE, "full"), parts)
    return joined.fillna(
        {
            "avg_weekly_km": 0.0,
            "avg_weekly_load": 0.0,
            "load_trend_pct": 0.0,
            "acwr": 1.0,
            "pct_easy": 0.0,
            "pct_hard": 100.0,
            "avg_sleep_hours": 0.0,
        }
    )


# -- alerts -------------------------------------------------------------------------


def _alert(text: tuple[str, str, str], words: dict[str, Column]) -> Column:
    level, emoji, message = text
    return F.struct(
        F.lit(level).alias("level"),
        F.lit(emoji).alias("emoji"),
        T.fill(message, words).alias("message"),
    )


def _graded(name: str, tests: list[Column], words: dict[str, Column]) -> Column:
    """The first alert of a rule whose test holds, null when none does."""
    texts = K.ALERT_TEXTS[name]
    return first_match([(t, _alert(x, words)) for t, x in zip(tests, texts, strict=True)])


def load_alert() -> Column:
    acwr = c("acwr")
    words = {"acwr": T.fixed(acwr, 2), "acwr_pct": T.whole(acwr * 100)}
    return _graded("load", [acwr > limit for limit in K.ACWR_LIMITS], words)


def hrv_alert() -> Column:
    trend = c("hrv_trend_pct")
    words = {
        "trend": T.whole(trend),
        "drop": T.whole(F.abs(trend)),
        "hrv": T.whole(c("avg_hrv")),
    }
    return _graded("hrv", [trend < limit for limit in K.HRV_TREND_LIMITS], words)


def sleep_alert() -> Column:
    hours = c("avg_sleep_hours")
    words = {"hours": T.fixed(hours, 1)}
    return _graded("sleep", [hours < limit for limit in K.SLEEP_LIMITS], words)


def recovery_alert() -> Column:
    score = c("avg_recovery_score")
    return _graded("recovery", [score < K.RECOVERY_LIMIT], {"score": T.whole(score)})


def current_race_pace() -> Column:
    """Best pace at the goal distance, else the last race's pace."""
    best = first_match(
        [(c("goal_distance") == label, c(name)) for label, name in _PR_NAMES.items()]
    )
    return F.coalesce(F.nullif(best, F.lit(0.0)), c("last_race_pace_min_per_km"))


def goal_alert() -> Column:
    now, goal = current_race_pace(), c("goal_pace_min_per_km")
    gap = (goal - now) / F.nullif(now, F.lit(0.0)) * 100
    words = {
        "distance": c("goal_distance"),
        "now": T.pace_uncarried(now),
        "goal": T.pace_uncarried(goal),
        "gap": T.fixed(F.abs(gap), 0),
    }
    return _graded("goal_gap", [gap < K.GOAL_GAP_LIMIT], words)


ALERTS = {
    "load": load_alert,
    "hrv": hrv_alert,
    "sleep": sleep_alert,
    "recovery": recovery_alert,
    "goal_gap": goal_alert,
}


def alert(context: DataFrame, name: str) -> DataFrame:
    """One rule: athletes that trigger it."""
    return (
        context.withColumn("_a", ALERTS[name]())
        .filter(c("_a").isNotNull())
        .select(ATHLETE, "_a.level", "_a.emoji", "_a.message")
    )


@reusable
def _raised() -> Column:
    raised = F.array_compact(F.array(*[rule() for rule in ALERTS.values()]))
    red = F.filter(raised, lambda a: a["level"] == "red")
    rest = F.filter(raised, lambda a: a["level"] != "red")
    return F.posexplode(F.concat(red, rest)).alias("position", "a")


def alerts(context: DataFrame) -> DataFrame:
    """All alerts, red before yellow, each in rule order."""
    listed = context.select(ATHLETE, _raised())
    return listed.select(ATHLETE, "position", "a.level", "a.emoji", "a.message").orderBy(
        ATHLETE, "position"
    )


# -- prompt -------------------------------------------------------------------------


def _known(x: Column, unit: str = "") -> Column:
    return F.coalesce(F.concat(x.cast("string"), F.lit(unit)), F.lit(K.NOT_KNOWN))


def _known_pace(x: Column) -> Column:
    return F.coalesce(T.pace_uncarried(x), F.lit(K.NOT_KNOWN))


def _signed(x: Column) -> Column:
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit("+"))
    return F.concat(sign, T.whole(F.abs(x)))


@reusable
def _prompt() -> Column:
    minutes, pace = c("goal_time_minutes"), c("avg_pace_min_per_km")
    words = {
        "weekly_km": c("avg_weekly_km").cast("string"),
        "weekly_load": c("avg_weekly_load").cast("string"),
        "load_trend": _signed(c("load_trend_pct")),
        "acwr": c("acwr").cast("string"),
        "pace": _known_pace(F.when(pace > 0, pace)),
        "easy": T.whole(c("pct_easy")),
        "hard": T.whole(c("pct_hard")),
        "sleep": c("avg_sleep_hours").cast("string"),
        "hrv": _known(c("avg_hrv"), "ms"),
        "hrv_trend": _known(c("hrv_trend_pct"), "%"),
        "resting_hr": _known(c("avg_resting_hr"), " bpm"),
        "stress": _known(c("avg_stress"), "/100"),
        "recovery": _known(c("avg_recovery_score"), "/100"),
        "readiness": _known(c("avg_readiness"), "/100"),
        "last_distance": _known(c("last_race_distance")),
        "last_pace": _known_pace(c("last_race_pace_min_per_km")),
        "pr_5k": _known_pace(c("pr_5k_pace")),
        "pr_10k": _known_pace(c("pr_10k_pace")),
        "pr_half": _known_pace(c("pr_half_pace")),
        "pr_marathon": _known_pace(c("pr_marathon_pace")),
        "goal": _known(c("goal_distance")),
        "goal_hours": _known(F.floor(minutes / 60)),
        "goal_minutes": _known(T.two_digits(F.floor(minutes % 60))),
        "goal_pace": _known_pace(c("goal_pace_min_per_km")),
        "weeks": _known(c("weeks_to_race")),
    }
    return T.fill("\n".join(K.PROMPT_LINES), words)


def prompt_text(context: DataFrame, weather: DataFrame | None = None) -> DataFrame:
    """The context as one labelled text per athlete, ``N/A`` for what is missing.

    ``weather`` (athlete_id, weather_text) adds a block after two blank lines.
    """
    text = _prompt()
    if weather is not None:
        context = context.join(weather, ATHLETE, "left")
        block = F.concat(F.lit("\n\n\n"), c("weather_text"))
        text = F.concat(text, F.coalesce(block, F.lit("")))
    return context.select(ATHLETE, text.alias("prompt"))
