"""Race results per athlete: records, training before the race, goals and trends.

An athlete may hold a very large share of all activities, so nothing here puts one
athlete's activities into one task. Activities are first summed per (athlete, day); that
table has at most one row per calendar day and carries everything a race reads from
other days: the last race, running counts, the 30 days of training before. Races get it
back by a join on (athlete, day).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions import dates as D
from cadenza.functions import race as R
from cadenza.functions.numeric import or_zero, rnd, rnd_agg, rnd_agg_pos, rnd_pos
from cadenza.functions.reuse import reusable
from cadenza.operators.windows import calendar_window

c = F.col

DAY = ["athlete_id", "race_date"]
CATEGORY = ["athlete_id", "race_distance_category"]
# Races outside the distance bands follow each other too. Under a name of their own they
# join by plain equality, which keeps the partitioning of the windows before the join.
DISTANCE = ["athlete_id", "_distance"]
UNGRADED = "ungraded"
LOOK_BACK_DAYS = 30


@reusable
def _race_columns() -> list[Column | str]:
    day = c("activity_date")
    return [
        "athlete_id",
        c("activity_id").alias("race_id"),
        day.alias("race_date"),
        F.year(day).alias("race_year"),
        F.month(day).alias("race_month"),
        F.quarter(day).alias("race_quarter"),
        D.season(day).alias("race_season"),
        "race_distance_category",
        "distance_km",
        (c("distance_km") * 1000).alias("distance_meters"),
        "duration_minutes",
        c("avg_pace_min_km").alias("pace_min_per_km"),
        c("avg_heart_rate").alias("avg_heart_rate_bpm"),
        c("max_heart_rate").alias("max_heart_rate_bpm"),
        "elevation_gain_m",
        "training_load",
        "effort_level",
    ]


def races(activities: DataFrame) -> DataFrame:
    """Race activities with calendar parts."""
    return activities.filter("is_race").select(*_race_columns())


@reusable
def _day_totals() -> list[Column]:
    training, pace = ~c("is_race"), c("avg_pace_min_km")
    return [
        F.count(F.when(c("is_race"), 1)).alias("races"),
        F.count(F.when(training, 1)).alias("runs"),
        F.sum(F.when(training, c("distance_km"))).alias("km"),
        F.sum(F.when(training, pace)).alias("pace_sum"),
        F.count(F.when(training, pace)).alias("pace_count"),
    ]


def day_totals(activities: DataFrame, tasks: tuple[int, ...] = ()) -> DataFrame:
    """Races and training of each athlete and day, shuffled to so many ``tasks`` if given."""
    day = c("activity_date").alias("race_date")
    dealt = activities.repartition(*tasks, "athlete_id", "activity_date") if tasks else activities
    return dealt.groupBy("athlete_id", day).agg(*_day_totals())


@reusable
def _days_before() -> dict[str, Column]:
    by_day = calendar_window("_day")
    earlier = by_day.rowsBetween(Window.unboundedPreceding, -1)
    in_year = calendar_window("_day", "_year").rowsBetween(Window.unboundedPreceding, -1)
    month = by_day.rangeBetween(-LOOK_BACK_DAYS, -1)
    race_day = F.when(c("races") > 0, c("race_date"))
    return {
        "prev_race_date": F.max(race_day).over(earlier),
        "races_before": or_zero(F.sum("races").over(earlier)),
        "races_before_in_year": or_zero(F.sum("races").over(in_year)),
        "_pace_sum": F.sum("pace_sum").over(month),
        "_pace_count": F.sum("pace_count").over(month),
        "total_training_distance_30d": F.sum("km").over(month),
        "matched_runs_30d": or_zero(F.sum("runs").over(month)),
    }


@reusable
def _context_columns() -> list[Column | str]:
    mean_pace = c("_pace_sum") / F.nullif(c("_pace_count"), F.lit(0))
    runs = c("matched_runs_30d")
    return [
        *DAY,
        "prev_race_date",
        "races_before",
        "races_before_in_year",
        mean_pace.alias("avg_training_pace_30d"),
        "total_training_distance_30d",
        F.greatest(runs, F.lit(1).cast("bigint")).alias("training_runs_30d"),
        runs,
    ]


def day_context(activities: DataFrame, tasks: tuple[int, ...] = ()) -> DataFrame:
    """What a race day knows of the days before it.

    Training is every activity type that is no race, from 30 days before up to the day
    before. A race without any still counts one run, as a left join's empty row does.
    Activities and days are shuffled to so many ``tasks`` if given.
    """
    day, totals = c("race_date"), day_totals(activities, tasks)
    totals = totals.repartition(*tasks, "athlete_id") if tasks else totals
    totals = totals.withColumns({"_day": D.day_number(day), "_year": F.year(day)})
    return totals.withColumns(_days_before()).filter("races > 0").select(*_context_columns())


@reusable
def _numbering() -> dict[str, Column]:
    nth = c("_nth")
    gap = F.date_diff(c("race_date"), c("prev_race_date"))
    return {
        "days_since_last_race": F.when(nth > 1, F.lit(0)).otherwise(gap),
        "race_number": c("races_before") + nth,
        "race_number_this_year": c("races_before_in_year") + nth,
    }


def with_day_context(race: DataFrame, context: DataFrame) -> DataFrame:
    """Races numbered, with days since the last race and the training before."""
    nth = F.row_number().over(Window.partitionBy(*DAY).orderBy("race_id"))
    joined = race.withColumn("_nth", nth).join(context, DAY, "left").withColumns(_numbering())
    return joined.drop("_nth", "prev_race_date", "races_before", "races_before_in_year")


@reusable
def _distance_name() -> Column:
    return F.coalesce("race_distance_category", F.lit(UNGRADED))


@reusable
def _distance_day() -> tuple[Column, list[Column], list[Column | str]]:
    """Rank from the day's end, the day's aggregates, and the columns over days."""
    in_day = Window.partitionBy(*DISTANCE, "race_date").orderBy(c("race_id").desc())
    pace, from_end = c("pace_min_per_km"), c("_from_end")
    totals = [
        F.min("duration_minutes").alias("_minutes"),
        F.min(pace).alias("_pace"),
        F.max(F.when(from_end == 1, pace)).alias("_last_1"),
        F.max(F.when(from_end == 2, pace)).alias("_last_2"),
        F.count("*").alias("_races"),
    ]
    by_day = Window.partitionBy(*DISTANCE).orderBy("race_date")
    at_distance = Window.partitionBy(*DISTANCE)
    graded = c("_distance") != UNGRADED
    before_2 = F.when(
        F.lag("_races", 1).over(by_day) > 1, F.lag("_last_2", 1).over(by_day)
    ).otherwise(F.lag("_last_1", 2).over(by_day))
    over_days = [
        *DISTANCE,
        "race_date",
        F.when(graded, F.min("_minutes").over(at_distance)).alias("pr_duration_minutes"),
        F.when(graded, F.min("_pace").over(at_distance)).alias("pr_pace_min_per_km"),
        F.lag("_last_1", 1).over(by_day).alias("_before_day_1"),
        before_2.alias("_before_day_2"),
    ]
    return F.row_number().over(in_day).alias("_from_end"), totals, over_days


def distance_days(race: DataFrame) -> DataFrame:
    """What a race day knows of its distance: the record, and the two races before it.

    One row per (athlete, distance, day). Races are ordered inside their day first; the
    windows over one athlete then run on this day table.
    """
    from_end, totals, over_days = _distance_day()
    named = race.withColumn("_distance", _distance_name())
    placed = named.select(
        *DISTANCE, "race_date", "duration_minutes", "pace_min_per_km", from_end
    )
    return placed.groupBy(*DISTANCE, "race_date").agg(*totals).select(*over_days)


def personal_records(race: DataFrame) -> DataFrame:
    """Best duration and pace per athlete and distance."""
    return (
        race.filter(c("race_distance_category").isNotNull())
        .groupBy(*CATEGORY)
        .agg(
            F.min("duration_minutes").alias("pr_duration_minutes"),
            F.min("pace_min_per_km").alias("pr_pace_min_per_km"),
        )
    )


@reusable
def _places() -> dict[str, Column]:
    in_day = Window.partitionBy(*DISTANCE, "race_date").orderBy("race_id")
    return {
        "_nth": F.row_number().over(in_day),
        "_lag_1": F.lag("pace_min_per_km", 1).over(in_day),
        "_lag_2": F.lag("pace_min_per_km", 2).over(in_day),
    }


@reusable
def _history() -> dict[str, Column]:
    nth, pace = c("_nth"), c("pace_min_per_km")
    minutes, best = c("duration_minutes"), c("pr_duration_minutes")
    before_1 = F.when(nth > 1, c("_lag_1")).otherwise(c("_before_day_1"))
    before_2 = (
        F.when(nth > 2, c("_lag_2"))
        .when(nth == 2, c("_before_day_1"))
        .otherwise(c("_before_day_2"))
    )
    three = [pace, before_1, before_2]
    total = sum((F.coalesce(p, F.lit(0.0)) for p in three), F.lit(0.0))
    known = sum((F.when(p.isNotNull(), 1).otherwise(0) for p in three), F.lit(0))
    return {
        "is_personal_record": F.coalesce(minutes == best, F.lit(False)),
        "minutes_off_pr": minutes - best,
        "pct_off_pr": F.when(best > 0, rnd_pos((minutes - best) / best * 100, 1)),
        "pace_ma_3_races": total / F.nullif(known, F.lit(0)),
        "pace_change_vs_last_race": pace - before_1,
    }


def with_distance_history(race: DataFrame, days: DataFrame) -> DataFrame:
    """Races with the record at their distance and the trend over the races before.

    Races without a category have no record, but they do follow each other.
    """
    named = race.withColumn("_distance", _distance_name()).withColumns(_places())
    joined = named.join(days, [*DISTANCE, "race_date"], "left")
    traced = joined.withColumns(_history())
    return traced.drop(
        "_distance", "_nth", "_lag_1", "_lag_2", "_before_day_1", "_before_day_2"
    )


@reusable
def _goal_gap() -> dict[str, Column]:
    minutes, goal = c("duration_minutes"), c("goal_time_seconds")
    return {
        "seconds_vs_goal": rnd(minutes * 60 - goal, 0),
        "goal_achievement": R.goal_outcome(minutes, goal),
    }


def with_goals(race: DataFrame, goals: DataFrame) -> DataFrame:
    """Races with the goal of their day, if any."""
    slim = goals.selectExpr(
        *DAY,
        "race_name AS goal_race_name",
        "goal_time_seconds",
        "goal_time_formatted AS goal_time_formatted_target",
        "notes AS goal_notes",
    )
    return race.join(slim, DAY, "left").withColumns(_goal_gap())


def days_since_record(recorded: DataFrame) -> DataFrame:
    """Days since the first race of the same distance and record state.

    The first date is an aggregate per day, spread over the days by a window over the
    day table.
    """
    keys = [*CATEGORY, "is_personal_record"]
    days = recorded.select(*keys, "race_date").distinct()
    first = days.withColumn("_first", F.min("race_date").over(Window.partitionBy(*keys)))
    on = [c(f"r.{k}").eqNullSafe(c(f"f.{k}")) for k in (*keys, "race_date")]
    return recorded.alias("r").join(first.alias("f"), on, "left").select(
        "r.*", F.date_diff(c("r.race_date"), c("f._first")).alias("days_since_pr")
    )


@reusable
def _measures() -> dict[str, Column]:
    km, rest = c("total_training_distance_30d"), c("days_since_last_race")
    diff = c("pace_min_per_km") - c("avg_training_pace_30d")
    return {
        "race_vs_training_pace_diff": rnd_agg(diff, 2),
        "race_readiness_score": R.readiness_score(rnd_agg_pos(km, 6), rest),
        "finish_time_formatted": R.finish_time(c("duration_minutes")),
    }


@reusable
def _output() -> list[Column | str]:
    out = {
        "race_distance_category": c("race_distance_category"),
        "distance_km": rnd_pos(c("distance_km"), 2),
        "distance_meters": rnd_pos(c("distance_meters"), 0),
        "duration_minutes": rnd_pos(c("duration_minutes"), 1),
        "finish_time_formatted": c("finish_time_formatted"),
        "pace_min_per_km": rnd_pos(c("pace_min_per_km"), 2),
        "avg_heart_rate_bpm": c("avg_heart_rate_bpm").cast("double"),
        "max_heart_rate_bpm": c("max_heart_rate_bpm"),
        "elevation_gain_m": rnd_pos(c("elevation_gain_m"), 0),
        "training_load": rnd_pos(c("training_load"), 1),
        "effort_level": c("effort_level"),
        "is_personal_record": c("is_personal_record"),
        "pr_duration_minutes": rnd_pos(c("pr_duration_minutes"), 1),
        "pr_pace_min_per_km": rnd_pos(c("pr_pace_min_per_km"), 2),
        "minutes_off_pr": rnd_pos(c("minutes_off_pr"), 1),
        "pct_off_pr": c("pct_off_pr"),
        "avg_training_pace_30d": rnd_agg_pos(c("avg_training_pace_30d"), 2),
        "total_training_distance_30d": rnd_agg_pos(c("total_training_distance_30d"), 1),
        "training_runs_30d": c("training_runs_30d"),
        "race_vs_training_pace_diff": c("race_vs_training_pace_diff"),
        "race_readiness_score": c("race_readiness_score"),
        "days_since_last_race": c("days_since_last_race"),
        "goal_race_name": c("goal_race_name"),
        "goal_time_formatted_target": c("goal_time_formatted_target"),
        "goal_time_seconds": c("goal_time_seconds"),
        "seconds_vs_goal": c("seconds_vs_goal"),
        "goal_achievement": c("goal_achievement"),
        "goal_notes": c("goal_notes"),
        "pace_ma_3_races": rnd_agg_pos(c("pace_ma_3_races"), 2),
        "pace_change_vs_last_race": rnd_agg(c("pace_change_vs_last_race"), 2),
        "performance_rating": R.rating(c("is_personal_record"), c("pct_off_pr")),
        "pacing_assessment": R.pacing(c("race_vs_training_pace_diff")),
        "recovery_status": R.recovery_status(c("days_since_last_race")),
    }
    names = "race_year race_month race_quarter race_season race_number race_number_this_year"
    return [
        "athlete_id",
        "race_id",
        "race_date",
        *names.split(),
        *[e.alias(n) for n, e in out.items()],
    ]


def mart_race(activities: DataFrame, goals: DataFrame, tasks: tuple[int, ...] = ()) -> DataFrame:
    """One row per race. Takes staged or unified activities, as the weekly mart does.

    ``tasks`` is the number of tasks for all activities and their days, where the session's own is not enough.
    """
    race = races(activities)
    history = with_distance_history(race, distance_days(race))
    known = with_goals(with_day_context(history, day_context(activities, tasks)), goals)
    return known.withColumns(_measures()).select(*_output())
