"""Page analyses as jobs for all athletes at once."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza import constants as K
from cadenza.functions import activity as A
from cadenza.functions import dates as D
from cadenza.functions import text as T
from cadenza.functions import weather as W
from cadenza.functions.numeric import band, first_match, rnd, rnd_agg, rnd_pos
from cadenza.operators.windows import newest, newest_ranked

c = F.col
ATHLETE = "athlete_id"


# -- activities and weather ---------------------------------------------------------


def weather_activities(raw: DataFrame) -> DataFrame:
    """Raw activities with a weather reading, pace repaired, wind in km/h."""
    known = raw.filter(
        c("weather_temp_c").isNotNull()
        & (c("distance_km") > 0)
        & (c("duration_minutes") >= K.MIN_DURATION_MINUTES)
    )
    return known.select(
        ATHLETE,
        "activity_id",
        "activity_name",
        F.to_date("activity_date").alias("activity_date"),
        c("activity_date").alias("started_at"),
        "activity_type",
        "distance_km",
        "duration_minutes",
        A.repaired_pace(c("avg_pace_min_km"), c("distance_km"), c("duration_minutes")).alias(
            "avg_pace_min_km"
        ),
        "avg_heart_rate",
        rnd(c("weather_temp_c"), 1).alias("temp_c"),
        c("weather_temp_c").alias("temp_raw"),
        c("weather_humidity_pct").alias("humidity_pct"),
        rnd_pos(c("weather_wind_speed_ms") * 3.6, 1).alias("wind_kmh"),
        "weather_condition",
        c("weather_precipitation_mm").alias("precipitation_mm"),
    )


def recent_activities(activities: DataFrame, n: int = 10) -> DataFrame:
    """The newest ``n`` activities per athlete, pace from time and distance."""
    km = c("distance_km")
    return newest(
        activities.select(
            ATHLETE,
            "activity_id",
            "activity_date",
            "activity_name",
            "activity_type",
            "distance_km",
            "duration_minutes",
            F.when(km > 0, rnd_pos(c("duration_minutes") / km, 3)).alias("pace_min_km"),
            "avg_heart_rate",
            "elevation_gain_m",
            "training_load",
            "pace_zone",
        ),
        n,
        c("activity_date").desc(),
        c("activity_id").desc(),
        spread_by="activity_id",
    )


def recent_with_weather(recent: DataFrame, weather: DataFrame) -> DataFrame:
    """Recent activities with the newest weather reading of their day, looked up for those days only."""
    days = recent.select(ATHLETE, "activity_date").distinct()
    one_per_day = weather.join(days, [ATHLETE, "activity_date"], "left_semi").groupBy(ATHLETE, "activity_date").agg(
        F.max_by(
            F.struct("temp_c", "weather_condition"), F.struct("started_at", "activity_id")
        ).alias("_w")
    )
    joined = recent.join(one_per_day, [ATHLETE, "activity_date"], "left")
    return joined.withColumns(
        {"temp_c": c("_w.temp_c"), "weather_condition": c("_w.weather_condition")}
    ).drop("_w")


def filter_types(activities: DataFrame, types: list[str]) -> DataFrame:
    """Activities of the given types (any case; none given keeps all), with labels."""
    if types:
        activities = activities.filter(
            F.lower("activity_type").isin([t.lower() for t in types])
        )
    return activities.withColumn("type_label", A.type_label(c("activity_type")))


def weather_labels(raw: DataFrame) -> DataFrame:
    return raw.select(
        ATHLETE,
        "activity_id",
        "weather_condition",
        W.condition_label(c("weather_condition")).alias("weather_label"),
    )


def run_details(activities: DataFrame) -> DataFrame:
    """Running activities for the scatter of time against distance."""
    runs = activities.filter(c("activity_type") == "running")
    pace = A.repaired_pace(c("avg_pace_min_km"), c("distance_km"), c("duration_minutes"))
    return (
        runs.withColumn("avg_pace_min_km", pace)
        .select(
            ATHLETE,
            "activity_id",
            "activity_name",
            "activity_date",
            "event_type",
            "distance_km",
            "duration_minutes",
            "moving_duration_minutes",
            "avg_pace_min_km",
            "avg_speed_kmh",
            "avg_heart_rate",
            "max_heart_rate",
            "elevation_gain_m",
            "elevation_loss_m",
            "calories",
            "training_load",
            "effort_level",
            "pace_zone",
            "hr_zone",
            "is_race",
            "race_distance_category",
            "terrain_type",
            "time_of_day",
            "is_weekend",
            "has_data_quality_issues",
            "has_unrealistic_pace",
        )
        .dropna(subset=["distance_km", "duration_minutes"])
    )


def running_weather(weather: DataFrame, period: str, as_of: dt.date) -> DataFrame:
    inside = D.in_period(c("activity_date"), period, as_of)
    return weather.filter(inside & (c("activity_type") == "running"))


def weather_kpis(weather: DataFrame) -> DataFrame:
    return weather.groupBy(ATHLETE).agg(
        F.avg("temp_c").alias("avg_temp"),
        F.avg("humidity_pct").alias("avg_humidity"),
        F.avg("wind_kmh").alias("avg_wind"),
        F.count("*").alias("n_runs"),
    )


def temp_pace_trend(weather: DataFrame) -> DataFrame:
    """Least-squares line of pace on temperature, with its two end points."""
    clean = weather.dropna(subset=["temp_c", "avg_pace_min_km"])
    x, y = "temp_c", "avg_pace_min_km"
    lines = clean.groupBy(ATHLETE).agg(
        F.count("*").alias("n_runs"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.min(x).alias("temp_min"),
        F.max(x).alias("temp_max"),
    )
    return lines.filter("n_runs >= 3").withColumns(
        {
            "pace_at_min": c("slope") * c("temp_min") + c("intercept"),
            "pace_at_max": c("slope") * c("temp_max") + c("intercept"),
        }
    )


# -- calendar -----------------------------------------------------------------------


def calendar_listing(calendar: DataFrame) -> DataFrame:
    return calendar.select(
        ATHLETE,
        "event_uuid",
        "title",
        "event_date",
        "location",
        "distance_km",
        "race_distance_category",
        "is_upcoming",
        "days_until_race",
        "race_season",
        "start_time",
        "url",
    ).orderBy("event_date", ATHLETE, "event_uuid")


def next_races(calendar: DataFrame, n: int = 4) -> DataFrame:
    """The next ``n`` races per athlete with urgency and countdown."""
    days = c("days_until_race")
    upcoming = newest_ranked(
        calendar.filter("is_upcoming"),
        n,
        c("event_date"),
        c("event_uuid"),
        spread_by="event_uuid",
    )
    plural = F.when(days == 1, F.lit("")).otherwise(F.lit("s"))
    return upcoming.select(
        ATHLETE,
        "rank",
        "event_uuid",
        F.coalesce(F.nullif("title", F.lit("")), F.lit("Race")).alias("title"),
        "event_date",
        F.coalesce("race_distance_category", F.lit("")).alias("race_distance_category"),
        F.coalesce("location", F.lit("")).alias("location"),
        "days_until_race",
        first_match(
            [(days <= 14, F.lit("urgent")), (days <= 30, F.lit("soon"))], F.lit("later")
        ).alias("urgency"),
        F.when(days == 0, F.lit("TODAY"))
        .otherwise(F.concat(F.lit("In "), days.cast("string"), F.lit(" day"), plural))
        .alias("countdown"),
    )


def upcoming_with_goals(calendar: DataFrame, goals: DataFrame) -> DataFrame:
    """Upcoming events with the goal of their date."""
    slim = goals.select(
        ATHLETE,
        c("race_date").alias("event_date"),
        c("race_name").alias("goal_name"),
        c("race_distance_category").alias("goal_dist_cat"),
        c("goal_time_formatted").alias("goal_time"),
        c("notes").alias("goal_notes"),
    )
    events = calendar.filter("is_upcoming").select(ATHLETE, "event_uuid", "title", "event_date")
    return events.join(slim, [ATHLETE, "event_date"], "left")


# -- weekly training ----------------------------------------------------------------


def all_time(training: DataFrame, race: DataFrame) -> DataFrame:
    totals = training.groupBy(ATHLETE).agg(
        F.sum("total_distance_km").alias("total_km"),
        F.sum("total_activities").alias("total_runs"),
        (F.sum("total_duration_minutes") / 60).alias("total_hours"),
    )
    races = race.groupBy(ATHLETE).agg(F.count("*").alias("total_races"))
    joined = totals.join(races, ATHLETE, "full")
    return joined.select(
        ATHLETE,
        F.coalesce("total_km", F.lit(0.0)).alias("total_km"),
        F.coalesce("total_runs", F.lit(0)).alias("total_runs"),
        F.coalesce("total_hours", F.lit(0.0)).alias("total_hours"),
        F.coalesce("total_races", F.lit(0)).alias("total_races"),
    )


def latest_and_previous(training: DataFrame, weeks: int = 4) -> DataFrame:
    """Last and second-last known value of weekly measures within the last weeks.

    At most ``weeks`` values per athlete are gathered.
    """
    recent = newest(training, weeks, c("week_start_date").desc())
    measures = {
        "distance": "total_distance_km",
        "duration": "total_duration_minutes",
        "load": "total_training_load",
        "heart_rate": "avg_heart_rate_bpm",
    }

    def known(column: str) -> Column:
        """Known values, newest first."""
        pair = F.struct("week_start_date", c(column).alias("v"))
        return F.sort_array(F.collect_list(F.when(c(column).isNotNull(), pair)), asc=False)["v"]

    gathered = recent.groupBy(ATHLETE).agg(*[known(m).alias(n) for n, m in measures.items()])
    out = {f"current_{n}": F.get(n, F.lit(0)) for n in measures}
    for n in ("distance", "load"):
        out[f"previous_{n}"] = F.get(n, F.lit(1))
        out[f"{n}_delta"] = F.get(n, F.lit(0)) - F.get(n, F.lit(1))
    return gathered.select(ATHLETE, *[e.alias(n) for n, e in out.items()])


def last_n(df: DataFrame, order: str, n: int, plotted: str) -> DataFrame:
    """The newest ``n`` rows per athlete; then rows without the plotted value go."""
    return newest(df, n, c(order).desc()).filter(c(plotted).isNotNull())


def period(df: DataFrame, column: str, name: str, as_of: dt.date, custom=None) -> DataFrame:
    return df.filter(D.in_period(c(column), name, as_of, custom))


def period_totals(weeks: DataFrame) -> DataFrame:
    """Totals of weekly rows that carry ``total_runs`` and ``total_duration_hours``."""
    return weeks.groupBy(ATHLETE).agg(
        F.sum("total_runs").alias("total_runs"),
        F.sum("total_distance_km").alias("total_distance"),
        F.sum("total_duration_hours").alias("total_hours"),
        F.avg("total_distance_km").alias("avg_weekly_distance"),
        F.sum("total_training_load").alias("total_load"),
    )


def half_over_half(weeks: DataFrame) -> DataFrame:
    """Mean of the second half of the weeks against the first, in percent."""
    by_week = Window.partitionBy(ATHLETE).orderBy("week_start_date")
    placed = weeks.select(
        ATHLETE,
        "total_distance_km",
        "total_training_load",
        F.row_number().over(by_week).alias("_nth"),
        F.count("*").over(Window.partitionBy(ATHLETE)).alias("_n"),
    )
    early = c("_nth") <= F.floor(c("_n") / 2)

    def delta(column: str) -> Column:
        first = F.avg(F.when(early, c(column)))
        second = F.avg(F.when(~early, c(column)))
        return F.when(first > 0, (second - first) / first * 100).otherwise(F.lit(0.0))

    return placed.groupBy(ATHLETE).agg(
        F.count("*").alias("weeks"),
        delta("total_distance_km").alias("distance_delta_pct"),
        delta("total_training_load").alias("load_delta_pct"),
    )


def zone_profile(weeks: DataFrame) -> DataFrame:
    """Mean zone shares, the easy share and its verdict."""
    zones = [
        "pct_zone1_easy",
        "pct_zone2_moderate",
        "pct_zone3_tempo",
        "pct_zone4_threshold",
        "pct_zone5_max",
    ]
    means = weeks.groupBy(ATHLETE).agg(*[F.avg(z).alias(z) for z in zones])
    easy = c("pct_zone1_easy") + c("pct_zone2_moderate")
    return means.withColumn("easy_pct", easy).withColumn(
        "verdict",
        first_match(
            [
                (rnd_agg(easy, 6) >= 70, F.lit("great aerobic base")),
                (rnd_agg(easy, 6) >= 50, F.lit("consider slowing down")),
            ],
            F.lit("injury risk if sustained"),
        ),
    )


def week_overall(training: DataFrame) -> DataFrame:
    """Totals, weekly means and the peak week. Of equal weeks the newest counts."""
    km = c("total_distance_km")
    peak = F.max(
        F.struct(
            rnd_agg(km, 6).alias("km"), "week_start_date", "week_label", "total_activities"
        )
    )
    return (
        training.groupBy(ATHLETE)
        .agg(
            F.count("*").alias("weeks"),
            F.sum("total_activities").alias("total_activities"),
            F.sum(km).alias("total_distance_km"),
            F.sum("total_duration_minutes").alias("total_duration_minutes"),
            (F.sum("total_duration_minutes") / 60).alias("total_hours"),
            F.avg(km).alias("avg_weekly_km"),
            F.avg("total_activities").alias("avg_weekly_activities"),
            F.avg("total_training_load").alias("avg_weekly_load"),
            peak.alias("_peak"),
        )
        .withColumns(
            {
                "peak_week": c("_peak.week_label"),
                "peak_km": c("_peak.km"),
                "peak_activities": c("_peak.total_activities"),
            }
        )
        .drop("_peak")
    )


# -- races --------------------------------------------------------------------------


def race_highlights(race: DataFrame) -> DataFrame:
    def best(category: str) -> Column:
        at = c("race_distance_category") == category
        return F.min(F.when(at, c("pace_min_per_km")))

    return race.groupBy(ATHLETE).agg(
        F.count("*").alias("total_races"),
        F.max(F.when(c("is_personal_record"), c("race_date"))).alias("last_pr_date"),
        best("10K").alias("best_10k_pace"),
        best("Half Marathon").alias("best_half_pace"),
    )


def filter_races(
    race: DataFrame, distances: list[str] | None = None, years: list[int] | None = None
) -> DataFrame:
    if distances:
        race = race.filter(c("race_distance_category").isin(distances))
    if years:
        race = race.filter(c("race_year").isin(years))
    return race


def race_years(race: DataFrame) -> DataFrame:
    """Years with a race, newest first."""
    return race.select(ATHLETE, "race_year").distinct().orderBy(ATHLETE, c("race_year").desc())


def race_kpis(race: DataFrame) -> DataFrame:
    """Counts and the most frequent rating (first by name on equal counts).

    Counted per rating first, so the second step sees a handful of rows per athlete.
    """
    per_rating = race.groupBy(ATHLETE, "performance_rating").agg(
        F.count("*").alias("n"),
        F.count_if("is_personal_record").alias("prs"),
        F.min(
            F.when(c("race_distance_category") == "10K", c("pace_min_per_km"))
        ).alias("best_10k"),
        F.collect_set("race_distance_category").alias("distances"),
    )
    order = F.struct((-c("n")).alias("few"), c("performance_rating").alias("rating"))
    return (
        per_rating.groupBy(ATHLETE)
        .agg(
            F.sum("n").alias("total_races"),
            F.sum("prs").alias("total_prs"),
            F.size(F.array_distinct(F.flatten(F.collect_list("distances")))).alias(
                "distances_run"
            ),
            F.min(order).alias("_top"),
            F.min("best_10k").alias("best_10k_pace"),
        )
        .withColumn("top_rating", c("_top.rating"))
        .drop("_top")
    )


def race_history(race: DataFrame) -> DataFrame:
    """Display rows of all races, newest first."""
    off = c("pct_off_pr")
    return race.select(
        ATHLETE,
        "race_id",
        F.date_format("race_date", "MMM dd, yyyy").alias("date_text"),
        c("race_distance_category").alias("distance"),
        "distance_km",
        "finish_time_formatted",
        "pace_min_per_km",
        "avg_heart_rate_bpm",
        "performance_rating",
        F.when(c("is_personal_record"), F.lit("🥇")).otherwise(F.lit("")).alias("pr_mark"),
        F.when(off > 0, F.concat(F.lit("+"), T.fixed(off, 1), F.lit("%")))
        .when(off.isNotNull(), F.lit("PR"))
        .otherwise(F.lit("—"))
        .alias("pct_off_pr_text"),
        "race_readiness_score",
        "recovery_status",
        "race_date",
    ).orderBy(c("race_date").desc(), ATHLETE, "race_id")


def pr_lines(race: DataFrame) -> DataFrame:
    """Best pace per distance over the races with both."""
    return (
        race.dropna(subset=["race_distance_category", "pace_min_per_km"])
        .groupBy(ATHLETE, "race_distance_category")
        .agg(F.min("pace_min_per_km").alias("pr_pace"))
    )


def pr_cards(race: DataFrame) -> DataFrame:
    """The fastest race per distance (the earliest of equals), in distance order."""
    known = race.dropna(subset=["race_distance_category", "pace_min_per_km"])
    best = known.groupBy(ATHLETE, "race_distance_category").agg(
        F.min(
            F.struct(
                "pace_min_per_km", "race_date", "race_id", "finish_time_formatted", "distance_km"
            )
        ).alias("_b")
    )
    order = F.array(*[F.lit(d) for d in K.DISTANCE_LABELS])
    return best.select(
        ATHLETE,
        "race_distance_category",
        "_b.*",
        F.array_position(order, c("race_distance_category")).cast("int").alias("distance_order"),
    ).orderBy(ATHLETE, "distance_order")


def goal_summary(race: DataFrame) -> DataFrame:
    """Goals set, achieved and missed; one just missed counts as neither."""
    outcome = c("goal_achievement")
    counted = (
        race.filter(c("goal_race_name").isNotNull())
        .groupBy(ATHLETE)
        .agg(
            F.count("*").alias("goals_set"),
            F.count_if(outcome == K.GOAL_ACHIEVED).alias("achieved"),
            F.count_if(outcome == K.GOAL_JUST_MISSED).alias("_near"),
        )
    )
    return counted.withColumn("missed", c("goals_set") - c("achieved") - c("_near")).drop("_near")


def goal_gaps(race: DataFrame) -> DataFrame:
    return race.filter(c("goal_race_name").isNotNull()).select(
        ATHLETE,
        "race_id",
        "race_date",
        "goal_race_name",
        "finish_time_formatted",
        "goal_time_formatted_target",
        "goal_achievement",
        T.signed_gap(c("seconds_vs_goal")).alias("gap_text"),
    )


def readiness_context(race: DataFrame) -> DataFrame:
    """Races with their readiness tier and the training of the 30 days before."""
    score = c("race_readiness_score")
    return race.filter(score.isNotNull()).select(
        ATHLETE,
        "race_id",
        "race_date",
        "race_readiness_score",
        band(score, [("success", 8), ("warning", 6), ("danger", None)], ">=").alias("tier"),
        F.concat(score.cast("string"), F.lit(" / 10")).alias("score_text"),
        "total_training_distance_30d",
        "training_runs_30d",
        "avg_training_pace_30d",
        "race_vs_training_pace_diff",
        "pacing_assessment",
    )


# -- health -------------------------------------------------------------------------


def recovery_today(health: DataFrame) -> DataFrame:
    """The newest health day with its readiness card."""
    latest = newest(health, 1, c("date").desc())
    card = F.create_map(
        *[
            x
            for key, (label, message) in K.READINESS_CARDS.items()
            for x in (F.lit(key), F.struct(F.lit(label).alias("l"), F.lit(message).alias("m")))
        ]
    )
    found = F.coalesce(
        F.try_element_at(card, F.lower("training_readiness")),
        F.element_at(card, F.lit(K.READINESS_DEFAULT)),
    )
    return latest.withColumn("_card", found).select(
        ATHLETE,
        "date",
        T.score(c("recovery_score")).alias("recovery_text"),
        c("_card.l").alias("readiness_label"),
        c("_card.m").alias("readiness_message"),
        F.when(c("total_sleep_hours") != 0, F.concat(T.fixed(c("total_sleep_hours"), 1), F.lit(" h")))
        .otherwise(F.lit("—"))
        .alias("sleep_text"),
        T.heart_rate(c("resting_heart_rate")).alias("resting_hr_text"),
    )


def health_kpis(days: DataFrame) -> DataFrame:
    """Means of the period and the readiness of its last day."""
    return days.groupBy(ATHLETE).agg(
        F.avg("total_sleep_hours").alias("avg_sleep"),
        F.avg("resting_heart_rate").alias("avg_rhr"),
        F.avg("hrv_numeric").alias("avg_hrv"),
        F.avg("average_stress_level").alias("avg_stress"),
        F.avg("recovery_score").alias("avg_recovery"),
        F.avg("total_steps").alias("avg_steps"),
        F.max_by("training_readiness", "date").alias("readiness_now"),
    )


def health_tiers(days: DataFrame) -> DataFrame:
    """Colour tiers of sleep, stress and steps."""
    stress = c("average_stress_level")
    return days.select(
        ATHLETE,
        "date",
        band(
            c("total_sleep_hours"), [("success", 7.5), ("warning", 6.0), ("danger", None)], ">="
        ).alias("sleep_tier"),
        F.when(
            stress.isNotNull(),
            band(
                stress,
                [("success", 25), ("warning", 50), ("accent", 75), ("danger", None)],
                "<",
            ),
        ).alias("stress_tier"),
        band(
            c("total_steps"), [("success", 10000), ("warning", 7500), ("danger", None)], ">="
        ).alias("steps_tier"),
    )


def sleep_stages(days: DataFrame, n: int = 7) -> DataFrame:
    """The newest ``n`` days with all four stages."""
    stages = ["deep_sleep_hours", "rem_sleep_hours", "light_sleep_hours", "awake_hours"]
    whole = days.select(ATHLETE, "date", *stages).dropna()
    return newest(whole, n, c("date").desc())


def coverage(days: DataFrame, name: str, as_of: dt.date) -> DataFrame:
    """First and last day, and whether the asked period starts before the data. All time has no start."""
    return days.groupBy(ATHLETE).agg(
        F.min("date").alias("data_min"),
        F.max("date").alias("data_max"),
        F.count("*").alias("data_days"),
        F.coalesce(F.min("date") > D.period_start(name, as_of), F.lit(False)).alias("starts_before_data"),
    )


# -- saved analyses -----------------------------------------------------------------


def analysis_history(log: DataFrame) -> DataFrame:
    return log.orderBy(c("generated_at").desc(), ATHLETE, "analysis_id")


def analysis_goals(log: DataFrame) -> DataFrame:
    return log.groupBy(ATHLETE, "goal_distance").agg(F.count("*").alias("analyses"))
