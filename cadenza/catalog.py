"""Every operator as a query over the test tables: name to function of :class:`Tables`.

Unrounded double columns named in ``ROUNDED`` are cut to six decimals, so that results
can be compared by value with another engine's.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza import quality_specs, schemas
from cadenza.functions import activity as A
from cadenza.functions import dates as D
from cadenza.functions import text as T
from cadenza.functions.numeric import rnd_agg, safe_divide
from cadenza.functions.reuse import reusable
from cadenza.operators import keyed, quality, shaping
from cadenza.operators.windows import newest
from cadenza.plans import build, checks, coaching, dashboard, health, overview, race, staging
from cadenza.plans import training, unified
from cadenza.plans import weather as wx
from cadenza.session import new_path
from cadenza.sources import bronze, landed
from cadenza.sources import star_batches as B
from cadenza.sources.star import AS_OF, LOADED_AT, StarTables
from cadenza.streaming import ingest

c = F.col
AID = "athlete_id"
ACT = [AID, "activity_id"]
WEEK = training.WEEK
RACE = [AID, "race_id"]


class Tables(StarTables):
    """Raw, staged and mart tables over one directory, all lazy."""

    @cached_property
    def enriched(self) -> DataFrame:
        return staging.enrich_activities(self.activities)

    @cached_property
    def stg(self) -> DataFrame:
        return staging.stage_activities(self.activities)

    @cached_property
    def days(self) -> DataFrame:
        return staging.enrich_health(self.daily_health)

    @cached_property
    def stg_days(self) -> DataFrame:
        return staging.stage_health(self.daily_health)

    @cached_property
    def events(self) -> DataFrame:
        return staging.stage_calendar(self.calendar_events, AS_OF)

    @cached_property
    def unified(self) -> DataFrame:
        return unified.unify(self.stg, self.stg_days)

    @cached_property
    def weekly(self) -> DataFrame:
        return training.weekly_metrics(self.stg)

    @cached_property
    def rolled(self) -> DataFrame:
        return training.rolling_metrics(self.weekly)

    @cached_property
    def training(self) -> DataFrame:
        return training.mart_training(self.silver_activities)

    @cached_property
    def rolled_days(self) -> DataFrame:
        return health.rolling(health.calendar_parts(self.stg_days))

    @cached_property
    def health(self) -> DataFrame:
        return health.mart_health(self.stg_days)

    @cached_property
    def races(self) -> DataFrame:
        return race.races(self.stg)

    @cached_property
    def placed_races(self) -> DataFrame:
        return race.with_day_context(self.races, race.day_context(self.stg))

    @cached_property
    def recorded_races(self) -> DataFrame:
        return race.with_distance_history(self.races, race.distance_days(self.races))

    @cached_property
    def race(self) -> DataFrame:
        return race.mart_race(self.silver_activities, self.race_goals)

    # The pages, alerts and data tests read stored marts, as they are built once a day.

    def _mart(
        self,
        name: str,
        computed: Callable[[], DataFrame],
        write: Callable[[DataFrame, str], None] = build.write_mart,
    ) -> DataFrame:
        return build.read_mart(self.spark, self._once(name, computed, write))

    def _silver(self, name: str, computed: Callable[[], DataFrame]) -> DataFrame:
        path = self._once(name, computed)
        return self.spark.read.schema(computed().schema).parquet(path)

    @cached_property
    def gold_training(self) -> DataFrame:
        return self._mart("mart-training", lambda: self.silver_activities, build.write_training)

    @cached_property
    def gold_health(self) -> DataFrame:
        return self._mart("mart-health", lambda: self.daily_health, build.write_health)

    @cached_property
    def gold_race(self) -> DataFrame:
        return self._mart("mart-race", lambda: self.race)

    @cached_property
    def silver_activities(self) -> DataFrame:
        """Staged activities, stored: marts and data tests read them several times."""
        return self._silver("stg-activities", lambda: self.stg)

    @cached_property
    def weather(self) -> DataFrame:
        return dashboard.weather_activities(self.activities)

    @cached_property
    def weather_runs(self) -> DataFrame:
        return wx.weather_runs(self.activities)

    @cached_property
    def forecast(self) -> DataFrame:
        return landed.normalise_forecast(B.forecast_payload(self))

    @cached_property
    def context(self) -> DataFrame:
        goals = coaching.newest_goal(self.analysis_log)
        return coaching.coaching_context(
            self.gold_training, self.gold_health, self.gold_race, goals, AS_OF
        )

    @cached_property
    def tested_unified(self) -> DataFrame:
        """Unified activities for their one scan by the data tests: only the tested columns are joined."""
        return unified.unify(self.silver_activities, self.stg_days)

    # Tables the declared data tests run on, and the property that holds each.
    TESTED = {
        "activities": "activities",
        "calendar_events": "calendar_events",
        "daily_health": "daily_health",
        "race_goals": "race_goals",
        "stg_activities": "silver_activities",
        "stg_health": "stg_days",
        "stg_calendar": "events",
        "int_unified": "tested_unified",
        "mart_training": "gold_training",
        "mart_race": "gold_race",
        "mart_health": "gold_health",
    }

    def tested(self, tests: list[quality.ColumnTest]) -> dict[str, DataFrame]:
        """The tables that the tests name; no other is built."""
        named = {x.table for x in tests}
        return {name: getattr(self, held) for name, held in self.TESTED.items() if name in named}


Query = Callable[[Tables], DataFrame]
QUERIES: dict[str, Query] = {}
ROUNDED: dict[str, list[str]] = {}


def query(name: str, rounded: str = ""):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        ROUNDED[name] = rounded.split()
        return fn

    return register


def pick(name: str, table: str, columns: str, keys: list[str], rounded: str = "") -> None:
    """Register a choice of columns of one of the tables."""
    query(name, rounded)(lambda t: getattr(t, table).select(*keys, *columns.split()))


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    df = QUERIES[name](Tables(spark, sf_dir))
    if not ROUNDED[name]:
        return df
    return df.withColumns(_cut(tuple(ROUNDED[name])))


@reusable
def _cut(columns: tuple[str, ...]) -> dict[str, Column]:
    return {n: rnd_agg(c(n), 6) for n in columns}


# -- sources, normalisation, loads, sinks -------------------------------------------


query("src_activities", "avg_speed_mps max_speed_mps moving_duration_seconds")(lambda t: t.activities)
query("src_daily_health")(lambda t: t.daily_health)
query("src_calendar")(lambda t: t.calendar_events)


@query("src_goals_csv")
def src_goals_csv(t: Tables) -> DataFrame:
    path = new_path(t.spark, "goals-csv")
    bronze.write_csv(t.race_goals, path)
    return bronze.read_goals_csv(t.spark, path)


query("norm_activities", "avg_speed_mps max_speed_mps moving_duration_seconds")(
    lambda t: landed.normalise_activities(B.activity_payload(t))
)
query("norm_daily_health")(lambda t: landed.normalise_daily_health(*B.health_payloads(t)))
query("norm_calendar")(lambda t: landed.normalise_calendar(B.calendar_payload(t)))
query("norm_weather")(lambda t: landed.normalise_weather(B.weather_payload(t)))
query("norm_forecast")(lambda t: t.forecast)
query("clean_activities")(lambda t: landed.clean_activities(B.fetched_twice(t), "fetch"))


@query("flatten_nested")
def flatten_nested(t: Tables) -> DataFrame:
    payload = B.activity_payload(t).select(
        AID, "activityId", "activityType", F.struct("eventType", "locationName").alias("place")
    )
    return shaping.flatten(payload)


@query("conform_schema")
def conform_schema(t: Tables) -> DataFrame:
    """A frame without weather and with a column too many."""
    short = t.activities.drop("weather_temp_c", "event_type").withColumn("extra", F.lit(1))
    kept = shaping.conform(short, schemas.ACTIVITIES)
    return kept.select(*ACT, "event_type", "distance_km", "weather_temp_c", "weather_condition")


_LOADED = [*ACT, "activity_name", "activity_date", "distance_km", "weather_temp_c"]
_LOADED += ["weather_humidity_pct", "weather_wind_speed_ms", "weather_condition"]
_LOADED += ["inserted_at", "updated_at"]


def _activity_table(t: Tables, activities: DataFrame | None = None) -> keyed.MonthTable:
    """A table that holds the stored part with its own load times."""
    table = ingest.raw_table(t.spark, new_path(t.spark, "activities"), "activities")
    table.store(B.stored_activities(t, activities))
    return table


@query("load_replace")
def load_replace(t: Tables) -> DataFrame:
    table = _activity_table(t)
    table.replace(B.activity_batch(t), LOADED_AT)
    return table.read().select(*_LOADED)


@query("load_append")
def load_append(t: Tables) -> DataFrame:
    table = _activity_table(t)
    table.append(B.later_activities(t), LOADED_AT)
    return table.read().select(*_LOADED)


@query("load_upsert_new")
def load_upsert_new(t: Tables) -> DataFrame:
    table = _activity_table(t)
    table.insert_new(B.activity_batch(t), LOADED_AT)
    return table.read().select(*_LOADED)


@query("backfill_weather")
def backfill_weather(t: Tables) -> DataFrame:
    table = _activity_table(t)
    table.backfill_weather(B.activity_batch(t), LOADED_AT)
    return table.read().select(*_LOADED)


@query("load_replace_by_key")
def load_replace_by_key(t: Tables) -> DataFrame:
    table = ingest.raw_table(t.spark, new_path(t.spark, "events"), "calendar_events")
    table.store(B.stored_events(t))
    table.replace_by_key(B.event_batch(t), LOADED_AT)
    return table.read()


def _log_table(t: Tables) -> keyed.MonthTable:
    keys = schemas.KEYS["analysis_log"]
    table = keyed.MonthTable(
        t.spark, new_path(t.spark, "log"), schemas.ANALYSIS_LOG, keys, "generated_at"
    )
    table.store(t.analysis_log)
    return table


@query("delete_by_key")
def delete_by_key(t: Tables) -> DataFrame:
    table = _log_table(t)
    table.delete(t.analysis_log.filter(c("model_used") == "model-1").select(AID, "analysis_id"))
    return table.read()


# Records of a landed file: it is compressed, so one task reads it.
_RECORDS = 200_000


def _ingested(t: Tables, name: str, drops: list[DataFrame]) -> DataFrame:
    """The table after drops of landed files, each with its number of the fetch and loaded by a run of its own."""
    landing, path, progress = (new_path(t.spark, x) for x in ("landing", name, "progress"))
    for fetch, drop in enumerate(drops, 1):
        files = {"compression": "gzip", "maxRecordsPerFile": _RECORDS}
        drop.withColumn("fetch", F.lit(fetch)).write.mode("append").options(**files).json(landing)
        ingest.ingest_incremental(t.spark, name, landing, path, progress, LOADED_AT)
    return ingest.raw_table(t.spark, path, name).read()


@query("ingest_incremental")
def ingest_incremental(t: Tables) -> DataFrame:
    """First activities without weather, then a re-fetch with it."""
    records = B.activity_records(t)
    began = c("startTimeLocal")
    first = records.filter(began < B.STORED_UNTIL).drop("weather_json")
    return _ingested(t, "activities", [first, records.filter(began >= B.REFETCH_FROM)]).select(*_LOADED)


@query("ingest_health")
def ingest_health(t: Tables) -> DataFrame:
    """Health days, then a re-fetch with other steps, which only new days take."""
    records = B.health_records(t)
    steps = c("stats").withField("totalSteps", c("stats.totalSteps") + 1000)
    again = records.filter(c("date") >= B.REFETCH_FROM).withColumn("stats", steps)
    return _ingested(t, "daily_health", [records.filter(c("date") < B.STORED_UNTIL), again])


@query("ingest_calendar")
def ingest_calendar(t: Tables) -> DataFrame:
    """Race events, then a re-fetch that retitles and moves some."""
    first = B.calendar_records(t, t.keyed_calendar.filter(c("event_date") < B.EVENTS_UNTIL))
    return _ingested(t, "calendar_events", [first, B.calendar_records(t, B.moved_events(t))])


def _sunk(t: Tables, rows: DataFrame, write: Callable[[DataFrame, str], None] = build.write_mart) -> DataFrame:
    """A mart after it was stored and read again."""
    path = new_path(t.spark, "mart")
    write(rows, path)
    return build.read_mart(t.spark, path)


@query("sink_marts", "total_distance_km")
def sink_marts(t: Tables) -> DataFrame:
    return _sunk(t, t.silver_activities, build.write_training).select(*WEEK, "total_activities", "total_distance_km")


query("sink_mart_health")(
    lambda t: _sunk(t, t.daily_health, build.write_health).select(AID, "date", "recovery_score", "training_readiness")
)
query("sink_mart_race")(lambda t: _sunk(t, t.race).select(*RACE, "race_number", "is_personal_record", "training_runs_30d"))


@query("sink_mart_changes")
def sink_mart_changes(t: Tables) -> DataFrame:
    """Races after a load, rebuilt only for the athletes that the load changed.

    Only the goals, which both builds read, are written before they are read.
    """
    raw = {n: t.projected(n) for n in schemas.TABLES}
    table, out = _activity_table(t, raw["activities"]), new_path(t.spark, "marts")
    stored = {**raw, "race_goals": t.race_goals, "activities": table.read()}
    build.build(stored, out)
    before = table.version().number
    table.append(table.stage(B.later_activities(t, raw["activities"])), LOADED_AT)
    build.update({**stored, "activities": table.read()}, out, activities=table.changed(before, [AID]))
    races = build.read_mart(t.spark, f"{out}/mart_race")
    return races.select(*RACE, "race_number", "is_personal_record", "training_runs_30d")


@query("sink_views")
def sink_views(t: Tables) -> DataFrame:
    build.register_views({n: getattr(t, n) for n in schemas.TABLES}, AS_OF)
    return t.spark.sql(
        "SELECT athlete_id, effort_level, count(*) AS activities FROM stg_activities GROUP BY ALL"
    )


@query("sink_csv")
def sink_csv(t: Tables) -> DataFrame:
    shown = dashboard.period(t.gold_health, "date", "Last 12 months", AS_OF).select(
        AID, "date", "recovery_score", "training_readiness"
    )
    path = new_path(t.spark, "health-csv")
    bronze.write_csv(shown, path)
    return t.spark.read.schema(shown.schema).option("header", True).csv(path)


query("table_counts")(
    lambda t: bronze.table_counts(
        {n: getattr(t, n) for n in ("activities", "daily_health", "calendar_events")}
    )
)


@query("table_newest")
def table_newest(t: Tables) -> DataFrame:
    """The 20 newest raw activities of all, as the table listing shows them."""
    return (
        t.activities.select(*ACT, "activity_name", "activity_date")
        .orderBy(c("activity_date").desc(), c("activity_id").desc())
        .limit(20)
    )


# -- activity staging ---------------------------------------------------------------

pick("act_time_parts", "enriched", "activity_date start_hour day_of_week", ACT)
pick("act_distance_default", "enriched", "distance_km", ACT)
pick("act_moving_pause", "enriched", "moving_duration_minutes pause_duration_minutes", ACT)
pick("act_pace_sanity", "enriched", "avg_pace_min_km", ACT)
pick("act_speed_kmh", "enriched", "avg_speed_kmh max_speed_kmh", ACT)
pick("act_hr_delta", "enriched", "avg_heart_rate max_heart_rate hr_delta", ACT)
pick("act_elevation", "enriched", "net_elevation_m elevation_range_m", ACT)
pick("act_training_effect", "enriched", "total_training_effect", ACT)
pick("act_is_race", "enriched", "is_race", ACT)
pick("act_distance_category", "enriched", "race_distance_category", ACT)
pick("act_pace_zone", "enriched", "pace_zone", ACT)
pick("act_hr_zone", "enriched", "hr_zone", ACT)
pick("act_effort_level", "enriched", "effort_level", ACT)
pick("act_training_load", "enriched", "training_load", ACT)
pick("act_terrain", "enriched", "terrain_type", ACT)
pick("act_time_of_day", "enriched", "time_of_day", ACT)
pick("act_is_weekend", "enriched", "is_weekend", ACT)
pick(
    "act_quality_flags",
    "enriched",
    "has_data_quality_issues is_very_short has_unrealistic_pace",
    ACT,
)
query("act_valid_filter")(
    lambda t: staging.valid_activities(t.activities).select(*ACT, "distance_km", "duration_minutes")
)
query("stg_activities")(lambda t: t.stg)

# -- health staging -----------------------------------------------------------------

DAY = [AID, "health_date"]
pick("hlt_date_dims", "days", "day_of_week week_of_year month_number year_number", DAY)
pick(
    "hlt_movement",
    "days",
    "steps daily_distance_km active_calories bmr_calories total_calories",
    DAY,
)
pick(
    "hlt_sleep_hours",
    "days",
    "sleep_hours deep_sleep_hours light_sleep_hours rem_sleep_hours awake_hours",
    DAY,
)
pick("hlt_sleep_efficiency", "days", "sleep_efficiency_pct", DAY)
pick("hlt_stage_pct", "days", "deep_sleep_pct rem_sleep_pct", DAY)
pick("hlt_battery_net", "days", "body_battery_net", DAY)
pick("hlt_is_weekend", "days", "is_weekend", DAY)
pick("hlt_sleep_quality", "days", "sleep_quality", DAY)
pick("hlt_stress_category", "days", "stress_category", DAY)
pick("hlt_battery_status", "days", "body_battery_status", DAY)
pick("hlt_hrv_category", "days", "hrv_category", DAY)
pick("hlt_steps_goal", "days", "steps_goal_met", DAY)
pick("hlt_recovery_score", "days", "recovery_score", DAY)
pick("hlt_missing_flags", "days", "has_missing_sleep has_missing_hr", DAY)
pick("hlt_valid_filter", "stg_days", "steps sleep_hours", DAY)
query("stg_health")(lambda t: t.stg_days)

# -- calendar staging ---------------------------------------------------------------

EVENT = [AID, "event_uuid"]
pick("cal_dates", "events", "event_year event_month", EVENT)
pick("cal_days_until", "events", "days_until_race is_upcoming", EVENT)
pick("cal_season", "events", "race_season", EVENT)
query("stg_calendar")(lambda t: t.events.orderBy("event_date", AID, "event_uuid"))

# -- unified activities -------------------------------------------------------------

pick("uni_join_health", "unified", "recovery_score pre_run_sleep_hours daily_resting_hr"
     " is_missing_health_context", ACT)
pick("uni_readiness", "unified", "training_readiness", ACT)
pick("uni_ran_while_tired", "unified", "ran_while_tired", ACT)
pick("uni_workout_context", "unified", "workout_context", ACT)
pick("uni_source_tag", "unified", "data_source", ACT)
query("int_unified")(lambda t: t.unified)

# -- joins --------------------------------------------------------------------------


@query("join_week_spine", "total_distance_km")
def join_week_spine(t: Tables) -> DataFrame:
    spine = training.week_spine(t.stg)
    weeks = t.weekly.select(*WEEK, "total_activities", "total_distance_km")
    return spine.join(weeks, WEEK, "left")


query("join_pr")(
    lambda t: t.recorded_races.select(
        *RACE, "race_distance_category", "pr_duration_minutes", "pr_pace_min_per_km"
    )
)
query("join_training_context_rows", "avg_training_pace_30d total_training_distance_30d")(
    lambda t: t.placed_races.select(
        *RACE, "avg_training_pace_30d", "total_training_distance_30d", "training_runs_30d"
    )
)
query("join_goals")(
    lambda t: race.with_goals(t.races, t.race_goals).select(
        *RACE, "race_date", "goal_race_name", "goal_time_seconds", "goal_notes"
    )
)
query("join_range_30d", "total_training_distance_30d")(
    lambda t: t.placed_races.select(
        *RACE, "race_date", "matched_runs_30d", "total_training_distance_30d"
    )
)
query("join_upcoming_goals")(lambda t: dashboard.upcoming_with_goals(t.events, t.race_goals))
query("join_runs_per_week", "total_duration_hours")(
    lambda t: overview.with_runs_per_week(t.gold_training, t.stg).select(
        *WEEK, "total_activities", "total_runs", "total_duration_hours"
    )
)
query("join_recent_weather")(
    lambda t: dashboard.recent_with_weather(
        dashboard.recent_activities(t.stg, 10), t.weather
    ).select(*ACT, "activity_date", "temp_c", "weather_condition")
)
query("join_week_training_health")(lambda t: overview.training_with_health(t.gold_training, t.gold_health))
query("join_day_workouts")(lambda t: overview.days_with_workouts(t.gold_health, t.stg))
query("join_pre_race_health")(lambda t: overview.races_with_eve_health(t.gold_race, t.gold_health))
query("anti_new_keys")(
    lambda t: keyed.new_rows(
        B.stored_activities(t), B.activity_batch(t), schemas.KEYS["activities"]
    ).select(*ACT, "activity_name")
)
query("semi_null_weather")(
    lambda t: keyed.weather_for_missing(
        B.stored_activities(t), B.activity_batch(t), schemas.KEYS["activities"]
    ).select(*ACT, "weather_temp_c", "weather_condition")
)

# -- aggregations -------------------------------------------------------------------

pick("agg_week_counts", "weekly", "total_activities total_races", WEEK)
pick(
    "agg_week_distance",
    "weekly",
    "total_distance_km avg_distance_per_activity_km max_distance_km total_duration_minutes"
    " avg_duration_per_activity_minutes",
    WEEK,
    "total_distance_km avg_distance_per_activity_km total_duration_minutes"
    " avg_duration_per_activity_minutes",
)
pick("agg_weighted_pace", "weekly", "avg_pace_min_per_km", WEEK, "avg_pace_min_per_km")
pick("agg_week_hr", "weekly", "avg_heart_rate_bpm max_heart_rate_bpm", WEEK, "avg_heart_rate_bpm")
pick(
    "agg_week_elevation",
    "weekly",
    "total_elevation_gain_m avg_elevation_per_activity_m",
    WEEK,
    "avg_elevation_per_activity_m",
)
pick("agg_effort_avg", "weekly", "avg_effort_level", WEEK, "avg_effort_level")
pick("agg_week_load", "weekly", "total_training_load", WEEK, "total_training_load")
_ZONES = (
    "pct_zone1_easy pct_zone2_moderate pct_zone3_tempo pct_zone4_threshold pct_zone5_max"
    " pct_zone5_actual"
)
pick("agg_zone_share", "weekly", _ZONES, WEEK, _ZONES)
query("agg_pr")(lambda t: race.personal_records(t.races))
query("agg_training_context", "avg_training_pace_30d total_training_distance_30d")(
    lambda t: race.day_context(t.stg).select(
        AID,
        "race_date",
        "avg_training_pace_30d",
        "total_training_distance_30d",
        "training_runs_30d",
    )
)
query("agg_activity_overview")(lambda t: overview.activity_overview(t.activities))
query("agg_health_overview")(lambda t: overview.health_overview(t.daily_health))
query("agg_activity_types")(lambda t: overview.activity_types(t.activities))
query("agg_runs_per_week")(lambda t: overview.runs_per_week(t.stg))
query("agg_null_coverage")(lambda t: overview.null_coverage(t.activities, "weather_temp_c"))
query("agg_date_range")(lambda t: overview.week_range(t.gold_training))
query("agg_effort_totals", "total_distance")(lambda t: overview.effort_totals(t.stg))
query("agg_weekend_split", "avg_distance avg_pace")(lambda t: overview.weekend_split(t.stg))
query("agg_iso_week_recovery", "avg_recovery avg_sleep avg_rhr")(
    lambda t: overview.iso_week_recovery(t.stg_days)
)
query("agg_weekday_profile", "avg_stress")(lambda t: overview.weekday_profile(t.gold_health))
query("agg_week_health")(lambda t: overview.recent_weekly_health(t.gold_health))
query("agg_rhr_week_spread", "week_avg_rhr avg_deviation")(
    # The key is a mean; cut it first so that equal means stay one group.
    lambda t: overview.rhr_week_spread(
        t.gold_health.withColumn("week_avg_rhr", rnd_agg(c("week_avg_rhr"), 6))
    )
)
query("agg_readiness_distribution")(lambda t: overview.readiness_distribution(t.gold_health))
query("agg_health_extremes")(lambda t: overview.health_extremes(t.gold_health))
query("distinct_weeks")(lambda t: overview.distinct_weeks(t.stg))

# -- windows ------------------------------------------------------------------------


def _rolled(n: int) -> str:
    return " ".join(
        f"rolling_{n}wk_avg_{m}"
        for m in ("distance_km", "activities", "duration_minutes", "training_load")
    )


pick("win_roll_4wk", "rolled", _rolled(4), WEEK, _rolled(4))
pick("win_roll_8wk", "rolled", _rolled(8), WEEK, _rolled(8))
pick(
    "win_prev_week",
    "rolled",
    "prev_week_distance_km prev_week_activities prev_week_avg_pace",
    WEEK,
    "prev_week_distance_km prev_week_avg_pace",
)
_M7 = "sleep_7day_avg deep_sleep_7day_avg rhr_7day_avg hrv_7day_avg stress_7day_avg steps_7day_avg"
pick("win_roll_7day", "rolled_days", _M7, DAY, _M7)
pick("win_roll_28day", "rolled_days", "sleep_28day_avg rhr_28day_avg", DAY, "sleep_28day_avg rhr_28day_avg")
pick(
    "win_prev_day",
    "rolled_days",
    "prev_day_sleep_hours prev_day_rhr prev_day_stress prev_day_battery_change",
    DAY,
)
pick("win_prev_7rows", "rolled_days", "prev_week_sleep_hours prev_week_rhr", DAY)
pick(
    "win_sleep_debt_7",
    "rolled_days",
    "sleep_debt_7day_cumulative",
    DAY,
    "sleep_debt_7day_cumulative",
)
pick(
    "win_week_partition",
    "health",
    "week_avg_sleep week_avg_rhr week_avg_stress week_total_steps",
    [AID, "date"],
    "week_avg_sleep week_avg_rhr week_avg_stress",
)
pick("win_days_since_race", "placed_races", "race_date days_since_last_race", RACE)
pick("win_race_number", "placed_races", "race_number race_number_this_year", RACE)
pick("win_pace_ma3", "recorded_races", "pace_ma_3_races", RACE, "pace_ma_3_races")
pick("win_pace_change", "recorded_races", "pace_change_vs_last_race", RACE, "pace_change_vs_last_race")
query("win_days_since_pr")(
    lambda t: race.days_since_record(t.recorded_races).select(
        *RACE, "is_personal_record", "days_since_pr"
    )
)
query("win_running_total", "total_distance_km running_distance_km")(
    lambda t: overview.running_total(t.gold_training)
)
query("win_score_ma7_30d", "score_7day_ma")(lambda t: checks.score_trend(t.gold_health, AS_OF))

# -- marts --------------------------------------------------------------------------

pick(
    "trn_pct_change",
    "training",
    "distance_vs_prev_week_pct activities_vs_prev_week_pct distance_vs_4wk_avg_pct",
    WEEK,
)
pick("trn_trend_flag", "training", "distance_trend_4wk training_load_trend_4wk", WEEK)
pick("trn_week_label", "training", "year week_number week_label", WEEK)
query(
    "mart_training",
    "total_distance_km avg_distance_per_activity_km total_duration_minutes"
    " avg_duration_per_activity_minutes",
)(lambda t: t.training)
query("hth_day_name")(
    lambda t: health.calendar_parts(t.stg_days).select(
        *DAY, "day_name", "week_start_date", "month_start_date"
    )
)
_CHANGES = (
    "sleep_change_vs_prev_day sleep_change_vs_prev_week sleep_vs_7day_avg rhr_vs_7day_avg"
    " stress_vs_7day_avg"
)
HDAY = [AID, "date"]
pick(
    "hth_changes",
    "health",
    _CHANGES + " rhr_change_vs_prev_day rhr_change_vs_prev_week stress_change_vs_prev_day",
    HDAY,
    _CHANGES,
)
pick("hth_recovery_score", "health", "recovery_score", HDAY)
pick("hth_readiness", "health", "training_readiness", HDAY)
pick("hth_sleep_debt", "health", "sleep_debt_hours", HDAY)
query(
    "mart_health",
    _CHANGES + " sleep_debt_7day_cumulative sleep_7day_avg sleep_28day_avg rhr_7day_avg"
    " rhr_28day_avg hrv_7day_avg stress_7day_avg steps_7day_avg week_avg_sleep week_avg_rhr"
    " week_avg_stress",
)(lambda t: t.health)
pick(
    "rac_calendar_parts",
    "race",
    "race_year race_month race_quarter race_season distance_meters",
    RACE,
)
pick("rac_goal_gap", "race", "seconds_vs_goal goal_achievement", RACE)
pick("rac_pr_gap", "race", "is_personal_record minutes_off_pr pct_off_pr", RACE)
pick("rac_pace_vs_training", "race", "race_vs_training_pace_diff", RACE)
pick("rac_readiness_score", "race", "race_readiness_score", RACE)
pick("rac_finish_time", "race", "finish_time_formatted", RACE)
pick("rac_rating", "race", "performance_rating", RACE)
pick("rac_pacing", "race", "pacing_assessment", RACE)
pick("rac_recovery_status", "race", "recovery_status", RACE)
query("mart_race")(lambda t: t.race)

# -- dashboard ----------------------------------------------------------------------

PERIOD = "Last 12 months"


def _weeks(t: Tables) -> DataFrame:
    return dashboard.period(t.gold_training, "week_start_date", PERIOD, AS_OF)


def _health_days(t: Tables) -> DataFrame:
    return dashboard.period(t.gold_health, "date", PERIOD, AS_OF)


query("qry_weather_activities")(lambda t: t.weather)
query("qry_recent_activities")(lambda t: dashboard.recent_activities(t.stg, 10))
query("qry_calendar")(lambda t: dashboard.calendar_listing(t.events))
query("qry_upcoming_top4")(lambda t: dashboard.next_races(t.events, 4))
query("qry_all_time", "total_km total_hours")(lambda t: dashboard.all_time(t.gold_training, t.gold_race))
query(
    "qry_latest_and_previous",
    "current_distance current_duration previous_distance distance_delta load_delta",
)(lambda t: dashboard.latest_and_previous(t.gold_training))
query("qry_recovery_today")(lambda t: dashboard.recovery_today(t.gold_health))
query("qry_race_highlights")(lambda t: dashboard.race_highlights(t.gold_race))
query("qry_last_n_weeks")(
    lambda t: dashboard.last_n(t.gold_training, "week_start_date", 12, "avg_pace_min_per_km").select(
        *WEEK, "avg_pace_min_per_km", "total_training_load"
    )
)
query("qry_type_filter")(
    lambda t: dashboard.filter_types(t.stg, ["Running", "CYCLING"]).select(
        *ACT, "activity_type", "type_label"
    )
)
query("qry_weather_label")(lambda t: dashboard.weather_labels(t.activities))
query("qry_period_filter", "total_distance_km")(
    lambda t: dashboard.period(t.gold_training, "week_start_date", "Last 3 months", AS_OF).select(
        *WEEK, "total_distance_km"
    )
)
query(
    "qry_period_totals", "total_distance total_hours avg_weekly_distance total_load"
)(lambda t: dashboard.period_totals(overview.with_runs_per_week(_weeks(t), t.stg)))
query("qry_half_over_half", "distance_delta_pct load_delta_pct")(
    lambda t: dashboard.half_over_half(_weeks(t))
)
_Z5 = "pct_zone1_easy pct_zone2_moderate pct_zone3_tempo pct_zone4_threshold pct_zone5_max"
query("qry_zone_profile", _Z5 + " easy_pct")(lambda t: dashboard.zone_profile(_weeks(t)))
query("qry_run_scatter")(lambda t: dashboard.run_details(t.stg))
query("qry_weather_kpis", "avg_temp avg_humidity avg_wind")(
    lambda t: dashboard.weather_kpis(dashboard.running_weather(t.weather, PERIOD, AS_OF))
)
query("qry_temp_pace_trend", "slope intercept pace_at_min pace_at_max")(
    lambda t: dashboard.temp_pace_trend(dashboard.running_weather(t.weather, "All time", AS_OF))
)
query("qry_race_filters")(
    lambda t: dashboard.filter_races(t.gold_race, ["10K", "Half Marathon"], [1999, 2000]).select(
        *RACE, "race_year", "race_distance_category"
    )
)
query("qry_race_years")(lambda t: dashboard.race_years(t.gold_race))
query("qry_race_kpis")(lambda t: dashboard.race_kpis(t.gold_race))
query("qry_race_history")(lambda t: dashboard.race_history(t.gold_race))
query("qry_pr_lines")(lambda t: dashboard.pr_lines(t.gold_race))
query("qry_pr_cards")(lambda t: dashboard.pr_cards(t.gold_race))
query("qry_goal_summary")(lambda t: dashboard.goal_summary(t.gold_race))
query("qry_goal_gaps")(lambda t: dashboard.goal_gaps(t.gold_race))
query("qry_readiness_context")(lambda t: dashboard.readiness_context(t.gold_race))
query("qry_health_kpis", "avg_sleep avg_rhr avg_hrv avg_stress avg_recovery avg_steps")(
    lambda t: dashboard.health_kpis(_health_days(t))
)
query("qry_health_tiers")(lambda t: dashboard.health_tiers(t.gold_health))
query("qry_sleep_stages_7")(lambda t: dashboard.sleep_stages(_health_days(t)))
for _key, _name in {
    "all": "All time",
    "2_weeks": "Last 2 weeks",
    "4_weeks": "Last 4 weeks",
    "6_months": "Last 6 months",
    "custom": "Custom",
}.items():
    query(f"qry_period_{_key}")(
        lambda t, name=_name: dashboard.period(
            t.gold_health, "date", name, AS_OF, (dt.date(1995, 1, 1), dt.date(1996, 6, 30))
        )
        .groupBy(AID)
        .agg(F.count("*").alias("days"), F.min("date").alias("first_day"), F.max("date").alias("last_day"))
    )
query("qry_coverage")(lambda t: dashboard.coverage(t.gold_health, "All time", AS_OF))
query(
    "qry_week_overall",
    "total_distance_km total_duration_minutes total_hours avg_weekly_km avg_weekly_activities"
    " avg_weekly_load",
)(lambda t: dashboard.week_overall(t.gold_training))
query("qry_analysis_history")(lambda t: dashboard.analysis_history(t.analysis_log))
query("qry_analysis_goals")(lambda t: dashboard.analysis_goals(t.analysis_log))

# -- published look-ups -------------------------------------------------------------

query("ck_peak_week")(lambda t: checks.peak_week(t.gold_training))
query("ck_above_average_weeks", "total_distance_km")(
    lambda t: checks.above_average_weeks(t.gold_training)
)
query("ck_zone_history")(lambda t: checks.zone_history(t.gold_training))
query("ck_load_trend")(lambda t: checks.load_trend(t.gold_training))
query("ck_recent_weeks", "total_distance_km")(lambda t: checks.recent_weeks(t.gold_training))
query("ck_best_worst_recovery")(lambda t: checks.best_worst_recovery(t.gold_health))
query("ck_sleep_debt_alert", "sleep_debt_7day_cumulative")(
    lambda t: checks.sleep_debt_alert(t.gold_health)
)
query("ck_rhr_trend_label", "rhr_7day_avg rhr_vs_7day_avg")(
    lambda t: checks.rhr_trend_label(t.gold_health)
)
query("ck_battery_label")(lambda t: checks.battery_label(t.gold_health))
query("ck_null_audit")(lambda t: checks.null_audit(t.gold_health))
query("ck_debt_validation", "calculated_debt")(lambda t: checks.debt_validation(t.gold_health))
query("ck_overreaching")(lambda t: checks.overreaching(t.unified))
query("ck_current_prs")(lambda t: checks.current_records(t.gold_race))
query("ck_race_calendar")(lambda t: checks.race_calendar(t.gold_race))
query("ck_readiness_vs_result")(lambda t: checks.readiness_vs_result(t.gold_race))
query("ck_10k_progression")(lambda t: checks.ten_k_progression(t.gold_race))
query("ck_pacing_analysis")(lambda t: checks.pacing_analysis(t.gold_race))
query("ck_best_races")(lambda t: checks.best_races(t.gold_race))
query("ck_restless_days")(lambda t: checks.restless_days(t.stg_days))

# -- coaching -----------------------------------------------------------------------

query("ctx_acute_chronic")(
    lambda t: coaching.load_context(t.gold_training).drop("acwr", "pct_easy", "pct_hard")
)
query("ctx_acwr")(lambda t: coaching.load_context(t.gold_training).select(AID, "acwr"))
query("ctx_zone_split")(
    lambda t: coaching.load_context(t.gold_training).select(AID, "pct_easy", "pct_hard")
)
query("ctx_health_7d")(lambda t: coaching.health_context(t.gold_health).drop("hrv_trend_pct"))
query("ctx_hrv_trend")(lambda t: coaching.health_context(t.gold_health).select(AID, "hrv_trend_pct"))
query("ctx_pr_paces")(lambda t: coaching.race_context(t.gold_race))
query("ctx_goal")(lambda t: coaching.goal_context(coaching.newest_goal(t.analysis_log), AS_OF))
query("coaching_context")(lambda t: t.context)
for _rule in coaching.ALERTS:
    query(f"alert_{_rule}")(lambda t, rule=_rule: coaching.alert(t.context, rule))
query("alerts")(lambda t: coaching.alerts(t.context))
query("prompt_text")(lambda t: coaching.prompt_text(t.context))
query("prompt_with_weather")(
    lambda t: coaching.prompt_text(
        t.context, wx.weather_block(t.forecast, wx.weather_summary(t.weather_runs))
    )
)

# -- weather ------------------------------------------------------------------------

query("wx_temp_buckets", "avg_pace")(lambda t: wx.temp_buckets(t.weather_runs))
query("wx_wind_impact", "diff_s_per_km")(lambda t: wx.wind_impact(t.weather_runs))
query("wx_rain_impact", "diff_s_per_km")(lambda t: wx.rain_impact(t.weather_runs))
query("wx_summary")(lambda t: wx.weather_summary(t.weather_runs))
query("wx_summary_all")(lambda t: wx.weather_summary(wx.weather_runs(t.activities, latest=None)))
query("wx_forecast_flags")(lambda t: wx.forecast_lines(t.forecast))
query("wx_prompt_block")(
    lambda t: wx.weather_block(t.forecast, wx.weather_summary(t.weather_runs))
)

# -- data tests ---------------------------------------------------------------------


def _tests(t: Tables, *kinds: str) -> DataFrame:
    chosen = [x for x in quality_specs.TESTS if x.kind in kinds]
    return quality.report(t.tested(chosen), chosen)


query("dq_not_null")(lambda t: _tests(t, "not_null"))
query("dq_unique")(lambda t: _tests(t, "unique"))
query("dq_accepted_values")(lambda t: _tests(t, "accepted_values"))
query("dq_expression")(lambda t: _tests(t, "expression"))
query("dq_accepted_range")(lambda t: _tests(t, "accepted_range"))


@query("dq_where_severity")
def dq_where_severity(t: Tables) -> DataFrame:
    chosen = [x for x in quality_specs.TESTS if x.where or x.severity == "error"]
    return quality.report(t.tested(chosen), chosen)


@query("dq_freshness")
def dq_freshness(t: Tables) -> DataFrame:
    parts = [
        quality.freshness(getattr(t, name), name, AS_OF, warn, error)
        for name, (warn, error) in quality_specs.FRESHNESS.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


query("dq_report")(lambda t: quality.report(t.tested(quality_specs.TESTS), quality_specs.TESTS))

# -- sorts, top-n, sets -------------------------------------------------------------

query("sort_marts")(
    lambda t: t.gold_race.select(*RACE, "race_date", "performance_rating").orderBy(
        c("race_date").desc(), AID, "race_id"
    )
)
query("topn_per_athlete")(
    lambda t: newest(
        t.activities.select(*ACT, "activity_date", "distance_km"),
        5,
        c("activity_date").desc(),
        c("activity_id").desc(),
        spread_by="activity_id",
    )
)
query("set_distinct")(lambda t: t.stg.select(AID, "activity_type", "pace_zone").distinct())


@query("set_union_sources")
def set_union_sources(t: Tables) -> DataFrame:
    """A second source that lacks the device: its rides, under their own tag."""
    rides = t.stg.filter(c("activity_type") == "cycling").drop("device_name")
    others = t.stg.filter(c("activity_type") != "cycling")
    united = unified.union_sources({"garmin": others, "strava": rides})
    return united.select(*ACT, "data_source", "device_name", "distance_km")


query("set_except_keys")(
    lambda t: keyed.new_rows(B.stored_activities(t), t.activities, ACT).select(*ACT)
)

# -- scalar functions ---------------------------------------------------------------


@query("fn_dates")
def fn_dates(t: Tables) -> DataFrame:
    start, end = D.look_back(AS_OF, 30)
    day = D.parse_date(D.format_date(c("activity_date")))
    return t.activities.select(
        *ACT,
        D.format_date(c("activity_date")).alias("date_text"),
        day.alias("parsed_date"),
        day.between(start, end).alias("in_last_30_days"),
        D.to_zone(c("start_time_gmt")).alias("local_time"),
    )


query("fn_hr_zone_pct")(
    lambda t: t.activities.select(
        *ACT, A.hr_ratio_zone(c("avg_heart_rate"), c("max_heart_rate")).alias("hr_ratio_zone")
    )
)
query("fn_safe_divide", "minutes_per_km")(
    lambda t: t.activities.select(
        *ACT, safe_divide(c("duration_minutes"), c("distance_km")).alias("minutes_per_km")
    )
)


@query("fn_format_metrics")
def fn_format_metrics(t: Tables) -> DataFrame:
    a, prev = t.stg, Window.partitionBy(AID, "activity_date").orderBy("activity_id")
    p, km, minutes = c("avg_pace_min_km"), c("distance_km"), c("duration_minutes")
    hr = c("avg_heart_rate").cast("double")
    texts: dict[str, Column] = {
        "pace_text": T.pace(p),
        "pace_short_text": T.pace_short(p),
        "pace_truncated_text": T.pace_truncated(p),
        "pace_uncarried_text": T.pace_uncarried(p),
        "duration_text": T.duration(minutes),
        "duration_short_text": T.duration_short(minutes),
        "distance_text": T.distance(km),
        "distance_short_text": T.distance_short(km * 10),
        "hr_text": T.heart_rate(hr),
        "load_text": T.load(c("training_load")),
        "score_text": T.score(c("elevation_gain_m")),
        "date_text": T.date(c("activity_date")),
        "week_text": T.week(c("activity_date")),
        "delta_distance_text": T.delta_distance(km, F.lag(km).over(prev)),
        "delta_pace_text": T.delta_pace(p, F.lag(p).over(prev)),
    }
    return a.select(*ACT, *[e.alias(n) for n, e in texts.items()])
