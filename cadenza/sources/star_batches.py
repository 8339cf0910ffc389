"""Landed payloads and load batches derived from the star-schema test tables.

Payloads go through JSON text, as landed ones do. Batches overlap the stored part by a
re-fetch window, and change what they re-fetch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza import schemas
from cadenza.sources.star import AS_OF, StarTables

# What is stored ends here; batches start at the re-fetch date.
STORED_UNTIL = "2001-05-01"
REFETCH_FROM = "2001-01-01"
EVENTS_UNTIL = "2001-09-01"
EVENTS_FROM = "2001-06-01"
FORECAST_DAYS = 7


def _through_json(df: DataFrame, ddl: str) -> DataFrame:
    """Records as JSON text and back under the declared schema.

    Each text is written and read once: a filter on what was read, as a join makes one, is not pushed below ``inline``.
    """
    text = df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("json"))
    return text.select(F.inline(F.array(F.from_json("json", ddl))))


WEATHER_JSON = """
CASE WHEN k % 3 = 0 THEN NULL WHEN k % 21 = 7 THEN '[]'
ELSE concat(CASE WHEN k % 3 = 1 THEN '[' ELSE '' END, to_json(named_struct(
  'temp', 20 + (k * 7) % 80,
  'apparentTemp', CASE WHEN k % 5 = 0 THEN NULL ELSE 18 + (k * 7) % 80 END,
  'relativeHumidity', 30 + k % 60,
  'windSpeed', (k * 3) % 50,
  'weatherTypeDTO', named_struct('desc', CASE k % 6 WHEN 0 THEN 'Fair' WHEN 1 THEN 'Partly Cloudy'
     WHEN 2 THEN '  Light Rain ' WHEN 4 THEN '' END),
  'weatherType', CASE k % 6 WHEN 3 THEN 'Snow' WHEN 4 THEN 'Fog' END,
  'condition', CASE k % 6 WHEN 5 THEN 'Windy Day' ELSE 'Other' END,
  'precipitation', CASE WHEN k % 5 = 0 THEN CAST(k % 60 AS DOUBLE) / 10 END)),
  CASE WHEN k % 3 = 1 THEN ']' ELSE '' END) END
"""


def activity_records(t: StarTables) -> DataFrame:
    """Activity payloads with their weather response, not yet through JSON."""
    a = t.keyed_activities
    clock = "yyyy-MM-dd HH:mm:ss"

    def kind(name: str):
        return F.when(F.col(name).isNotNull(), F.struct(F.col(name).alias("typeKey")))

    return a.select(
        "athlete_id",
        F.col("k").alias("activityId"),
        F.col("activity_name").alias("activityName"),
        F.date_format("start_time_local", clock).alias("startTimeLocal"),
        F.date_format("start_time_gmt", clock).alias("startTimeGMT"),
        kind("activity_type").alias("activityType"),
        kind("event_type").alias("eventType"),
        F.col("distance_m").alias("distance"),
        F.col("duration_seconds").alias("duration"),
        F.col("moving_duration_seconds").alias("movingDuration"),
        F.col("avg_speed_mps").alias("averageSpeed"),
        F.col("max_speed_mps").alias("maxSpeed"),
        F.col("avg_heart_rate").cast("double").alias("averageHR"),
        F.col("max_heart_rate").cast("double").alias("maxHR"),
        F.col("elevation_gain_m").alias("elevationGain"),
        F.col("elevation_loss_m").alias("elevationLoss"),
        F.col("min_elevation_m").alias("minElevation"),
        F.col("max_elevation_m").alias("maxElevation"),
        F.col("calories").cast("double").alias("calories"),
        F.col("avg_cadence").cast("double").alias("averageRunningCadenceInStepsPerMinute"),
        F.col("max_cadence").cast("double").alias("maxRunningCadenceInStepsPerMinute"),
        F.col("aerobic_training_effect").alias("aerobicTrainingEffect"),
        F.col("anaerobic_training_effect").alias("anaerobicTrainingEffect"),
        F.col("device_name").alias("deviceName"),
        F.col("location_name").alias("locationName"),
        F.expr(WEATHER_JSON).alias("weather_json"),
    )


def activity_payload(t: StarTables) -> DataFrame:
    return _through_json(activity_records(t).drop("weather_json"), schemas.ACTIVITY_PAYLOAD)


def weather_payload(t: StarTables) -> DataFrame:
    return t.orders.select(
        F.expr("CAST((c - c % 30) / 30 AS BIGINT)").alias("athlete_id"),
        F.col("k").cast("string").alias("activity_id"),
        F.expr(WEATHER_JSON).alias("weather_json"),
    )


def _stats() -> list[Column]:
    return [
        F.col("steps").alias("totalSteps"),
        F.col("distance_m").alias("totalDistanceMeters"),
        F.col("active_calories").cast("double").alias("activeKilocalories"),
        F.col("bmr_calories").cast("double").alias("bmrKilocalories"),
        F.col("resting_heart_rate").alias("restingHeartRate"),
        F.col("min_heart_rate").alias("minHeartRate"),
        F.col("max_heart_rate").alias("maxHeartRate"),
        F.col("stress_avg").alias("averageStressLevel"),
        F.col("body_battery_charged").alias("bodyBatteryChargedValue"),
        F.col("body_battery_drained").alias("bodyBatteryDrainedValue"),
        F.col("body_battery_high").alias("bodyBatteryHighestValue"),
        F.col("body_battery_low").alias("bodyBatteryLowestValue"),
        F.col("avg_waking_respiration_rate").alias("avgWakingRespirationValue"),
        F.col("avg_sleep_respiration_rate").alias("avgSleepRespirationValue"),
    ]


def _hrv() -> list[Column]:
    return [F.col("hrv_avg").alias("lastNightAvg"), F.col("hrv_status").alias("status")]


def _sleep() -> Column:
    return F.struct(
        F.col("sleep_seconds").alias("sleepTimeSeconds"),
        F.col("deep_sleep_seconds").alias("deepSleepSeconds"),
        F.col("light_sleep_seconds").alias("lightSleepSeconds"),
        F.col("rem_sleep_seconds").alias("remSleepSeconds"),
        F.col("awake_seconds").alias("awakeSleepSeconds"),
    ).alias("dailySleepDTO")


def health_payloads(t: StarTables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Daily stats, HRV and sleep; a tenth of the days lacks one or the other."""
    d = t.keyed_health
    day = ["athlete_id", "date"]
    return (
        _through_json(d.select(*day, *_stats()), schemas.STATS_PAYLOAD),
        _through_json(d.filter("h % 7 <> 0").select(*day, *_hrv()), schemas.HRV_PAYLOAD),
        _through_json(d.filter("h % 13 <> 0").select(*day, _sleep()), schemas.SLEEP_PAYLOAD),
    )


def health_records(t: StarTables) -> DataFrame:
    """The same days as landed records, one a day."""
    return t.keyed_health.select(
        "athlete_id",
        "date",
        F.struct(*_stats()).alias("stats"),
        F.expr("h % 7 <> 0").alias("has_hrv"),
        F.struct(*_hrv()).alias("hrv"),
        F.expr("h % 13 <> 0").alias("has_sleep"),
        F.struct(_sleep()).alias("sleep"),
    ).select(
        "athlete_id",
        "date",
        "stats",
        F.when(F.col("has_hrv"), F.col("hrv")).alias("hrv"),
        F.when(F.col("has_sleep"), F.col("sleep")).alias("sleep"),
    )


def calendar_payload(t: StarTables, events: DataFrame | None = None) -> DataFrame:
    """One payload per event: the event, a workout beside it, and for every sixth event
    a later listing by the next month."""
    e = t.keyed_calendar if events is None else events
    listings = e.withColumn(
        "listing", F.explode(F.expr("CASE WHEN k % 6 = 0 THEN array(0, 1) ELSE array(0) END"))
    )
    k = F.col("k")
    event = F.struct(
        F.lit(True).alias("isRace"),
        F.expr("CASE k % 10 WHEN 0 THEN NULL WHEN 5 THEN '' ELSE event_uuid END").alias(
            "shareableEventUuid"
        ),
        F.col("event_uuid").alias("id"),
        F.when(F.col("listing") == 1, F.lit("Later listing"))
        .otherwise(F.col("title"))
        .alias("title"),
        F.col("event_date").cast("string").alias("date"),
        F.col("location").alias("location"),
        F.struct(
            F.coalesce("distance_m", F.lit(5.0)).alias("value"),
            F.when(F.col("distance_m").isNull(), F.lit("kilometer"))
            .otherwise(F.lit("meter"))
            .alias("unit"),
            F.lit("distance").alias("unitType"),
        ).alias("completionTarget"),
        F.struct(
            F.col("start_time").alias("startTimeHhMm"), F.col("timezone").alias("timeZoneId")
        ).alias("eventTimeLocal"),
        F.when(k % 3 == 0, F.lit(True)).alias("subscribed"),
        F.col("url").alias("url"),
    )
    workout = event.withField("isRace", F.lit(False)).withField("id", F.lit("workout"))
    payload = listings.select(
        "athlete_id",
        F.date_format(F.add_months("event_date", F.col("listing")), "yyyy-MM").alias("month"),
        F.array(workout, event).alias("calendarItems"),
    )
    return _through_json(payload, schemas.CALENDAR_PAYLOAD)


def calendar_records(t: StarTables, events: DataFrame) -> DataFrame:
    """Landed records, one per athlete and month with all its listings."""
    items = F.flatten(F.collect_list("calendarItems")).alias("calendarItems")
    return calendar_payload(t, events).groupBy("athlete_id", "month").agg(items)


def forecast_payload(t: StarTables) -> DataFrame:
    """Seven forecast days for the city of every customer."""
    customers = t._read("customer").select(F.col("c_custkey").alias("c"))

    def series(sql: str):
        return F.expr(f"transform(sequence(0, {FORECAST_DAYS - 1}), i -> {sql})")

    payload = customers.select(
        F.expr("CAST((c - c % 30) / 30 AS BIGINT)").alias("athlete_id"),
        F.expr("concat('City ', CAST(c AS STRING))").alias("city"),
        F.struct(
            series(f"CAST(date_add(DATE '{AS_OF}', i) AS STRING)").alias("time"),
            series(
                "CASE WHEN (c + i) % 11 = 0 THEN NULL"
                " ELSE CAST((c * 3 + i * 5) % 40 - 5 AS DOUBLE) + 0.25e0 END"
            ).alias("temperature_2m_min"),
            series("CAST((c * 3 + i * 5) % 40 + 5 AS DOUBLE) + 0.25e0").alias("temperature_2m_max"),
            series("CAST((c + i * 7) % 80 AS DOUBLE) / 1e1").alias("precipitation_sum"),
            series("CAST((c * 2 + i) % 45 AS DOUBLE)").alias("windspeed_10m_max"),
            series("element_at(array(0, 1, 2, 3, 45, 61, 95, 7), CAST((c + i) % 8 AS INT) + 1)").alias(
                "weathercode"
            ),
        ).alias("daily"),
    )
    return _through_json(payload, schemas.FORECAST_PAYLOAD)


def fetched_twice(t: StarTables) -> DataFrame:
    """Activities as text rows of a first fetch, every fourth also of a second one with
    another name, some of those with an unreadable date."""
    a = t.keyed_activities.withColumn(
        "fetch", F.explode(F.expr("CASE WHEN k % 4 = 0 THEN array(0, 1) ELSE array(0) END"))
    )
    second = F.col("fetch") == 1
    clock = F.date_format("activity_date", "yyyy-MM-dd HH:mm:ss")
    return a.select(
        "athlete_id",
        "activity_id",
        "fetch",
        F.when(second, F.lit("Renamed")).otherwise(F.col("activity_name")).alias("activity_name"),
        F.when(second & (F.col("k") % 16 == 0), F.lit("not a date"))
        .otherwise(clock)
        .alias("activity_date"),
    )


def stored_activities(t: StarTables, activities: DataFrame | None = None) -> DataFrame:
    """The part of the raw activities, or of those given, that is stored."""
    return (activities or t.activities).filter(F.col("activity_date") < STORED_UNTIL)


def activity_batch(t: StarTables) -> DataFrame:
    """Activities from the re-fetch date on: renamed, and with some weather found."""
    a = t.keyed_activities.filter(F.col("activity_date") >= REFETCH_FROM)
    found = a.withColumns(
        {
            "activity_name": F.lit("Fetched again"),
            "weather_temp_c": F.coalesce("weather_temp_c", F.expr("CASE WHEN k % 2 = 0 THEN 11.5e0 END")),
            "weather_humidity_pct": F.expr("CASE WHEN k % 2 = 0 THEN 77 END"),
            "weather_condition": F.expr("CASE WHEN k % 12 <> 3 THEN 'FOUND' END"),
            "weather_feels_like_c": F.lit(None).cast("double"),
            "weather_wind_speed_ms": F.lit(None).cast("double"),
            "weather_precipitation_mm": F.lit(None).cast("double"),
        }
    )
    return found.select(*[c for c in t.activities.columns if c not in ("inserted_at", "updated_at")])


def later_activities(t: StarTables, activities: DataFrame | None = None) -> DataFrame:
    """Activities the stored part does not have."""
    late = (activities or t.activities).filter(F.col("activity_date") >= STORED_UNTIL)
    return late.drop("inserted_at", "updated_at")


def stored_events(t: StarTables) -> DataFrame:
    return t.calendar_events.filter(F.col("event_date") < EVENTS_UNTIL)


def moved_events(t: StarTables) -> DataFrame:
    """Events fetched again, with their order key: retitled, every fifth moved by 40 days."""
    e = t.keyed_calendar.filter(F.col("event_date") >= EVENTS_FROM)
    return e.withColumns(
        {
            "title": F.concat(F.lit("Updated "), F.col("event_uuid")),
            "event_date": F.expr("CASE WHEN k % 5 = 0 THEN event_date + 40 ELSE event_date END"),
        }
    )


def event_batch(t: StarTables) -> DataFrame:
    return moved_events(t).select(
        *[c for c in t.calendar_events.columns if c not in ("inserted_at", "updated_at")]
    )
