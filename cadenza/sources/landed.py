"""Landed JSON payloads to raw tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza import schemas
from cadenza.functions import activity as A
from cadenza.functions import weather as W
from cadenza.functions.numeric import rnd, rnd_pos
from cadenza.operators.shaping import conform, first_per_key, latest_per_key


def read_payload(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return spark.read.schema(ddl).json(path)


def _clock(text: Column) -> Column:
    return text.try_cast("timestamp_ntz")


def _or_zero(x: Column) -> Column:
    return F.coalesce(x, F.lit(0.0))


def normalise_activities(payload: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Activity payloads to raw activities without weather and audit columns.

    ``keep`` names payload columns to carry along at the end.
    """
    km = rnd_pos(_or_zero(F.col("distance")) / 1000, 2)
    minutes = rnd_pos(_or_zero(F.col("duration")) / 60, 2)
    measured = payload.withColumns({"_km": km, "_min": minutes})
    fields = {
        "athlete_id": F.col("athlete_id"),
        "activity_id": F.col("activityId").cast("string"),
        "activity_name": F.col("activityName"),
        "activity_date": _clock(F.col("startTimeLocal")),
        "start_time_local": _clock(F.col("startTimeLocal")),
        "start_time_gmt": _clock(F.col("startTimeGMT")),
        "activity_type": F.coalesce(F.col("activityType.typeKey"), F.lit("unknown")),
        "event_type": F.col("eventType.typeKey"),
        "device_name": F.col("deviceName"),
        "location_name": F.col("locationName"),
        "distance_m": _or_zero(F.col("distance")),
        "distance_km": F.col("_km"),
        "duration_seconds": _or_zero(F.col("duration")),
        "duration_minutes": F.col("_min"),
        "moving_duration_seconds": _or_zero(F.col("movingDuration")),
        "avg_speed_mps": F.col("averageSpeed"),
        "max_speed_mps": F.col("maxSpeed"),
        "avg_pace_min_km": F.when(
            (F.col("_km") > 0) & (F.col("_min") > 0),
            rnd_pos(F.col("_min") / F.nullif(F.col("_km"), F.lit(0.0)), 2),
        ),
        "avg_heart_rate": F.col("averageHR").cast("int"),
        "max_heart_rate": F.col("maxHR").cast("int"),
        "elevation_gain_m": F.col("elevationGain"),
        "elevation_loss_m": F.col("elevationLoss"),
        "min_elevation_m": F.col("minElevation"),
        "max_elevation_m": F.col("maxElevation"),
        "calories": F.col("calories").cast("int"),
        "avg_cadence": F.col("averageRunningCadenceInStepsPerMinute").cast("int"),
        "max_cadence": F.col("maxRunningCadenceInStepsPerMinute").cast("int"),
        "aerobic_training_effect": F.col("aerobicTrainingEffect"),
        "anaerobic_training_effect": F.col("anaerobicTrainingEffect"),
    }
    return measured.select(*[c.alias(n) for n, c in fields.items()], *keep)


def normalise_weather(payload: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per-activity weather: ``weather_json`` (array or object) to the six fields."""
    first = F.get(F.from_json("weather_json", schemas.WEATHER_PAYLOAD), 0)
    read = payload.withColumn("_w", first)
    w = {
        n: F.col(f"_w.{n}")
        for n in ("temp", "apparentTemp", "relativeHumidity", "windSpeed", "precipitation")
    }
    return read.select(
        "athlete_id",
        "activity_id",
        *keep,
        W.celsius(w["temp"]).alias("weather_temp_c"),
        W.celsius(w["apparentTemp"]).alias("weather_feels_like_c"),
        w["relativeHumidity"].alias("weather_humidity_pct"),
        W.metres_per_second(w["windSpeed"]).alias("weather_wind_speed_ms"),
        W.condition_code(
            F.col("_w.weatherTypeDTO.desc"), F.col("_w.weatherType"), F.col("_w.condition")
        ).alias("weather_condition"),
        w["precipitation"].alias("weather_precipitation_mm"),
    )


# Payload field to raw column.
_STATS = {
    "totalSteps": "steps",
    "totalDistanceMeters": "distance_m",
    "activeKilocalories": "active_calories",
    "bmrKilocalories": "bmr_calories",
    "restingHeartRate": "resting_heart_rate",
    "minHeartRate": "min_heart_rate",
    "maxHeartRate": "max_heart_rate",
    "averageStressLevel": "stress_avg",
    "bodyBatteryChargedValue": "body_battery_charged",
    "bodyBatteryDrainedValue": "body_battery_drained",
    "bodyBatteryHighestValue": "body_battery_high",
    "bodyBatteryLowestValue": "body_battery_low",
    "avgWakingRespirationValue": "avg_waking_respiration_rate",
    "avgSleepRespirationValue": "avg_sleep_respiration_rate",
}
_HRV = {"lastNightAvg": "hrv_avg", "status": "hrv_status"}
_NIGHT = {
    "dailySleepDTO.sleepTimeSeconds": "sleep_seconds",
    "dailySleepDTO.deepSleepSeconds": "deep_sleep_seconds",
    "dailySleepDTO.lightSleepSeconds": "light_sleep_seconds",
    "dailySleepDTO.remSleepSeconds": "rem_sleep_seconds",
    "dailySleepDTO.awakeSleepSeconds": "awake_seconds",
}


def _renamed(fields: dict[str, str], within: str | None = None) -> list[Column]:
    return [F.col(f"{within}.{field}" if within else field).alias(name) for field, name in fields.items()]


def normalise_daily_health(stats: DataFrame, hrv: DataFrame, sleep: DataFrame) -> DataFrame:
    """Three payloads per day to one row; an absent payload leaves nulls."""
    key = ["athlete_id", "date"]
    days, variability = stats.select(*key, *_renamed(_STATS)), hrv.select(*key, *_renamed(_HRV))
    nights = sleep.select(*key, *_renamed(_NIGHT))
    joined = days.join(variability, key, "left").join(nights, key, "left")
    return conform(joined, schemas.DAILY_HEALTH).drop("inserted_at", "updated_at")


def normalise_health_records(records: DataFrame) -> DataFrame:
    """:func:`normalise_daily_health` of records that hold the day's payloads side by side, one record a day: no join.

    A record without ``stats`` is no day.
    """
    names = _renamed(_STATS, "stats") + _renamed(_HRV, "hrv") + _renamed(_NIGHT, "sleep")
    days = records.filter(F.col("stats").isNotNull()).select("athlete_id", "date", *names)
    return conform(days, schemas.DAILY_HEALTH).drop("inserted_at", "updated_at")


def normalise_calendar(payload: DataFrame) -> DataFrame:
    """Monthly calendars to race events, each event once.

    An event near a month's end is listed by both months; the first listing counts.
    Items without any id cannot be matched and are all kept.
    """
    items = payload.select(
        "athlete_id", "month", F.posexplode("calendarItems").alias("position", "item")
    ).filter("item.isRace")
    item = F.col("item")
    target = item["completionTarget"]
    metres = F.when(
        (target["unitType"] == "distance") & (target["unit"] == "meter"), target["value"]
    )
    uuid = F.coalesce(F.nullif(item["shareableEventUuid"], F.lit("")), F.nullif(item["id"], F.lit("")))
    flat = items.select(
        "athlete_id",
        uuid.alias("event_uuid"),
        F.when(uuid.isNull(), F.concat_ws("/", "month", "position")).alias("_unmatched"),
        "month",
        "position",
        item["title"].alias("title"),
        F.to_date(item["date"]).alias("event_date"),
        item["location"].alias("location"),
        metres.alias("distance_m"),
        item["eventTimeLocal"]["startTimeHhMm"].alias("start_time"),
        item["eventTimeLocal"]["timeZoneId"].alias("timezone"),
        F.lit(True).alias("is_race"),
        F.coalesce(item["subscribed"], F.lit(False)).alias("subscribed"),
        item["url"].alias("url"),
    )
    once = first_per_key(flat, ["athlete_id", "event_uuid", "_unmatched"], "month", "position")
    km = F.when(F.col("distance_m") != 0, rnd_pos(F.col("distance_m") / 1000, 3))
    classed = once.withColumn("distance_km", km).withColumn(
        "race_distance_category", A.distance_category(F.col("distance_km"))
    )
    return conform(classed, schemas.CALENDAR_EVENTS).drop("inserted_at", "updated_at")


def normalise_forecast(payload: DataFrame) -> DataFrame:
    """Daily forecast arrays to one row per athlete, city and day: that of the last ``fetch``, if there."""
    daily = F.col("daily")
    fetch = F.col("fetch") if "fetch" in payload.columns else F.lit(0)
    names = ["time", "temperature_2m_min", "temperature_2m_max"]
    names += ["precipitation_sum", "windspeed_10m_max", "weathercode"]
    days = payload.select(
        "athlete_id",
        "city",
        fetch.alias("fetch"),
        F.explode(F.arrays_zip(*[daily[n].alias(n) for n in names])).alias("day"),
    )
    day = F.col("day")

    def reading(name: str) -> Column:
        return rnd(_or_zero(day[name]), 1)

    days = days.withColumn("date", F.to_date(day["time"]))
    # One task reads a file of payloads, and their days are many more: dealt out, no task orders them all. By the fetch
    # too, so that a day that was fetched very often is in several tasks.
    days = days.repartition("athlete_id", "city", "date", "fetch")
    date = F.col("date")
    return latest_per_key(days, ["athlete_id", "city", "date"], "fetch").select(
        "athlete_id",
        "city",
        "date",
        F.date_format(date, "EEEE").alias("day_name"),
        reading("temperature_2m_min").alias("temp_min_c"),
        reading("temperature_2m_max").alias("temp_max_c"),
        W.code_label(day["weathercode"]).alias("condition"),
        reading("windspeed_10m_max").alias("wind_kmh"),
        reading("precipitation_sum").alias("precipitation_mm"),
    )


def clean_activities(df: DataFrame, sequence: str) -> DataFrame:
    """One row per activity (the last by ``sequence``), unreadable dates null."""
    dated = df.withColumns(
        {c: _clock(F.col(c)) for c in ("activity_date", "start_time", "end_time") if c in df.columns}
    )
    return latest_per_key(dated, schemas.KEYS["activities"], sequence)


def newest_first(df: DataFrame) -> DataFrame:
    """Activities in the order in which a reader wants them; not for a load."""
    return df.orderBy(F.col("activity_date").desc_nulls_last(), "athlete_id", "activity_id")
