"""Landed JSON files to raw tables, each file once.

A file stream with ``availableNow`` takes what has landed since the last run, like the
scheduled 7-day re-fetch it stands for. Re-fetched records carry the same keys, so the
keyed load makes a repeat harmless and late records need no watermark.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza import schemas
from cadenza.operators.keyed import MonthTable
from cadenza.operators.shaping import latest_per_key, repeats
from cadenza.sources import landed

# A landed record carries the number of its fetch; of one key the last fetch counts.
ACTIVITY_RECORD = schemas.ACTIVITY_PAYLOAD + ", weather_json STRING, fetch INT"
HEALTH_RECORD = f"""
    athlete_id BIGINT, date DATE, fetch INT,
    stats STRUCT<{schemas.STATS_PAYLOAD.split('DATE,', 1)[1]}>,
    hrv STRUCT<{schemas.HRV_PAYLOAD.split('DATE,', 1)[1]}>,
    sleep STRUCT<{schemas.SLEEP_PAYLOAD.split('DATE,', 1)[1]}>
"""
CALENDAR_RECORD = schemas.CALENDAR_PAYLOAD + ", fetch INT"

#: Where a line that is no JSON is kept, and the fields without which a record is of no use.
BROKEN = "_broken"
RECORD_KEYS = {
    "activities": ("athlete_id", "activityId"),
    "daily_health": ("athlete_id", "date"),
    "calendar_events": ("athlete_id", "month"),
}
_DATES = {"activities": "activity_date", "daily_health": "date", "calendar_events": "event_date"}
#: A health day's date is in its key, and an activity's id stands for one recorded start; race events are moved.
_STAYS = {"activities", "daily_health"}


def raw_table(spark: SparkSession, path: str, name: str, buckets: int = 2) -> MonthTable:
    """A raw table; give it as many buckets as make a month's bucket a few hundred megabytes."""
    return MonthTable(
        spark, path, schemas.TABLES[name], schemas.KEYS[name], _DATES[name], buckets, stays=name in _STAYS
    )


def load_activities(table: MonthTable, records: DataFrame, loaded_at: dt.datetime) -> None:
    """Insert unseen activities, then fill weather that stored ones lack."""
    last = latest_per_key(records, ["athlete_id", "activityId"], "fetch")
    base = landed.normalise_activities(last, keep=("weather_json",))
    batch = table.stage(landed.normalise_weather(base, keep=tuple(base.columns[2:-1])))
    with table.load():
        table.insert_new(batch, loaded_at)
        table.backfill_weather(batch, loaded_at)


def load_health(table: MonthTable, records: DataFrame, loaded_at: dt.datetime) -> None:
    """Insert unseen days; a stored day is not touched again."""
    if repeats(records, ["athlete_id", "date"]):
        records = table.stage(latest_per_key(records, ["athlete_id", "date"], "fetch"))
    table.insert_new(landed.normalise_health_records(records), loaded_at)


def load_calendar(table: MonthTable, records: DataFrame, loaded_at: dt.datetime) -> None:
    """Store race events over older versions of themselves."""
    last = latest_per_key(records, ["athlete_id", "month"], "fetch")
    table.replace_by_key(table.stage(landed.normalise_calendar(last)), loaded_at)


LOADERS: dict[str, tuple[str, Callable[[MonthTable, DataFrame, dt.datetime], None]]] = {
    "activities": (ACTIVITY_RECORD, load_activities),
    "daily_health": (HEALTH_RECORD, load_health),
    "calendar_events": (CALENDAR_RECORD, load_calendar),
}


def take_batch(
    table: MonthTable, name: str, batch: DataFrame, stream: str, number: int, loaded_at: dt.datetime, aside: str
) -> int:
    """Load one micro-batch, once: what it stores and that it is in become one version of the table.

    A batch that a stream hands over again, after a failure between the load and the stream's own note of it, is
    not loaded again. Records put aside go to a folder of the batch, which a repeat writes anew. Returns their number.
    """
    last, put_aside = table.last_batch(stream)
    if number <= last:
        return put_aside if number == last else 0
    staged = table.stage(batch)
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in RECORD_KEYS[name]])
    usable = F.col(BROKEN).isNull() & known
    bad = staged.filter(~usable)
    if n := bad.count():
        line = F.coalesce(BROKEN, F.to_json(F.struct(*[c for c in staged.columns if c != BROKEN])))
        late = F.lit(loaded_at.isoformat(sep=" ")).cast("timestamp_ntz")
        folder = f"{aside}/stream={stream}/batch={number}"
        bad.select(line.alias("record"), late.alias("loaded_at")).write.mode("overwrite").parquet(folder)
    with table.load():
        LOADERS[name][1](table, staged.filter(usable).drop(BROKEN), loaded_at)
        table.note_batch(stream, number, n)
    return n


def ingest_incremental(
    spark: SparkSession,
    name: str,
    landing: str,
    table_path: str,
    progress: str,
    loaded_at: dt.datetime,
    quarantine: str | None = None,
) -> int:
    """Load the files that landed since the last run; ``progress`` remembers them.

    Lines that are no JSON, and records without a key, are put aside under ``quarantine`` (beside the
    table, if not given) with the time of the load. Returns how many were. Each batch is loaded exactly once.
    """
    table = raw_table(spark, table_path, name)
    aside = quarantine or f"{table_path.rstrip('/')}-quarantine"
    put_aside = []

    def take(batch: DataFrame, number: int) -> None:
        stream = spark.read.json(f"{progress}/metadata").first().id
        put_aside.append(take_batch(table, name, batch, stream, number, loaded_at, aside))

    stream = (
        spark.readStream.schema(f"{LOADERS[name][0]}, {BROKEN} STRING")
        .option("columnNameOfCorruptRecord", BROKEN)
        .json(landing)
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
    return sum(put_aside)
