"""The daily build: raw tables to stored marts and named views."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.operators.layout import enough_tasks, store_bucketed
from cadenza.operators.versions import VersionedTable
from cadenza.plans import health, race, staging, training, unified
from cadenza.session import new_path


def register_views(
    raw: dict[str, DataFrame], as_of: dt.date, prefix: str = ""
) -> dict[str, DataFrame]:
    """Silver views: staging and unified activities, computed when read."""
    activities = staging.stage_activities(raw["activities"])
    days = staging.stage_health(raw["daily_health"])
    views = {
        "stg_activities": activities,
        "stg_health": days,
        "stg_calendar": staging.stage_calendar(raw["calendar_events"], as_of),
        "int_unified": unified.unify(activities, days),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return views


def store_silver(
    raw: dict[str, DataFrame], buckets: int, prefix: str = ""
) -> dict[str, DataFrame]:
    """Staged activities and health as tables bucketed by (athlete, day).

    Joining activities with health, and summing activities per day for the race mart,
    then need no shuffle; staging is computed once for all that reads it.
    """
    staged = {
        "stg_activities": (staging.stage_activities(raw["activities"]), "activity_date"),
        "stg_health": (staging.stage_health(raw["daily_health"]), "health_date"),
    }
    stored = {}
    for name, (df, day) in staged.items():
        store_bucketed(df, prefix + name, ["athlete_id", day], buckets)
        stored[name] = df.sparkSession.table(prefix + name)
    return stored


def stage_once(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Staging as the marts read it: activities, which two marts read several times, from a table in the work folder.

    There ``is_race`` and the distance class are columns, on which a scan can filter.
    """
    activities = staging.stage_activities(raw["activities"])
    path = new_path(activities.sparkSession, "stg-activities")
    activities.write.parquet(path, compression="zstd")
    return {
        "stg_activities": activities.sparkSession.read.schema(activities.schema).parquet(path),
        "stg_health": staging.stage_health(raw["daily_health"]),
    }


def marts(
    raw: dict[str, DataFrame], silver: dict[str, DataFrame] | None = None, tasks: tuple[int, ...] = ()
) -> dict[str, DataFrame]:
    """Gold marts as lazy DataFrames, from stored staging tables where given; the race mart in so many ``tasks``."""
    if silver is None:
        silver = {
            "stg_activities": staging.stage_activities(raw["activities"]),
            "stg_health": staging.stage_health(raw["daily_health"]),
        }
    activities = silver["stg_activities"]
    return {
        "mart_training": training.mart_training(activities),
        "mart_health": health.mart_health(silver["stg_health"]),
        "mart_race": race.mart_race(activities, raw["race_goals"], tasks),
    }


class MartTable(VersionedTable):
    """A mart in folders by bucket of the athlete, sorted by athlete: a reader of some athletes opens their buckets.

    A rebuild of some athletes stores their buckets anew, with the rows of the bucket's other athletes as they
    were; all other buckets keep their files. A reader sees all of the old mart or all of the new. Choose the
    buckets so that one is some hundred megabytes; the count is fixed when a mart is first written.
    """

    BUCKET = "athlete_bucket"
    ATHLETE = "athlete_id"

    def __init__(self, spark: SparkSession, path: str, buckets: int = 8, keep: int = 10):
        super().__init__(spark, path, {self.BUCKET: T.IntegerType()}, keep)
        self.buckets = buckets

    def _bucket(self, athlete: Column) -> Column:
        return F.pmod(F.xxhash64(athlete.cast("long")), F.lit(self.buckets)).cast("int")

    def with_bucket(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(self.BUCKET, self._bucket(F.col(self.ATHLETE)))

    def deal(self, rows: DataFrame, tasks: tuple[int, ...] = ()) -> DataFrame:
        """Rows that a mart is made of, with their bucket and dealt out as the mart is stored, to so many ``tasks``.

        What is computed per (bucket, athlete) from them is written where it is, by :meth:`write_dealt`: the narrow
        rows are shuffled once, the wide ones not at all.
        """
        return self.with_bucket(rows).repartitionByRange(*tasks, self.BUCKET, self.ATHLETE)

    def _place(self, rows: DataFrame) -> None:
        self._add(self.with_bucket(rows), [self.ATHLETE])

    def write(self, rows: DataFrame) -> None:
        """Store the mart, rebuilt in full."""
        with self.load():
            self._drop(list(self._open.parts))
            self._place(rows)

    def write_dealt(self, rows: DataFrame) -> None:
        """Store the mart, rebuilt in full from rows that :meth:`deal` gave; they still have their bucket."""
        with self.load():
            self._drop(list(self._open.parts))
            self._add(rows, [self.ATHLETE], dealt=True)

    def rebuild(self, rows: DataFrame, athletes: DataFrame, dealt: bool = False) -> None:
        """Store the rows of some athletes, who are all in ``athletes``, in place of what they had.

        ``dealt`` says that the rows were computed from what :meth:`deal` gave and have their bucket; they are then
        written where they are, beside the rows of the bucket's other athletes.
        """
        athletes = athletes.select(self.ATHLETE).distinct()
        # at most as many as there are buckets, so safe to collect
        touched = {str(r[0]) for r in athletes.select(self._bucket(F.col(self.ATHLETE))).distinct().collect()}
        with self.load():
            held = {b: loads for b, loads in self._open.parts.items() if b in touched}
            mart = T.StructType([f for f in rows.schema if f.name != self.BUCKET])
            others = self._rows(mart, held).select(*mart.names).join(athletes, self.ATHLETE, "left_anti")
            others = others.select(*mart.names)
            self._drop(list(held))
            if dealt:
                self._place(others)
                self._add(rows, [self.ATHLETE], dealt=True)
            else:
                self._place(others.unionByName(rows))

    def read(self, athletes: list[int] | None = None, version: int | None = None) -> DataFrame:
        """The mart; of some athletes only, from their buckets; or an older version that is still kept."""
        held = (self.version() if version is None else self.log.at(version)).parts
        if not held:
            raise FileNotFoundError(f"no mart at {self.path}")
        if athletes is not None:
            own = self.spark.sql("SELECT 1").select(F.array(*[self._bucket(F.lit(a)) for a in athletes])).first()[0]
            held = {b: held[b] for b in map(str, own) if b in held} or dict([next(iter(held.items()))])
        paths = [f"{self.log.data}/{self.LOAD}={load}/{self.BUCKET}={b}" for b in held for load in held[b]]
        rows = self.spark.read.option("basePath", self.log.data).parquet(*paths).drop(self.LOAD, self.BUCKET)
        return rows if athletes is None else rows.filter(F.col(self.ATHLETE).isin(athletes))


def write_mart(df: DataFrame, path: str) -> None:
    """Store a mart, rebuilt in full."""
    MartTable(df.sparkSession, path).write(df)


def write_health(raw_days: DataFrame, path: str) -> None:
    """Store the health mart of raw health days, rebuilt in full: the raw days are all that is shuffled."""
    table = MartTable(raw_days.sparkSession, path)
    dealt = (table.BUCKET,)
    days = table.deal(raw_days, enough_tasks(raw_days))
    table.write_dealt(health.mart_health(staging.stage_health(days, dealt), dealt))


def write_training(activities: DataFrame, path: str) -> None:
    """Store the weekly mart of staged activities, rebuilt in full: its weeks are shuffled before they grow wide."""
    table = MartTable(activities.sparkSession, path)
    table.write_dealt(_dealt_training(table, activities, enough_tasks(activities)))


def _dealt_training(table: MartTable, activities: DataFrame, tasks: tuple[int, ...]) -> DataFrame:
    deal = partial(table.deal, tasks=tasks)  # weeks are fewer than activities, but counting them would sum them twice
    return training.dealt_mart(activities, deal, (table.BUCKET,), tasks)


def read_mart(spark: SparkSession, path: str, athletes: list[int] | None = None) -> DataFrame:
    return MartTable(spark, path).read(athletes)


def _each(spark: SparkSession, work: dict[str, Callable[[], None]]) -> None:
    """Run the writes side by side: one plans while another computes, and tails of one fill with tasks of another."""
    with ThreadPoolExecutor(len(work)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(fn)) for fn in work.values()]:
            done.result()


def build(
    raw: dict[str, DataFrame], out: str, silver: dict[str, DataFrame] | None = None
) -> dict[str, str]:
    """Write all marts under ``out``; returns their paths. Without stored staging, activities are staged once, and
    health days on the way to their mart."""
    staged = silver or stage_once(raw)
    tasks = () if silver else enough_tasks(staged["stg_activities"])  # stored by athlete and day, they are not shuffled
    made = marts(raw, staged, tasks)
    paths = {name: f"{out}/{name}" for name in made}
    spark = raw["activities"].sparkSession
    work: dict[str, Callable[[], None]] = {name: partial(write_mart, df, paths[name]) for name, df in made.items()}
    if silver is None:
        work["mart_training"] = partial(write_training, staged["stg_activities"], paths["mart_training"])
        work["mart_health"] = partial(write_health, raw["daily_health"], paths["mart_health"])
    _each(spark, work)
    return paths


def update(
    raw: dict[str, DataFrame],
    out: str,
    activities: DataFrame | None = None,
    days: DataFrame | None = None,
    goals: DataFrame | None = None,
) -> None:
    """Rebuild the marts under ``out`` for the athletes whose activities, health days or goals have changed.

    The three hold ``athlete_id``, as ``MonthTable.changed`` gives it. What an athlete's rows say depends on all of the
    athlete's days (records, running counts), so an athlete is computed whole; nobody else is. The athletes are written
    first: as a small table Spark broadcasts them, so neither raw rows nor the marts' are shuffled to be held against them.
    """
    spark = raw["activities"].sparkSession

    def of(name: str, athletes: DataFrame) -> DataFrame:
        return raw[name].join(athletes, "athlete_id", "left_semi")

    work: dict[str, Callable[[], None]] = {}
    changed = None if activities is None else _listed(activities)
    if changed is not None:
        work["mart_training"] = partial(
            _rebuild_training, staging.stage_activities(of("activities", changed)), f"{out}/mart_training", changed
        )
    if days is not None:
        ids = _listed(days)
        rows = health.mart_health(staging.stage_health(of("daily_health", ids)))
        work["mart_health"] = partial(_rebuild, rows, f"{out}/mart_health", ids)
    racing = [df.select("athlete_id") for df in (changed, goals) if df is not None]
    if racing:
        ids = changed if goals is None else _listed(reduce(DataFrame.unionByName, racing))
        staged = staging.stage_activities(of("activities", ids))
        rows = race.mart_race(staged, of("race_goals", ids), enough_tasks(staged))
        work["mart_race"] = partial(_rebuild, rows, f"{out}/mart_race", ids)
    if work:
        _each(spark, work)


def _listed(athletes: DataFrame) -> DataFrame:
    """The athletes, each once, from a table in the work folder."""
    ids = athletes.select("athlete_id").distinct()
    path = new_path(ids.sparkSession, "athletes")
    ids.write.parquet(path)
    return ids.sparkSession.read.schema(ids.schema).parquet(path)


def _rebuild(rows: DataFrame, path: str, athletes: DataFrame) -> None:
    MartTable(rows.sparkSession, path).rebuild(rows, athletes)


def _rebuild_training(activities: DataFrame, path: str, athletes: DataFrame) -> None:
    table = MartTable(activities.sparkSession, path)
    table.rebuild(_dealt_training(table, activities, enough_tasks(activities)), athletes, dealt=True)
