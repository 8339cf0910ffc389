"""Raw tables projected from the star-schema test tables (orders, lineitem, customer)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza import schemas
from cadenza.operators.layout import enough_tasks
from cadenza.operators.shaping import conform
from cadenza.session import new_path
from cadenza.sources import star_mapping as M
from cadenza.sources.bronze import read_table

AS_OF = dt.date.fromisoformat(M.AS_OF)
LOADED_AT = dt.datetime.fromisoformat(M.LOADED_AT)


def _build(df: DataFrame, base: dict[str, str], steps: list[dict[str, str]], keep: list[str]):
    def texts(columns: dict[str, str]) -> list[str]:
        return [f"{t.replace('{ntz}', '_NTZ')} AS {n}" for n, t in columns.items()]

    out = df.selectExpr(*keep, *texts(base))
    for step in steps:
        out = out.selectExpr("*", *texts(step))
    return out


# Tables already written by this application: (application, directory, table) to path.
_written: dict[tuple[str, str, str], str] = {}


def _write(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


class StarTables:
    """Raw tables over one directory of test tables.

    The projection stands in for a load: it is written once per application to the
    shared work folder, and queries read the raw table from there, in its declared
    schema and with filters and columns pushed into the scan.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _once(
        self, name: str, derived: Callable[[], DataFrame], write: Callable[[DataFrame, str], None] = _write
    ) -> str:
        """Path of a derived table, written when first asked for."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _written:
            path = new_path(self.spark, name)
            write(derived(), path)
            _written[key] = path
        return _written[key]

    def projected(self, name: str) -> DataFrame:
        """A raw table as a load would store it, computed where it is read: for a job that reads it once."""
        sources = {
            "activities": lambda: self.keyed_activities,
            "daily_health": lambda: self.keyed_health,
            "calendar_events": lambda: self.keyed_calendar,
            "race_goals": self._projected_goals,
            "analysis_log": lambda: _build(self.orders.filter(M.LOG_FILTER), M.LOG_BASE, [], []),
        }
        return conform(sources[name](), schemas.TABLES[name])

    def _raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self._once(name, lambda: self.projected(name)), name)

    @cached_property
    def orders(self) -> DataFrame:
        return self._orders()

    def _orders(self, *tasks: int) -> DataFrame:
        orders = self._read("orders")
        # The test tables are one file each, which one task would read.
        return orders.repartition(*tasks, "o_orderkey").select(
            "o_orderpriority",
            F.col("o_orderkey").alias("k"),
            F.col("o_custkey").alias("c"),
            F.col("o_orderdate").alias("order_ts"),
            F.expr("o_orderdate + INTERVAL '1' SECOND * ((o_orderkey * 37) % 86400)").alias("ts"),
        )

    @cached_property
    def keyed_activities(self) -> DataFrame:
        """Raw activities with the order and customer key still there."""
        return _build(self.orders, M.ACTIVITY_BASE, M.ACTIVITY_STEPS, ["k", "c", "order_ts"])

    @cached_property
    def activities(self) -> DataFrame:
        return self._raw("activities")

    @cached_property
    def keyed_health(self) -> DataFrame:
        """Raw health days with their number still there, from the days and quantities, which are written once."""
        path = self._once("health-days", self._health_days)
        days = self.spark.read.schema("athlete_id BIGINT, d DATE, q BIGINT").parquet(path)
        numbered = days.withColumn("h", F.col("athlete_id") * 31 + F.unix_date("d") * 17)
        return _build(numbered, M.HEALTH_BASE, M.HEALTH_STEPS, ["h", "d"])

    def _health_days(self) -> DataFrame:
        lines = self._read("lineitem").select(
            F.col("l_orderkey").alias("k"), "l_quantity", F.to_date("l_shipdate").alias("d")
        )
        tasks = enough_tasks(lines)
        joined = lines.join(self._orders(*tasks).select("k", "c"), "k")
        shipped = joined.select(F.expr(M.ATHLETE).alias("athlete_id"), "d", "l_quantity")
        if tasks:
            shipped = shipped.repartition(*tasks, "athlete_id", "d")
        return shipped.groupBy("athlete_id", "d").agg(F.sum("l_quantity").cast("bigint").alias("q"))

    @cached_property
    def daily_health(self) -> DataFrame:
        return self._raw("daily_health")

    @cached_property
    def keyed_calendar(self) -> DataFrame:
        urgent = self.orders.filter(M.CALENDAR_FILTER)
        return _build(urgent, M.CALENDAR_BASE, M.CALENDAR_STEPS, ["k", "c", "order_ts"])

    @cached_property
    def calendar_events(self) -> DataFrame:
        return self._raw("calendar_events")

    @cached_property
    def race_goals(self) -> DataFrame:
        return self._raw("race_goals")

    @cached_property
    def analysis_log(self) -> DataFrame:
        return self._raw("analysis_log")

    def _projected_goals(self) -> DataFrame:
        per_day = (
            self.keyed_activities.filter(M.GOAL_FILTER)
            .groupBy("athlete_id", F.to_date("activity_date").alias("race_date"))
            .agg(
                F.min(F.expr(M.GOAL_SECONDS)).alias("goal_time_seconds"),
                F.min("k").alias("k"),
                F.min("distance_km").alias("distance_km"),
            )
        )
        return per_day.selectExpr(
            "*",
            "concat('Goal ', k) AS race_name",
            f"{M.CALENDAR_STEPS[1]['race_distance_category']} AS race_distance_category",
            "format_string('%d:%02d:%02d', goal_time_seconds div 3600,"
            " goal_time_seconds % 3600 div 60, goal_time_seconds % 60) AS goal_time_formatted",
            "CASE WHEN k % 4 <> 3 THEN 'steady start' END AS notes",
        )
