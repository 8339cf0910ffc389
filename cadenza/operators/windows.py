"""Windows that stay small however many rows one athlete has.

A day or week table holds at most one row per athlete and calendar day, so a window
over one athlete is bounded by the calendar, not by the data. Activities have no such
bound: one athlete may hold a large share of them. Ordered reads over activities are
therefore split in two. Rows of one day are ordered inside their day, and what a row
needs from earlier days is read from a table with one row per day and joined back on
(athlete, day), which spreads even the busiest athlete over all days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ATHLETE = "athlete_id"


def calendar_window(order: str | tuple[str, ...], *keys: str, dealt: tuple[str, ...] = ()):
    """Ordered window over a table with one row per athlete and calendar step.

    ``dealt`` names columns, one value of each per athlete, by which the rows are dealt out and stored.
    """
    by = (order,) if isinstance(order, str) else order
    return Window.partitionBy(*dealt, ATHLETE, *keys).orderBy(*by)


def last_rows(order: str | tuple[str, ...], n: int, *keys: str, dealt: tuple[str, ...] = ()):
    """Frame of the current row and the ``n - 1`` rows before it."""
    return calendar_window(order, *keys, dealt=dealt).rowsBetween(1 - n, 0)


def whole(*keys: str, dealt: tuple[str, ...] = ()):
    return Window.partitionBy(*dealt, ATHLETE, *keys)


# Parts a busy key is cut into before its final ranking.
SPREAD = 64


def newest_ranked(
    df: DataFrame,
    n: int,
    *order: Column,
    keys: tuple[str, ...] = (ATHLETE,),
    spread_by: str | None = None,
) -> DataFrame:
    """The first ``n`` rows per key in ``order``, with their ``rank``.

    Spark cuts every map partition to ``n`` rows per key before the shuffle. On tables
    without a calendar bound name a row id in ``spread_by``: the rows left of one key are
    then ranked in 64 parts first, so that no task sees n rows from every map task.
    """
    if spread_by is not None:
        part = F.pmod(F.xxhash64(spread_by), F.lit(SPREAD))
        in_part = Window.partitionBy(*keys, "_part").orderBy(*order)
        df = (
            df.withColumn("_part", part)
            .withColumn("_place", F.row_number().over(in_part))
            .filter(F.col("_place") <= n)
            .drop("_part", "_place")
        )
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= n)


def newest(df: DataFrame, n: int, *order: Column, **how) -> DataFrame:
    """:func:`newest_ranked` without the rank."""
    return newest_ranked(df, n, *order, **how).drop("rank")
