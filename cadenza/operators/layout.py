"""Stored layouts that let a later join or group skip its shuffle, and how many tasks a large table needs."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Rows that one task sorts in a fraction of its memory, also with the some forty columns of a staged table.
ROWS_A_TASK = 500_000
# How many times as many rows a task may get before a shuffle takes more tasks than Spark fills without sorting.
UNSORTED_TIMES = 3


def enough_tasks(rows: DataFrame) -> tuple[int, ...]:
    """Number of tasks to shuffle as many rows to, as the first arguments of ``repartition`` and its like; empty where
    the session's own number is enough.

    The session's number is fixed: with it, a task's rows grow with the table until its sorts write them to disk. The
    rows are counted; of a stored Parquet table that reads file footers only.

    For more tasks than ``spark.shuffle.sort.bypassMergeThreshold`` Spark sorts what a map task sends, and writes it
    to disk once more if it is much; so that number is not passed as long as the tasks can hold the rows.
    """
    spark = rows.sparkSession
    own = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    unsorted = int(spark.sparkContext.getConf().get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    return _tasks(rows.count(), own, unsorted)


def _tasks(rows: int, own: int, unsorted: int) -> tuple[int, ...]:
    needed = -(-rows // ROWS_A_TASK)
    fewest = -(-needed // UNSORTED_TIMES)
    needed = max(fewest, min(needed, unsorted))
    return (needed,) if needed > own else ()


def store_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int) -> None:
    """Store a table bucketed and sorted by ``keys``.

    Two tables stored with the same keys and bucket count join on them without a shuffle
    or sort. One task writes one bucket (a rebalanced write would scatter buckets over
    files), so choose the count for the size: a few hundred megabytes per bucket.
    """
    (
        df.repartition(buckets, *keys)
        .write.mode("overwrite")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(table)
    )
