"""Raw tables: Parquet with a declared schema, and the goals CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza import schemas


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A raw table in its declared schema; columns a file lacks read as null."""
    return spark.read.schema(schemas.TABLES[name]).parquet(path)


def read_goals_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RACE_GOALS).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per raw table."""
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"))
        for name, df in tables.items()
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
