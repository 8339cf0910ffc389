"""Schema-driven reshaping."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` by name: missing ones null, others dropped, all cast."""
    have = dict(df.dtypes)

    def column(f: T.StructField) -> str:
        kind = f.dataType.simpleString()
        if have.get(f.name) == kind:
            return f"`{f.name}`"
        source = f"`{f.name}`" if f.name in have else "NULL"
        return f"CAST({source} AS {kind}) AS `{f.name}`"

    return df.selectExpr(*[column(f) for f in schema.fields])


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Nested records as ``parent_child`` columns, at any depth."""

    def leaves(schema: T.StructType, path: tuple[str, ...]) -> Iterator[Column]:
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, here)
            else:
                yield F.col(".".join(f"`{p}`" for p in here)).alias(sep.join(here))

    return df.select(*leaves(df.schema, ()))


def repeats(df: DataFrame, keys: list[str]) -> bool:
    """Whether rows share a key. Only keys are shuffled."""
    return not df.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").isEmpty()


def latest_per_key(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The row with the greatest ``order`` per key.

    An aggregate, so copies of one key shrink to one row in every map task before the
    shuffle; a key with very many copies cannot fill a task.
    """
    rest = [c for c in df.columns if c not in {*keys, *order}]
    best = F.max(F.struct(*order, *rest)).alias("_row")
    out = df.groupBy(*keys).agg(best)
    return out.select(*[F.col(c if c in keys else f"_row.{c}").alias(c) for c in df.columns])


def first_per_key(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The row with the least ``order`` per key, as an aggregate too."""
    rest = [c for c in df.columns if c not in {*keys, *order}]
    best = F.min(F.struct(*order, *rest)).alias("_row")
    out = df.groupBy(*keys).agg(best)
    return out.select(*[F.col(c if c in keys else f"_row.{c}").alias(c) for c in df.columns])
