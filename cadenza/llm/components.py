"""Connected components of a graph given by its edges, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm import common


def _least_neighbour(edges: DataFrame, tasks: int) -> DataFrame:
    """Edges both ways with ``m``, the least of a vertex and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("_least")).coalesce(tasks)
    return both.join(least, "u").select("u", "v", F.least("u", "_least").alias("m"))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """Rows (vertex, component) for every vertex of an edge ``u``, ``v``; the component is its least vertex.

    Each round hangs the larger neighbours of every vertex on its least one, then the smaller ones. The number
    of rounds grows with the logarithm of the graph. Neighbours are reduced to their minimum and never
    gathered, so a vertex of any degree is no group in memory. Every round's edges are written. ``rows`` is the
    number of edges, if known.
    """
    edges = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = common.written(edges, "edges", rows)
    state = _state(edges)
    while state[0]:
        rows = state[0]
        tasks = common.row_groups(rows, 100_000)
        hung = _least_neighbour(edges, tasks).where("v > u AND v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = common.written(hung.coalesce(tasks).distinct(), "edges", rows)
        least = large.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks)
        joined = large.join(least, "u")
        small = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(joined.select("u", F.col("m").alias("v"))).coalesce(tasks).distinct()
        before, edges = edges, common.written(small, "edges", rows)
        new = _state(edges)
        common.drop_written(before)
        common.drop_written(large)
        if new == state:
            break
        state = new
    roots = edges.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("vertex"), F.col("v").alias("component")).union(roots)
