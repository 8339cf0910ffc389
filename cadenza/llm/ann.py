"""Approximate nearest neighbours by inner product: a forest of random-projection trees.

The trees are fitted on a bounded sample; every vector is then put into one leaf of each tree. A query
walks all trees through one priority queue: it goes down the nearer side of each split and queues the other
with the squares of the margins so far, and takes leaves until enough rows are in them. Leaves are dealt to
shards of bounded size, a large leaf to several, and a query is sent to the shards that hold its leaves. There
its candidates are ranked by their exact inner products.

Largest inner product becomes nearest point by one more coordinate, which lifts all vectors to the norm of
the longest.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.llm import common

#: Vectors that the trees are fitted on: those with the smallest hashes of their ids.
SAMPLE = 50_000
TREES = 4
#: Leaves of a tree, about.
LEAVES = 128
#: Rows in the leaves that a query takes, as a share of all rows; a row counts once in each tree. Vectors
#: without structure need this much for a recall of 0.9; less will do for others.
VISITS = 1.3
SHARD_ROWS = 20_000
#: Queries that meet a shard at once, and those whose scores are held at once.
QUERY_ROWS = 20_000
QUERY_BLOCK = 128


@dataclass(frozen=True)
class Tree:
    """Splits as arrays; a child below 0 is leaf -1 - child."""

    normals: np.ndarray
    thresholds: np.ndarray
    children: np.ndarray
    leaves: int

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int64)
        if not len(self.normals):
            return out
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, at = todo.pop()
            right = points[at] @ self.normals[node] > self.thresholds[node]
            for child, own in zip(self.children[node].tolist(), (at[~right], at[right]), strict=True):
                if child < 0:
                    out[own] = -1 - child
                elif len(own):
                    todo.append((child, own))
        return out


def fit_tree(points: np.ndarray, leaf_rows: int, rng: np.random.Generator) -> Tree:
    """A tree whose splits lie across the line between two sample points, at the median."""
    normals, thresholds, children = [], [], []
    leaves = 0

    def grow(at: np.ndarray) -> int:
        nonlocal leaves
        for _ in range(8):
            if len(at) <= leaf_rows:
                break
            a, b = rng.choice(at, 2, replace=False)
            normal = points[a] - points[b]
            size = np.linalg.norm(normal)
            if not size:
                continue
            along = points[at] @ (normal / size)
            middle = float(np.median(along))
            right = along > middle
            if right.all() or not right.any():
                continue
            me = len(normals)
            normals.append(normal / size)
            thresholds.append(middle)
            children.append([0, 0])
            children[me] = [grow(at[~right]), grow(at[right])]
            return me
        leaves += 1
        return -leaves

    grow(np.arange(len(points)))
    width = points.shape[1]
    return Tree(
        np.array(normals).reshape(-1, width), np.array(thresholds), np.array(children, np.int64).reshape(-1, 2), leaves
    )


def search(trees: list[Tree], sizes: list[np.ndarray], margins: list[np.ndarray], enough: float) -> list[tuple[int, int]]:
    """Leaves (tree, leaf) to look into, nearest first, until they hold ``enough`` rows.

    ``margins`` has, for each tree, the query's signed distance from each split.
    """
    queue = [(0.0, t, 0 if len(tree.normals) else -1) for t, tree in enumerate(trees)]
    found, rows = [], 0
    while queue and rows < enough:
        far, t, node = heapq.heappop(queue)
        if node < 0:
            if sizes[t][-1 - node]:
                found.append((t, -1 - node))
                rows += int(sizes[t][-1 - node])
            continue
        margin = float(margins[t][node])
        left, right = trees[t].children[node].tolist()
        near, other = (right, left) if margin > 0 else (left, right)
        heapq.heappush(queue, (far, t, near))
        heapq.heappush(queue, (far + margin * margin, t, other))
    return found


def shards_of(sizes: list[np.ndarray], shard_rows: int) -> dict[tuple[int, int], tuple[int, int]]:
    """For each leaf its first shard and its number of shards; neighbouring small leaves share one."""
    out, shard, held = {}, 0, 0
    for t, own in enumerate(sizes):
        for leaf, n in enumerate(own.tolist()):
            if n > shard_rows:
                shard += bool(held)
                parts = -(-n // shard_rows)
                out[t, leaf] = (shard, parts)
                shard, held = shard + parts, 0
            else:
                if held and held + n > shard_rows:
                    shard, held = shard + 1, 0
                out[t, leaf] = (shard, 1)
                held += n
    return out


def exact_top(
    rough: np.ndarray, query: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """The k largest inner products of one query, ties to smaller ids, of the rows whose rough score is finite.

    A row may be there several times, once for each tree; an id counts once, with its best score.
    """
    finite = int(np.isfinite(rough).sum())
    n = min(4 * k, finite)
    while n:
        bound = np.partition(rough, len(rough) - n)[len(rough) - n]
        at = np.flatnonzero((rough >= bound - 1e-9 * (1 + abs(bound))) & np.isfinite(rough))
        exact = (vectors[at] * query).sum(axis=1)  # in one order for all pairs, whatever their place
        best = np.lexsort([ids[at], -exact])
        _, first = np.unique(ids[at][best], return_index=True)
        best = best[np.sort(first)]
        if len(best) >= k or n == finite:
            return ids[at][best[:k]], exact[best[:k]]
        n = min(4 * n, finite)
    return ids[:0], rough[:0]


def _usable(vector: Column) -> Column:
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(
        vector, lambda x: x != 0
    )


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    vector: str = "embedding",
    ids: str = "vec_id",
    trees: int = TREES,
    leaves: int = LEAVES,
    visits: float = VISITS,
    sample: int = SAMPLE,
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
    seed: int = 11,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the ``k`` nearest found of each query, without its own id.

    Vectors that are null, zero, or hold a null or non-finite component take no part, nor do rows without
    an id, nor vectors of another length than most have. All candidates are returned if there are no more than
    ``k``. Rows of one id count as one neighbour, with the best of their scores.
    """
    spark: SparkSession = vectors.sparkSession
    own = vectors.select(
        F.col(ids).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("q")
    ).where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & _usable(F.col("v")))
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    shape = own.groupBy(F.size("v").alias("width")).agg(
        F.count("*").alias("n"), F.max(norm).alias("longest"), F.sum(F.col("q").cast("int")).alias("queries")
    )
    shape = shape.orderBy(F.desc("n"), "width").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if shape is None:
        return spark.createDataFrame([], schema)
    width, rows, longest, queries = shape.width, shape.n, float(shape.longest), shape.queries or 0
    own = own.where(F.size("v") == width)

    def lifted(points: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0.0, longest - (points * points).sum(axis=1)))
        return np.column_stack([points, rest])

    drawn = own.select("id", "v").orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(sample).collect()
    points = lifted(np.array([r.v for r in drawn]))
    rng = np.random.default_rng(seed)
    forest = [fit_tree(points, max(8, len(points) // leaves), rng) for _ in range(trees)]
    held_forest = spark.sparkContext.broadcast(forest)

    def matrix(batch: pa.RecordBatch) -> np.ndarray:
        return batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = lifted(matrix(batch)) if batch.num_rows else np.zeros((0, width + 1))
            for t, tree in enumerate(held_forest.value):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(np.full(len(found), t, np.int32)),
                        pa.array(tree.leaf_of(found).astype(np.int32)),
                    ],
                    names=["id", "tree", "leaf"],
                )

    counts = own.select("id", "v").mapInArrow(put, "id long, tree int, leaf int").groupBy("tree", "leaf").count().collect()
    sizes = [np.zeros(max(tree.leaves, 1), np.int64) for tree in forest]
    for r in counts:
        sizes[r.tree][r.leaf] = r["count"]
    where = shards_of(sizes, shard_rows)
    enough = max(visits * rows, trees * (k + 1))
    blocks = common.row_groups(queries, query_rows)
    plan = spark.sparkContext.broadcast((sizes, where))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each vector with its leaf, to the shard of that leaf in every tree."""
        _, shard_of = plan.value
        for batch in batches:
            if not batch.num_rows:
                continue
            found, number = lifted(matrix(batch)), np.array(batch.column(0))
            for t, tree in enumerate(held_forest.value):
                leaf = tree.leaf_of(found)
                first = np.array([shard_of[t, x][0] for x in range(max(tree.leaves, 1))])
                parts = np.array([shard_of[t, x][1] for x in range(max(tree.leaves, 1))])
                mixed = (number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(first[leaf] + (mixed.astype(np.int64) % parts[leaf])),
                        batch.column(0),
                        pa.array((leaf + (t << 20)).astype(np.int64)),
                        batch.column(1),
                    ],
                    names=["shard", "id", "leaf", "v"],
                )

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query with its leaves, to every shard that holds one."""
        own_sizes, shard_of = plan.value
        grown = held_forest.value
        for batch in batches:
            if not batch.num_rows:
                continue
            points = np.column_stack([matrix(batch), np.zeros(batch.num_rows)])
            margins = [points @ tree.normals.T - tree.thresholds for tree in grown]
            shard, row, leaves_of = [], [], []
            for i in range(batch.num_rows):
                per: dict[int, list[int]] = {}
                for t, leaf in search(grown, own_sizes, [m[i] for m in margins], enough):
                    first, parts = shard_of[t, leaf]
                    for s in range(first, first + parts):
                        per.setdefault(s, []).append(leaf + (t << 20))
                for s, found in per.items():
                    shard.append(s)
                    row.append(i)
                    leaves_of.append(found)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shard, pa.int64()),
                    batch.column(0).take(at),
                    pa.array(leaves_of, pa.list_(pa.int64())),
                    batch.column(1).take(at),
                ],
                names=["shard", "query_id", "leaves", "v"],
            )

    def rank(asked: pa.Table, there: pa.Table) -> pa.Table:
        out_q, out_v, out_s = [], [], []
        if asked.num_rows and there.num_rows:
            leaf = there["leaf"].to_numpy()
            order = np.argsort(leaf, kind="stable")
            leaf, number = leaf[order], there["id"].to_numpy()[order]
            points = there["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)[order]
            q = asked["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            leaf_ids, column = np.unique(leaf, return_inverse=True)
            names, wanted = asked["query_id"].to_pylist(), asked["leaves"].to_pylist()
            for first in range(0, len(names), QUERY_BLOCK):
                block = slice(first, first + QUERY_BLOCK)
                looked = np.zeros((len(names[block]), len(leaf_ids)), bool)
                for i, own in enumerate(wanted[block]):
                    at = np.searchsorted(leaf_ids, own)
                    there_too = (at < len(leaf_ids)) & (leaf_ids[np.minimum(at, len(leaf_ids) - 1)] == own)
                    looked[i, at[there_too]] = True
                rough = q[block] @ points.T
                rough[~looked[:, column]] = -np.inf
                for i, name in enumerate(names[block]):
                    rough[i, number == name] = -np.inf
                    found, score = exact_top(rough[i], q[first + i], points, number, k)
                    out_q.append(np.full(len(found), name))
                    out_v.append(found)
                    out_s.append(score)
        empty = [np.zeros(0, np.int64)]
        return pa.table(
            {
                "query_id": pa.array(np.concatenate(out_q or empty), pa.int64()),
                "vec_id": pa.array(np.concatenate(out_v or empty), pa.int64()),
                "score": pa.array(np.concatenate(out_s or [np.zeros(0)]), pa.float64()),
            }
        )

    index = own.select("id", "v").mapInArrow(deal, "shard long, id long, leaf long, v array<double>")
    index = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = own.where("q").select("id", "v").mapInArrow(ask, "shard long, query_id long, leaves array<bigint>, v array<double>")
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    found = (
        asked.groupBy("shard", "block")
        .cogroup(index.groupBy("shard", "block"))
        .applyInArrow(rank, "query_id long, vec_id long, score double")
    )
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op1_forest_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every vector whose id is divisible by 20, among all others."""
    return nearest(common.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
