"""Whitening of embeddings by their leading principal components.

Three passes over the vectors: exact sums, then the covariance of vectors that are centred before they are
multiplied, then (to measure the result) the covariance of what was whitened. A task adds up its own rows and
hands on one matrix; the matrices are added row by row. What reaches the driver is dimensions x dimensions, whatever
the number of vectors. There the matrix is made tridiagonal by Householder reflections, its leading eigenvalues
are found by bisection on Sturm counts, and their vectors by inverse iteration, orthogonal within clusters
of close values. The projection is broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import common

EPS = np.finfo(float).eps
#: A component with less of the largest component's variance is rounding, not data.
LEAST_SHARE = 1e-11
#: Eigenvalues closer than this share of the matrix's norm are a cluster.
CLUSTER = 1e-3
#: Whole-number entries stay below this, so that sums over a batch are exact.
WHOLE_BOUND = 1 << 40


@dataclass(frozen=True)
class Whitening:
    """Fitted on ``n`` vectors; its size is dimensions x components, never the data."""

    n: int
    sums: list  # per dimension: whole numbers if scaled, else doubles
    values: np.ndarray  # eigenvalues, falling
    components: np.ndarray  # one unit vector a row
    trace: float
    scale: int | None
    offset: int

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace


# -- eigenvalues and eigenvectors of one symmetric matrix ---------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the unit vectors of the Householder reflections that make it so."""
    a = np.array(matrix, float)
    size = len(a)
    reflections = []
    for k in range(size - 2):
        v = a[k + 1 :, k].copy()
        alpha = -np.copysign(np.linalg.norm(v), v[0])
        v[0] -= alpha
        length = np.linalg.norm(v)
        if length > 0:
            v /= length
            block = a[k + 1 :, k + 1 :]
            p = block @ v
            w = p - (v @ p) * v
            block -= 2 * (np.outer(v, w) + np.outer(w, v))
            a[k + 1, k] = alpha
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix are below each of ``at``."""
    tiny = np.finfo(float).tiny * max(1.0, float((off**2).max(initial=0.0)))
    below, q = np.zeros(len(at), int), np.ones(len(at))
    for d, e in zip(diagonal, [0.0, *off], strict=True):
        q = d - at - e * e / q
        q = np.where(np.abs(q) < tiny, -tiny, q)
        below += q < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection to the last bit of the matrix's norm."""
    size = len(diagonal)
    reach = np.zeros(size)
    reach[:-1] += np.abs(off)
    reach[1:] += np.abs(off)
    low, high = (diagonal - reach).min(), (diagonal + reach).max()
    room = EPS * max(abs(low), abs(high)) + np.finfo(float).tiny
    lows, highs = np.full(k, low - room), np.full(k, high + room)
    below = size - np.arange(1, k + 1)  # that many eigenvalues are smaller
    while True:
        middle = (lows + highs) / 2
        if not ((lows < middle) & (middle < highs) & (highs - lows > room / 2)).any():
            return middle
        up = sturm_counts(diagonal, off, middle) <= below
        lows, highs = np.where(up, middle, lows), np.where(up, highs, middle)


def _solver(diagonal: np.ndarray, off: np.ndarray, shift: float, norm: float) -> Callable[[np.ndarray], np.ndarray]:
    """Solves (T - shift) y = b by elimination with row exchanges; a pivot of about zero becomes a tiny one."""
    size, tiny = len(diagonal), EPS * norm
    main, upper, second = (diagonal - shift).tolist(), [*off.tolist(), 0.0], [0.0] * size
    steps = []
    for i in range(size - 1):
        lower = off[i]
        exchange = abs(lower) > abs(main[i])
        if exchange:
            row = (lower, main[i + 1], upper[i + 1])
            main[i + 1], upper[i + 1] = upper[i], second[i]
            lower, (main[i], upper[i], second[i]) = main[i], row
        if abs(main[i]) < tiny:
            main[i] = tiny
        factor = lower / main[i]
        main[i + 1] -= factor * upper[i]
        upper[i + 1] -= factor * second[i]
        steps.append((exchange, factor))
    if abs(main[-1]) < tiny:
        main[-1] = tiny

    def solve(b: np.ndarray) -> np.ndarray:
        y = b.tolist()
        for i, (exchange, factor) in enumerate(steps):
            if exchange:
                y[i], y[i + 1] = y[i + 1], y[i]
            y[i + 1] -= factor * y[i]
        for i in range(size - 1, -1, -1):
            rest = y[i]
            if i + 1 < size:
                rest -= upper[i] * y[i + 1]
            if i + 2 < size:
                rest -= second[i] * y[i + 2]
            y[i] = rest / main[i]
        return np.array(y)

    return solve


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix for falling eigenvalues, one a column."""
    size = len(diagonal)
    norm = float(np.abs(diagonal).max() + 2 * np.abs(off).max(initial=0.0)) or 1.0
    random = np.random.default_rng(size)
    found = np.zeros((size, len(values)))
    shift, start = np.inf, 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * norm:
            start = j
        shift = min(value, shift - 4 * EPS * norm) if j > start else value
        solve = _solver(diagonal, off, shift, norm)
        y = random.standard_normal(size)
        for _ in range(4):
            near = found[:, start:j]
            for _ in range(2):  # twice is enough
                y = y - near @ (near.T @ y)
            y = solve(y / np.linalg.norm(y))
        near = found[:, start:j]
        for _ in range(2):
            y = y - near @ (near.T @ y)
            y /= np.linalg.norm(y)
        found[:, j] = y
    return found


def leading_components(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and unit eigenvectors, one a row.

    Of each vector the entry of largest size is positive. Equal eigenvalues get some orthogonal vectors.
    """
    size = len(matrix)
    k = min(k, size)
    if not k:
        return np.zeros(0), np.zeros((0, size))
    diagonal, off, reflections = tridiagonal(matrix)
    values = leading_values(diagonal, off, k)
    vectors = inverse_iteration(diagonal, off, values)
    for at in range(len(reflections) - 1, -1, -1):
        v = reflections[at]
        vectors[at + 1 :] -= 2 * np.outer(v, v @ vectors[at + 1 :])
    vectors = vectors.T
    largest = vectors[np.arange(k), np.abs(vectors).argmax(axis=1)]
    return values, vectors * np.where(largest < 0, -1.0, 1.0)[:, None]


# -- passes over the vectors ---------------------------------------------------------------


def _usable(column: Column, dimensions: int | None, scale: int | None) -> Column:
    bound = F.lit(float(WHOLE_BOUND) / scale if scale else float("inf"))

    def unfit(e: Column) -> Column:
        return e.isNull() | F.isnan(e) | (F.abs(e) >= bound)

    fits = column.isNotNull() & (F.size(column) > 0) & ~F.exists(column, unfit)
    return fits if dimensions is None else fits & (F.size(column) == dimensions)


def usable(vectors: DataFrame, column: str = "embedding", scale: int | None = None) -> tuple[DataFrame, int]:
    """The rows whose vector takes part, and the number of dimensions (0 without a row).

    No part take vectors that are null, empty or hold null or non-finite entries, nor such of another length than
    most (of equally many, the longest). With ``scale``, an entry whose multiple reaches 2^40 counts as non-finite.
    """
    x = F.col(f"`{column}`").cast("array<double>")
    fit = vectors.where(_usable(x, None, scale))
    lengths = fit.groupBy(F.size(x).alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    size = lengths[0] if lengths else 0
    return vectors.where(_usable(x, size, scale)), size


def _entries(batch: pa.RecordBatch, column: str, dimensions: int, scale: int | None, offset: int) -> np.ndarray:
    """The vectors of a batch, one a row: as they are, or as whole numbers floor(scale * entry) + offset."""
    x = batch.column(batch.schema.get_field_index(column)).flatten().to_numpy(zero_copy_only=False)
    x = x.astype(float).reshape(-1, dimensions)
    return np.floor(x * scale).astype(np.int64) + offset if scale else x


def _sums(rows: DataFrame, column: str, dimensions: int, scale: int | None, offset: int) -> tuple[int, list]:
    """Number of rows and the sum per dimension, exact for whole numbers."""
    kind = "decimal(38, 0)" if scale else "double"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * dimensions
        for batch in batches:
            n += batch.num_rows
            here = _entries(batch, column, dimensions, scale, offset).sum(axis=0).tolist()
            sums = [a + b for a, b in zip(sums, here, strict=True)]
        if scale:
            values = pa.array([Decimal(n), *map(Decimal, sums)], pa.decimal128(38, 0))
        else:
            values = pa.array([float(n), *sums], pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, dimensions), pa.int32()), values], names=["at", "value"])

    found = rows.select(column).mapInArrow(add, f"at int, value {kind}").groupBy("at").agg(F.sum("value").alias("value"))
    by_place = dict(found.collect())
    whole = int if scale else float
    return int(by_place.get(-1, 0)), [whole(by_place.get(i, 0)) for i in range(dimensions)]


def _deviations(x: np.ndarray, model_n: int, sums: list, scale: int | None) -> np.ndarray:
    """n * x - sums in whole numbers, of any size; for doubles x - sums / n."""
    if not scale:
        return x - np.array(sums) / model_n
    largest = max(int(np.abs(x).max(initial=0)) * model_n, max(map(abs, sums), default=0))
    kind = np.int64 if 2 * largest < 1 << 62 else object
    return x.astype(kind) * model_n - np.array(sums, kind)


def _centred(deviations: np.ndarray, n: int, scale: int | None) -> np.ndarray:
    return deviations.astype(float) / n if scale else deviations


def _covariance(
    rows: DataFrame, column: str, size: int, n: int, centred: Callable[[pa.RecordBatch], np.ndarray]
) -> np.ndarray:
    """Covariance with divisor ``n`` of what ``centred`` makes of a batch; what is left of its mean is taken off."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rest = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            x = centred(batch)
            total += x.T @ x
            rest += x.sum(axis=0)
        cells = np.vstack([total, rest])
        places = pa.array(np.arange(0, cells.size + 1, size), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(size + 1), pa.int32()), pa.ListArray.from_arrays(places, pa.array(cells.ravel()))],
            names=["row", "cells"],
        )

    def add(key, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for part in parts:
            flat = part.column(part.schema.get_field_index("cells")).flatten()
            total += flat.to_numpy(zero_copy_only=False).reshape(-1, size).sum(axis=0)
        yield pa.RecordBatch.from_pydict(
            {"row": pa.array([key[0].as_py()], pa.int32()), "cells": pa.array([total], pa.list_(pa.float64()))}
        )

    kind = "row int, cells array<double>"
    # annotated here, as the names in the annotations are not known where Spark looks them up
    add.__annotations__ = {"key": tuple, "parts": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    found = rows.select(column).mapInArrow(multiply, kind).groupBy("row").applyInArrow(add, kind).collect()
    by_row = {r.row: np.array(r.cells) for r in found}
    if not by_row:
        return np.zeros((size, size))
    rest = by_row[size] / n
    return np.vstack([by_row[i] for i in range(size)]) / n - np.outer(rest, rest)


def fit(
    vectors: DataFrame, column: str = "embedding", components: int = 8, scale: int | None = None, offset: int = 0
) -> Whitening | None:
    """The leading components of all vectors that take part; None without such a vector.

    With ``scale`` an entry c stands for the whole number floor(scale * c) + offset, and sums are exact. There are
    as many components as asked for, or fewer if the rest has no variance.
    """
    rows, size = usable(vectors, column, scale)
    if not size:
        return None
    n, sums = _sums(rows, column, size, scale, offset)

    def centred(batch: pa.RecordBatch) -> np.ndarray:
        return _centred(_deviations(_entries(batch, column, size, scale, offset), n, sums, scale), n, scale)

    covariance = _covariance(rows, column, size, n, centred)
    values, found = leading_components(covariance, components)
    real = values > LEAST_SHARE * max(values.max(initial=0.0), np.finfo(float).tiny)
    return Whitening(n, sums, values[real], found[real], float(np.trace(covariance)), scale, offset)


def _whitened(model: Whitening, centred: np.ndarray) -> np.ndarray:
    return centred @ (model.components / np.sqrt(model.values)[:, None]).T


def _squares(deviations: np.ndarray) -> list[int | None]:
    """Sum of squares of each row, exact; None if it is beyond a long."""
    largest = int(np.abs(deviations).max(initial=0))
    if largest * largest * max(deviations.shape[1], 1) < 1 << 63:
        return (deviations.astype(np.int64) ** 2).sum(axis=1).tolist()
    exact = (deviations.astype(object) ** 2).sum(axis=1).tolist()
    return [v if v < 1 << 63 else None for v in exact]


def transform(
    vectors: DataFrame, model: Whitening | None, column: str = "embedding", keep: tuple[str, ...] = ("vec_id",)
) -> DataFrame:
    """``keep``, ``whitened`` (one entry a component) and, for whole numbers, ``deviation``, for rows that take part.

    ``deviation`` is the exact sum over dimensions of (n * x - sums)^2, null if that is beyond a long; it is null
    without a scale. Repeated rows and ids are rows of their own. One pass without a shuffle.
    """
    spark: SparkSession = vectors.sparkSession
    size = len(model.sums) if model else 0
    x = F.col(f"`{column}`").cast("array<double>")
    rows = vectors.where(_usable(x, size, model.scale if model else None)).select(*keep, F.col(f"`{column}`").alias("_vector"))
    schema = rows.drop("_vector").withColumns(
        {"deviation": F.lit(None).cast("long"), "whitened": F.lit(None).cast("array<double>")}
    ).schema
    if model is None:
        return spark.createDataFrame([], schema)
    held = spark.sparkContext.broadcast(model)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Whitening = held.value
        k = len(m.values)
        for batch in batches:
            away = _deviations(_entries(batch, "_vector", size, m.scale, m.offset), m.n, m.sums, m.scale)
            found = _whitened(m, _centred(away, m.n, m.scale))
            places = pa.array(np.arange(batch.num_rows + 1) * k, pa.int32())
            own = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "_vector"]
            names = [name for name in batch.schema.names if name != "_vector"]
            apart = _squares(away) if m.scale else [None] * batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(apart, pa.int64()), pa.ListArray.from_arrays(places, pa.array(found.ravel()))],
                names=[*names, "deviation", "whitened"],
            )

    return rows.mapInArrow(project, schema)


def identity_error(vectors: DataFrame, model: Whitening, column: str = "embedding") -> float:
    """Largest entry, in size, of the covariance of the whitened vectors less the identity; 0 without components."""
    size, k = len(model.sums), len(model.values)
    if not k:
        return 0.0
    rows, _ = usable(vectors, column, model.scale)
    n, sums, scale, offset = model.n, model.sums, model.scale, model.offset

    def centred(batch: pa.RecordBatch) -> np.ndarray:
        return _whitened(model, _centred(_deviations(_entries(batch, column, size, scale, offset), n, sums, scale), n, scale))

    return float(np.abs(_covariance(rows, column, k, n, centred) - np.eye(k)).max())


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's place along the eight leading components of all vectors, with variance one.

    Without a row that takes part, or if the vectors do not differ, there are no components and no rows.
    """
    vectors = common.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = fit(vectors, scale=1024, offset=100_000)
    error = identity_error(vectors, model) if model else 0.0
    share = F.array(*[F.lit(float(x)) for x in model.explained]) if model and len(model.values) else F.lit(None).cast("array<double>")
    return (
        transform(vectors, model)
        .select("vec_id", "deviation", F.posexplode("whitened").alias("_at", "whitened"))
        .select(
            "vec_id",
            (F.col("_at") + 1).alias("component"),
            F.lit(model.n if model else 0).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.get(share, F.col("_at")).alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )
