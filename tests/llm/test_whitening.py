import math

import numpy as np
import pytest

from cadenza.llm import whitening as wh


def spectrum(rng, values):
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    return (q * values) @ q.T


@pytest.mark.parametrize(
    "values",
    [
        [5.0],
        [3.0, 1.0],
        [9.0, 9.0, 9.0, 1.0, 0.0],
        [4.0, 4.0 - 1e-13, 4.0 - 1e-9, 2.0, 2.0, 1e-6, 0.0, 0.0, 0.0, 0.0],
        list(np.linspace(10, 0.1, 64)),
        list(np.geomspace(1e6, 1e-3, 40)),
        [1.0] * 20,
    ],
)
def test_components_of_a_known_spectrum(values):
    matrix = spectrum(np.random.default_rng(len(values)), np.array(values))
    matrix = (matrix + matrix.T) / 2
    got, vectors = wh.leading_components(matrix, 8)
    want = np.linalg.eigvalsh(matrix)[::-1][:8]
    norm = max(values)
    assert np.allclose(got, want, rtol=0, atol=1e-13 * norm * len(values))
    assert np.allclose(vectors @ vectors.T, np.eye(len(got)), atol=1e-12)
    assert np.abs(matrix @ vectors.T - vectors.T * got).max() < 1e-12 * norm * len(values)


def test_matrices_that_fall_apart():
    for matrix in (np.zeros((4, 4)), np.diag([1.0, 7.0, 7.0, 2.0]), np.kron(np.eye(3), np.array([[2.0, 1.0], [1.0, 2.0]]))):
        got, vectors = wh.leading_components(matrix, 3)
        assert np.allclose(got, np.linalg.eigvalsh(matrix)[::-1][:3])
        assert np.allclose(vectors @ vectors.T, np.eye(3), atol=1e-13)
        assert np.allclose(matrix @ vectors.T, vectors.T * got)


def test_sturm_counts_at_zero_pivots():
    diagonal, off = np.array([0.0, 0.0, 0.0]), np.array([1.0, 1.0])
    assert wh.sturm_counts(diagonal, off, np.array([-2.0, -1.0, 0.5, 2.0])).tolist() == [0, 1, 2, 3]


def table(spark, path, rows):
    spark.createDataFrame(
        [(i, v, 1, [0.5], 2.0) for i, v in rows], "vec_id long, embedding array<float>, n long, whitened array<double>, component double"
    ).write.parquet(f"{path}/embeddings.parquet")
    return wh.op11_embedding_whitening(spark, str(path))


def brute(rows):
    fit = [(i, v) for i, v in rows if v and all(e is not None and math.isfinite(e) for e in v)]
    x = [[math.floor(1024 * float(np.float32(e))) + 100000 for e in v] for _, v in fit]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    centred = np.array([[(n * e - s) / n for e, s in zip(r, sums, strict=True)] for r in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(8, int((values > 1e-9 * values[0]).sum()))
    away = [sum((n * e - s) ** 2 for e, s in zip(r, sums, strict=True)) for r in x]
    return fit, away, centred @ vectors[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def rows_of(rng, n, size):
    mix = rng.standard_normal((size, size)) * np.geomspace(1, 0.05, size)
    return [(i, (rng.standard_normal(size) @ mix).astype(np.float32).tolist()) for i in range(n)]


def test_against_brute_force(spark, tmp_path):
    rows = rows_of(np.random.default_rng(3), 60, 12)
    rows += [(60, None), (61, [None] * 12), (62, [1.0] * 11 + [float("nan")]), (63, [float("inf")] + [0.0] * 11), (64, [])]
    rows += [(None, [0.25] * 12), (5, rows[5][1]), (5, rows[5][1]), (65, [0.0] * 12), (66, [1.0] * 11 + [None])]
    got = table(spark, tmp_path, rows).collect()
    fit, away, whitened, explained = brute(rows)
    assert len(got) == 8 * len(fit) and {r.n for r in got} == {len(fit)}
    by = {}
    for r in got:
        by.setdefault(r.vec_id, []).append(r)
    signs = {}
    for (i, _), d, w in zip(fit, away, whitened, strict=True):
        for r in by[i]:
            c = r.component - 1
            assert r.deviation == d
            assert r.explained == pytest.approx(explained[c], rel=1e-9)
            assert abs(r.whitened) == pytest.approx(abs(w[c]), abs=1e-7)
            if abs(w[c]) > 1e-3:
                signs.setdefault(c, set()).add(r.whitened * w[c] > 0)
    assert all(len(s) == 1 for s in signs.values())
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_few_dimensions_no_variance_and_no_rows(spark, tmp_path):
    few = [(i, [float(i % 5), 7.0, float(i % 3)]) for i in range(15)]  # the second has no variance
    got = table(spark, tmp_path / "few", few).collect()
    assert len(got) == 30 and {r.component for r in got} == {1, 2}
    assert got[0].identity_error < 1e-9
    assert table(spark, tmp_path / "same", [(i, [1.0, 2.0]) for i in range(4)]).collect() == []
    none = table(spark, tmp_path / "none", [(1, None), (2, [])])
    assert none.collect() == [] and none.columns[:3] == ["vec_id", "component", "n"]
    assert table(spark, tmp_path / "empty", []).collect() == []


def test_lengths_that_differ_and_large_entries(spark, tmp_path):
    rows = [(i, [float(i), float(i * i)]) for i in range(6)] + [(9, [1.0]), (10, [1.0, 2.0, 3.0]), (11, [1e30, 0.0])]
    got = table(spark, tmp_path, rows).collect()
    assert {r.vec_id for r in got} == set(range(6)) and {r.n for r in got} == {6}


def test_exact_sums_of_large_numbers():
    x = np.array([[1 << 39, -(1 << 39)]], np.int64)
    away = wh._deviations(x, 1 << 30, [5, 7], 1)
    assert away.tolist() == [[(1 << 69) - 5, -(1 << 69) - 7]]
    assert wh._squares(away) == [None]
    assert wh._squares(np.array([[3, 4]])) == [25]


def test_without_a_scale(spark):
    rng = np.random.default_rng(1)
    rows = rows_of(rng, 40, 6)
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    model = wh.fit(vectors, components=6)
    out = wh.transform(vectors, model).collect()
    white = np.array([r.whitened for r in out])
    assert np.allclose(white.T @ white / len(white), np.eye(6), atol=1e-10)
    assert wh.identity_error(vectors, model) < 1e-10
    assert all(r.deviation is None for r in out)
