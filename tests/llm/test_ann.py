import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.llm import ann


def frame_of(spark, rows):
    return spark.createDataFrame([(i, v, 3, "x") for i, v in rows], "vec_id long, embedding array<double>, rank int, id string")


def plain(rows, query, k):
    """By definition: all pairs of usable vectors."""
    use = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v]
    use = [(i, v) for i, v in use if np.isfinite(v).all() and v.any()]
    width = max({len(v) for _, v in use}, key=lambda n: (sum(len(v) == n for _, v in use), -n), default=0)
    use = [(i, v) for i, v in use if len(v) == width]
    out = {}
    for i, q in use:
        if query(i):
            best = {}
            for j, v in use:
                if i != j:
                    best[j] = max(best.get(j, -np.inf), float((v * q).sum()))
            for j, s in best.items():
                out.setdefault(i, {})[j] = max(out.get(i, {}).get(j, -np.inf), s)
    return {i: sorted(((-s, j) for j, s in found.items()))[:k] for i, found in out.items()}


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        found = out.setdefault(r.query_id, [])
        assert r.rank == len(found) + 1
        found.append((-r.score, r.vec_id))
    return out


def same(a, b):
    assert a.keys() == b.keys()
    for i in a:
        assert [x[1] for x in a[i]] == [x[1] for x in b[i]]
        assert [x[0] for x in a[i]] == pytest.approx([x[0] for x in b[i]], rel=1e-14)


@pytest.mark.parametrize("seed", range(2))
def test_exact_if_all_leaves_are_taken(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(400)]
    rows += [(1000 + i, [1.0, 2.0, 0.5, 0.0, 0.0, 0.0]) for i in range(90)]  # ties
    rows += [(600, None), (620, [0.0] * 6), (640, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (660, [float("nan")] + [1.0] * 5)]
    rows += [(680, [float("inf")] + [0.0] * 5), (700, []), (720, [1.0, 2.0]), (None, [1.0] * 6), (20, rng.normal(size=6).tolist())]
    df = frame_of(spark, rows)
    found = ann.nearest(df, F.col("vec_id") % 20 == 0, k=7, visits=9.0, leaves=16, shard_rows=30, query_rows=10)
    same(got(found), plain(rows, lambda i: i % 20 == 0, 7))


def test_few_candidates_are_all_returned(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(15)]
    same(got(ann.nearest(frame_of(spark, rows), F.col("vec_id") == 0, visits=0.0)), plain(rows, lambda i: i == 0, 20))
    same(got(ann.nearest(frame_of(spark, rows[:1]), F.col("vec_id") == 0)), {})


def test_empty(spark):
    assert ann.nearest(frame_of(spark, []), F.col("vec_id") % 20 == 0).collect() == []
    assert ann.nearest(frame_of(spark, [(0, None), (20, [0.0])]), F.col("vec_id") % 20 == 0).collect() == []


def recall(found, want):
    return np.mean([len({j for _, j in found.get(i, [])} & {j for _, j in w}) / len(w) for i, w in want.items()])


def test_recall_of_unstructured_vectors_of_many_norms(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=32) * rng.uniform(0.5, 2)).tolist()) for i in range(3000)]
    found = got(ann.nearest(frame_of(spark, rows), F.col("vec_id") % 20 == 0))
    assert recall(found, plain(rows, lambda i: i % 20 == 0, 20)) >= 0.9


def test_query(spark, sf_dir):
    data = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    rows = [(r.vec_id, list(r.embedding)) for r in data]
    want = plain(rows, lambda i: i % 20 == 0, 20)
    found = got(ann.op1_forest_ann(spark, sf_dir))
    assert found.keys() == want.keys() and all(len(v) == 20 for v in found.values())
    assert recall(found, want) >= 0.9
