import re
from collections import defaultdict

import pytest

from cadenza.llm import mixing


def plain_targets(sizes, weights=(1, 2, 3), most=3.0):
    """Shares by weight, again and again with the excess of those above their cap, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = dict.fromkeys(names, 0.0), set(names), float(sum(sizes.values()))
    while left > 1e-9 and free:
        total = sum(weight[s] for s in free)
        for s in free:
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(free):
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                free.discard(s)
    return target


def words(n, tag):
    return " ".join(f"{tag}{i}" for i in range(n))


SIZES = {"b": [5, 0, 40, 3], "a": [1], "é": [300, 200], None: [7, 1], "zero": [0, 0], "c": [2000, 1, 64], "": [16]}


@pytest.fixture(scope="module")
def rows():
    out = []
    for s, found in SIZES.items():
        out += [(len(out) + i, words(n, f"d{len(out) + i}_") if n else None, "en", s) for i, n in enumerate(found)]
    out += [(2, out[2][1], "en", "b"), (None, words(9, "null"), "en", "a"), (500, " \n\t ", None, "c")]
    return out


@pytest.mark.parametrize("block", [1, 4, 64, 5000])
def test_taken_words(spark, frame, rows, block):
    docs = frame(rows)
    sized, taken = mixing.mix(docs, block_words=block, shard_slots=16)
    sized, taken = sized.collect(), taken.collect()
    size = defaultdict(int)
    for _, t, _, s in rows:
        size[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = plain_targets(size)
    assert len(sized) == len(rows)
    own = {(r.id, r.n): r for r in sized}
    got, seen = defaultdict(int), defaultdict(int)
    for r in sized:
        assert r.source_size == size[r.source]
        assert r.target == pytest.approx(want[r.source])
    for r in taken:
        source = own[r.id, r.n].source
        assert 0 <= r.lo < r.hi <= own[r.id, r.n].size
        got[source] += r.hi - r.lo
        for w in range(r.lo, r.hi):
            seen[r.id, r.n, r["pass"], w] += 1
    assert max(seen.values()) == 1  # a pass takes no word twice
    assert max(r["pass"] for r in taken) <= 2
    for s in size:
        assert got[s] == pytest.approx(want[s], abs=0.5001)


def test_passes_use_different_orders_and_reruns_agree(spark, frame, rows):
    docs = frame(rows)
    a = {tuple(r) for r in mixing.mix(docs, block_words=4)[1].collect()}
    b = {tuple(r) for r in mixing.mix(docs.repartition(5), block_words=4)[1].collect()}
    c = {tuple(r) for r in mixing.mix(docs, block_words=4, seed=2)[1].collect()}
    assert a == b != c


def test_slots_are_dealt_to_tasks(spark, frame, rows, monkeypatch):
    """Few slots a task and shards a window change nothing; an exchange stands before each explode."""
    docs = frame(rows)
    want = {tuple(r) for r in mixing.mix(docs, block_words=4, shard_slots=3)[1].collect()}
    for name, value in (("SLOT_RUN", 5), ("TASK_SLOTS", 9), ("SHARD_GROUP", 2)):
        monkeypatch.setattr(mixing, name, value)
    assert want == {tuple(r) for r in mixing.mix(docs, block_words=4, shard_slots=3)[1].collect()}
    sized = spark.createDataFrame([("a", 10**6), ("b", 10)], "source string, size long")
    found = mixing.slots(mixing.source_targets(sized), 1000, 8, 1)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("explode(sequence") < plan.index("RepartitionByExpression")
    most = found.groupBy(mixing.F.spark_partition_id()).count().agg(mixing.F.max("count")).first()[0]
    assert most < found.count() / 4


def test_permutation(spark):
    for n in (1, 2, 3, 10, 97, 1000):
        df = spark.range(n).select(mixing.permuted(mixing.F.col("id"), mixing.F.lit(n), mixing.F.lit("k")).alias("p"))
        found = [r.p for r in df.collect()]
        assert sorted(found) == list(range(n))
        assert n < 90 or found != list(range(n))


def test_documents_of_the_mix(spark, frame, rows):
    docs = frame(rows)
    out = mixing.mixed_documents(docs, block_words=4)
    assert out.columns == docs.columns
    sized, taken = mixing.mix(docs, block_words=4)
    count = defaultdict(int)
    for r in taken.collect():
        count[r.id] += r.hi - r.lo
    got = defaultdict(int)
    for r in out.collect():
        got[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text)
    assert got == count


def test_empty(spark, frame):
    for rows in ([], [(1, None, None, None)], [(1, "", "en", "a"), (2, " ", "en", "b")]):
        sized, taken = mixing.mix(frame(rows))
        assert sized.count() == len(rows) and taken.count() == 0
        assert mixing.mixed_documents(frame(rows)).count() == 0


def test_query(spark, sf_dir):
    got = mixing.op3_source_mixing(spark, sf_dir)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    rows = got.collect()
    assert all(r.taken <= 3 * r["size"] for r in rows)
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    total, target = defaultdict(int), {}
    for r in rows:
        total[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    assert all(abs(total[s] - target[s]) <= 0.5001 for s in total)
