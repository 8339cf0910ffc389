import math
import random
import re

import numpy as np
import pytest

from cadenza.llm import chosen_path as cp
from cadenza.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    own = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(own) < width:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + width]) for i in range(len(own) - width + 1)}


def plain(rows, width, percent):
    """By definition, over all pairs: (id, size, component, kept) of each row (id, text)."""
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            if min(len(sets[a]), len(sets[b])) * 100 < percent * max(len(sets[a]), len(sets[b])):
                continue
            shared = len(sets[a] & sets[b])
            if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    out = []
    for k, (i, _) in enumerate(rows):
        component = None if i is None else least[root(k)]
        out.append((i, len(sets[k]), component, i is None or component == i))
    return sorted(out, key=str)


def corpus(seed, groups=25):
    rng = random.Random(seed)

    def prose(n):
        return [f"w{rng.randint(0, 400)}" for _ in range(n)]

    out = [None, "", " \n", "One", "one", "one two", "ONE  two", "two one", "one two three", "a\xa0b c d", "x " * 3000]
    shared = prose(12)
    for _ in range(groups):
        base = prose(rng.choice([5, 20, 80, 300]))
        for _ in range(rng.choice([1, 1, 2, 3, 9])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, len(own) // 12])):
                own[rng.randrange(len(own))] = f"e{rng.randint(0, 99)}"
            if rng.random() < 0.3:
                own += shared
            out.append(" ".join(own).capitalize())
    return out


def got(docs, **options):
    return sorted((tuple(r) for r in cp.near_duplicates(docs, **options).collect()), key=str)


@pytest.mark.parametrize("seed,width,percent,node_sets", [(1, 3, 85, 1500), (2, 5, 80, 1500), (3, 3, 85, 4)])
def test_against_brute_force(spark, frame, seed, width, percent, node_sets):
    found = corpus(seed)
    ids = random.Random(seed).sample(range(10 * len(found)), len(found))
    rows = list(zip(ids, found, strict=True))
    rows += [rows[20], (rows[21][0], rows[25][1]), (None, rows[22][1]), (None, None)]
    docs = frame([(i, t, None, None) for i, t in rows])
    assert got(docs, width=width, percent=percent, node_sets=node_sets) == plain(rows, width, percent)


def test_one_large_group_in_small_nodes(spark, frame):
    """A group far larger than a node, in which many are linked with one document only."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        own = list(base)
        for k in rng.sample(range(60), rng.choice([0, 1, 1, 2])):
            own[k] = f"e{i}_{k}"
        rows.append((1000 - i, " ".join(own)))
    docs = frame([(i, t, None, None) for i, t in rows])
    assert got(docs, width=3, percent=85, node_sets=10) == plain(rows, 3, 85)


def test_dense_nodes_are_finished_in_rounds(spark, frame, monkeypatch):
    monkeypatch.setattr(cp, "MARGIN", 0.5)  # most candidates are false, and no node gives all at first
    rng = random.Random(6)
    base = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(60):
        own = list(base)
        for k in rng.sample(range(40), 3):
            own[k] = f"e{rng.randint(0, 2)}_{k}"
        rows.append((i, " ".join(own)))
    docs = frame([(i, t, None, None) for i, t in rows])
    assert got(docs, width=3, percent=85) == plain(rows, 3, 85)


@pytest.mark.parametrize("percent", [80, 85])
def test_estimate_loses_one_link_in_a_million(percent):
    p, n = percent / 100, cp.TOKENS
    below = sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(cp.least_agreeing(percent)))
    assert below <= 1e-6


def test_full_sets_decide_within_a_node(spark):
    """Sets that are alike are linked though none of their tokens agree; others are not."""
    sets = [list(range(20)), list(range(1, 21)), list(range(30, 50))]
    rows = []
    for i, own in enumerate(sets):
        tokens = np.full(cp.TOKENS, i, np.uint16).tobytes()
        rows.append((1, 0, bytes([i]), bytes([i]), 0, len(own), tokens, own))
    schema = "node long, tree int, key binary, part binary, block long, n long, tokens binary, shingles array<long>"
    found = cp.links_within(spark.createDataFrame(rows, schema), percent=85).collect()
    assert [(bytes(r.u), bytes(r.v)) for r in found] == [(b"\0", b"\1")]


def test_rows_of_one_id_with_different_texts(spark, frame):
    """Each text is judged on its own: a copy goes, what is no copy stays, in whatever order the rows come."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, a, "en", "s"), (2, a, "en", "t"), (2, b, "en", "s"), (2, b, "en", "u"), (3, c, "en", "s"), (3, b + " x", "en", "s"), (3, a + " y", None, None)]
    rows += [(4, "", "en", "s"), (4, "d", "en", "s"), (None, a, "en", "s"), (None, a, "en", "s")]
    found = []
    for own in (rows, rows[::-1]):
        docs = frame(own)
        got = cp.first_of_each(docs, width=5, percent=80)
        assert got.columns == docs.columns
        found.append(sorted((tuple(r) for r in got.collect()), key=str))
    assert found[0] == found[1]
    want = [(1, a), (2, b), (3, c), (4, ""), (4, "d"), (None, a), (None, a)]
    assert sorted([r[:2] for r in found[0]], key=str) == sorted(want, key=str)


def test_empty(spark, frame):
    assert got(frame([])) == []
    assert got(frame([(4, None, None, None), (2, "", None, None), (1, "x", None, None)])) == [
        (1, 1, 1, True),
        (2, 0, 2, True),
        (4, 0, 4, True),
    ]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    edges += [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(60)]
    rng.shuffle(edges)
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    want = {x: root(x) for x in parent}
    df = spark.createDataFrame(edges, "u long, v long")
    assert {r.vertex: r.component for r in components(df).collect()} == want
    assert components(df.where("u < 0")).collect() == []


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = plain([(r.doc_id, r.text) for r in docs], 3, 85)
    assert sorted((tuple(r) for r in cp.op5_minhash_near_dedup(spark, sf_dir).collect()), key=str) == want
