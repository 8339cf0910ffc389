import random

import corpus_pipeline
import pytest

from cadenza.llm import chosen_path, common, language_id, mixing, packing, suffix_dedup
from tests.llm import test_chosen_path, test_packing, test_suffix_dedup

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = []
    shared = "the same passage stands here and there, word for word, é and longer than fifty bytes."
    for i in range(60):
        own = " ".join(rng.choices("un deux trois one two three eins zwei drei".split(), k=rng.randint(5, 60)))
        out.append((i, f"{own} {shared if i % 4 == 0 else ''} {i} {own[::-1]}", "en", f"s{i % 5}"))
    out += [(100 + i, out[i][1], "en", "s1") for i in range(10)] + [(200 + i, out[i][1] + " x", None, None) for i in range(10)]
    out += [(300, None, "en", "a"), (301, "", "en", "a"), (302, "12 34 !!", "en", "a"), (5, out[5][1], "en", "s0"), (None, "no id at all", "en", "a")]
    return out


def test_stages_one_by_one(spark, frame, rows):
    """Every stage against the brute force of its operator, on what the one before left."""
    docs = frame(rows).select(*COLUMNS)
    got = [docs]
    for name, stage in corpus_pipeline.STAGES:
        got.append(common.written(stage(spark, got[-1], ""), name))
    found = [[tuple(r) for r in df.collect()] for df in got]
    for df in got[1:-1]:
        assert df.columns == COLUMNS and df.schema["doc_id"].dataType == docs.schema["doc_id"].dataType

    key = lambda r: (r[0] is None, str(r))
    want = [(*r[:2], r[2] or "en", *r[3:]) for r in found[0] if any(c.isalpha() for c in r[1] or "")]  # all that is learnt is en
    assert sorted(found[1], key=key) == sorted(want, key=key)

    judged = test_chosen_path.plain([(r[0], r[1]) for r in found[1]], 5, 80)
    kept = {r[0] for r in judged if r[3]}
    assert sorted(found[2], key=key) == sorted({r for r in found[1] if r[0] in kept}, key=key)
    assert len(found[2]) < len(found[1])

    cut = {r[0]: r[2] for r in test_suffix_dedup.plain([(r[0], r[1].encode()) for r in found[2]], 50)}
    for r in found[3]:
        before = next(x for x in found[2] if x[0] == r[0])
        assert r[4] == len(r[1]) and (r[1] == before[1] if not cut[r[0]] else len(r[1].encode()) <= len(before[1].encode()) - cut[r[0]])
    assert any(cut.values())

    sized, taken = mixing.mix(got[3])
    words = {}
    for r in taken.collect():
        words[r.id] = words.get(r.id, 0) + r.hi - r.lo
    assert {r[0]: len(r[1].split()) for r in found[4]} == words

    pieces = test_packing.check_sequences(got[5].collect(), packing.CAPACITY)
    assert pieces.keys() == {r[0] for r in found[4]}


def test_empty(spark, frame):
    docs = frame([]).select(*COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        docs = common.written(stage(spark, docs, ""), name)
    assert docs.collect() == []


def test_clashing_columns(spark, frame, rows):
    """Columns named like those inside survive every stage that returns documents."""
    docs = frame(rows[:30])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, "")
        assert after.columns == docs.columns
        docs = common.written(after, "clash")
    assert docs.select("words").distinct().collect() == [("x",)]


def test_run(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir).collect()
    test_packing.check_sequences(got, packing.CAPACITY)
    assert len(got) > 50


def test_cut_characters_go_whole():
    import numpy as np

    data = np.frombuffer("aéb𝄞c".encode(), np.uint8)
    gone = np.zeros(len(data), bool)
    gone[[2, 6]] = True
    assert data[~suffix_dedup.whole_characters(data, gone)].tobytes() == b"abc"
    assert chosen_path and language_id
