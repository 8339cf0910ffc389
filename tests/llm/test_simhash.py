import hashlib
import random

import pytest

from cadenza.llm import simhash as sh
from pyspark.sql import functions as F


def plain_edits(rows):
    """(id, n_chars, sha256 of the edited text, next row) in descending order of ids, which differ."""
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (i, t) in enumerate(order):
        t, (j, other) = t or "", order[(k + 1) % len(order)]
        n = len(t) // 2
        edited = t[: len(t) - n] + (other or "")[:n]
        out[i] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), j, edited)
    return out


def plain_fingerprint(spark, texts):
    """Votes counted one by one, from the hashes of the terms."""
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", sh.term_hashes(F.col("t")).alias("h"))
    out = [None] * len(texts)
    for r in df.collect():
        hashes = [h for h in r.h if h is not None]
        bits = [sum((h[p] >> j) & 1 for h in hashes) * 2 > len(hashes) for p in (0, 1) for j in reversed(range(64))]
        out[r.i] = f"{int(''.join('01'[b] for b in bits), 2):032x}"
    return out


TEXTS = [
    None,
    "",
    " \n",
    "one",
    "one two",
    "one two one two one two",
    "a b c d e f g",
    "a  b\tc\nd e f g ",
    "日本 語 𝄞𝄞𝄞 é",
    "word " * 3000,
    "x" * 2001,
]


@pytest.mark.parametrize("ids", ["dense", "wide", "one"])
def test_against_brute_force(spark, frame, ids, monkeypatch):
    monkeypatch.setattr(sh, "GROUP_DOCS", 3)
    rng = random.Random(1)
    texts = TEXTS + [" ".join(rng.choices("the of and in to a is".split(), k=rng.randint(0, 40))) for _ in range(30)]
    texts = texts[8:9] if ids == "one" else texts
    number = range(len(texts)) if ids != "wide" else [rng.randrange(-(2**62), 2**62) for _ in texts[5:]] + [2**63 - 1, -(2**63), 1, 2, 3]
    rows = list(zip(number, texts, strict=True))
    got = {r.doc_id: r for r in sh.fingerprint_edits(frame([(i, t, None, None) for i, t in rows])).collect()}
    want = plain_edits(rows)
    assert got.keys() == want.keys()
    prints = dict(zip([i for i, _ in rows], plain_fingerprint(spark, [t or "" for _, t in rows]), strict=True))
    edits = dict(zip(want, plain_fingerprint(spark, [x[3] for x in want.values()]), strict=True))
    same = lambda a, b: 1 - (int(a, 16) ^ int(b, 16)).bit_count() / 128
    for i, r in got.items():
        assert (r.n_chars, r.edited_sha256) == want[i][:2]
        assert (r.fingerprint, r.edited_fingerprint) == (prints[i], edits[i])
        assert r.near_edited == same(prints[i], edits[i])
        assert r.near_next == same(prints[i], prints[want[i][2]])


def test_groups_are_bounded_whatever_the_ids(spark, frame, monkeypatch):
    """One far id, a third of the rows without an id, a third equal rows: no group is far above its size."""
    monkeypatch.setattr(sh, "GROUP_DOCS", 40)
    rows = [(i, f"a b {i}", None, None) for i in range(900)] + [(2**61, "x", None, None), (-(2**62), "y", None, None)]
    rows += [(None, f"n {i}", None, None) for i in range(900)] + [(7777, "the same text", None, None)] * 900
    found = sh.neighbours(frame(rows).repartition(5), "doc_id", "text").collect()
    sizes = {}
    for r in found:
        sizes[r.group] = sizes.get(r.group, 0) + 1
    assert max(sizes.values()) <= 130 and len(sizes) > 50
    own = [r for r in found if not r.copy]
    assert sorted(repr((r.id, r.text)) for r in own) == sorted(repr(r[:2]) for r in rows)
    # the texts and the texts after them are the same rows: each is once somebody's next one
    assert sorted(r.next_text for r in own) == sorted(r.text for r in own)
    after = {r.id: r.next_text for r in own if r.id is not None and r.id != 7777}
    assert after[2**61] == "the same text" and after[5] == "a b 4" and after[0] == "y"
    same = [r.next_text for r in own if r.id == 7777]
    assert same.count("the same text") == 899 and same.count("a b 899") == 1


def test_repeated_and_null_ids(spark, frame):
    rows = [(1, "a b", None, None)] * 3 + [(None, "c d e", None, None), (None, None, None, None), (2, "x y", None, None)]
    got = sh.fingerprint_edits(frame(rows)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_chars) for r in got) == [
        (False, 1, 3), (False, 1, 3), (False, 1, 3), (False, 2, 3), (True, 0, 0), (True, 0, 5),
    ]
    assert len({r.fingerprint for r in got if r.doc_id == 1}) == 1
    assert sh.fingerprint_edits(frame([])).collect() == []


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 6])
def test_all_pairs_within_the_radius(spark, radius):
    rng = random.Random(radius)
    base = [rng.getrandbits(128) for _ in range(20)]
    values = {b ^ sum(1 << k for k in rng.sample(range(128), rng.randint(0, 8))) for b in base * 8}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = [(signed(v >> 64), signed(v & (2**64 - 1))) for v in values]
    df = spark.createDataFrame(rows + rows[:5], "a long, b long")
    got = {(r.qa, r.qb, r.a, r.b): r.distance for r in sh.within_radius(df.limit(10_000), df, radius).collect()}
    want = {}
    for x in values:
        for y in values:
            if (x ^ y).bit_count() <= radius:
                want[signed(x >> 64), signed(x & (2**64 - 1)), signed(y >> 64), signed(y & (2**64 - 1))] = (x ^ y).bit_count()
    assert got == want


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = sh.op4_simhash_fingerprints(spark, sf_dir).collect()
    got, want = {r.doc_id: r for r in rows}, plain_edits(docs)
    assert len(rows) == len(docs)
    text = dict(docs)
    prints = {}
    for i, r in got.items():
        assert (r.n_chars, r.edited_sha256) == want[i][:2]
        assert prints.setdefault(text[i], r.fingerprint) == r.fingerprint
        near = [j for j, o in got.items() if j != i and (int(o.fingerprint, 16) ^ int(r.fingerprint, 16)).bit_count() <= 3]
        assert r.n_near == (len(near) if i % 20 == 0 else None)
    long = [r for r in rows if r.n_chars > 500]
    assert sum(r.near_edited > r.near_next for r in long) > 0.9 * len(long)
