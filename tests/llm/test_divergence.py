import re
from collections import Counter, defaultdict

import duckdb
import pytest

from cadenza.llm import divergence as dv

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def lowered(text):
    return text.translate({i: i + 32 for i in range(65, 91)})


def brute(rows, min_docs=3, top=200):
    docs = [(lg or "", s or "", Counter(TERM.findall(lowered(t or "")))) for _, t, lg, s in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        here = [d for d in docs if d[0] == lang]
        seen = Counter(w for _, _, c in here for w in c)
        kept = sorted(w for w, n in seen.items() if n >= min_docs)
        counts = defaultdict(Counter)
        for _, source, c in here:
            counts[source].update({w: n for w, n in c.items() if w in set(kept)})
        total = sum(counts.values(), Counter())

        def share(c):
            size = sum(c.values()) + len(kept)
            return {w: 1 + 1000000000 * (c[w] + 1) // size for w in kept}

        whole, own = share(total), {s: share(c) for s, c in counts.items()}
        for source, p in own.items():
            pairs = [(-sum((p[w] - q[w]) ** 2 // q[w] for w in kept), s.encode()) for s, q in own.items() if s != source]
            terms = [
                (-((p[w] - whole[w]) ** 2 // whole[w]), w.encode()) for w in kept if counts[source][w] and p[w] > whole[w]
            ]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                out |= {(lang, source, part, i.decode(), -v, k) for k, (v, i) in enumerate(sorted(found)[:most], 1)}
    return out


ROWS = [
    (1, "The cat, the CAT; été Été", "en", "a"),
    (2, "the dog [the] dog's cat_cat", "en", "a"),
    (2, "the dog [the] dog's cat_cat", "en", "a"),
    (3, "dog dog dog 日本 the", "en", "b"),
    (4, "日本 x日本 the été", "en", "c"),
    (5, None, "en", "d"),
    (6, "", "en", None),
    (7, "日本 the été cat", None, None),
    (8, "the the the", None, "b"),
    (9, "12 !?", "fr", "a"),
    (10, "seul", "fr", "b"),
    (None, "the cat", "en", "c"),
    (11, "dog été a\x00b\x7fc", "en", "e"),
    (12, "the " * 40 + "cat", "de", "only"),
]


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, frame, monkeypatch, small):
    if small:  # texts in segments, sums handed on early, several blocks and tiles
        for name, value in (("SEGMENT", 5), ("HELD_TERMS", 3), ("BLOCK_CELLS", 6), ("TILE", 2)):
            monkeypatch.setattr(dv, name, value)
    got = [tuple(r) for r in dv.audit(frame(ROWS)).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(ROWS)


def test_only_the_top_terms(spark, frame):
    rows = [(i, " ".join(f"{a}{b}" for a in "abcde" for b in "uvwxyz"), "en", "s") for i in range(3)]
    rows += [(9 + i, "other", "en", "t") for i in range(3)]
    got = {tuple(r) for r in dv.audit(frame(rows), top=7).collect()}
    assert got == brute(rows, top=7)
    assert sum(r[1:3] == ("s", "term") for r in got) == 7


def test_empty_table_and_least_documents(spark, frame):
    assert dv.audit(frame([])).collect() == []
    assert {tuple(r) for r in dv.audit(frame(ROWS), min_docs=1).collect()} == brute(ROWS, min_docs=1)


def test_one_long_text_and_counts_beyond_a_long(spark):
    sums = dv.terms_of(("Ab cd\n" * 1_500_000).encode())
    assert sums == {b"ab": 1_500_000, b"cd": 1_500_000}
    row = spark.range(1).selectExpr("9000000000000L AS n", "90000000000000L AS size", "7L AS terms")
    got = row.select(dv.probability("n", "size", "terms")).first()[0]
    assert got == 1 + 1000000000 * 9000000000001 // 90000000000007


def test_query_equals_its_sql(spark, sf_dir):
    got = dv.op12_source_divergence(spark, sf_dir)
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
        want = db.execute(dv.ORACLE)
        assert [c[0] for c in want.description] == got.columns
        assert sorted(want.fetchall()) == sorted(tuple(r) for r in got.collect())
