"""The queries whose results SQL states, beside that SQL: on the given documents, and on planted ones."""

import random

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from cadenza.llm.registry import ORACLES, QUERIES

NAMES = ["op2_suffix_dedup", "op5_minhash_near_dedup"]


def same(spark, name, sf_dir):
    got = QUERIES[name](spark, sf_dir)
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
        want = db.execute(ORACLES[name])
        assert [c[0] for c in want.description] == got.columns
        rows = want.fetchall()
    assert sorted(map(repr, rows)) == sorted(repr(tuple(r)) for r in got.collect())
    return rows


def planted(seed):
    """Chains of near copies, passages at odd places, copies, short and empty texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["É", "été", "A", "b\u00a0c"]
    base = rng.choices(words, k=60)
    chain = [" ".join(base[i : i + 48]) for i in range(12)]
    passage = "é" * 20 + " ".join(rng.choices(words, k=12))
    texts = [None, "", " ", "a", "A b", "a B", "a b", "x" * 49, "x" * 50, "x" * 200, *chain, *chain[:3]]
    for _ in range(40):
        own = " ".join(rng.choices(words, k=rng.randint(0, 30)))
        cut = rng.randint(0, len(passage))
        texts.append(own + rng.choice(["", " ", "\n"]) + rng.choice([passage, passage[cut:], passage[:cut], ""]))
    rng.shuffle(texts)
    return [(3 * i - 20, t, "en", "a", len(t or "")) for i, t in enumerate(texts)]


@pytest.mark.parametrize("name", NAMES)
def test_given_documents(spark, sf_dir, name):
    same(spark, name, sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_planted_documents(spark, tmp_path, name):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    rows = planted(5)
    pq.write_table(pa.table({c: [r[i] for r in rows] for i, c in enumerate(columns)}), tmp_path / "documents.parquet")
    found = same(spark, name, str(tmp_path))
    if name.startswith("op2"):
        assert sum(r[2] > 0 for r in found) > 10
    else:
        assert sum(not r[3] for r in found) > 5
