import binascii
import math
from collections import Counter

import numpy as np
import pytest

from cadenza.llm import language_id as li


def plain_ngrams(text, orders):
    """All n-grams of the text with its runs of other than letters as one blank."""
    out, last = [], " "
    for c in (text or "").lower():
        c = c if c.isalpha() else " "
        if c != " " or last != " ":
            out.append(c)
        last = c
    if not any(c != " " for c in out):
        return []
    flat = " " + "".join(out).strip() + " "
    return [flat[i : i + k] for k in orders for i in range(len(flat) - k + 1)]


def bucket_of(gram, buckets):
    points = np.array([ord(c) for c in gram], np.uint64)
    return int(li._hashed(points, len(gram), 1, buckets)[0])


@pytest.mark.parametrize(
    "text", ["Hello, wörld 12 x", "a", " a ", "\n\n", "日本 語", "ǅ İ 𝔘nd 😀", "1 2 3", "x" * 50, "ab\x00cd\ud800e"]
)
def test_ngrams_are_those_of_the_whole_text(text, monkeypatch):
    monkeypatch.setattr(li, "SEGMENT", 7)
    got = Counter(int(h) for part in li.ngrams(text, (1, 2, 3), 1 << 16) for h in part)
    assert got == Counter(bucket_of(g, 1 << 16) for g in plain_ngrams(text, (1, 2, 3)))


def test_against_brute_force(spark, frame):
    rows = [
        (1, "the cat and the dog", "en", "a"),
        (2, "le chat et le chien", "fr", "a"),
        (3, "der hund und die katze", "de", "b"),
        (3, "der hund und die katze", "de", "b"),
        (4, None, "en", None),
        (5, "", None, None),
        (6, "12 34 !", "fr", None),
        (7, "the dog", None, None),
        (None, "chien", None, None),
    ]
    buckets, orders = 512, (1, 2)
    docs = frame(rows)
    model = li.train(docs, buckets=buckets, orders=orders)
    assert model.languages == ["de", "en", "fr"]
    counts = {k: Counter() for k in model.languages}
    priors = Counter()
    for _, t, name, _ in rows:
        grams = plain_ngrams(t, orders)
        if name and grams:
            counts[name].update(bucket_of(g, buckets) for g in grams)
            priors[name] += 1

    def joint(t):
        out = {}
        for name in model.languages:
            total = sum(counts[name].values()) + 0.5 * buckets
            out[name] = math.log(priors[name] / sum(priors.values())) + sum(
                math.log((counts[name][bucket_of(g, buckets)] + 0.5) / total) for g in plain_ngrams(t, orders)
            )
        return out

    got = li.identify(docs, model, keep=("doc_id", "text", "size")).collect()
    assert len(got) == len(rows)
    for r in got:
        if not plain_ngrams(r.text, orders):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        want = joint(r.text)
        best = max(want, key=want.get)
        assert r.lang_pred == best
        assert r.score == pytest.approx(1 / sum(math.exp(v - want[best]) for v in want.values()), abs=1e-3)


def test_priors_count_documents_whatever_their_length(spark, frame, monkeypatch):
    monkeypatch.setattr(li, "SEGMENT", 10)
    model = li.train(frame([(1, "long text " * 50, "en", "a"), (2, "kurz", "de", "a"), (3, "auch", "de", "a")]))
    assert np.exp(model.log_prior) == pytest.approx([2 / 3, 1 / 3])


def test_without_a_model(spark, frame):
    assert li.train(frame([])) is None
    assert li.train(frame([(1, "x", None, None)])) is None
    assert li.identify(frame([]), None).collect() == []
    assert [tuple(r) for r in li.identify(frame([(1, "x", None, None)]), None).collect()] == [(1, "und", 0.0)]


def test_texts_with_letters_stay_without_a_model(spark, frame):
    docs = frame([(1, "a clean text", None, "a"), (2, "12 !", None, "a"), (3, None, None, "a"), (4, "", None, "a"), (None, "é", None, None)])
    got = li.with_language(docs, li.train(docs))
    assert got.columns == docs.columns
    assert sorted(r.text for r in got.collect()) == ["a clean text", "é"]


def test_a_missing_language_is_filled(spark, frame):
    rows = [(i, "the cat and the dog", "en", "a") for i in range(3)] + [(i, "le chat et le chien", "fr", "a") for i in range(3, 6)]
    docs = frame([*rows, (7, "the dog", None, "a"), (8, "le chien", None, "b"), (9, "the dog", "fr", "b"), (10, "12", None, "b")])
    got = li.with_language(docs, li.train(docs))
    assert got.schema.simpleString() == docs.schema.simpleString()
    assert {r.doc_id: r.lang for r in got.where("doc_id > 6").collect()} == {7: "en", 8: "fr", 9: "fr"}


def test_query_on_held_out_documents(spark, sf_dir):
    lang = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = li.op7_language_id(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == sorted(lang)
    assert all(r.held_out == (binascii.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    judged = [r for r in got if r.held_out and r.lang_pred != "und" and lang[r.doc_id].lang]
    right = sum(r.lang_pred == lang[r.doc_id].lang for r in judged)
    assert judged and right >= 0.95 * len(judged)
