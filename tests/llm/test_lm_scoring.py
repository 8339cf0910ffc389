import binascii
import math
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cadenza.llm import lm_scoring as lm

PATH = str(public_tokenizers.path("piece_bpe_32k.model"))
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def plain_base(rows):
    """(n_tokens, n_known, train_tokens, base_score) of each row (text, held_out), by definition."""
    counts = Counter()
    for t, out in rows:
        if not out:
            counts.update([*words(t), None])
    n, v = sum(counts.values()), len(counts)
    found = []
    for t, _ in rows:
        own = [*words(t), None]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        found.append((len(own), sum(counts[w] > 0 for w in own), n, base))
    return found


def all_ways(text, probability):
    if not text:
        return 1.0
    return sum(probability[text[:k]] * all_ways(text[k:], probability) for k in range(1, len(text) + 1) if text[:k] in probability)


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(1)
    pieces = ["▁", "a", "b", "c", "ab", "bc", "abc", "▁a", "▁ab", "ca", "cab", "<0x64>", "<unk>"]
    p = rng.random(len(pieces))
    p /= p.sum()
    lattice = lm.Lattice(pieces, np.log(p))
    known = dict(zip(pieces[:11], p, strict=False)) | {"d": p[11]}
    for word in ("a", "abc", "cabcab", "aabbcc", "abdcab", "d", "dd"):
        assert lattice[word.encode()] == pytest.approx(math.log10(all_ways("▁" + word, known)))


def test_probabilities_of_words_are_proper():
    """Over an alphabet that the pieces cover, all texts of up to n words have at most probability 1."""
    pieces = ["▁", "a", "b", "ab", "▁a"]
    lattice = lm.Lattice(pieces, np.log(np.full(5, 0.15)))
    total, level = 0.0, [""]
    for _ in range(9):
        level = [w + c for w in level for c in "ab"]
        total += sum(10 ** lattice[w.encode()] for w in level)
    assert 0 < total < 1


def test_against_brute_force(spark, frame):
    texts = [None, "", " ", "The the CAT sat", "the dog\tsat\x0bon é", "É é straße", "x" * 5000, "a\xa0b a\xa0b", "日本 語 𝄞"]
    texts += [f"word{i % 7} the {'cat ' * (i % 5)}" for i in range(40)]
    rows = [(i, t, None, None) for i, t in enumerate(texts)] + [(3, texts[3], None, None), (None, "the end", None, None)]
    out = [i is not None and binascii.crc32(str(i).encode()) % 7 == 2 for i, *_ in rows]
    assert any(out)
    docs = frame(rows).repartition(3)
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    got = lm.score(docs, PATH, held, chunk_bytes=200, bin_bytes=400).collect()
    want = plain_base([(r[1], h) for r, h in zip(rows, out, strict=True)])
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for (i, t, *_), h, (n, known, trained, base) in zip(rows, out, want, strict=True):
        r = by_id[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, n, known, trained)
        assert r.base_score == pytest.approx(base)
        assert r.score < 0 or not t
    scores = lm.piece_scores(docs.where(~F.coalesce(held, F.lit(False))), PATH)
    assert np.exp(scores).sum() == pytest.approx(1)
    lattice = lm.kept_lattice(PATH, scores)
    end = scores[lm.kept_model(PATH).eos_id()] / math.log(10)
    for i, t, *_ in rows:
        assert by_id[i].score == pytest.approx(sum(lattice[w.encode()] for w in words(t)) + end)


def test_without_training_rows(spark, frame):
    assert lm.score(frame([]), PATH, F.lit(True)).collect() == []
    (r,) = lm.score(frame([(1, "a b", None, None)]), PATH, F.lit(True)).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0)


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    out = [binascii.crc32(str(r.doc_id).encode()) % 7 == 2 for r in docs]
    want = {r.doc_id: (h, *w) for r, h, w in zip(docs, out, plain_base([(r.text, h) for r, h in zip(docs, out, strict=True)]), strict=True)}
    got = lm.op9_lm_scoring(spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:4]
        assert r.base_score == pytest.approx(want[r.doc_id][4])
    held = [r for r in got if r.held_out]
    print(sum(r.score for r in held), sum(r.base_score for r in held))


def test_a_word_of_all_documents_is_one_entry_a_chunk(spark, frame):
    """What bins get depends on the chunks' distinct words, not on how many documents have them."""

    def sent(copies):
        docs = frame([(i, "the same few words", None, None) for i in range(copies)]).coalesce(1)
        own = docs.selectExpr("doc_id AS _id", "false AS held_out", "CAST(text AS BINARY) AS _text")
        scores = lm.piece_scores(own, PATH, "_text")
        rows = lm.deal_words(own, PATH, scores, 7, 10**6).where("key >= 0").collect()
        found = [lm._unpacked(r.data) for r in rows]
        assert all(count.tolist() == [copies] * len(count) for _, count in found)
        return sum(len(hashes) for hashes, _ in found)

    assert sent(3) == sent(500) == 5
