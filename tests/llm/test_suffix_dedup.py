import hashlib
import random

import numpy as np
import pytest

from cadenza.llm import suffix_dedup as sd


def plain(rows, length):
    """By definition: every string with the smallest id that has it."""
    first = {}
    for i, t in rows:
        for a in range(len(t) - length + 1) if i is not None else ():
            s = t[a : a + length]
            first[s] = min(first.get(s, i), i)
    out = []
    for i, t in rows:
        gone = bytearray(len(t))
        for a in range(len(t) - length + 1) if i is not None else ():
            if first[t[a : a + length]] < i:
                gone[a : a + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def texts(seed):
    rng = random.Random(seed)

    def prose(n, letters="abcdefghij klmno é"):
        return "".join(rng.choices(letters, k=n))

    line, passage = prose(70), prose(400)
    out = [None, "", "short", "a" * 49, "a" * 50, "a" * 51, "ab" * 200, " " * 300, "a" * 3000]
    for _ in range(40):
        parts = [prose(rng.randint(0, 300))]
        for _ in range(rng.randint(0, 4)):
            a = rng.randint(0, 350)
            parts += [rng.choice([line, passage, passage[a:], passage[:a], "a" * 60, out[-1] or ""]), prose(rng.randint(0, 90))]
        out.append("".join(parts))
    out += [out[20], out[20], out[21][:-1] + "!", out[22][5:], "é" * 100, "xé" * 60]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed,length,chunk,hot", [(1, 50, 10**7, 2000), (2, 50, 3000, 2000), (3, 50, 3000, 1), (4, 20, 2000, 0)])
def test_against_brute_force(spark, frame, seed, length, chunk, hot, monkeypatch):
    found = texts(seed)
    ids = list(range(len(found)))
    random.Random(seed).shuffle(ids)
    rows = [(i, t, None, None) for i, t in zip(ids, found, strict=True)]
    rows += [(rows[12][0], rows[12][1], "en", "a"), (rows[12][0], rows[13][1], "en", "a"), (None, rows[14][1], "en", "a")]
    docs = frame(rows).repartition(3)
    got = sd.remove_repeats(docs, length=length, chunk_bytes=chunk, bin_bytes=5000, hot_chunks=hot).collect()
    want = plain([(r[0], (r[1] or "").encode()) for r in rows], length)
    key = lambda x: (x[0] is None, x)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_segments_do_not_matter(monkeypatch):
    import pyarrow as pa

    data = [t.encode() if t else None for t in texts(5)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(data)), pa.int64()), pa.array(data, pa.binary())], names=["i", "t"])
    whole = sd.Chunk(batch, 50)
    monkeypatch.setattr(sd, "SEGMENT", 97)
    parts = sd.Chunk(batch, 50)

    def strings(c):
        return sorted((s + j, k) for s, w, k in zip(c.start, c.windows, c.key, strict=True) for j in range(w))

    assert strings(whole) == strings(parts)
    assert len(strings(whole)) == sum(max(0, len(t or b"") - 49) for t in data)


def test_corpus_order_is_sorted():
    import numpy as np

    rng = np.random.default_rng(0)
    data = rng.integers(0, 3, 900, dtype=np.uint8)
    begin = np.arange(0, 850)
    order, new = sd.corpus_order(data, begin, 50)
    suffixes = [data[a : a + 50].tobytes() for a in begin[order]]
    assert suffixes == sorted(suffixes)
    assert [bool(x) for x in new] == [True, *(a != b for a, b in zip(suffixes, suffixes[1:], strict=False))]


def test_empty(spark, frame):
    assert sd.remove_repeats(frame([])).collect() == []
    got = sd.remove_repeats(frame([(1, None, None, None), (None, None, None, None)]), with_text=True).collect()
    assert sorted(tuple(r)[1:4] for r in got) == [(0, 0, 0)] * 2
    assert {r.kept for r in got} == {""}


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = plain([(r.doc_id, (r.text or "").encode()) for r in docs], 50)
    assert sorted(map(tuple, sd.op2_suffix_dedup(spark, sf_dir).collect())) == sorted(want)


def test_hashes_of_strings_do_not_depend_on_segments(monkeypatch):
    data = np.random.default_rng(3).integers(0, 4, 1000).astype(np.uint8)
    begin = np.flatnonzero(np.random.default_rng(4).random(951) < 0.3)
    whole = sd.rolling(data, 50)[begin]
    for segment in (1, 7, 64, 950, 951, 1000, 5000):
        monkeypatch.setattr(sd, "SEGMENT", segment)
        assert (sd.string_hashes(data, begin, 50) == whole).all()
    assert len(sd.string_hashes(data, begin[:0], 50)) == 0
