"""Best-fit packing of token pieces into sequences of a fixed length, by large-item matching.

Lengths are whole numbers up to the capacity, so the packing is decided on a histogram of at most
``capacity`` counts: pieces above a third of the capacity are paired greedily, at most two to a sequence;
the others go, longest first, into the smallest gap that takes them. The histogram's plan says for the
k-th piece of each length its sequence and offset. Which piece is the k-th is a rank that Spark computes.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.llm import common

CAPACITY = 2048
#: Words whose ids a task remembers; it starts anew when they are more.
CACHE_WORDS = 1_200_000
#: Text handled at a time in a task.
BATCH_BYTES = 8_000_000


class WordIds(dict):
    """Token ids of words, as little-endian bytes, remembered from one text to the next.

    The tokenizer drops blanks before it splits, so a text's ids are those of its words in order. A word
    of Latin-1 characters has the ids of its lower case, which the tokenizer applies itself. A full stop or
    comma after a Latin-1 letter or digit is a token of its own (other letters may be taken apart by the tokenizer into
    a letter and a mark, which is one token with the stop). A word of letters only is one piece, for which the
    tokenizer's model is asked at once, with its letters spelt as bytes.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        made = Tokenizer.from_file(path)
        self.encode, self.model = made.encode, made.model
        spelt = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.letters = {i: spelt(chr(i))[0][0] for i in range(256) if chr(i).isalpha()}

    def __missing__(self, word: str) -> bytes:
        if word[-1] in ".," and word[-2:-1].isalnum() and _latin(word[-2]):
            found = self[word[:-1]] + self[word[-1]]
        elif word.isalpha() and (word.isascii() or _latin(word)) and word.islower():
            spelt = word if word.isascii() else word.translate(self.letters)
            found = struct.pack(f"<{len(ids := self.model.tokenize(spelt))}I", *(x.id for x in ids))
        else:
            found = np.array(self.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = found
        return found


_kept: dict[str, WordIds] = {}


def kept_words(path: str) -> WordIds:
    """The words of a tokenizer's file, which a worker keeps from one task to the next."""
    if path not in _kept:
        _kept[path] = WordIds(path)
    return _kept[path]


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def document_ids(text: str | None, words: WordIds, end_id: int) -> bytes:
    """Ids of the whole text and the end id, as little-endian 32-bit numbers; null counts as empty."""
    if not text:
        return np.array([end_id], "<u4").tobytes()
    if _latin(text) and "<|" not in text:  # special tokens are as they stand
        text = text.lower()
    return b"".join([*map(words.__getitem__, common.words_of(text)), np.array([end_id], "<u4").tobytes()])


def pieces(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    ids: str = "doc_id",
    capacity: int = CAPACITY,
    end_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """``ids``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, the ``token_ids``.

    Only documents longer than ``capacity`` are cut; a null text is one end id. One pass, no shuffle.
    ``tokenizer`` is the path of the tokenizer's file on every executor.
    """
    key = docs.schema[ids].dataType.simpleString()
    schema = f"`{ids}` {key}, piece int, start long, length long, ids_crc32 long"
    schema += ", token_ids binary" * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = kept_words(tokenizer)
        for batch in common.slices(batches, "_text", BATCH_BYTES):
            row, piece, start, length, crc, own = [], [], [], [], [], []
            for i, t in enumerate(common.column_of(batch, "_text")):
                tokens = document_ids(t, words, end_id)
                for k, at in enumerate(range(0, len(tokens), 4 * capacity)):
                    part = tokens[at : at + 4 * capacity]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        own.append(part)
            columns = {
                ids: batch.column(0).take(pa.array(row, pa.int64())),
                "piece": pa.array(piece, pa.int32()),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()),
            }
            if with_ids:
                columns["token_ids"] = pa.array(own, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    return docs.select(F.col(ids), F.col(text).cast("string").alias("_text")).mapInArrow(cut, schema)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, pieces, first sequence, pieces a sequence, offset) for the whole histogram.

    A run of sequences with one gap is handled as one, so the work and the plan depend on the number of
    different lengths, not of pieces. A length splits at most one run.
    """
    left = {n: k for n, k in histogram.items() if k > 0}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError("a length is outside 1..capacity")
    used = dict.fromkeys(left, 0)
    rows: list[tuple[int, int, int, int, int, int]] = []
    gaps: list[tuple[int, int, int]] = []  # sorted: gap, first sequence, sequences
    sequences = 0

    def put(length: int, count: int, first: int, each: int, offset: int) -> None:
        rows.append((length, used[length], count, first, each, offset))
        used[length] += count
        left[length] -= count

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        n = large[-1]
        if not left[n]:
            large.pop()
            continue
        at = bisect_left(large, capacity - n + 1) - 1
        while at >= 0 and not left[large[at]]:
            at -= 1
        partner = large[at] if at >= 0 else 0
        if not partner:
            count = left[n]
            put(n, count, sequences, 1, 0)
            gap = capacity - n
        elif partner == n:
            count = (left[n] + 1) // 2
            pairs = left[n] // 2
            if pairs:
                put(n, 2 * pairs, sequences, 2, 0)
            if left[n]:
                put(n, 1, sequences + pairs, 1, 0)
                if capacity - n:
                    insort(gaps, (capacity - n, sequences + pairs, 1))
            if pairs and capacity - 2 * n:
                insort(gaps, (capacity - 2 * n, sequences, pairs))
            sequences += count
            continue
        else:
            count = min(left[n], left[partner])
            put(n, count, sequences, 1, 0)
            put(partner, count, sequences, 1, n)
            gap = capacity - n - partner
        if gap:
            insort(gaps, (gap, sequences, count))
        sequences += count

    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            at = bisect_left(gaps, (n, -1, -1))
            if at == len(gaps):
                gap, first, count = capacity, sequences, -(-left[n] // (capacity // n))
                sequences += count
            else:
                gap, first, count = gaps.pop(at)
            each = gap // n
            full = min(count, left[n] // each)
            rest = 0 if full == count else min(left[n] - full * each, each)
            if full:
                put(n, full * each, first, each, capacity - gap)
                if gap - each * n:
                    insort(gaps, (gap - each * n, first, full))
            if rest:
                put(n, rest, first + full, each, capacity - gap)
                insort(gaps, (gap - rest * n, first + full, 1))
            untouched = count - full - bool(rest)
            if untouched:
                insort(gaps, (gap, first + full + bool(rest), untouched))
    return rows


def pack(cut: DataFrame, keys: list[str], length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """The rows of ``cut`` with ``sequence_id`` and ``offset``.

    ``keys`` order the pieces of one length; equal keys are interchangeable. A length that a large share of
    the pieces has is spread over groups by a hash of the keys, and only their counts meet. The driver sees
    the histogram, at most ``capacity`` rows. ``cut`` is read three times: give a written table.
    """
    spark = cut.sparkSession
    histogram = {r[0]: r[1] for r in cut.groupBy(length).count().collect()}
    rows = plan(histogram, capacity)
    steps = spark.sparkContext.broadcast(np.array(sorted(rows), np.int64).reshape(-1, 6))

    groups = common.row_groups(sum(histogram.values()), 2000)
    grouped = cut.withColumn("_group", F.pmod(F.xxhash64(*keys), F.lit(groups)))
    before = Window.partitionBy(length).orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        grouped.groupBy(length, "_group")
        .agg(F.count("*").alias("_n"))
        .select(length, "_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    )
    within = Window.partitionBy(length, "_group").orderBy(*keys)
    ranked = grouped.join(bases, [length, "_group"]).select(
        *cut.columns, (F.col("_base") + F.row_number().over(within) - 1).alias("_rank")
    )
    schema = ranked.drop("_rank").withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = steps.value
        for batch in batches:
            names = batch.schema.names
            n = batch.column(names.index(length)).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column(names.index("_rank")).to_numpy(zero_copy_only=False).astype(np.int64)
            # the plan's rows are sorted by (length, first rank): one search on a combined key
            wide = int(table[:, 1].max(initial=0) + 1 + rank.max(initial=0))
            at = np.searchsorted(table[:, 0] * wide + table[:, 1], n * wide + rank, "right") - 1
            row = table[at]
            k = rank - row[:, 1]
            sequence = row[:, 3] + k // row[:, 4]
            offset = row[:, 5] + (k % row[:, 4]) * n
            own = [batch.column(i) for i, x in enumerate(names) if x != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=[*(x for x in names if x != "_rank"), "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, schema)


def packed_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of every document, with its sequence and place there.

    ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``. A sequence's
    pieces follow each other without gaps from 0. Rows with one id are separate documents.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    cut = common.written(pieces(docs, str(tokenizer), capacity=capacity), "pieces")
    return pack(cut, ["doc_id", "piece", "ids_crc32"], capacity=capacity)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return packed_documents(common.table(spark, sf_dir, "documents"))
