"""Language-model scores of whole documents: the likelihood of a subword lattice, beside a word baseline.

The model is a unigram model over the pieces of an existing vocabulary. Its scores are log-probabilities of
the pieces, counted where the vocabulary's tokenizer segments the words of the training documents. A word's
probability is the sum over all its segmentations, found by a forward recursion in log space; a document's
is the product over its words and its end. No segmentation is chosen, so the score is a true marginal.

The baseline needs the training count of each word of each document, and there is no bound on the number of
words. Tasks reduce a chunk of documents to its distinct words, and send each word's hash and training count in
the chunk to a bin by the hash. A bin adds up the counts of its words and answers each chunk with the words'
totals; which document has which word stays with the chunk, where the documents' sums are made. So a word is one
entry of twelve bytes a chunk, however many documents have it.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import common

#: The mark that stands for the blank before a word, in the vocabulary.
MARK = "▁"
CACHE_WORDS = 700_000
#: Distinct words that are counted before they are segmented.
COUNT_WORDS = 400_000
CHUNK_BYTES = 8_000_000
BIN_BYTES = 64_000_000
_LOWER = bytes(common.LOWER_ASCII.get(i, i) for i in range(256))
#: Stands for a text's end among the words; no word has a blank.
END = b"\n"


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text with A-Z in lower case; bytes.split() cuts at the very blanks of ``WORD``."""
    return text.translate(_LOWER).split() if text else []


# --- the lattice ---


class Lattice(dict):
    """Log10 marginal probability of a word, remembered."""

    def __init__(self, pieces: list[str], log_probability: np.ndarray):
        import ahocorasick

        super().__init__()
        self.automaton = ahocorasick.Automaton()
        self.bytes = np.full(256, -np.inf)
        for piece, value in zip(pieces, log_probability.tolist(), strict=True):
            if len(piece) == 6 and piece.startswith("<0x"):
                self.bytes[int(piece[3:5], 16)] = value
            elif not (piece.startswith("<") and piece.endswith(">") and len(piece) > 2):
                self.automaton.add_word(piece, (len(piece), value))
        self.automaton.make_automaton()

    def __missing__(self, word: bytes) -> float:
        found = self.forward(MARK + word.decode("utf-8", "replace")) / math.log(10)
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = found
        return found

    def forward(self, text: str) -> float:
        """Log of the sum over all segmentations. A character without a piece of its own goes by its bytes."""
        size = len(text)
        ending: list[list[tuple[int, float]]] = [[] for _ in range(size)]
        alone = bytearray(size)
        for end, found in self.automaton.iter(text):
            ending[end].append(found)
            if found[0] == 1:
                alone[end] = 1
        total = [0.0] * (size + 1)
        for end in range(size):
            ways = [total[end + 1 - length] + value for length, value in ending[end]]
            if not alone[end]:
                ways.append(total[end] + sum(self.bytes[b] for b in text[end].encode("utf-8", "surrogatepass")))
            top = max(ways)
            total[end + 1] = top if len(ways) == 1 else top + math.log(sum(math.exp(x - top) for x in ways))
        return total[size]


_models: dict[str, object] = {}
_lattices: dict[bytes, Lattice] = {}


def kept_model(path: str):
    """The vocabulary's tokenizer, which a worker keeps from one task to the next."""
    if path not in _models:
        from sentencepiece import SentencePieceProcessor

        _models[path] = SentencePieceProcessor(model_file=path)
    return _models[path]


def kept_lattice(path: str, log_probability: np.ndarray) -> Lattice:
    """The lattice of these scores, which a worker keeps from one task to the next."""
    key = xxhash.xxh3_128_digest(log_probability.tobytes())
    if key not in _lattices:
        _lattices.clear()
        model = kept_model(path)
        _lattices[key] = Lattice([model.id_to_piece(i) for i in range(model.get_piece_size())], log_probability)
    return _lattices[key]


def piece_scores(training: DataFrame, path: str, text: str = "text") -> np.ndarray:
    """Natural log-probability of each piece, from its count in the training texts, plus one.

    The end of a text counts as the end piece. Tasks send at most one row a piece, and the vocabulary is
    fixed, so the sums are bounded.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = kept_model(path)
        sums = np.zeros(model.get_piece_size(), np.int64)
        held: Counter = Counter()

        def flush() -> None:
            words = [w.decode("utf-8", "replace") for w in held]
            found = model.encode(words, num_threads=1)
            ids = np.fromiter((i for own in found for i in own), np.int64)
            times = np.repeat(np.fromiter(held.values(), np.int64), [len(own) for own in found])
            np.add.at(sums, ids, times)
            held.clear()

        for batch in batches:
            for t in batch.column(0).to_pylist():
                held.update(words_of(t))
                sums[model.eos_id()] += 1
                if len(held) > COUNT_WORDS:
                    flush()
        flush()
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"piece": pa.array(at, pa.int64()), "n": pa.array(sums[at], pa.int64())})

    rows = (
        training.select(F.col(text).cast("string").cast("binary").alias("text"))
        .mapInArrow(count, "piece long, n long")
        .groupBy("piece")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    model = kept_model(path)
    counts = np.ones(model.get_piece_size())
    counts[[i for i in range(len(counts)) if model.is_unknown(i) or i == model.bos_id()]] = 0.0
    for r in rows:
        if counts[r.piece]:
            counts[r.piece] += r.n
    with np.errstate(divide="ignore"):
        return np.log(counts / counts.sum())


# --- words of chunks, dealt to bins ---


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays in one compressed piece, their lengths and kinds in front."""
    head = "".join(f"{a.dtype.str} {len(a)} " for a in arrays).encode() + b"\n"
    return head + pa.Codec("zstd", 3).compress(b"".join(a.tobytes() for a in arrays), asbytes=True)


def _unpacked(blob: bytes) -> list[np.ndarray]:
    head, packed = blob.split(b"\n", 1)
    named = head.decode().split()
    kinds, sizes = [np.dtype(k) for k in named[::2]], [int(n) for n in named[1::2]]
    raw = pa.Codec("zstd").decompress(packed, sum(k.itemsize * n for k, n in zip(kinds, sizes, strict=True)), asbytes=True)
    out, at = [], 0
    for kind, n in zip(kinds, sizes, strict=True):
        out.append(np.frombuffer(raw, kind, n, at))
        at += out[-1].nbytes
    return out


def deal_words(docs: DataFrame, path: str, log_probability: np.ndarray, bins: int, chunk_bytes: int) -> DataFrame:
    """Rows (key, chunk, data, words). A key from 0 is a bin, with the hashes and counts of the chunk's words there.

    A key below 0 has the chunk's rows, and in ``words`` which of them has which word how often, the words in the
    order of the bins.

    ``docs`` has ``_id``, ``held_out`` and ``_text``, which is binary.
    """
    scores = docs.sparkSession.sparkContext.broadcast(log_probability)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = kept_lattice(path, scores.value)
        end_score = scores.value[kept_model(path).eos_id()] / math.log(10)
        task, n = TaskContext.get().partitionId(), 0
        for batch in common.slices(batches, "_text", chunk_bytes):
            n += 1
            chunk = (task << 32) + n
            texts = batch.column(2).to_pylist()
            training = ~np.array(batch.column(1))
            numbers = _Numbers()
            number_of = numbers.__getitem__
            number_of(END)
            tokens, sizes = [], []
            for t in texts:
                own = words_of(t)
                sizes.append(len(own) + 1)
                tokens.append(np.fromiter(map(number_of, own), np.int64, len(own)))
                tokens.append(np.zeros(1, np.int64))
            tokens = np.concatenate(tokens)
            value = np.fromiter((end_score if w == END else lattice[w] for w in numbers), np.float64, len(numbers))
            score = np.add.reduceat(value[tokens], np.cumsum(sizes) - sizes)
            rows = pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(score, pa.float64())],
                names=["_id", "held_out", "n_tokens", "score"],
            )
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema) as writer:
                writer.write_batch(rows)

            pairs, times = np.unique(
                tokens * len(texts) + np.repeat(np.arange(len(texts)), sizes), return_counts=True
            )
            word, doc = pairs // len(texts), pairs % len(texts)
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, numbers), np.uint64, len(numbers))
            place = (hashes % np.uint64(bins)).astype(np.int64)
            trained = np.bincount(word, times * training[doc], len(numbers)).astype(np.uint32)
            order = np.argsort(place, kind="stable")
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order))
            of_docs = _packed(rank[word], doc.astype(np.uint32), times.astype(np.uint32))
            out = [(-chunk, chunk, sink.getvalue().to_pybytes(), of_docs)]
            there, starts = np.unique(place[order], return_index=True)
            for b, own in zip(there.tolist(), np.split(order, starts[1:]), strict=True):
                out.append((b, chunk, _packed(hashes[own], trained[own]), None))
            columns = zip(*out, strict=True)
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["key", "chunk", "data", "words"]
            )

    return docs.select("_id", "held_out", "_text").mapInArrow(deal, "key long, chunk long, data binary, words binary")


def word_totals(dealt: DataFrame) -> DataFrame:
    """Rows (chunk, key, totals, tokens, words): for each bin and chunk the training counts of the chunk's words there.

    ``tokens`` and ``words`` are the bin's totals, on its first row.
    """
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
    names = ["chunk", "key", "totals", "tokens", "words"]

    def add(table: pa.Table) -> pa.Table:
        parts = [_unpacked(d) for d in table["data"].to_pylist()]
        _, number = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        count = np.bincount(number, np.concatenate([p[1] for p in parts])).astype(np.int64)
        totals, at, out = (int(count.sum()), int((count > 0).sum())), 0, []
        for c, key, (own, _) in zip(table["chunk"].to_pylist(), table["key"].to_pylist(), parts, strict=True):
            out.append((c, key, _packed(count[number[at : at + len(own)]]), *totals))
            at += len(own)
            totals = (0, 0)
        columns = zip(*out, strict=True)
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    bins = dealt.where("key >= 0").select("key", "chunk", "data")
    return bins.groupBy("key").applyInArrow(add, "chunk long, key long, totals binary, tokens long, words long")


def score(
    docs: DataFrame,
    path: str,
    held_out,
    text: str = "text",
    ids: str = "doc_id",
    chunk_bytes: int = CHUNK_BYTES,
    bin_bytes: int = BIN_BYTES,
) -> DataFrame:
    """One row per document, scored by a model of the rows for which ``held_out`` is false.

    ``ids``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``. A null text
    is empty: its one token is the end. A null ``held_out`` counts as false. Without training rows every
    count is 0 and all pieces weigh the same. Rows of one id are separate documents.
    """
    own = docs.select(
        F.col(ids).alias("_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col(text).cast("string").cast("binary").alias("_text"),
    )
    scores = piece_scores(own.where(~F.col("held_out")), path, "_text")
    total = own.agg(F.sum(F.length("_text"))).first()[0] or 0
    bins = max(1, -(-total // bin_bytes))
    dealt = common.written(deal_words(own, path, scores, bins, chunk_bytes), "words")
    totals = common.written(word_totals(dealt), "totals")
    tokens, words = totals.agg(F.sum("tokens"), F.sum("words")).first()
    tokens, words = tokens or 0, words or 0
    floor = math.log10(tokens + words + 1)

    key = docs.schema[ids].dataType.simpleString()
    schema = f"`{ids}` {key}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def finish(own: pa.Table, answers: pa.Table) -> pa.Table:
        rows = pa.ipc.open_stream(own["data"][0].as_py()).read_next_batch()
        word, doc, times = _unpacked(own["words"][0].as_py())
        order = np.argsort(answers["key"].to_numpy())
        found = answers["totals"].to_pylist()
        count = np.concatenate([_unpacked(found[i])[0] for i in order])[word]
        base = np.bincount(doc, times * np.log10(count + 1), rows.num_rows)
        known = np.bincount(doc, times * (count > 0), rows.num_rows).astype(np.int64)
        size = np.array(rows.column(2))
        return pa.table(
            {
                ids: rows.column(0),
                "held_out": rows.column(1),
                "n_tokens": rows.column(2),
                "n_known": pa.array(known, pa.int64()),
                "train_tokens": pa.array(np.full(rows.num_rows, tokens), pa.int64()),
                "base_score": pa.array(base - size * floor, pa.float64()),
                "score": rows.column(3),
            }
        )

    chunks = dealt.where("key < 0").select("chunk", "data", "words")
    return chunks.groupBy("chunk").cogroup(totals.groupBy("chunk")).applyInArrow(finish, schema)


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, learnt from those whose crc32(doc_id) mod 7 is not 2."""
    import public_tokenizers

    path = str(public_tokenizers.path("piece_bpe_32k.model"))
    return score(common.table(spark, sf_dir, "documents"), path, common.id_remainder("doc_id", 7) == 2)
