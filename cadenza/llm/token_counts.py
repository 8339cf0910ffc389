"""Token counts without tokens: Viterbi over a unigram vocabulary that carries only score and count.

The vocabulary's pieces and scores are read from a public file and used as they are. An Aho-Corasick
automaton lists all pieces that occur in a word; going over them in order of their ends, each place keeps
the best score and the number of pieces on that path. Ties are settled as a unigram tokenizer does: of
equal scores at one place, the piece that starts first wins. Words do not share pieces, so a word's count
is found once and remembered.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import common

#: The mark that stands for the blank before a word, in the vocabulary.
MARK = "▁"
#: What an unknown character costs below the lowest score: a fixed value of unigram tokenizers.
UNKNOWN_PENALTY = 10.0
CACHE_WORDS = 600_000
BATCH_BYTES = 8_000_000


def vocabulary(path: str) -> list[tuple[str, float]]:
    """The pieces of a vocabulary file that text can have, with their scores, by id.

    Control pieces, the unknown piece and the pieces that stand for single bytes are none: ``<s>`` or ``<0x41>`` in
    a text are characters like others.
    """
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    other = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
    found = range(model.get_piece_size())
    return [(model.id_to_piece(i), model.get_score(i)) for i in found if not any(test(i) for test in other)]


class Counter(dict):
    """Count and best score of a word, remembered."""

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), float(score)))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY

    def __missing__(self, word: str) -> tuple[int, float]:
        found = self.count(MARK + word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = found
        return found

    def count(self, text: str) -> tuple[int, float]:
        """Pieces on the best path and its score. An unknown character counts its UTF-8 bytes."""
        size = len(text)
        ending: list[list[tuple[int, float]]] = [[] for _ in range(size)]
        alone = bytearray(size)
        for end, found in self.automaton.iter(text):
            ending[end].append(found)
            if found[0] == 1:
                alone[end] = 1
        best, count = [0.0] * (size + 1), [0] * (size + 1)
        for end in range(size):
            top, n = None, 0
            for length, score in sorted(ending[end], reverse=True):
                start = end + 1 - length
                new = best[start] + score
                if top is None or new > top:
                    top, n = new, count[start] + 1
            if not alone[end]:
                new = best[end] + self.unknown
                if top is None or new > top:
                    top, n = new, count[end] + len(text[end].encode("utf-8", "surrogatepass"))
            best[end + 1], count[end + 1] = top, n
        return count[size], best[size]


_kept: dict[str, Counter] = {}


def kept_counter(path: str) -> Counter:
    """The counter of a vocabulary file, which a worker keeps from one task to the next."""
    if path not in _kept:
        _kept[path] = Counter(vocabulary(path))
    return _kept[path]


def token_counts(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``n_tokens``, ``n_words`` and ``best_score`` for every row, beside the columns in ``keep``.

    One pass without a shuffle; a task holds the vocabulary and a bounded number of words. A null text
    counts as empty: no tokens, score 0.0. ``path`` is the vocabulary file on every executor.
    """
    chosen = docs.select(*keep, F.col(text).cast("string").alias("_text"))
    zero = F.lit(0).cast("long")
    schema = chosen.drop("_text").withColumns({"n_tokens": zero, "n_words": zero, "best_score": F.lit(0.0)}).schema

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = kept_counter(path).__getitem__
        for batch in common.slices(batches, "_text", BATCH_BYTES):
            tokens, words, scores = [], [], []
            for t in common.column_of(batch, "_text"):
                own = common.words_of(t) if t else []
                found = list(map(look, own))
                words.append(len(own))
                tokens.append(sum(x[0] for x in found))
                scores.append(float(sum(x[1] for x in found)))
            names = [n for n in batch.schema.names if n != "_text"]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(batch.schema.names.index(n)) for n in names),
                    pa.array(tokens, pa.int64()),
                    pa.array(words, pa.int64()),
                    pa.array(scores, pa.float64()),
                ],
                names=[*names, "n_tokens", "n_words", "best_score"],
            )

    return chosen.mapInArrow(count, schema)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token, word and best-path score totals of every whole document."""
    import public_tokenizers

    path = str(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts(common.table(spark, sf_dir, "documents"), path)
