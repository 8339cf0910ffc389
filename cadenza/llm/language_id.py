"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import common

#: Code points below this have their letter test in a table; the few above are tested one by one.
_BMP = 0x10000
_letter_table: np.ndarray | None = None
#: Characters handled at a time, which bounds the memory of a task whatever the texts.
SEGMENT = 1_000_000
BATCH_BYTES = 16_000_000
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


@dataclass(frozen=True)
class Model:
    """Log-probabilities, one column a language; its size is buckets * languages, never the corpus."""

    languages: list[str]
    log_prior: np.ndarray
    log_likelihood: np.ndarray
    orders: tuple[int, ...]


def _letters(points: np.ndarray) -> np.ndarray:
    global _letter_table
    if _letter_table is None:
        _letter_table = np.array([chr(i).isalpha() for i in range(_BMP)])
    found = _letter_table[np.minimum(points, _BMP - 1)]
    high = np.flatnonzero(points >= _BMP)
    if len(high):
        found[high] = [chr(p).isalpha() for p in points[high]]
    return found


def normalised(text: str) -> np.ndarray:
    """Code points of the text in lower case; every run of other than letters is one blank, also at both ends.

    Empty if the text has no letter.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters(points)
    if not letter.any():
        return points[:0]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of each run of other characters
    out = np.where(letter, points, 32)[keep]
    head = [] if out[0] == 32 else [32]
    tail = [] if out[-1] == 32 else [32]
    return np.concatenate([np.array(head, out.dtype), out, np.array(tail, out.dtype)])


def _hashed(points: np.ndarray, order: int, starts: int, buckets: int) -> np.ndarray:
    """Bucket of each n-gram that begins among the first ``starts`` places."""
    n = min(starts, len(points) - order + 1)
    if n <= 0:
        return np.zeros(0, np.int64)
    h = np.full(n, order, np.uint64)
    for j in range(order):
        h = (h ^ points[j : j + n]) * _MIX[0]
        h ^= h >> np.uint64(29)
    return ((h * _MIX[1]) >> np.uint64(40)).astype(np.int64) % buckets


def ngrams(text: str | None, orders: tuple[int, ...], buckets: int) -> Iterator[np.ndarray]:
    """Buckets of all n-grams of the whole text, a bounded number at a time; nothing without letters."""
    points = normalised(text) if text else np.zeros(0, np.uint32)
    points = points.astype(np.uint64)
    for at in range(0, len(points), SEGMENT):
        part = points[at : at + SEGMENT + max(orders) - 1]
        yield np.concatenate([_hashed(part, k, SEGMENT, buckets) for k in orders])


def train(
    docs: DataFrame, text: str = "text", lang: str = "lang", buckets: int = 1 << 16, orders=(1, 2, 3), smoothing: float = 0.5
) -> Model | None:
    """Counts of the n-grams of all rows with a language and a letter, summed by language and bucket.

    A task adds up its own rows first, so what is shuffled is at most buckets * languages rows a task,
    however many rows one language has. The sums that reach the driver are bounded alike. None without
    a usable row.
    """
    orders = tuple(orders)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for batch in common.slices(batches, "text", BATCH_BYTES):
            for t, name in zip(common.column_of(batch, "text"), common.column_of(batch, "lang"), strict=True):
                for part, hashed in enumerate(ngrams(t, orders, buckets)):
                    if name not in sums:
                        sums[name] = np.zeros(buckets, np.int64)
                        rows[name] = 0
                    rows[name] += part == 0  # a document counts once, however many parts it has
                    np.add.at(sums[name], hashed, 1) if len(hashed) < 2000 else sums[name].__iadd__(
                        np.bincount(hashed, minlength=buckets)
                    )
        for name, found in sums.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([name] * (len(at) + 1), pa.string()),
                    "bucket": pa.array(np.append(at, -1), pa.int64()),
                    "n": pa.array(np.append(found[at], rows[name]), pa.int64()),
                }
            )

    rows = (
        docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
        .where("text IS NOT NULL AND lang IS NOT NULL")
        .mapInArrow(count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    if not rows:
        return None
    languages = sorted({r.lang for r in rows})
    place = {name: i for i, name in enumerate(languages)}
    counts, priors = np.zeros((buckets, len(languages))), np.zeros(len(languages))
    for r in rows:
        if r.bucket < 0:
            priors[place[r.lang]] = r.n
        else:
            counts[r.bucket, place[r.lang]] = r.n
    likelihood = np.log((counts + smoothing) / (counts.sum(axis=0) + smoothing * buckets))
    return Model(languages, np.log(priors / priors.sum()), likelihood.astype(np.float32), orders)


def predict(model: Model, text: str | None) -> tuple[str, float]:
    """The likeliest language and its posterior probability; ``und`` and 0.0 without a letter.

    A tie goes to the language that sorts first.
    """
    total = model.log_prior.copy()
    seen = False
    for hashed in ngrams(text, model.orders, len(model.log_likelihood)):
        if len(hashed):
            seen = True
            total += model.log_likelihood[hashed].sum(axis=0, dtype=np.float64)
    if not seen:
        return "und", 0.0
    best = int(total.argmax())
    return model.languages[best], float(1.0 / np.exp(total - total[best]).sum())


def identify(
    docs: DataFrame, model: Model | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",), with_text: bool = False
) -> DataFrame:
    """``lang_pred`` and ``score`` for every row, beside the columns in ``keep``; only the text is read.

    ``with_text`` gives the text back as ``_text``, so that it need not be among ``keep`` too and go to a task twice.

    One pass without a shuffle: the matrix goes to the tasks, and each text is scored on its own. A null
    text, or one without a letter, gets ``und`` and 0.0, as does every text without a model.
    """
    spark: SparkSession = docs.sparkSession
    chosen = docs.select(*keep, F.col(text).cast("string").alias("_text"))
    out = chosen if with_text else chosen.drop("_text")
    schema = out.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    held = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "_text", BATCH_BYTES):
            found = [predict(held.value, t) if held.value else ("und", 0.0) for t in common.column_of(batch, "_text")]
            names = [n for n in batch.schema.names if with_text or n != "_text"]
            own = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                names=[*names, "lang_pred", "score"],
            )

    return chosen.mapInArrow(score, schema)


def with_language(docs: DataFrame, model: Model | None, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows whose text is given a language, with the columns of ``docs``; those that get ``und`` go.

    A null ``lang`` becomes the predicted language; a language that is there stays. Without a model only texts that are
    null or have no letter go, and no language is filled in.
    """
    filled = F.coalesce(F.col(f"_row.`{lang}`"), F.col("lang_pred")) if model else F.col(f"_row.`{lang}`")
    model = model or Model(["unnamed"], np.zeros(1), np.zeros((1, 1), np.float32), (1,))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("_row")
    found = identify(docs.select(row, F.col(text).alias("text")), model, keep=("_row",), with_text=True)
    kept = found.where("lang_pred != 'und'")
    back = {lang: filled, text: F.col("_text").cast(docs.schema[text].dataType)}
    return kept.select(*[back.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from those whose crc32(doc_id) mod 3 is not 1."""
    docs = common.table(spark, sf_dir, "documents")
    held_out = F.coalesce(common.id_remainder("doc_id", 3) == 1, F.lit(False))
    model = train(docs.where(~held_out))
    found = identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model, keep=("doc_id", "held_out"))
    return found.select("doc_id", "held_out", "lang_pred", "score")
