"""A corpus pipeline over documents: each stage is written as Parquet and read again by the next.

1. Language: documents without a letter have no language and go. The model learns from the stage's rows; a
   document whose language is not given takes the predicted one.
2. Near duplicates: of each component of documents whose 5-word shingle sets have a similarity of 0.8 or
   more one document stays, that with the smallest id.
3. Repeated passages: bytes covered by a 50-byte string of a document with a smaller id go. Of a character
   that is cut, the rest goes too. A document of which no word is left goes.
4. Mixing: sources are brought to their target weights; a document is what the mix takes of it.
5. Packing: all documents as token pieces in sequences of at most 2048 tokens.

A null text has no language, so none gets past the first stage. Rows of one id with
different texts are judged one by one in the second stage, of those with equal texts it keeps one;
rows with a null id take no part in the second and third stage and pass unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import chosen_path, common, language_id, mixing, packing, suffix_dedup


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language."""
    return language_id.with_language(docs, language_id.train(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each component of near duplicates."""
    return chosen_path.first_of_each(docs, width=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that documents before them have."""
    return suffix_dedup.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    return mixing.mixed_documents(docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces with their places in sequences."""
    return packing.packed_documents(docs)


STAGES = [
    ("language_id", keep_languages),
    ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack_documents),
]
#: The stages classify, hash and pack, which SQL does not express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from all documents."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return docs
