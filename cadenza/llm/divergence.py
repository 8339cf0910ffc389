"""Audit of sources: how far the term distributions of the sources of a language are apart.

A term is a run of letters: A-Z and a-z, and every character beyond ASCII. ``bytes.translate`` lowers A-Z and
blanks all other ASCII in one pass over the UTF-8 bytes, ``bytes.split`` cuts the terms, and a ``Counter`` per
document gives its frequencies; each distinct term of it counts as one document. A task adds up what it has
seen by (language, source, term), so the shuffle carries sums and not words.

All that follows is exact whole-number arithmetic on the sparse sums. Terms that a source lacks have one
probability there, so two sources are compared on the terms that either has, plus one product for the rest.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.llm import common

#: Letters stay or are lowered, bytes beyond ASCII stay, all else is a blank.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_BREAK = re.compile(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]")
#: Bytes of a text that are translated and split at a time; a term is never cut.
SEGMENT = 4_000_000
BATCH_BYTES = 16_000_000
#: Sums that a task holds before it hands them on.
HELD_TERMS = 400_000
#: Probabilities are whole numbers of this part, one more so that none is 0.
UNIT = 1_000_000_000
#: Cells (sources x terms) of a block in which sources are compared, and sources a tile.
BLOCK_CELLS = 1_000_000
TILE = 256

_SUMS = "lang string, source string, term binary, n long, docs long"


def terms_of(text: bytes | None) -> Counter:
    """How often each term is in the whole text."""
    found: Counter = Counter()
    at, end = 0, len(text or b"")
    while at < end:
        cut = _BREAK.search(text, min(at + SEGMENT, end))
        stop = cut.start() if cut else end
        found.update(text[at:stop].translate(TABLE).split())
        at = stop
    return found


def term_sums(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` (occurrences) and ``docs`` (documents with it), one row a term.

    Each group has one more row without a term, with its number of documents, so groups without terms are there too. A null
    text, language or source counts as ''. Repeated rows are documents of their own.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, str], tuple[Counter, Counter, list[int]]] = {}

        def handed_on() -> Iterator[pa.RecordBatch]:
            for (name, origin), (n, seen, rows) in sums.items():
                size = len(n) + 1
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([name] * size, pa.string()),
                        "source": pa.array([origin] * size, pa.string()),
                        "term": pa.array([None, *n], pa.binary()),
                        "n": pa.array([0, *n.values()], pa.int64()),
                        "docs": pa.array([rows[0], *map(seen.__getitem__, n)], pa.int64()),
                    }
                )
            sums.clear()

        held = 0
        for batch in common.slices(batches, "text", BATCH_BYTES):
            columns = [common.column_of(batch, x) for x in ("text", "lang", "source")]
            for t, *group in zip(*columns, strict=True):
                n, seen, rows = sums.setdefault(tuple(group), (Counter(), Counter(), [0]))
                here = terms_of(t)
                held -= len(n)
                n.update(here)
                seen.update(here.keys())
                rows[0] += 1
                held += len(n)
                if held + len(sums) > HELD_TERMS:
                    yield from handed_on()
                    held = 0
        yield from handed_on()

    def whole(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(""))

    return (
        docs.select(
            whole(text).cast("binary").alias("text"), whole(lang).alias("lang"), whole(source).alias("source")
        )
        .mapInArrow(count, _SUMS)
        .select("lang", "source", F.col("term").cast("string").alias("term"), "n", "docs")
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )


def kept_terms(sums: DataFrame, min_docs: int = 3) -> DataFrame:
    """The sums of terms in at least ``min_docs`` documents of their language, and the rows of the groups.

    ``total`` is the term's occurrences in the language; ``first`` marks one row a (language, term). The
    window holds one row a source, as the sums are made before it.
    """
    each = Window.partitionBy("lang", "term")
    return (
        sums.withColumns(
            {
                "total": F.sum("n").over(each),
                "_docs": F.sum("docs").over(each),
                "first": F.row_number().over(each.orderBy("source")) == 1,
            }
        )
        .where(F.col("term").isNull() | (F.col("_docs") >= min_docs))
        .select("lang", "source", "term", "n", "total", "first")
    )


def group_sizes(kept: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``size`` (occurrences of kept terms), and the language's ``lang_size``,
    ``terms`` (kept) and ``sources``."""
    groups = kept.groupBy("lang", "source").agg(
        F.sum("n").alias("size"), F.count_if(F.col("first") & F.col("term").isNotNull()).alias("_terms")
    )
    langs = groups.groupBy("lang").agg(
        F.sum("size").alias("lang_size"), F.sum("_terms").alias("terms"), F.count("*").alias("sources")
    )
    return groups.drop("_terms").join(langs, "lang")


def probability(count: str, size: str, terms: str) -> Column:
    """1 + floor(UNIT * (count + 1) / (size + terms)), exact at any size."""
    return F.expr(
        f"1 + (CAST({UNIT} AS DECIMAL(10, 0)) * CAST({count} + 1 AS DECIMAL(19, 0)))"
        f" div CAST({size} + {terms} AS DECIMAL(20, 0))"
    )


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    apart = p - q
    return apart * apart // q


def compare_sources(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``item`` (another source of the language), ``value``: the sum over all kept terms.

    ``rows`` have ``lang``, ``source``, ``term``, ``p``; ``groups`` what ``group_sizes`` gives. The terms of a
    language are dealt to blocks by their hash and its sources to tiles, so that a task has at most about
    ``BLOCK_CELLS`` cells and ``TILE`` sources to compare with all others, whatever the language; the blocks'
    sums are added up. A value fits into a long below 5e8 kept terms.
    """
    sized = groups.where("sources > 1").select(
        "lang",
        "source",
        F.when(F.col("terms") > 0, probability("0", "size", "terms")).otherwise(1).alias("p"),
        F.expr(f"greatest(1, (terms * sources + {BLOCK_CELLS - 1}) div {BLOCK_CELLS})").alias("_blocks"),
        F.expr(f"(sources + {TILE - 1}) div {TILE}").alias("_tiles"),
    )
    tiles = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_tiles") - 1))
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))
    own = F.pmod(F.xxhash64("source"), F.col("_tiles"))
    all_sources = (
        sized.withColumn("_own", own).withColumn("_tile", tiles).withColumn("_block", blocks).drop("_blocks", "_tiles")
    )
    dealt = rows.join(sized.select("lang", "source", "_blocks", "_tiles"), ["lang", "source"]).select(
        "lang", "source", "term", "p", F.pmod(F.xxhash64("term"), F.col("_blocks")).alias("_block"), tiles.alias("_tile")
    )

    def compare(key, terms: pa.Table, sources: pa.Table) -> pa.Table:
        names = sources["source"].to_pylist()
        absent = sources["p"].to_numpy()
        mine = np.flatnonzero(sources["_own"].to_numpy() == key[2].as_py())
        place = {name: i for i, name in enumerate(names)}
        term = terms["term"].combine_chunks().dictionary_encode()
        column = term.indices.to_numpy(zero_copy_only=False)
        row = np.array([place[s] for s in terms["source"].to_pylist()], np.int64)
        cells = np.repeat(absent[:, None], len(term.dictionary), axis=1)
        cells[row, column] = terms["p"].to_numpy()
        sums = np.zeros((len(mine), len(names)), np.int64)
        if cells.size:
            # as if these sources had none of the block's terms
            for j in range(len(names)):
                values, times = np.unique(cells[j], return_counts=True)
                sums[:, j] = (_distance(absent[mine, None], values[None, :]) * times).sum(axis=1)
            for i, s in enumerate(mine):  # what the terms they do have change
                at = column[row == s]
                others = cells[:, at]
                sums[i] += (_distance(cells[s, at], others) - _distance(absent[s], others)).sum(axis=1)
        a, b = np.nonzero(mine[:, None] != np.arange(len(names))[None, :])
        label = pa.array(names, pa.string())
        return pa.table(
            {
                "lang": pa.array([key[0].as_py()] * len(a), pa.string()),
                "source": label.take(pa.array(mine[a])),
                "item": label.take(pa.array(b)),
                "value": pa.array(sums[a, b], pa.int64()),
            }
        )

    keys = ["lang", "_block", "_tile"]
    return (
        dealt.groupBy(*keys)
        .cogroup(all_sources.groupBy(*keys))
        .applyInArrow(compare, "lang string, source string, item string, value long")
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"))
    )


def audit(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = 3, top: int = 200
) -> DataFrame:
    """Per (language, source): its distance to every other source, and the terms it has more of than its language.

    ``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``. Part ``pair``: all other sources of the language,
    farthest first. Part ``term``: the ``top`` terms by value. Ties go to the item that sorts first as UTF-8.

    A null text, language or source counts as ''. A group without kept terms has distances but no terms; a
    language with one source has no pairs; an empty table gives no rows. Other columns are not looked at.
    """
    kept = common.written(kept_terms(term_sums(docs, text, lang, source), min_docs), "kept_terms")
    groups = common.written(group_sizes(kept), "term_groups")
    rows = (
        kept.where("term IS NOT NULL")
        .join(groups, ["lang", "source"])
        .select(
            "lang",
            "source",
            "term",
            probability("n", "size", "terms").alias("p"),
            probability("total", "lang_size", "terms").alias("q"),
        )
    )

    def ranked(part: str, found: DataFrame) -> DataFrame:
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return found.select(
            "lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank")
        )

    pairs = ranked("pair", compare_sources(rows.select("lang", "source", "term", "p"), groups))
    more = rows.where("p > q").select(
        "lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value")
    )
    return pairs.unionByName(ranked("term", more).where(F.col("rank") <= top))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of each language, and the terms that set a source apart, over all documents."""
    return audit(common.table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), words AS (
  SELECT rid, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT rid) >= 3
), counts AS (
  SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL
), langs AS (
  SELECT lang, count(*) AS v, sum(total) AS size FROM kept GROUP BY lang
), groups AS (
  SELECT d.lang, d.source, coalesce((SELECT sum(n) FROM counts c WHERE c.lang = d.lang AND c.source = d.source), 0) AS size
  FROM (SELECT DISTINCT lang, source FROM docs) d
), cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.size + l.v) AS p,
         1 + (1000000000::HUGEINT * (k.total + 1)) // (l.size + l.v) AS q
  FROM groups g JOIN langs l ON l.lang = g.lang JOIN kept k ON k.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM cells WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""
