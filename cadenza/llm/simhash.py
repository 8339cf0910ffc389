"""SimHash fingerprints of whole texts, and the pairs of them within a Hamming radius.

Terms are the pairs of neighbouring words, with their numbers of occurrences as weights: each occurrence
adds its hash's bits as votes for or against the fingerprint's 128 bits. The votes are counted in longs that hold
two counters each, so a document is one group with 64 sums, whatever its length.

Fingerprints within a radius r agree in at least one of r + 1 blocks of bits. There is one table a block, in
which fingerprints meet by that block; distance decides. Equal fingerprints are one row in them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.llm import common

#: Two counters of 32 bits in a long: places j and j + 32 of a hash.
_LANES = (1 << 32) + 1
#: Cells that the order of the documents is cut into first; the driver holds so many boundaries.
CELLS = 1024
#: Documents in a group of neighbours.
GROUP_DOCS = 1000


def term_hashes(text: Column) -> Column:
    """128 bits for each term, as an array of two longs each; a single word is a term, no word gives none."""
    words = F.filter(F.split(text, common.BLANKS), lambda w: w != "")
    pairs = F.greatest(F.lit(1), F.size(words) - 1)
    # the words are cut once a text, not once a pair
    both = F.arrays_zip(F.slice(words, F.lit(1), pairs).alias("x"), F.slice(words, F.lit(2), pairs).alias("y"))
    return F.transform(
        both, lambda p: F.struct(F.xxhash64(p["x"], p["y"]).alias("a"), F.xxhash64(F.lit(1), p["x"], p["y"]).alias("b"))
    )


def _sums() -> list[Column]:
    return [
        F.sum(F.shiftrightunsigned(F.col(f"t.{part}"), j).bitwiseAND(F.lit(_LANES))).alias(f"_{part}{j}")
        for part in "ab"
        for j in range(32)
    ]


def _bits(part: str) -> Column:
    """A bit is set if more than half of the votes are for it."""

    def bit(j: int) -> Column:
        own = F.col(f"_{part}{j % 32}")
        votes = own.bitwiseAND(F.lit((1 << 32) - 1)) if j < 32 else F.shiftrightunsigned(own, 32)
        return F.when(votes * 2 > F.col("_n"), F.lit((1 << j) - ((1 << 64) if j == 63 else 0))).otherwise(F.lit(0).cast("long"))

    return reduce(Column.bitwiseOR, map(bit, range(64)))


def fingerprints(rows: DataFrame, keys: list[str], terms: str) -> DataFrame:
    """``keys`` and ``a``, ``b``: the 128 bits of each row, from its array of term hashes."""
    exploded = rows.select(*keys, F.explode_outer(terms).alias("t"))
    votes = exploded.groupBy(*keys).agg(F.count("t").alias("_n"), *_sums())
    votes = votes.select(*keys, "_n", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in votes.columns if c[0] == "_" and c != "_n" and c not in keys])
    return votes.select(*keys, _bits("a").alias("a"), _bits("b").alias("b"))


def as_text(a: Column, b: Column) -> Column:
    """32 hexadecimal digits."""
    return F.lower(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))


def distance(a: Column, b: Column, c: Column, d: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(c)) + F.bit_count(b.bitwiseXOR(d))


def within_radius(queries: DataFrame, index: DataFrame, radius: int = 3) -> DataFrame:
    """Rows (qa, qb, a, b, distance): all pairs of distinct fingerprints of both at most ``radius`` apart.

    ``queries`` and ``index`` have (a, b). The 128 bits are cut into radius + 1 blocks; a pair within the radius
    agrees in one at least, and is kept in the table of the first. Up to a radius of 15.
    """
    if not 0 <= radius <= 15:
        raise ValueError("the radius must be from 0 to 15")
    # blocks never cross the two longs: each gets half of them, rounded up
    blocks = (radius + 2) // 2
    cuts = [64 * i // blocks for i in range(blocks + 1)]

    def block(value: Column, lo: int, hi: int) -> Column:
        mask = (1 << (hi - lo)) - 1
        return F.shiftrightunsigned(value, lo).bitwiseAND(F.lit(mask if mask < 1 << 63 else -1))

    def tables(df: DataFrame) -> DataFrame:
        own = df.select("a", "b").distinct()
        found = [block(F.col(part), lo, hi) for part in "ab" for lo, hi in zip(cuts, cuts[1:], strict=False)]
        return own.select("a", "b", F.posexplode(F.array(*found)).alias("table", "block"))

    q = tables(queries).select(F.col("a").alias("qa"), F.col("b").alias("qb"), "table", "block")
    apart = distance(F.col("qa"), F.col("qb"), F.col("a"), F.col("b"))
    met = q.join(tables(index), ["table", "block"]).where(apart <= radius)
    return met.select("qa", "qb", "a", "b", apart.alias("distance")).distinct()


def _count_upto(edges: Column, key: Column, rounds: int, equal: bool) -> Column:
    """How many of the sorted ``edges`` are below ``key``, or with ``equal`` at most ``key``: a binary search."""

    def halve(at: Column, _: Column) -> Column:
        middle = F.floor((at["lo"] + at["hi"]) / 2).cast("int")
        edge = F.element_at(edges, middle + 1)
        right = (edge <= key) if equal else (edge < key)
        open_ = at["lo"] < at["hi"]
        return F.struct(
            F.when(open_ & right, middle + 1).otherwise(at["lo"]).alias("lo"),
            F.when(open_ & ~right, middle).otherwise(at["hi"]).alias("hi"),
        )

    start = F.struct(F.lit(0).alias("lo"), F.size(edges).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, halve, lambda at: at["lo"])


def boundaries(keys: DataFrame) -> tuple[DataFrame, int]:
    """Rows (cell, group, key): the first key of each group of ``GROUP_DOCS`` rows in order, groups numbered from 0.

    Rows are sorted over all tasks by ranges of a sample, so groups follow how the rows lie, whatever their keys;
    rows of one key are told apart by a random number, so no key is one task's. A task's last group may be
    smaller. ``cell`` numbers runs of groups; the second result is how many groups a cell has.
    """
    order = ["key", "_salt"]
    ranked = keys.withColumn("_salt", F.rand(5)).repartitionByRange(*order).sortWithinPartitions(*order)
    ranked = ranked.select("key", F.monotonically_increasing_id().alias("_spot"))
    nth = F.col("_spot").bitwiseAND(F.lit((1 << 33) - 1))
    first = common.written(ranked.where(nth % GROUP_DOCS == 0), "firsts")
    # numbered through by task: a task's groups follow those of the tasks before
    first = first.select("key", F.shiftright("_spot", 33).alias("_task"), F.floor(nth / GROUP_DOCS).alias("_nth"))
    sizes = first.groupBy("_task").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    width = max(1, -(-first.count() // CELLS))
    numbered = first.join(bases, "_task").select((F.col("_base") + F.col("_nth")).alias("group"), "key")
    cells = numbered.select(F.floor(F.col("group") / width).alias("cell"), "group", "key")
    return common.written(cells, "boundaries"), width


def neighbours(docs: DataFrame, ids: str, text: str) -> DataFrame:
    """Rows (group, place, copy, id, text, next_text) in descending order of the ids, null ids last.

    Rows of one id are in order of a hash of their texts. The order is cut into groups of ``GROUP_DOCS`` rows, by
    keys alone; the text of a row finds its group by two binary searches, among the cells' first keys and among
    those of its cell, and moves once. A key that begins several groups, as that of many equal rows, is spread over
    them: such rows are alike, so it is all one which goes where. The first row of a group is also put, as a
    copy, at the end of the group before, and that of the first group at the end of the last, so each text finds
    its next one in its group.
    """
    own = docs.select(F.col(ids).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # ascending order of the key is descending order of the ids: ~id falls as id rises
    key = F.struct(
        F.col("id").isNull().alias("none"),
        F.coalesce(F.bitwise_not("id"), F.lit(0).cast("long")).alias("down"),
        F.xxhash64("text").alias("hash"),
    )
    edges, width = boundaries(own.select(key.alias("key")))
    tops = edges.groupBy("cell").agg(F.min("key").alias("key")).orderBy("cell").collect()
    names = ("none", "down", "hash")
    top_keys = F.array(*[F.struct(*[F.lit(k[n]).cast("boolean" if n == "none" else "long").alias(n) for n in names]) for _, k in tops])
    if not tops:
        top_keys = F.array(key)
    in_cell = edges.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("key", "group"))).alias("_edges"))
    in_cell = common.written(in_cell, "cells")

    def ends_of(df: DataFrame, found: Column, rounds: int) -> DataFrame:
        low, high = (_count_upto(found, F.col("_key"), rounds, equal) for equal in (False, True))
        return df.withColumns({"_low": low, "_high": high})

    spread = F.col("_low") + F.floor(F.rand(7) * (F.col("_high") - F.col("_low"))).cast("int")
    several = F.col("_high") - F.col("_low")
    keyed = ends_of(own.withColumn("_key", key), top_keys, CELLS.bit_length())
    cell = F.when(several >= 2, spread).otherwise(F.col("_high") - 1)
    keyed = keyed.withColumn("cell", cell.cast("long")).join(in_cell, "cell")
    keyed = ends_of(keyed, F.transform("_edges", lambda e: e["key"]), width.bit_length())
    edge = F.element_at("_edges", F.when(several >= 3, spread).otherwise(F.col("_high") - 1) + 1)
    keyed = keyed.select("id", "text", "_key", edge.alias("_edge"))
    placed = keyed.select("_edge.group", F.lit(False).alias("copy"), "id", "text")

    last = edges.agg(F.max("group")).first()[0]
    before = F.when(F.col("group") == 0, F.lit(last).cast("long")).otherwise(F.col("group") - 1)
    firsts = keyed.where(F.col("_key") == F.col("_edge.key")).dropDuplicates(["_key"])
    copies = firsts.join(edges.select(before.alias("group"), F.col("key").alias("_key")), "_key")
    dealt = placed.unionByName(copies.select("group", F.lit(True).alias("copy"), "id", "text"))
    order = Window.partitionBy("group").orderBy("copy", F.col("id").desc_nulls_last(), F.xxhash64("text"))
    return dealt.select(
        "group", F.row_number().over(order).alias("place"), "copy", "id", "text", F.lead("text").over(order).alias("next_text")
    )


def edited_text(text: Column, other: Column) -> Column:
    """The text with its last half, rounded down, replaced by as many first characters of the other."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), F.char_length(text) - half), F.substr(other, F.lit(1), half))


def _word(digest: Column, i: int) -> Column:
    """Sixteen digits of a hexadecimal digest as a long."""
    return F.conv(F.substr(digest, F.lit(1 + 16 * i), F.lit(16)), 16, -10).cast("long")


def fingerprint_edits(docs: DataFrame, ids: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its fingerprint, its edited text's, and their likeness.

    ``ids``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.
    Likeness is the share of equal bits. The edited text ends with the start of the next document's, in
    descending order of ids; after the last comes the first, and a single document is its own next. A null
    text is empty. A text without words has the fingerprint 0. The texts move in one exchange, on which the
    windows and sums build.
    """
    own = neighbours(docs, ids, text)
    edited = F.coalesce(edited_text(F.col("text"), F.coalesce("next_text", F.lit(""))), F.lit(""))
    own = own.withColumn("_edited", edited)
    digest = F.sha2(F.col("_edited"), 256)
    meta = [_word(digest, i).alias(f"s{i}") for i in range(4)]
    kinds = F.array(F.struct(F.lit(0).alias("kind"), F.col("text")), F.struct(F.lit(1).alias("kind"), F.col("_edited").alias("text")))
    keys = ["group", "place", "copy", "id", "n_chars", "s0", "s1", "s2", "s3", "kind"]
    rows = own.select(
        "group", "place", "copy", "id", F.char_length("text").cast("long").alias("n_chars"), *meta, F.explode(kinds).alias("_k")
    )
    rows = rows.where("NOT copy OR _k.kind = 0").select(*keys[:-1], "_k.kind", term_hashes(F.col("_k.text")).alias("terms"))
    found = fingerprints(rows, keys, "terms")
    pairs = found.groupBy(*keys[:-1]).agg(
        *[F.max(F.when(F.col("kind") == k, F.col(part))).alias(f"{part}{k}") for part in "ab" for k in (0, 1)]
    )
    order = Window.partitionBy("group").orderBy("place")
    full = pairs.withColumns({"_na": F.lead("a0").over(order), "_nb": F.lead("b0").over(order)}).where("NOT copy")
    col = F.col
    sha = F.lower(F.concat(*[F.lpad(F.hex(f"s{i}"), 16, "0") for i in range(4)]))
    return full.select(
        col("id").alias(ids),
        "n_chars",
        sha.alias("edited_sha256"),
        as_text(col("a0"), col("b0")).alias("fingerprint"),
        as_text(col("a1"), col("b1")).alias("edited_fingerprint"),
        (1 - distance(col("a0"), col("b0"), col("a1"), col("b1")) / 128.0).alias("near_edited"),
        (1 - distance(col("a0"), col("b0"), col("_na"), col("_nb")) / 128.0).alias("near_next"),
    )


def halves(fingerprint: Column) -> tuple[Column, Column]:
    return _word(fingerprint, 0).alias("a"), _word(fingerprint, 1).alias("b")


def op4_simhash_fingerprints(spark: SparkSession, sf_dir: str, radius: int = 3) -> DataFrame:
    """Fingerprints of every document and its edited text, and how many fingerprints are near.

    ``n_near`` is for documents whose id is divisible by 20, null for others: the number of other documents
    with a fingerprint at most ``radius`` bits from theirs, found in the block tables.
    """
    found = common.written(fingerprint_edits(common.table(spark, sf_dir, "documents")), "fingerprints")
    index = found.groupBy(*halves(F.col("fingerprint"))).agg(F.count("*").alias("documents"))
    asked = found.where("doc_id % 20 = 0").select(*halves(F.col("fingerprint")))
    near = within_radius(asked, index, radius).join(index, ["a", "b"]).groupBy("qa", "qb").agg(F.sum("documents").alias("_near"))
    near = near.select(as_text(F.col("qa"), F.col("qb")).alias("fingerprint"), "_near")
    joined = found.join(near, "fingerprint", "left")
    n_near = F.when(F.col("doc_id") % 20 == 0, F.col("_near") - 1)
    return joined.select(*found.columns, n_near.alias("n_near"))
