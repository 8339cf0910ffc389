"""Mixing sources to target weights: fixed-length token blocks, dealt to output shards by index.

The words of each source, its documents in a fixed pseudorandom order, form one stream that is cut into
blocks of ``block_words``. A source's target fixes how many whole passes over its blocks the mix makes,
and how many words of one more. Every pass visits the source's blocks in an order of its own, given by a
pseudorandom permutation of the block numbers; the draw of output shards is multinomial. Only numbers are
shuffled, never text, and all of it is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.llm import common

#: Rounds of the swap-or-not permutation; each is an involution, so any number gives a permutation.
ROUNDS = 24
#: Slots that one row of a source's plan is exploded into at a time.
SLOT_RUN = 1 << 16
#: Slots that one task draws, numbers and permutes.
TASK_SLOTS = 1 << 18
#: Shards whose running totals are one window.
SHARD_GROUP = 1 << 12


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``weight`` and ``target`` in words.

    Sources in code-point order, null last, take the weights in turn and share the sum of all sizes by
    weight. No target is above ``most`` times its source's size; what is cut off is shared by weight among
    the others. With the sources in order of size / weight, the capped ones come first, so the level at
    which the sharing ends is read off running sums. Works on one row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*[F.lit(float(w)) for w in weights])
    ranked = per_source.withColumn("source_no", F.row_number().over(by_name)).withColumn(
        "weight", F.element_at(turn, ((F.col("source_no") - 1) % len(weights) + 1).cast("int"))
    )
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), "source_no")
    before, everything = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(1))
    cap = F.col("source_size") * F.lit(float(most))
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    levelled = ranked.withColumn("_place", F.row_number().over(by_ratio)).withColumn("_level", level)
    free = F.when(cap > F.col("_level") * F.col("weight"), F.struct("_place", "_level"))
    final = F.min(free).over(everything)["_level"]
    return levelled.withColumn("_final", final).select(
        "source",
        "source_no",
        "source_size",
        "weight",
        F.when(F.col("_final").isNull(), cap).otherwise(F.least(cap, F.col("_final") * F.col("weight"))).alias("target"),
    )


def permuted(index: Column, n: Column, *keys: Column) -> Column:
    """A pseudorandom permutation of 0..n-1, one for each value of the keys (swap-or-not shuffle)."""

    def swap(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(F.lit("key"), r, *keys), n) - x, n)
        return F.when(F.xxhash64(F.lit("bit"), r, F.greatest(x, partner), *keys) > 0, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index.cast("long"), swap)


def placed(sizes: DataFrame, rows: int, per_group: int = 2000) -> DataFrame:
    """Each row with words gets ``start``: the place of its first word in the stream of its source.

    The order within a source is by group, a hash of the id, then by id. Sums by group come first and
    their running totals are joined back, so a source of any share of the rows is spread over all groups.
    """
    groups = common.row_groups(rows, per_group)
    grouped = sizes.where("size > 0").withColumn("_group", F.pmod(F.xxhash64("id"), F.lit(groups)))
    before = Window.partitionBy("source_no").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        grouped.groupBy("source_no", "_group")
        .agg(F.sum("size").alias("_words"))
        .select("source_no", "_group", F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_base"))
    )
    own = Window.partitionBy("source_no", "_group").orderBy("id", "n")
    within = own.rowsBetween(Window.unboundedPreceding, -1)
    return (
        grouped.join(totals, ["source_no", "_group"])
        .withColumn("start", F.col("_base") + F.coalesce(F.sum("size").over(within), F.lit(0)))
        .drop("_group", "_base")
    )


def slots(targets: DataFrame, block_words: int, shard_slots: int, seed: int) -> DataFrame:
    """The mix: one row per block taken, with its output ``shard``, ``slot`` there, ``pass`` and ``take``.

    ``take`` is the number of the block's leading words that are used: all of them but in the last block of
    the last pass. The short block at a stream's end closes every pass. Each slot draws its shard on its
    own, which makes the counts of a source over shards multinomial with the source's quota as their sum;
    a source's draws are numbered by shard, and the number, through the permutation of its pass, names the
    block.
    """
    whole, words = F.col("source_size"), F.round("target").cast("long")
    plan = (
        targets.where("source_size > 0")
        .withColumn("_quota", words)
        .withColumn("_blocks", F.ceil(whole / block_words))
        .withColumn("_full", F.floor(whole / block_words))
        .withColumn("_passes", F.floor(F.col("_quota") / whole))
        .withColumn("_rest", F.col("_quota") - F.col("_passes") * whole)
        .withColumn("_slots", F.col("_passes") * F.col("_blocks") + F.ceil(F.col("_rest") / block_words))
        .where("_slots > 0")
    )
    shards = F.greatest(F.lit(1), F.ceil(F.sum("_slots").over(Window.partitionBy(F.lit(1))) / shard_slots))
    plan = common.written(plan.withColumn("_shards", shards), "plan")
    total = plan.agg(F.sum("_slots")).first()[0] or 0
    tasks = common.row_groups(total, TASK_SLOTS)
    kept = ["source_no", "source_size", "_blocks", "_full", "_passes", "_rest"]
    # few rows become many slots: runs of draws, and then shards, are dealt to as many tasks as their slots ask for
    runs = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_slots") - 1) / SLOT_RUN)))
    first = F.col("_run") * SLOT_RUN
    draws = (
        plan.withColumn("_run", runs)
        .repartition(tasks, "source_no", "_run")
        .withColumn("_draw", F.explode(F.sequence(first, F.least(first + SLOT_RUN, F.col("_slots")) - 1)))
        .withColumn("shard", F.pmod(F.xxhash64(F.lit(f"shard {seed}"), "source_no", "_draw"), F.col("_shards")))
    )
    counts = draws.groupBy(*kept, "shard").agg(F.count("*").alias("_n"))
    counts = common.written(counts.withColumn("_group", F.floor(F.col("shard") / SHARD_GROUP)), "counts")
    # running totals by groups of shards first, so that one source's shards are not one window
    groups = counts.groupBy("source_no", "_group").agg(F.sum("_n").alias("_all"))
    before = Window.partitionBy("source_no").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("source_no", "_group", F.coalesce(F.sum("_all").over(before), F.lit(0)).alias("_base"))
    earlier = Window.partitionBy("source_no", "_group").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    index = (
        counts.join(groups, ["source_no", "_group"])
        .withColumn("_first", F.col("_base") + F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .drop("_group", "_base")
        .repartition(tasks, "source_no", "shard")
        .withColumn("_j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
        .withColumn("_i", F.col("_first") + F.col("_j"))
        .withColumn("pass", F.floor(F.col("_i") / F.col("_blocks")))
        .withColumn("_at", F.col("_i") % F.col("_blocks"))
    )
    spot = permuted(F.col("_at"), F.greatest(F.col("_full"), F.lit(1)), F.lit(seed), F.col("source_no"), F.col("pass"))
    block = F.when(F.col("_at") < F.col("_full"), spot).otherwise(F.col("_full"))
    length = F.least(F.lit(block_words).cast("long"), F.col("source_size") - F.col("block") * block_words)
    left = F.col("_rest") - F.col("_at") * block_words
    return (
        index.withColumn("block", block)
        .withColumn("take", F.when(F.col("pass") < F.col("_passes"), length).otherwise(F.least(length, left)))
        .withColumn("slot", F.xxhash64(F.lit(f"slot {seed}"), "source_no", "_i"))
        .select("source_no", "block", "pass", "shard", "slot", "take")
    )


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    ids: str = "doc_id",
    block_words: int = 1024,
    shard_slots: int = 1024,
    seed: int = 1,
) -> tuple[DataFrame, DataFrame]:
    """Sizes of all rows, and the word ranges that the mix takes.

    First frame, one row per row of ``docs``: ``id``, ``n`` (which of the rows with this id, text and
    source it is), ``size``, ``source``, ``source_no``, ``source_size``, ``target``. Second frame:
    ``id``, ``n``, ``pass``, ``shard``, ``slot`` (order in the shard) and ``lo``, ``hi``, the words
    ``lo``..``hi`` - 1 of the document taken there. The sizes are counted once and written to the
    shared folder. Null texts have size 0 and are never taken; a null source is a source like any
    other; rows with one id are told apart by ``n``.
    """
    sized = docs.select(
        F.col(ids).alias("id"),
        F.col(source).alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(common.WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(text).alias("_text"),
    )
    alike = Window.partitionBy("id").orderBy(F.col("source").asc_nulls_last(), "size", "_text")
    sized = sized.withColumn("n", F.row_number().over(alike)).drop("_text")
    sized = common.written(sized, "sizes")
    targets = common.written(source_targets(sized), "targets")
    known = targets.select(F.col("source").alias("_source"), "source_no", "source_size", "target")
    sized = sized.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    placed_rows = placed(sized, sized.count())
    last = F.col("start") + F.col("size") - 1
    overlaps = placed_rows.withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("start") / block_words), F.floor(last / block_words)))
    )
    begin = F.col("block") * block_words
    taken = (
        # the slots come of a few rows, from which their number cannot be told: they are not for broadcast
        overlaps.join(slots(targets, block_words, shard_slots, seed).hint("merge"), ["source_no", "block"])
        .withColumn("lo", F.greatest(F.lit(0), begin - F.col("start")))
        .withColumn("hi", F.least(F.col("size"), begin + F.col("take") - F.col("start")))
        .where("hi > lo")
        .select("id", "n", "pass", "shard", "slot", "lo", "hi")
    )
    return sized, taken


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents as the mix takes them, with the columns of ``docs``.

    A document that the mix does not take goes. Of the others the text is what is taken of it: a pass that
    takes all its words gives the text as it is, another the words taken, joined by blanks; passes follow
    each other on lines of their own. ``n_chars``, if there, is the new length.
    """
    sized, taken = mix(docs, **options)
    keep = docs.columns
    ranges = (
        taken.groupBy("id", "n", "pass")
        .agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("ranges"))
        .groupBy("id", "n")
        .agg(F.sort_array(F.collect_list(F.struct("pass", "ranges"))).alias("passes"))
    )
    alike = Window.partitionBy("doc_id").orderBy(
        F.col("source").asc_nulls_last(), F.coalesce(F.regexp_count("text", F.lit(common.WORD)), F.lit(0)), F.xxhash64("text")
    )
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row")
    numbered = docs.select(row, "doc_id", "source", "text").select(
        "_row", F.col("doc_id").alias("_id"), F.row_number().over(alike).alias("_n")
    )
    joined = numbered.join(ranges, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_n") == F.col("n")))
    words = F.regexp_extract_all(F.col("_row.text"), F.lit(f"({common.WORD})"))
    joined = joined.withColumn("_words", words)

    def one_pass(p: Column) -> Column:
        total = F.aggregate(p["ranges"], F.lit(0).cast("long"), lambda a, r: a + r["hi"] - r["lo"])
        part = F.flatten(
            F.transform(p["ranges"], lambda r: F.slice("_words", (r["lo"] + 1).cast("int"), (r["hi"] - r["lo"]).cast("int")))
        )
        return F.when(total == F.size("_words"), F.col("_row.text")).otherwise(F.array_join(part, " "))

    joined = joined.withColumn("_text", F.array_join(F.transform("passes", one_pass), "\n"))
    new = {"text": F.col("_text"), "n_chars": F.char_length("_text").cast("long")}
    return joined.select(*[new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in keep])


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document the mix takes.

    A document of size 0 is returned with taken 0. The taken words of a source are its target, rounded.
    """
    sized, taken = mix(common.table(spark, sf_dir, "documents"))
    words = taken.groupBy("id", "n").agg(F.sum(F.col("hi") - F.col("lo")).alias("taken"))
    got = sized.alias("d").join(
        words.alias("w"), F.col("d.id").eqNullSafe(F.col("w.id")) & (F.col("d.n") == F.col("w.n")), "left"
    )
    return got.select(
        F.col("d.id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
    )
