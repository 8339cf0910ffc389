"""Near-duplicate documents by a chosen-path join of shingle sets.

Every distinct set of shingles has a signature of minwise tokens. In each of several independent trees a set
follows the path of its chosen tokens: sets that agree on the tokens so far meet in a node, and a node with
too many sets branches by further tokens. Within small nodes all pairs are compared by signature. Candidates
are confirmed on the full sets, and the links make components.

Documents with equal sets are one set from the start. Of a dense node only a spanning forest and the likeliest
pairs are confirmed at first; what they join needs no further test. The other pairs of dense nodes, and those
of nodes that were too large, are then compared on the full sets within the node, large nodes block by block,
apart from pairs within a component. A pair that meets in several trees is compared in the first of them. No
pair is given up for a node's size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import common
from cadenza.llm.components import components
from cadenza.llm.lm_scoring import words_of

#: Minwise tokens of a signature; 16 bits of each are kept.
TOKENS = 128
TREES = 12
#: Numbers of tokens that the paths have, one level after the other.
DEPTHS = (2, 4, 8, 16, 32, 64, 128)
#: Sets in a node that are compared with each other at once.
NODE_SETS = 1500
#: Shingles in a block of a large node.
BLOCK_SHINGLES = 2_000_000
#: Pairs of a dense node that are confirmed at first, for each of its sets.
FIRST_PAIRS = 4
#: A pair is a candidate if its estimate is at most this far below the threshold, or further, as ``MISS`` asks.
MARGIN = 0.12
#: Probability, at most, that the estimate of a pair at the threshold is too low for a candidate.
MISS = 1e-6
CHUNK_BYTES = 8_000_000
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_RNG = np.random.default_rng(20240229)
_MULTIPLY = _RNG.integers(0, 1 << 32, (2, TOKENS), dtype=np.uint32) | np.uint32(1)
_ADD = _RNG.integers(0, 1 << 32, TOKENS, dtype=np.uint32)
_ORDERS = np.array([np.random.default_rng([7, t]).permutation(TOKENS) for t in range(256)])


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def shingle_sets(texts: list[bytes | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, end to end, and how many each text has.

    A text with fewer words than ``width`` has its whole sequence as the one shingle, without words none.
    """
    numbers = _Numbers()
    number_of = numbers.__getitem__
    tokens = [np.fromiter(map(number_of, own), np.int64, len(own)) for own in map(words_of, texts)]
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, numbers), np.uint64, len(numbers))
    found = []
    for own in tokens:
        h = hashes[own]
        n = max(min(len(h), 1), len(h) - width + 1)
        out = np.full(n, min(len(h), width), np.uint64)
        for j in range(min(width, len(h))):
            out = (out ^ h[j : j + n]) * _M1
            out ^= out >> np.uint64(32)
            out *= _M2
        found.append(np.unique(out))
    return np.concatenate([np.zeros(0, np.uint64), *found]), np.array([len(s) for s in found], np.int64)


def signatures(shingles: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Minwise tokens of each nonempty set, 16 bits each."""
    low, high = shingles.astype(np.uint32), (shingles >> np.uint64(32)).astype(np.uint32)
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    out = np.zeros((len(starts), TOKENS), np.uint16)
    if len(starts):
        for i in range(TOKENS):
            value = (low ^ _ADD[i]) * _MULTIPLY[0, i] + high * _MULTIPLY[1, i]
            least = np.minimum.reduceat(value, starts)
            out[:, i] = (least ^ (least >> np.uint32(16))) & np.uint32(0xFFFF)
    return out


def least_agreeing(percent: int) -> int:
    """Equal tokens that make a pair a candidate: a pair of similarity ``percent`` has fewer with ``MISS`` at most."""
    p, below = percent / 100, 0.0
    for k in range(TOKENS + 1):
        below += math.comb(TOKENS, k) * p**k * (1 - p) ** (TOKENS - k)
        if below > MISS:
            break
    return max(0, min(k, math.floor(TOKENS * (p - MARGIN))))


def document_sets(docs: DataFrame, text: str, ids: str, width: int, with_shingles: bool = False) -> DataFrame:
    """Rows (id, n, key, tokens) or, with the shingles, (id, n, key, shingles).

    ``key`` is a 128-bit hash of the sorted set; it and ``tokens`` are null for an empty set.
    """
    key = docs.schema[ids].dataType.simpleString()
    last = "shingles array<bigint>" if with_shingles else "tokens binary"

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "_text", CHUNK_BYTES):
            shingles, sizes = shingle_sets(batch.column(1).to_pylist(), width)
            ends = np.cumsum(sizes)
            raw = shingles.tobytes()
            keys = [
                xxhash.xxh3_128_digest(raw[8 * (b - n) : 8 * b]) if n else None
                for b, n in zip(ends.tolist(), sizes.tolist(), strict=True)
            ]
            if with_shingles:
                offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                extra = pa.ListArray.from_arrays(offsets, pa.array(shingles.view(np.int64)))
            else:
                found = iter(signatures(shingles, sizes))
                extra = pa.array([next(found).tobytes() if n else None for n in sizes], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), extra],
                names=["id", "n", "key", last.split()[0]],
            )

    chosen = docs.select(F.col(ids).alias("id"), F.col(text).cast("string").cast("binary").alias("_text"))
    return chosen.mapInArrow(build, f"id {key}, n long, key binary, {last}")


def paths(rows: DataFrame, depth: int, trees: int) -> DataFrame:
    """Rows (node, tree, key): the node that each set reaches after ``depth`` tokens.

    ``rows`` has (key, tokens), for all trees, or (key, tokens, tree).
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, TOKENS)
            own = np.array(batch.column(2)) if batch.num_columns > 2 else None
            for t in range(trees):
                at = np.arange(len(tokens)) if own is None else np.flatnonzero(own == t)
                if not len(at):
                    continue
                node = np.full(len(at), t + 1, np.uint64)
                for j in _ORDERS[t % len(_ORDERS)][:depth]:
                    node = (node ^ tokens[at, j].astype(np.uint64)) * _M1
                    node ^= node >> np.uint64(29)
                    node *= _M2
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(node.view(np.int64)),
                        pa.array(np.full(len(at), t, np.int32)),
                        batch.column(0).take(pa.array(at)),
                    ],
                    names=["node", "tree", "key"],
                )

    return rows.mapInArrow(walk, "node long, tree int, key binary")


def branch(sets: DataFrame, trees: int, node_sets: int) -> tuple[DataFrame, DataFrame, bool]:
    """Members (node, tree, key) of small nodes, those of the first level, and whether one was too large there.

    ``sets`` has (key, tokens). The first frame has the nodes of all levels with 2 to ``node_sets`` sets, the
    second all nodes of the first level, with ``members``. Every further level handles only the sets whose
    node was too large.
    """
    found, first, rows = None, None, sets.select("key", "tokens")
    count = sets.count() * trees
    for depth in DEPTHS:
        at = common.written(paths(rows, depth, trees), "paths", count)
        sizes = at.groupBy("node").agg(F.count("*").alias("members")).where("members > 1")
        there = common.written(at.join(sizes, "node"), "members", count)
        common.drop_written(at)
        small = there.where(F.col("members") <= node_sets).select("node", "tree", "key")
        found = small if found is None else found.union(small)
        over = there.where(F.col("members") > node_sets).select("node", "tree", "key")
        count = over.count()
        if first is None:
            first, wide = there.select("node", "tree", "key", "members"), count > 0
        if not count:
            break
        rows = over.select("key", "tree").join(sets.select("key", "tokens"), "key").select("key", "tokens", "tree")
    return found, first, wide


def _agreeing(tokens: np.ndarray, sizes: np.ndarray, group: np.ndarray, least: int, ratio: float):
    """Pairs of one group with at least ``least`` equal tokens: two indexes and the number.

    Rows are sorted by group. Sizes that rule the threshold out are skipped.
    """
    left, right, equal = [], [], []
    active = np.arange(len(group))
    for shift in range(1, len(group)):
        active = active[active + shift < len(group)]
        active = active[group[active] == group[active + shift]]
        if not len(active):
            break
        for a in np.array_split(active, -(-len(active) // 20_000)):
            b = a + shift
            small, big = np.minimum(sizes[a], sizes[b]), np.maximum(sizes[a], sizes[b])
            near = small >= ratio * big
            a, b = a[near], b[near]
            same = (tokens[a] == tokens[b]).sum(axis=1)
            chosen = same >= least
            left.append(a[chosen])
            right.append(b[chosen])
            equal.append(same[chosen])
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right), np.concatenate(equal)


def _chosen(left: np.ndarray, right: np.ndarray, most: int) -> np.ndarray:
    """Of pairs in order of likelihood the first ``most``, and a spanning forest of all."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    vertices = len(np.unique(np.concatenate([left, right])))
    keep = np.zeros(len(left), bool)
    keep[:most] = True
    joined = 0
    for i, (a, b) in enumerate(zip(left.tolist(), right.tolist(), strict=True)):
        a, b = root(a), root(b)
        if a != b:
            parent[a] = b
            keep[i] = True
            joined += 1
            if joined == vertices - 1:
                break
    return keep


def candidates(members: DataFrame, rows: int, least: int, ratio: float) -> DataFrame:
    """Rows (u, v, node): pairs to confirm, u < v; a row with null u marks a node that has more of them.

    ``members`` has (node, key, n, tokens). A node gives all its pairs or, if these are more than
    ``FIRST_PAIRS`` for a set, so many and a spanning forest. Many nodes are handled in one call.
    """

    def compare(table: pa.Table) -> pa.Table:
        node = table["node"].to_numpy()
        order = np.argsort(node, kind="stable")
        node = node[order]
        tokens = np.frombuffer(b"".join(table["tokens"].to_pylist()), np.uint16).reshape(-1, TOKENS)[order]
        key = np.array(table["key"].to_pylist(), object)[order]
        left, right, equal = _agreeing(tokens, table["n"].to_numpy()[order], node, least, ratio)
        members_of = dict(zip(*np.unique(node, return_counts=True), strict=True))
        out_u, out_v, out_node = [], [], []
        by_node = np.lexsort([right, left, -equal, node[left]])
        left, right = left[by_node], right[by_node]
        cuts = np.flatnonzero(node[left][1:] != node[left][:-1]) + 1
        for l, r in zip(np.split(left, cuts), np.split(right, cuts), strict=True):
            if not len(l):
                continue
            name = int(node[l[0]])
            most = FIRST_PAIRS * members_of[name]
            if len(l) > most:
                keep = _chosen(l, r, most)
                l, r = l[keep], r[keep]
                out_u.append(None)
                out_v.append(None)
                out_node.append(name)
            for x, y in zip(key[l], key[r], strict=True):
                out_u.append(min(x, y))
                out_v.append(max(x, y))
                out_node.append(name)
        return pa.table(
            {"u": pa.array(out_u, pa.binary()), "v": pa.array(out_v, pa.binary()), "node": pa.array(out_node, pa.int64())}
        )

    called = members.withColumn("_call", F.pmod(F.xxhash64("node"), F.lit(common.row_groups(rows, 5_000))))
    return called.groupBy("_call").applyInArrow(compare, "u binary, v binary, node long")


def full_sets(keys: DataFrame, sets: DataFrame, docs: DataFrame, text: str, ids: str, width: int) -> DataFrame:
    """Rows (key, shingles) for distinct keys, built anew from one document of each.

    The ids of these are a written table, whose bytes the planner knows when it picks the join with the texts.
    """
    wanted = common.written(sets.select("key", "id").join(keys, "key").select("id").distinct(), "wanted")
    own = docs.select(F.col(ids).alias("id"), F.col(text).alias("text")).join(wanted, "id", "left_semi")
    full = document_sets(own, "text", "id", width, with_shingles=True).where("n > 0").select("key", "shingles")
    return common.written(full.join(keys, "key", "left_semi").dropDuplicates(["key"]), "full")


def confirmed(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (u, v) those whose full sets have 100 * intersection >= percent * union."""
    a, b = (full.select(F.col("key").alias(k), F.col("shingles").alias(f"s{k}")) for k in "uv")
    both = pairs.join(a, "u").join(b, "v")
    shared = F.size(F.array_intersect("su", "sv"))
    linked = both.select("u", "v", shared.alias("i"), (F.size("su") + F.size("sv")).alias("t"))
    return linked.where(F.col("i") * 100 >= (F.col("t") - F.col("i")) * percent).select("u", "v")


def blocks(members: DataFrame) -> DataFrame:
    """Members (node, tree, key, n, part) of nodes again as pairs of blocks: (node, tree, key, part, block).

    A part with many shingles has blocks of its own, which are not compared with each other; small parts share
    blocks. Only pairs of blocks that hold different parts are made.
    """
    sizes = members.groupBy("node", "part").agg(F.sum("n").alias("_n"))
    big = F.col("_n") >= BLOCK_SHINGLES // 4
    total = sizes.groupBy("node").agg(F.sum(F.when(~big, F.col("_n")).otherwise(0)).alias("_small"))
    sized = members.join(sizes, ["node", "part"]).join(total, "node")
    own = F.pmod(F.xxhash64("key"), F.ceil(F.col("_n") / BLOCK_SHINGLES))
    shared = F.pmod(F.xxhash64("part"), F.greatest(F.lit(1), F.ceil(F.col("_small") / BLOCK_SHINGLES)))
    block = F.when(big, F.xxhash64("part", own)).otherwise(F.xxhash64(F.lit("shared"), shared))
    placed = sized.select("node", "tree", "key", "part", block.alias("block"), F.when(big, F.col("part")).alias("alone"))
    placed = common.written(placed, "blocks")
    each = placed.groupBy("node", "block", "alone").agg((F.min("part") != F.max("part")).alias("mixed"))
    a = each.select("node", F.col("block").alias("a"), F.col("alone").alias("pa"), "mixed")
    b = each.select("node", F.col("block").alias("b"), F.col("alone").alias("pb"))
    pairs = a.join(b, "node").where("a < b AND NOT (pa <=> pb AND pa IS NOT NULL) OR a = b AND mixed")
    named = pairs.select("node", F.explode(F.array_distinct(F.array("a", "b"))).alias("block"), F.xxhash64("node", "a", "b").alias("_pair"))
    joined = named.join(placed, ["node", "block"])
    return joined.select(F.col("_pair").alias("node"), "tree", "key", "part", "block")


def links_within(members: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) between sets of one node but different parts, found on the full sets.

    ``members`` has (node, tree, key, part, block, n, tokens, shingles). In a node of two blocks only pairs across
    are compared, whatever their tokens. A pair that meets in the first level of an earlier tree is left to that.
    Linked sets share one of their rarest shingles, of so many as one may have beside the other, so only those that
    do are counted out.
    """

    def compare(table: pa.Table) -> pa.Table:
        order = np.argsort(table["key"].to_numpy(zero_copy_only=False), kind="stable")
        table = table.take(pa.array(order))
        tokens = np.frombuffer(b"".join(table["tokens"].to_pylist()), np.uint16).reshape(-1, TOKENS)
        key, sizes, tree = table["key"].to_pylist(), table["n"].to_numpy(), table["tree"][0].as_py()
        part = np.unique(np.array([x.hex() for x in table["part"].to_pylist()]), return_inverse=True)[1]
        block = table["block"].to_numpy()
        two = block.min() != block.max()
        shingles = table["shingles"].combine_chunks()
        codes, often = np.unique(shingles.flatten().to_numpy(), return_inverse=True, return_counts=True)[1:]
        codes = np.argsort(np.argsort(often, kind="stable"))[codes]  # rare ones first
        ends, owner = np.cumsum(sizes), np.repeat(np.arange(len(key), dtype=np.int32), sizes)
        codes |= owner.astype(np.int64) << 32  # so that one sort in place orders each set's codes
        codes.sort()
        codes = (codes & 0xFFFFFFFF).astype(np.int32)
        rarest = sizes + (-percent * sizes) // 100 + 1
        head = np.arange(len(codes)) - np.repeat(ends - sizes, sizes) < np.repeat(rarest, sizes)
        by_code = np.argsort(codes[head], kind="stable")
        holders, held = owner[head][by_code], codes[head][by_code]
        out_u, out_v = [], []
        there = np.zeros(int(codes.max(initial=0)) + 1, bool)
        for a in range(len(key) - 1):
            b = np.arange(a + 1, len(key))
            b = b[part[b] != part[a]]
            b = b[block[b] != block[a]] if two else b
            small, big = np.minimum(sizes[a], sizes[b]), np.maximum(sizes[a], sizes[b])
            b = b[100 * small >= percent * big]
            rare = codes[ends[a] - sizes[a] : ends[a] - sizes[a] + rarest[a]]
            low, high = np.searchsorted(held, rare), np.searchsorted(held, rare, "right")
            meets = np.zeros(len(key), bool)
            meets[holders[np.repeat(high - np.cumsum(high - low), high - low) + np.arange((high - low).sum())]] = True
            b = b[meets[b]]
            for t in range(tree):
                at = _ORDERS[t % len(_ORDERS)][: DEPTHS[0]]
                b = b[(tokens[b][:, at] != tokens[a, at]).any(axis=1)]
            if not len(b):
                continue
            own = codes[ends[a] - sizes[a] : ends[a]]
            there[own] = True
            for part_of_b in np.array_split(b, -(-int(sizes[b].sum()) // 4_000_000)):
                at = np.concatenate([np.arange(ends[i] - sizes[i], ends[i]) for i in part_of_b])
                starts = np.cumsum(sizes[part_of_b]) - sizes[part_of_b]
                shared = np.add.reduceat(there[codes[at]].astype(np.int64), starts)
                for i in part_of_b[100 * shared >= percent * (sizes[a] + sizes[part_of_b] - shared)]:
                    out_u.append(key[a])
                    out_v.append(key[i])
            there[own] = False
        return pa.table({"u": pa.array(out_u, pa.binary()), "v": pa.array(out_v, pa.binary())})

    return members.groupBy("node").applyInArrow(compare, "u binary, v binary").distinct()


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    ids: str = "doc_id",
    width: int = 5,
    percent: int = 80,
    trees: int = TREES,
    node_sets: int = NODE_SETS,
) -> DataFrame:
    """One row per document: ``ids``, ``n_shingles``, ``component_id``, ``kept``.

    Documents are linked if 100 * intersection >= percent * union of their shingle sets. A null text, and one
    without words, has no shingles and is linked with nothing, as is a row with a null id, whose component is
    null and which is kept. Rows of one id are in the component by their texts; all rows with the component's
    id are kept.
    """
    least = least_agreeing(percent)
    own = common.written(document_sets(docs, text, ids, width), "sets")
    named = own.where("n > 0 AND id IS NOT NULL")
    sets = named.groupBy("key").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("tokens").alias("tokens"))
    sets = common.written(sets, "distinct")
    small, first, wide = branch(sets, trees, node_sets)
    signed = sets.select("key", "n", "tokens")
    members = common.written(small.join(signed, "key").select("node", "key", "n", "tokens"), "nodes")
    rows = members.count()
    found = candidates(members, rows, least, percent / 100).coalesce(common.row_groups(rows, 5_000))
    found = common.written(found, "candidates")
    pairs = common.written(found.where("u IS NOT NULL").select("u", "v").distinct(), "pairs", rows)
    count = pairs.count()
    ends = pairs.select(F.col("u").alias("key")).union(pairs.select(F.col("v").alias("key"))).distinct()
    full = full_sets(ends, sets, docs, text, ids, width)
    links = common.written(confirmed(pairs, full, percent), "links")
    parts = common.written(components(links, count), "parts", count)

    dense = common.written(found.where("u IS NULL").select("node").distinct(), "dense", 1)
    if wide or dense.limit(1).count():
        rest = first.join(dense.withColumn("_dense", F.lit(True)), "node", "left")
        rest = rest.where((F.col("members") > node_sets) | F.col("_dense")).select("node", "tree", "key")
        rest = rest.join(parts, F.col("key") == F.col("vertex"), "left").select(
            "node", "tree", "key", F.coalesce("component", "key").alias("part")
        )
        cut = common.written(blocks(rest.join(sets.select("key", "n"), "key")), "cut")
        keys = common.written(cut.select("key").distinct(), "keys")
        full = full_sets(keys, sets, docs, text, ids, width)
        more = links_within(cut.join(signed, "key").join(full, "key"), percent)
        links = common.written(links.union(more), "links")
        parts = common.written(components(links, count), "parts", count)

    of_set = sets.join(parts, F.col("key") == F.col("vertex"), "left").select(
        "key", "id", F.coalesce("component", "key").alias("component")
    )
    least_id = of_set.groupBy("component").agg(F.min("id").alias("component_id"))
    labelled = of_set.join(least_id, "component").select("key", "component_id")
    joined = own.select("id", "n", "key").join(
        labelled, (own["key"] == labelled["key"]) & own["id"].isNotNull(), "left"
    )
    component = F.coalesce("component_id", "id")
    return joined.select(
        F.col("id").alias(ids),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )


def first_of_each(docs: DataFrame, ids: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Of each component the row of ``docs`` with the smallest id; all rows with a null id.

    Rows of one id with different texts are documents of their own, and among them the smallest hash of a text
    comes first. Of rows with equal id and text one stays, chosen by a hash of all columns.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    digest = F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"))
    own = docs.where(F.col(ids).isNotNull()).select(
        F.struct(F.col(ids).alias("id"), digest.alias("digest")).alias("_doc"), F.col(text).alias("_text"), row.alias("_row")
    )
    found = near_duplicates(own, text="_text", ids="_doc", **options).where("kept").select("_doc").distinct()
    kept = own.join(found, "_doc", "left_semi").withColumn("_order", F.xxhash64(F.to_json("_row")))
    kept = kept.groupBy("_doc").agg(F.min_by("_row", "_order").alias("_row"))
    return kept.select("_row.*").union(docs.where(F.col(ids).isNull()))


#: The query's rows in SQL. Linked sets share one of so many of their rarest shingles as one may have beside the other.
ORACLE = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT rid, s FROM (
    SELECT rid, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 1), lambda i: concat(w[i], ' ', w[i + 1], ' ', w[i + 2])) END) AS s
    FROM docs)
), sizes AS (
  SELECT rid, count(*) AS n, sha256(string_agg(s, chr(10) ORDER BY s)) AS key FROM shingles GROUP BY rid
), sets AS (
  SELECT z.key, any_value(z.n) AS n, min(z.rid) AS rid
  FROM sizes z JOIN docs d ON z.rid = d.rid WHERE d.doc_id IS NOT NULL GROUP BY z.key
), ranked AS (
  SELECT e.key, e.n, h.s, row_number() OVER (PARTITION BY e.key ORDER BY f.often, h.s) AS rank
  FROM sets e JOIN shingles h ON e.rid = h.rid
  JOIN (SELECT s, count(*) AS often FROM shingles WHERE rid IN (SELECT rid FROM sets) GROUP BY s) f ON h.s = f.s
), heads AS (
  SELECT key, n, s FROM ranked WHERE rank <= n - (85 * n + 99) // 100 + 1
), pairs AS (
  SELECT DISTINCT a.key AS u, b.key AS v, a.n AS un, b.n AS vn
  FROM heads a JOIN heads b ON a.s = b.s AND a.key < b.key
  WHERE 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
), links AS (
  SELECT p.u, p.v FROM pairs p JOIN ranked a ON a.key = p.u JOIN ranked b ON b.key = p.v AND a.s = b.s
  GROUP BY p.u, p.v, p.un, p.vn HAVING 100 * count(*) >= 85 * (p.un + p.vn - count(*))
), both_ways AS (
  SELECT u AS a, v AS b FROM links UNION ALL SELECT v, u FROM links
), reach AS (
  SELECT key AS a, key AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a
), component AS (
  SELECT r.a AS key, min(d.doc_id) AS component_id
  FROM reach r JOIN sizes z ON r.b = z.key JOIN docs d ON z.rid = d.rid GROUP BY r.a
)
SELECT d.doc_id, CAST(coalesce(z.n, 0) AS BIGINT) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id,
       coalesce(coalesce(c.component_id, d.doc_id) = d.doc_id, true) AS kept
FROM docs d LEFT JOIN sizes z ON d.rid = z.rid LEFT JOIN component c ON z.key = c.key AND d.doc_id IS NOT NULL
"""


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 3-word shingles have a similarity of 0.85 or more."""
    return near_duplicates(common.table(spark, sf_dir, "documents"), width=3, percent=85)
