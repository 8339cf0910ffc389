"""Removal of repeated passages by prefix-free parsing.

Every document is parsed into phrases by a rolling hash. The trigger of a 50-byte string is the smallest
hash among its 16-byte substrings; a phrase is a run of neighbouring strings with one trigger, so
consecutive phrases overlap by 49 bytes and each string lies in exactly one phrase. Equal strings have equal
triggers, wherever they stand. The corpus is thereby a dictionary of distinct phrases and a parse, the
order of the phrases in each document.

The dictionary is dealt to bins by trigger. Phrases whose trigger occurs in one document only share nothing
and are dropped, by a first exchange of 32-bit fingerprints. Of the others each bin hashes all strings of 50
bytes and sorts those whose hash meets another, up to that depth. Neighbours that agree are the same string,
and the smallest document among their phrases is its first one. The answer for each phrase goes back along
the parse, and the documents drop the bytes that are covered. No suffix array of the parse is built.

Texts travel in compressed chunks of a few MB. Within a chunk phrases are made distinct before anything is
sent, so thousands of copies weigh little more than one. A trigger found in very many chunks would fill
one bin with the places where a common passage begins or ends; its phrases are sent as single strings, dealt
out by a hash of the whole string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import common

#: Bytes of text in a chunk; a longer document is a chunk of its own.
CHUNK_BYTES = 8_000_000
#: Bytes of text for which there is one bin.
BIN_BYTES = 8_000_000
#: Bytes hashed at a time.
SEGMENT = 1 << 21
TRIGGER = 16
#: A trigger in more chunks than this has its phrases dealt out string by string.
HOT_CHUNKS = 2000
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)

LONE, SHARED, HOT = 0, 1, 2


def rolling(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of each substring of ``width`` bytes, put together from hashes of half the width."""
    own = (data.astype(np.uint64) + np.uint64(1)) * _A
    done, size, out, total = width, 1, None, 0
    while True:
        if done & 1:
            if out is None:
                out, total = own, size
            else:
                n = len(data) - total - size + 1
                out = (out[:n] * _B) ^ own[total : total + n]
                out = (out ^ (out >> np.uint64(31))) * _C
                total += size
        done >>= 1
        if not done:
            return out
        n = len(data) - 2 * size + 1
        own = (own[:n] * _C) ^ own[size : size + n]
        own = (own ^ (own >> np.uint64(29))) * _B
        size *= 2


def window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each run of ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    if size < width:
        rest = width - size
        values = np.minimum(values[:-rest], values[rest:])
    return values


class Chunk:
    """Documents laid end to end, with their phrases.

    ``start`` and ``windows`` of a phrase: its first byte, and its number of strings of ``length`` bytes;
    ``doc``: the row it is in; ``key``: its trigger, mixed. No phrase has more than 31 strings. Rows
    with a null id have no phrases.
    """

    def __init__(self, batch: pa.RecordBatch, length: int):
        self.length = length
        self.ids = batch.column(0)
        texts = batch.column(1).to_pylist()
        self.sizes = np.array([len(t or b"") for t in texts], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.begins = self.ends - self.sizes
        self.data = np.frombuffer(b"".join(t or b"" for t in texts), np.uint8)
        valid = np.array(self.ids.is_valid())
        self.known = valid
        self.id = np.array(self.ids.fill_null(0).cast(pa.int64()))
        row_of = np.repeat(np.arange(len(texts), dtype=np.int32), self.sizes)
        starts, windows, docs, keys = [], [], [], []
        for at in range(0, max(0, len(self.data) - length + 1), SEGMENT):
            part = self.data[at : at + SEGMENT + length - 1]
            least = window_minimum(rolling(part, TRIGGER), length - TRIGGER + 1)
            row = row_of[at : at + len(least)]
            inside = (np.arange(at + length, at + length + len(least)) <= self.ends[row]) & valid[row]
            new = np.ones(len(least), bool)
            new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
            first = np.flatnonzero(new)
            size = np.diff(first, append=len(least))
            # strings past the end of a document end its last phrase
            size = np.add.reduceat(inside, first) if len(first) else size
            first, size = first[size > 0], size[size > 0]
            cuts = -(-size // 31)
            if len(cuts) and cuts.max() > 1:
                nth = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
                size = np.minimum(31, np.repeat(size, cuts) - 31 * nth)
                first = np.repeat(first, cuts) + 31 * nth
            starts.append(first + at)
            windows.append(size)
            docs.append(row[first])
            keys.append(least[first])
        empty = [np.zeros(0, np.int64)]
        self.start, self.windows = np.concatenate(starts or empty), np.concatenate(windows or empty)
        self.doc = np.concatenate(docs or empty)
        key = np.concatenate(keys or [np.zeros(0, np.uint64)]) * _C
        self.key = (key ^ (key >> np.uint64(32))) * _A

    def place(self, bins: int) -> np.ndarray:
        """Bin (upper half) and fingerprint (lower half) of each phrase's trigger."""
        fingerprint = self.key & np.uint64(0xFFFFFFFF)
        return ((self.key >> np.uint64(32)) % np.uint64(bins) << np.uint64(32)) | fingerprint

    def triggers(self, bins: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct places, whether each is in documents of different ids, and each phrase's number among them."""
        found, number = np.unique(self.place(bins), return_inverse=True)
        low = np.full(len(found), np.iinfo(np.int64).max)
        high = np.full(len(found), np.iinfo(np.int64).min)
        np.minimum.at(low, number, self.id[self.doc])
        np.maximum.at(high, number, self.id[self.doc])
        return found, low != high, number


def pack(batches: list[pa.RecordBatch]) -> bytes:
    table = pa.Table.from_batches(batches).combine_chunks()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack(blob: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(blob).read_next_batch()


def chunks(docs: DataFrame, text: str, ids: str, chunk_bytes: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """Rows (chunk, n_bytes, data): whole documents of a task, as UTF-8, ``chunk_bytes`` together."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        held, size = [], 0

        def out():
            nonlocal n
            n += 1
            return pa.RecordBatch.from_pydict(
                {
                    "chunk": pa.array([(task << 32) + n], pa.int64()),
                    "n_bytes": pa.array([size], pa.int64()),
                    "data": pa.array([pack(held)], pa.binary()),
                }
            )

        for batch in common.slices(batches, "_text", chunk_bytes // 4):
            own = sum(len(x.as_buffer()) for x in batch.column(1) if x.is_valid)
            if held and size + own > chunk_bytes:
                yield out()
                held, size = [], 0
            held.append(batch)
            size += own
        if held:
            yield out()

    others = [F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(carry)]
    chosen = docs.select(F.col(ids).alias("_id"), F.col(text).cast("string").cast("binary").alias("_text"), *others)
    return chosen.mapInArrow(cut, "chunk long, n_bytes long, data binary")


def _by_bin(place: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The bins in sorted places, and where each one's are."""
    bins = (place >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    for a, b in zip(first, np.append(first[1:], len(bins)), strict=False):
        yield int(bins[a]), slice(int(a), int(b))


def fingerprints(parsed: DataFrame, bins: int, length: int) -> DataFrame:
    """Rows (bin, chunk, fingerprints, several): the triggers of each chunk, dealt to bins."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found, several, _ = Chunk(unpack(blob.as_buffer()), length).triggers(bins)
                rows = [
                    (b, chunk, found[s].astype(np.uint32).tobytes(), np.packbits(several[s]).tobytes())
                    for b, s in _by_bin(found)
                ]
                if rows:
                    columns = [*zip(*rows, strict=True)]
                    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                        names=["bin", "chunk", "fingerprints", "several"],
                    )

    schema = "bin long, chunk long, fingerprints binary, several binary"
    return parsed.select("chunk", "data").mapInArrow(deal, schema)


def shared_triggers(dealt: DataFrame, hot_chunks: int) -> DataFrame:
    """Rows (chunk, kind 0, bin, answer): for each trigger of the chunk whether other documents have it."""

    def judge(table: pa.Table) -> pa.Table:
        own = [np.frombuffer(x, np.uint32) for x in table["fingerprints"].to_pylist()]
        several = [
            np.unpackbits(np.frombuffer(x, np.uint8), count=len(n)).astype(bool)
            for x, n in zip(table["several"].to_pylist(), own, strict=True)
        ]
        _, number, count = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
        more = count[number] > 1
        more |= np.bincount(number, np.concatenate(several), len(count))[number] > 0
        state = np.where(count[number] > hot_chunks, HOT, np.where(more, SHARED, LONE)).astype(np.uint8)
        cuts = np.cumsum([len(n) for n in own])[:-1]
        answers = [np.packbits([s == SHARED, s == HOT], axis=1).tobytes() for s in np.split(state, cuts)]
        return pa.table(
            {
                "chunk": table["chunk"],
                "kind": pa.array([0] * len(answers), pa.int32()),
                "bin": table["bin"],
                "answer": pa.array(answers, pa.binary()),
            }
        )

    return dealt.groupBy("bin").applyInArrow(judge, "chunk long, kind int, bin long, answer binary")


class Entries:
    """The distinct phrases of a chunk that may be shared, in the order in which they are sent.

    ``phrase`` has the bytes, ``place`` bin and group (in a bin, only phrases of one group can share a
    string), ``least`` the smallest id here; ``number`` and ``windows`` name the entry and its strings for
    each sent occurrence, whose first byte is ``start`` and whose row is ``doc``.
    """

    def __init__(self, chunk: Chunk, answers: dict[int, bytes], bins: int):
        found, _, number = chunk.triggers(bins)
        state = np.zeros(len(found), np.uint8)
        for b, s in _by_bin(found):
            n = s.stop - s.start
            shared, hot = np.unpackbits(np.frombuffer(answers[b], np.uint8).reshape(2, -1), axis=1, count=n)
            state[s] = shared * SHARED + hot * HOT
        own = state[number]
        chosen = np.flatnonzero(own == SHARED)
        start, windows, doc = chunk.start[chosen], chunk.windows[chosen], chunk.doc[chosen]
        place = found[number[chosen]]
        hot = np.flatnonzero(own == HOT)
        if len(hot):  # one entry for each string
            each = chunk.windows[hot]
            nth = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            at = np.repeat(chunk.start[hot], each) + nth
            h = np.array(
                [
                    int.from_bytes(hashlib.blake2b(chunk.data[a : a + chunk.length].tobytes(), digest_size=8).digest(), "little")
                    for a in at
                ],
                np.uint64,
            )
            start, windows = np.concatenate([start, at]), np.concatenate([windows, np.ones(len(at), np.int64)])
            doc = np.concatenate([doc, np.repeat(chunk.doc[hot], each)])
            split = ((h >> np.uint64(32)) % np.uint64(bins) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))
            place = np.concatenate([place, split])
        raw = chunk.data.tobytes()
        stop = start + windows + chunk.length - 1
        seen: dict[bytes, int] = {}  # equal phrases have one trigger, so one place
        numbered = np.empty(len(start), np.int64)
        for at in range(0, len(start), 1 << 16):
            ends = zip(start[at : at + (1 << 16)].tolist(), stop[at : at + (1 << 16)].tolist(), strict=True)
            for i, (a, b) in enumerate(ends, at):
                numbered[i] = seen.setdefault(raw[a:b], len(seen))
        own_place = np.empty(len(seen), np.uint64)
        own_place[numbered] = place
        phrases = list(seen)
        del seen, raw
        order = np.argsort(own_place >> np.uint64(32), kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.number = rank[numbered]
        self.phrase = [phrases[i] for i in order.tolist()]
        self.place = own_place[order]
        self.least = np.full(len(order), np.iinfo(np.int64).max)
        np.minimum.at(self.least, self.number, chunk.id[doc])
        self.start, self.windows, self.doc = start, windows, doc


def _answers(replies: pa.Table, kind: int) -> dict[int, bytes]:
    return {
        b: a
        for k, b, a in zip(
            replies["kind"].to_pylist(), replies["bin"].to_pylist(), replies["answer"].to_pylist(), strict=True
        )
        if k == kind
    }


def phrases(parsed: DataFrame, replies: DataFrame, bins: int, length: int) -> DataFrame:
    """Rows (bin, chunk, groups, sizes, phrases, least): the dictionary entries of each chunk, dealt to bins."""
    schema = "bin long, chunk long, groups binary, sizes binary, phrases binary, least binary"
    kinds = (pa.int64(), pa.int64(), *[pa.binary()] * 4)
    names = ["bin", "chunk", "groups", "sizes", "phrases", "least"]

    def deal(text: pa.Table, answer: pa.Table) -> pa.Table:
        rows = []
        for chunk, blob in zip(text["chunk"].to_pylist(), text["data"].to_pylist(), strict=True):
            entries = Entries(Chunk(unpack(blob), length), _answers(answer, 0), bins)
            for b, s in _by_bin(entries.place):
                own = entries.phrase[s]
                sizes = np.array([len(p) for p in own], np.uint16)
                group = entries.place[s].astype(np.uint32)
                packed = pa.Codec("zstd", 3).compress(b"".join(own), asbytes=True)
                rows.append((b, chunk, group.tobytes(), sizes.tobytes(), packed, entries.least[s].tobytes()))
        columns = [*zip(*rows, strict=True)] or [[]] * 6
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return parsed.select("chunk", "data").groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(deal, schema)


def corpus_order(data: np.ndarray, begin: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by their first ``length`` bytes; which of them, in order, differ from the one before.

    Eight bytes of each suffix are one column, so little more than the columns is held.
    """
    columns = []
    for j in range(0, length, 8):
        part = np.zeros(len(begin), np.uint64)
        for k in range(j, min(j + 8, length)):
            part |= data[begin + k].astype(np.uint64) << np.uint64(8 * (7 - k + j))
        columns.append(part)
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for part in columns:
        ranked = part[order]
        new[1:] |= ranked[1:] != ranked[:-1]
    return order, new


def string_hashes(data: np.ndarray, begin: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the strings of ``length`` bytes at the ascending places ``begin``, a segment at a time."""
    cuts = np.searchsorted(begin, np.arange(0, len(data) + SEGMENT, SEGMENT))
    parts = [
        rolling(data[n * SEGMENT : (n + 1) * SEGMENT + length - 1], length)[begin[a:b] - n * SEGMENT]
        for n, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
        if a < b
    ]
    return np.concatenate([np.zeros(0, np.uint64), *parts])


def first_documents(phrase: list[bytes], group: np.ndarray, least: np.ndarray, length: int) -> np.ndarray:
    """For each phrase the bits of its strings that a smaller document than ``least`` has, lowest bit first."""
    seen: dict[bytes, int] = {}  # equal phrases are of one group
    number = np.fromiter((seen.setdefault(x, len(seen)) for x in phrase), np.int64, len(phrase))
    first = np.full(len(seen), np.iinfo(np.int64).max)
    np.minimum.at(first, number, least)
    owner = np.empty(len(seen), np.int64)
    owner[number] = group
    each = np.fromiter(map(len, seen), np.int64, len(seen)) - length + 1
    _, of_group, members = np.unique(owner, return_inverse=True, return_counts=True)
    several = members[of_group] > 1  # alone in its group, a phrase is found as a whole or not at all
    data = np.frombuffer(b"".join(p for p, s in zip(seen, several.tolist(), strict=True) if s), np.uint8)
    del seen

    strings = np.where(several, each, 0)
    at = np.cumsum(strings) - strings
    own = np.flatnonzero(several)
    nth = np.arange(strings.sum()) - np.repeat(at[own], each[own])
    before = np.cumsum(each[own] + length - 1) - (each[own] + length - 1)
    begin, from_doc = np.repeat(before, each[own]) + nth, np.repeat(first[own], each[own])
    if len(begin):
        # most suffixes differ from all others already in a hash of their strings, and need no place in the order
        hashes = string_hashes(data, begin, length)
        by_hash = np.argsort(hashes)
        same = hashes[by_hash][1:] == hashes[by_hash][:-1]
        met = np.zeros(len(begin), bool)
        met[by_hash[1:][same]] = met[by_hash[:-1][same]] = True
        chosen = np.flatnonzero(met)
        order, new = corpus_order(data, begin[chosen], length)
        if len(order):
            holder = from_doc[chosen][order]
            from_doc[chosen[order]] = np.minimum.reduceat(holder, np.flatnonzero(new))[np.cumsum(new) - 1]

    bits = np.where(first[number] < least, (np.int64(1) << each[number]) - 1, 0)
    mixed = np.flatnonzero(several[number])
    if len(mixed):
        count = each[number[mixed]]
        start = np.cumsum(count) - count
        nth = np.arange(count.sum()) - np.repeat(start, count)
        found = from_doc[np.repeat(at[number[mixed]], count) + nth] < np.repeat(least[mixed], count)
        bits[mixed] = np.bitwise_or.reduceat(found.astype(np.int64) << nth, start)
    return bits.astype(np.uint32)


def covered(dealt: DataFrame, length: int) -> DataFrame:
    """Rows (chunk, kind 1, bin, answer): the strings of each entry that a smaller document has."""

    def judge(table: pa.Table) -> pa.Table:
        phrase: list[bytes] = []
        cuts = [0]
        for sizes, packed in zip(table["sizes"].to_pylist(), table["phrases"].to_pylist(), strict=True):
            own = np.frombuffer(sizes, np.uint16).astype(np.int64)
            raw = pa.Codec("zstd").decompress(packed, int(own.sum()), asbytes=True)
            stop = np.cumsum(own)
            phrase += [raw[a:b] for a, b in zip((stop - own).tolist(), stop.tolist(), strict=True)]
            cuts.append(len(phrase))
        group = np.concatenate([np.frombuffer(x, np.uint32) for x in table["groups"].to_pylist()])
        least = np.concatenate([np.frombuffer(x, np.int64) for x in table["least"].to_pylist()])
        bits = first_documents(phrase, group, least, length)
        return pa.table(
            {
                "chunk": table["chunk"],
                "kind": pa.array([1] * table.num_rows, pa.int32()),
                "bin": table["bin"],
                "answer": pa.array([bits[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
            }
        )

    return dealt.groupBy("bin").applyInArrow(judge, "chunk long, kind int, bin long, answer binary")


def removed_bytes(chunk: Chunk, answers: dict[int, bytes], bits: dict[int, bytes], bins: int) -> np.ndarray:
    """Which bytes of the chunk are covered by a string that a smaller document has."""
    entries = Entries(chunk, answers, bins)
    mask = np.zeros(len(entries.phrase), np.uint32)
    for b, s in _by_bin(entries.place):
        mask[s] = np.frombuffer(bits[b], np.uint32)
    own = mask[entries.number].astype(np.int64)
    later = chunk.id[entries.doc] > entries.least[entries.number]
    own[later] = (np.int64(1) << entries.windows[later]) - 1
    change = np.zeros(len(chunk.data) + chunk.length + 1, np.int32)
    for j in range(31):
        at = entries.start[(own >> j) & 1 == 1] + j
        np.add.at(change, at, 1)
        np.add.at(change, at + chunk.length, -1)
    del entries
    return np.cumsum(change[: len(chunk.data)], dtype=np.int32) > 0


def whole_characters(data: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """``gone`` with all bytes of a character added of which one is gone, in UTF-8."""
    first = (data & 0xC0) != 0x80
    character = np.cumsum(first)
    cut = np.bincount(character[gone], minlength=int(character[-1]) + 1 if len(character) else 1) > 0
    return cut[character]


def _digests(chunk: Chunk, gone: np.ndarray, with_text: bool) -> list[tuple]:
    out = []
    for a, b in zip(chunk.begins.tolist(), chunk.ends.tolist(), strict=True):
        own = gone[a:b]
        kept = chunk.data[a:b][~own].tobytes()
        spans = int((own[1:] & ~own[:-1]).sum() + (own[:1].sum() if len(own) else 0))
        row = (b - a, int(own.sum()), spans, hashlib.sha256(kept).hexdigest())
        if with_text:
            kept = chunk.data[a:b][~whole_characters(chunk.data[a:b], own)].tobytes().decode("utf-8", "replace")
        out.append((*row, kept) if with_text else row)
    return out


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    ids: str = "doc_id",
    length: int = 50,
    with_text: bool = False,
    chunk_bytes: int = CHUNK_BYTES,
    bin_bytes: int = BIN_BYTES,
    hot_chunks: int = HOT_CHUNKS,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: ``ids``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, if asked ``kept``.

    Columns in ``carry`` follow, as ``_0``, ``_1`` and so on.

    A byte goes if a string of ``length`` bytes over it also starts in a document with a smaller id. Strings
    are judged on the texts as given and never cross documents. A null text is empty. Rows of one id take
    nothing from each other; a row with a null id keeps all its bytes and takes none. ``kept`` is the text
    without the characters of which a byte goes. Ids are whole numbers.
    """
    if not TRIGGER <= length < 1 << 15:
        raise ValueError("length is outside what phrases can hold")
    parsed = common.written(chunks(docs, text, ids, chunk_bytes, carry), "chunks")
    total = parsed.agg(F.sum("n_bytes")).first()[0] or 0
    bins = max(1, -(-total // bin_bytes))
    replies = common.written(shared_triggers(fingerprints(parsed, bins, length), hot_chunks), "triggers")
    found = common.written(covered(phrases(parsed, replies, bins, length), length), "covered")

    key = docs.schema[ids].dataType.simpleString()
    schema = f"`{ids}` {key}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept string" * with_text
    schema += "".join(f", _{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(carry))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()][: 4 + with_text]
    names = [ids, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 + with_text]

    def apply(texts: pa.Table, reply: pa.Table) -> pa.Table:
        out = []
        for blob in texts["data"].to_pylist():
            batch = unpack(blob)
            chunk = Chunk(batch, length)
            gone = removed_bytes(chunk, _answers(reply, 0), _answers(reply, 1), bins)
            rows = [*zip(*_digests(chunk, gone, with_text), strict=True)]
            found = [pa.array(c, k) for c, k in zip(rows, kinds, strict=True)]
            others = {f"_{i}": batch.column(2 + i) for i in range(batch.num_columns - 2)}
            out.append(pa.Table.from_arrays([chunk.ids, *found, *others.values()], names=[*names, *others]))
        return pa.concat_tables(out)

    both = replies.unionByName(found)
    return parsed.select("chunk", "data").groupBy("chunk").cogroup(both.groupBy("chunk")).applyInArrow(apply, schema)


def without_repeats(docs: DataFrame, text: str = "text", ids: str = "doc_id", length: int = 50, **options) -> DataFrame:
    """The rows of ``docs`` with what remove_repeats keeps as their text; rows without a word left go.

    ``n_chars``, if there, is the new length. The other columns travel with the texts.
    """
    others = tuple(c for c in docs.columns if c != text)
    found = remove_repeats(docs, text, ids, length, with_text=True, carry=others, **options)
    new = {c: F.col(f"_{i}") for i, c in enumerate(others)} | {text: F.col("kept")}
    if "n_chars" in others:
        new["n_chars"] = F.char_length("kept").cast(docs.schema["n_chars"].dataType)
    return found.where(F.col("kept").rlike(common.WORD)).select(*[new[c].alias(c) for c in docs.columns])


#: The query's rows in SQL, by definition: every string of 50 bytes and the smallest id that has it.
ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), parts AS (
  SELECT rid, doc_id, a AS base, substr(h, 2 * a + 1, 2 * 1049) AS part
  FROM (SELECT rid, doc_id, h, unnest(range(0, greatest(length(h) // 2 - 49, 0), 1000)) AS a FROM docs WHERE doc_id IS NOT NULL)
), starts AS (
  SELECT rid, doc_id, base + p AS start, unhex(substr(part, 2 * p + 1, 100)) AS string
  FROM (SELECT *, unnest(range(0, least(length(part) // 2 - 49, 1000))) AS p FROM parts)
), firsts AS (
  SELECT string, min(doc_id) AS first_id FROM starts GROUP BY string HAVING min(doc_id) < max(doc_id)
), covered AS (
  SELECT s.rid, s.start FROM starts s JOIN firsts f ON s.string = f.string AND f.first_id < s.doc_id
), marked AS (
  SELECT rid, start, CASE WHEN start - lag(start) OVER (PARTITION BY rid ORDER BY start) <= 50 THEN 0 ELSE 1 END AS opens
  FROM covered
), runs AS (
  SELECT rid, min(start) AS lo, max(start) + 50 AS hi
  FROM (SELECT rid, start, sum(opens) OVER (PARTITION BY rid ORDER BY start) AS run FROM marked)
  GROUP BY rid, run
), gaps AS (
  SELECT r.rid, r.lo, r.hi, coalesce(lag(r.hi) OVER (PARTITION BY r.rid ORDER BY r.lo), 0) AS before FROM runs r
), kept AS (
  SELECT g.rid, sum(g.hi - g.lo) AS n_removed, count(*) AS n_spans, max(g.hi) AS last,
         string_agg(substr(d.h, 2 * g.before + 1, 2 * (g.lo - g.before)), '' ORDER BY g.lo) AS front
  FROM gaps g JOIN docs d ON g.rid = d.rid GROUP BY g.rid
)
SELECT d.doc_id, CAST(length(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(k.n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN k.rid IS NULL THEN d.h ELSE concat(k.front, substr(d.h, 2 * k.last + 1)) END)) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.rid = k.rid
"""


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeat a 50-byte string of a document with a smaller doc_id."""
    return remove_repeats(common.table(spark, sf_dir, "documents"))
