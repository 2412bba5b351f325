"""Packing: documents cut into pieces, pieces put into windows by Karmarkar-Karp multiway differencing.

A document's ids, closed by the end id, are cut into full windows and a rest, the rest into pieces of at most ``cut``
ids. Full windows stand alone. The other pieces are dealt over shards by a hash, so that a shard holds about
``windows_per_shard`` windows. In a shard, differencing merges partial partitions: the two with the greatest imbalance
are laid over each other with opposing slots, largest on smallest, which leaves windows of nearly equal load. If the
fullest window exceeds the capacity, the number of windows rises and the shard is packed again.

Each document is encoded once and its ids move with its pieces; a group holds one shard, never all. ``sequences``
gives the windows themselves, ids with padding, and the pieces that lie in them; ``pack`` lists those pieces with checksums
of the ids that stand in the windows.

Defined results: a null text counts as empty, an empty document is the end id alone; repeated rows and rows without id
are documents of their own; no documents give no pieces.
"""

from __future__ import annotations

import heapq
import math
import zlib
from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from predia.llm.common import settle
from predia.llm.vocabulary import SPECIAL, encoder, shared_ranks

PIECES = "doc_id long, start long, length long, doc_tokens long, ids array<int>"
PLACES = "doc_id long, start long, length long, doc_tokens long, offset long"
WINDOWS = f"sequence_id long, n_ids long, ids array<int>, pieces array<struct<{PLACES.replace(' ', ':').replace(',:', ',')}>>"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@dataclass(frozen=True)
class Settings:
    capacity: int = 1024
    cut: int = 256
    windows_per_shard: int = 256
    pieces_per_shard: int = 20_000
    end_id: int = 0
    pad_id: int = 0
    vocabulary: str | None = None


def cuts(n: int, settings: Settings) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` ids."""
    rest = n - n % settings.capacity
    starts = [*range(0, rest, settings.capacity), *range(rest, n, settings.cut)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n])]


def pieces(docs: DataFrame, settings: Settings) -> DataFrame:
    """The pieces of every document with their ids."""
    shared = shared_ranks(docs.sparkSession, settings.vocabulary)
    end = np.array([settings.end_id], np.int32)

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, special = encoder(shared.value), set(SPECIAL)
        for batch in batches:
            rows, all_ids = [], []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                ids = encode.encode_to_numpy(text.as_py() or "", allowed_special=special)
                all_ids += [ids.astype(np.int32), end]
                n = len(ids) + 1
                rows += [(doc_id, a, size, n) for a, size in cuts(n, settings)]
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 4
            offsets = np.concatenate([[0], np.cumsum([r[2] for r in rows])]).astype(np.int32)
            flat = np.concatenate([*all_ids, np.empty(0, np.int32)])
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(offsets, flat)],
                                             ["doc_id", "start", "length", "doc_tokens", "ids"])

    return docs.select("doc_id", "text").mapInArrow(cut_up, PIECES)


def differenced(sizes: list[int], k: int) -> list[int]:
    """The slot of each size in a ``k``-way partition by differencing.

    A partial partition is a list of loads, ascending and relative to its least, with the items of each; slots without
    items are left out while there are some.
    """
    heap = [(-s, i, [s], [i]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    count = len(sizes)
    while len(heap) > 1:
        _, _, a, x = heapq.heappop(heap)
        _, _, b, y = heapq.heappop(heap)
        if len(a) < len(b):
            a, x, b, y = b, y, a, x
        if len(b) == 1:  # one load goes on the smallest slot
            load, node = b[0], y[0]
            if len(a) == k:
                load, node = load + a.pop(0), (x.pop(0), node)
            at = bisect(a, load)
            a.insert(at, load)
            x.insert(at, node)
        else:
            loads, nodes = a + b, x + y
            if len(loads) > k:  # largest on smallest
                a, x, b, y = *filled(a, x, k), *filled(b, y, k)
                loads = [p + q for p, q in zip(a, reversed(b))]
                nodes = [p if q is None else q if p is None else (p, q) for p, q in zip(x, reversed(y))]
            order = sorted(range(len(loads)), key=loads.__getitem__)
            a, x = [loads[i] for i in order], [nodes[i] for i in order]
        if len(a) == k and a[0]:
            least = a[0]
            a = [load - least for load in a]
        heapq.heappush(heap, (-(a[-1] - (a[0] if len(a) == k else 0)), count, a, x))
        count += 1
    slot = [0] * len(sizes)
    for number, node in enumerate(heap[0][3] if heap else []):
        stack = [node]
        while stack:
            top = stack.pop()
            if isinstance(top, tuple):
                stack.extend(top)
            elif top is not None:
                slot[top] = number
    return slot


def filled(loads: list[int], nodes: list, k: int) -> tuple[list[int], list]:
    """With the slots that have no items yet, which come first."""
    free = k - len(loads)
    return [0] * free + loads, [None] * free + nodes


def windows(sizes: list[int], capacity: int) -> list[int]:
    """A window for each size, none over the capacity; their number rises while the fullest window exceeds it."""
    k = max(1, math.ceil(sum(sizes) / capacity))
    while True:
        slots = differenced(sizes, k)
        fullest = int(np.bincount(slots, sizes).max()) if sizes else 0
        if fullest <= capacity:
            return slots
        k += max(1, (fullest - capacity) * k // (8 * capacity))


def laid_out(table: pa.Table, settings: Settings) -> pa.Table:
    """The windows of one shard's pieces."""
    table = table.sort_by([(c, "ascending") for c in ("doc_id", "start", "row")]).combine_chunks()
    length, lists = table["length"].to_numpy(), table["ids"].combine_chunks()
    flat, first = lists.flatten().to_numpy(), np.cumsum(length) - length
    window = np.array(windows(length.tolist(), settings.capacity), np.int64)
    order = np.argsort(window, kind="stable")
    window, length, first = window[order], length[order], first[order]
    begins = np.flatnonzero(np.diff(window, prepend=-1))
    before = np.cumsum(length) - length
    offset = before - np.repeat(before[begins], np.diff([*begins, len(window)]))

    # Every id goes from its place in its piece to its place in its window.
    number = np.cumsum(np.diff(window, prepend=-1) > 0) - 1
    within = np.arange(int(length.sum())) - np.repeat(before, length)
    filled_to = np.add.reduceat(length, begins)
    width = np.where(filled_to & (filled_to - 1), settings.capacity, filled_to)
    ends = np.cumsum(width)
    ids = np.full(int(width.sum()), settings.pad_id, np.int32)
    ids[np.repeat((ends - width)[number] + offset, length) + within] = flat[np.repeat(first, length) + within]

    places = table.select(["doc_id", "start", "length", "doc_tokens"]).take(pa.array(order))
    parts = pa.StructArray.from_arrays([*(places[c].combine_chunks() for c in places.column_names), pa.array(offset)],
                                       [*places.column_names, "offset"])
    shard = table["shard"][0].as_py()
    return pa.table({
        "sequence_id": pa.array((shard << 32) + window[begins]),
        "n_ids": pa.array(filled_to),
        "ids": pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), ids),
        "pieces": pa.ListArray.from_arrays(np.append(begins, len(window)).astype(np.int32), parts)})


def sequences(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per window: sequence_id, n_ids, ids, pieces.

    ``ids`` are closed by padding up to ``capacity``, but not where their number is a power of two. ``pieces`` names in
    their order the parts of documents that the ids are: doc_id, start, length, doc_tokens, offset. A piece that fills a
    window is one where it lies; only the others are dealt to shards and packed.
    """
    every = settle(pieces(docs, settings), "pieces")
    whole = every.where(F.col("length") == settings.capacity).select(
        (F.lit(1 << 62) + F.monotonically_increasing_id()).alias("sequence_id"), F.col("length").alias("n_ids"), "ids",
        F.array(F.struct("doc_id", "start", "length", "doc_tokens", F.lit(0).cast("long").alias("offset"))).alias("pieces"))
    cut = every.where(F.col("length") < settings.capacity)
    counts = cut.agg(F.count("*").alias("pieces"), F.sum("length").alias("rest")).first()
    shards = max(1, math.ceil((counts["rest"] or 0) / (settings.capacity * settings.windows_per_shard)),
                 math.ceil(counts["pieces"] / settings.pieces_per_shard))
    rows = cut.withColumn("row", F.monotonically_increasing_id())
    shard = F.pmod(F.xxhash64("doc_id", "start", "row"), F.lit(shards))
    packed = rows.withColumn("shard", shard).groupBy("shard").applyInArrow(
        lambda table: laid_out(table, settings), WINDOWS)
    return whole.unionAll(packed)


def listed(found: DataFrame) -> DataFrame:
    """The pieces of windows, one row each, with the checksum of the ids that stand in the window."""
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for sequence, ids, parts in zip(batch["sequence_id"].to_pylist(), batch["ids"], batch["pieces"].to_pylist()):
                ids = ids.values.to_numpy().astype("<u4")
                rows += [(p["doc_id"], p["start"], p["length"],
                          zlib.crc32(ids[p["offset"]:p["offset"] + p["length"]].tobytes()), p["doc_tokens"], sequence,
                          p["offset"]) for p in parts]
            names = [name.split()[0] for name in PACKED.split(", ")]
            columns = zip(*rows) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return found.select("sequence_id", "ids", "pieces").mapInArrow(summed, PACKED)


def pack(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per piece of the windows: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return listed(sequences(docs, settings))
