"""Packing documents into windows of a fixed number of tokens by Karmarkar-Karp differencing."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavid.llm.common import in_small_batches, stored
from stratavid.llm.tokens import encoder, slices, vocabulary_path

# Text encoded at a time; its words and ids take many times as much in a worker.
SLICE_BYTES = 1 << 20
CAPACITY = 4096
END_ID = 2
# Tokens packed together: about 256 windows, and the most a task holds besides one document.
GROUP_TOKENS = 1 << 20

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, ids binary"
)


def differencing(sizes: list[int], ways: int) -> list[list[int]]:
    """Multiway differencing: item numbers of ``ways`` near-equal parts.

    Every item begins as a partial partition with one filled part. The two partitions with the
    widest spread are merged, the largest part of one with the smallest of the other, until
    one is left. A partition lists its filled parts in descending order; the others are empty.
    """
    heap = [(-size, n, [(size, [n])]) for n, size in enumerate(sizes)]
    heapq.heapify(heap)
    order = len(sizes)
    while len(heap) > 1:
        one, other = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        alone = ways - len(other)  # so many of the largest parts of ``one`` meet empty parts
        merged = [*one[:alone], *other[: max(0, ways - len(one))]]
        for n, (size, items) in enumerate(one[alone:], alone):
            size2, items2 = other[ways - 1 - n]
            merged.append((size + size2, items + items2))
        merged.sort(key=lambda part: -part[0])
        least = merged[-1][0] if len(merged) == ways else 0
        heapq.heappush(heap, (least - merged[0][0], order, merged))
        order += 1
    parts = [items for _, items in heap[0][2]] if heap else []
    return parts + [[] for _ in range(ways - len(parts))]


def pack_lengths(lengths: list[int], capacity: int = CAPACITY, cut: bool = True) -> list[list[tuple[int, int, int]]]:
    """Windows of pieces (document number, start, length) holding every token once.

    A document fills whole windows by itself as often as it can; the rests are divided by differencing
    into as few windows as their sum allows. Where a window exceeds the capacity, the excess is
    cut off and fills the windows with room; with ``cut=False``, or without room, the window count
    rises by one and the division begins anew. Empty documents have no piece.
    """
    windows, rests = [], []
    for doc, length in enumerate(lengths):
        full = length // capacity
        windows += [[(doc, n * capacity, capacity)] for n in range(full)]
        if length % capacity:
            rests.append((doc, full * capacity, length % capacity))
    sizes = [size for _, _, size in rests]
    ways = -(-sum(sizes) // capacity)
    while ways:
        parts = [[rests[n] for n in items] for items in differencing(sizes, ways)]
        if cut:
            parts = _levelled(parts, capacity)
        if all(sum(piece[2] for piece in part) <= capacity for part in parts):
            windows += [part for part in parts if part]
            break
        ways += 1
    return windows


def _levelled(parts: list[list[tuple[int, int, int]]], capacity: int) -> list[list[tuple[int, int, int]]]:
    """What exceeds a window is cut off and put where there is room."""
    loose, room, out = [], [], []
    for part in parts:
        kept, left = [], capacity
        for doc, start, size in sorted(part, key=lambda p: -p[2]):
            here = min(size, left)
            if here:
                kept.append((doc, start, here))
            if size > here:
                loose.append((doc, start + here, size - here))
            left -= here
        out.append(kept)
        room.append(left)
    open_ = [n for n in sorted(range(len(out)), key=lambda n: -room[n]) if room[n]]
    for doc, start, size in sorted(loose, key=lambda p: -p[2]):
        while size and open_:
            n = open_[0]
            here = min(size, room[n])
            out[n].append((doc, start, here))
            start, size, room[n] = start + here, size - here, room[n] - here
            if not room[n]:
                open_.pop(0)
        if size:
            out[0].append((doc, start, size))  # no room: the caller adds a window
    return out


def written_order(docs: DataFrame) -> DataFrame:
    """Rows of part files in the order they were written in: by part number, file and row.

    A scan sorts files by size and puts several into a task, so an order over all files must be
    restored, by ranges: task numbers ascend with it. Rows that are no plain scan of files are written
    first, in the order they have. Columns of any name, nulls, repeats, long texts and empty files pass through.
    """

    def placed(rows: DataFrame) -> DataFrame:
        return rows.select(
            F.struct("*").alias("row"),
            F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).try_cast("long").alias("part"),
            F.col("_metadata.file_name").alias("file"),
            F.col("_metadata.row_index").alias("at"),
        )

    try:
        found = placed(docs)
    except AnalysisException:
        found = placed(stored(docs, "order"))
    place = ["part", "file", "at"]
    return found.repartitionByRange(*place).sortWithinPartitions(*place).select("row.*")


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    cut: bool = True,
    group_tokens: int = GROUP_TOKENS,
    vocabulary: str | None = None,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    Each task packs its own input split, a group of about ``group_tokens`` at a time, so nothing is
    shuffled, a hot source changes nothing, and memory is bounded by a group and one document.
    Neighbours in the input share windows, and groups ascend with the input's partitions; an order over
    part files is restored by ``written_order`` first. Less than one window of padding is left per
    group (a window or two with ``cut=False``). Sequence numbers are unique and start anew with each
    task's number in the upper bits; a task that runs again gives the same rows.

    Nulls: a null text is empty and has the end id alone; a null id stays null. Repeated rows are
    packed like any others. Empty tables give empty results; further columns are ignored.
    """
    path = vocabulary or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, task = encoder(path), TaskContext.get().partitionId()
        number, held, waiting = task << 32, 0, []

        def flush() -> pa.RecordBatch:
            nonlocal number, held
            rows = []
            for window in pack_lengths([len(ids) for _, ids in waiting], capacity, cut):
                offset = 0
                for doc, start, length in window:
                    doc_id, ids = waiting[doc]
                    piece = ids[start : start + length].tobytes()
                    rows.append((doc_id, start, length, zlib.crc32(piece), len(ids), number, offset, piece))
                    offset += length
                number += 1
            waiting.clear()
            held = 0
            columns = list(zip(*rows))
            kinds = [pa.int64()] * 7 + [pa.binary()]
            names = [c.split(" ")[0] for c in PIECES.split(", ")]
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                ids, bounds = words.encode(part.column("text"))
                for n, doc_id in enumerate(part.column("id").to_pylist()):
                    own = np.append(ids[bounds[n] : bounds[n + 1]], np.uint32(end_id)).astype("<u4")
                    waiting.append((doc_id, own))
                    held += len(own)
                    if held >= group_tokens:
                        yield flush()
        if waiting:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return in_small_batches(rows).mapInArrow(run, PIECES)
