"""Hard negatives: exact inner products by Four-Russians tables over packed bit planes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratavid.llm.common import stored
from stratavid.llm.vectors import commonest_length, usable, whole
from stratavid.operators.latest import top_per_key

SCALE = 256
POSITIVES = NEGATIVES = 5
# A negative's score lies between these hundredths of the positive's.
LOW, HIGH = 80, 100
# Candidates of one stored block, and anchors whose tables are held at once.
BLOCK = 4096
ANCHORS = 256
# Bytes of anchors in one round: they go to every task with its code.
ROUND_BYTES = 8 << 20
# Bits of a whole-number component, sign included.
MOST_BITS = 27
NOTHING = -(1 << 62)

CANDIDATES = "ids binary, labels binary, planes binary"


# --- scores -------------------------------------------------------------------------------


def packed(x: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes of whole numbers (vectors by dimensions): bytes of eight dimensions, plane by group by vector.

    Two's complement of ``bits`` bits, lowest plane first; missing dimensions of the last group are 0.
    """
    spare = -x.shape[1] % 8
    x = np.pad(x, ((0, 0), (0, spare)))
    planes = [np.packbits(((x >> b) & 1).astype(np.uint8), axis=1, bitorder="little").T for b in range(bits)]
    return np.ascontiguousarray(np.stack(planes))


def tables(anchors: np.ndarray) -> np.ndarray:
    """Subset sums of each eight dimensions of the anchors: group by byte by anchor."""
    spare = -anchors.shape[1] % 8
    groups = np.pad(anchors, ((0, 0), (0, spare))).reshape(len(anchors), -1, 8)
    out = np.zeros((groups.shape[1], 256, len(anchors)), np.int64)
    for bit in range(8):  # a subset with a new highest dimension is one without it, plus that dimension
        out[:, 1 << bit : 2 << bit] = out[:, : 1 << bit] + groups[:, :, bit].T[:, None, :]
    return out


def scores(planes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Inner product of every packed vector with every anchor: table look-ups, shifted and added.

    From the highest plane, which counts negatively as the sign, down to the lowest.
    """
    total = np.zeros((planes.shape[2], table.shape[2]), np.int64)
    for at in range(len(planes) - 1, -1, -1):
        plane = table[0][planes[at, 0]]
        for group in range(1, len(table)):
            plane += table[group][planes[at, group]]
        if at == len(planes) - 1:
            np.negative(plane, out=total)
        else:
            total <<= 1
            total += plane
    return total


# --- tasks --------------------------------------------------------------------------------


def _blocks(rows: DataFrame, bits: int) -> DataFrame:
    """The vectors in blocks: ids, labels and bit planes as bytes, by ascending id inside a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                part = batch.slice(lo, BLOCK)
                ids, labels = (part.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
                order = np.argsort(ids, kind="stable")
                columns = [a.tobytes() for a in (ids[order], labels[order], packed(x[order], bits))]
                yield pa.record_batch([pa.array([c], pa.binary()) for c in columns], ["ids", "labels", "planes"])

    return rows.mapInArrow(run, CANDIDATES)


def _opened(batch: pa.RecordBatch, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for ids, labels, planes in zip(*(batch.column(c) for c in ("ids", "labels", "planes"))):
        ids, labels = (np.frombuffer(v.as_buffer(), np.int64) for v in (ids, labels))
        yield ids, labels, np.frombuffer(planes.as_buffer(), np.uint8).reshape(bits, -1, len(ids))


class _Best:
    """The best few (score, id) of each list, over the blocks of a task."""

    def __init__(self, lists: int, most: int):
        self.score = np.full((lists, most), NOTHING, np.int64)
        self.id = np.zeros((lists, most), np.int64)

    def take(self, at: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """New entries (lists by any number) for the lists ``at``."""
        score, ids = np.hstack([self.score[at], score]), np.hstack([self.id[at], ids])
        order = np.lexsort((ids, -score), axis=-1)[:, : self.score.shape[1]]
        self.score[at], self.id[at] = (np.take_along_axis(a, order, 1) for a in (score, ids))

    def rows(self) -> pa.RecordBatch:
        at, n = np.nonzero(self.score > NOTHING)
        columns = [pa.array(at.astype(np.int64)), pa.array(self.score[at, n]), pa.array(self.id[at, n])]
        return pa.record_batch(columns, ["list", "score", "other"])


def _first(score: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``most`` of each column by score, then by id, as lists by rank. ``ids`` ascend."""
    order = np.argsort(-score, axis=0, kind="stable")[:most]
    return np.take_along_axis(score, order, 0).T, ids[order].T


FOUND = "list long, score long, other long"


def _same_label(bits: int, ids: np.ndarray, labels: np.ndarray, anchors: np.ndarray, most: int):
    """Tasks over blocks: the best rows of each anchor's own label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(ids), most)
        for batch in batches:
            for own, label, planes in _opened(batch, bits):
                for value in np.intersect1d(label, labels):
                    rows, mine = np.flatnonzero(label == value), np.flatnonzero(labels == value)
                    for lo in range(0, len(mine), ANCHORS):
                        at = mine[lo : lo + ANCHORS]
                        score = scores(planes[:, :, rows], tables(anchors[at]))
                        score[own[rows][:, None] == ids[at]] = NOTHING
                        best.take(at, *_first(score, own[rows], most))
        yield best.rows()

    return run


def _other_labels(bits: int, ids, labels, anchors, floor: np.ndarray, ceiling: np.ndarray, most: int):
    """Tasks over blocks: the best rows of other labels between the bounds of each anchor's positives.

    ``floor`` and ``ceiling`` are anchors by positives. A block's rows are sorted once per anchor;
    each positive's rows then begin where scores fall to its ceiling.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        positives = floor.shape[1]
        best = _Best(len(ids) * positives, most)
        for batch in batches:
            for own, label, planes in _opened(batch, bits):
                for lo in range(0, len(ids), ANCHORS):
                    at = np.arange(lo, min(lo + ANCHORS, len(ids)))
                    score = scores(planes, tables(anchors[at]))
                    score[label[:, None] == labels[at]] = NOTHING
                    order = np.argsort(-score, axis=0, kind="stable")
                    score = np.take_along_axis(score, order, 0)
                    for p in range(positives):
                        begin = (score > ceiling[at, p]).sum(axis=0)
                        spot = begin[:, None] + np.arange(most)
                        inside = spot < len(own)
                        spot = np.minimum(spot, len(own) - 1)
                        column = np.arange(len(at))[:, None]
                        found = score[spot, column]
                        good = inside & (found >= floor[at, p][:, None]) & (found > NOTHING)
                        best.take(at * positives + p, np.where(good, found, NOTHING), own[order[spot, column]])
        yield best.rows()

    return run


# --- the operator -------------------------------------------------------------------------


def mine(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(scale * c). A row's score is its inner product with the anchor; higher
    scores come first, ties by smaller id. An anchor's positives are its first ``positives`` other rows of
    its label; for each of them its first ``negatives`` rows of other labels follow whose score lies
    between ``low`` and ``high`` hundredths of the positive's (none of a negative one's).

    Candidates are packed once into written blocks of bit planes, which every round reads as they are:
    no vector is shuffled. A round takes anchors of at most about ROUND_BYTES to all tasks, so what a
    task holds does not grow; the number of rounds does. A task keeps a few rows per anchor, and the
    best of all tasks are chosen in Spark.

    ``is_anchor`` is a condition on the columns of ``rows``. Rows with a null id, label or vector, an empty
    vector, a null or non-finite component, or another length than most take no part. Of repeated ids
    one is an anchor, that of the least label and vector; all are candidates. An anchor's rows
    are those of other ids. Empty tables give no rows; further columns are ignored. Components beyond
    +-2**26 / scale raise an error.
    """
    vector = F.col(vector_col).cast("array<double>")
    good = (
        rows.select(
            F.col(id_col).cast("long").alias("vec_id"),
            F.col(label_col).cast("long").alias("label"),
            vector.alias("v"),
            F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        )
        .where("vec_id IS NOT NULL AND label IS NOT NULL")
        .where(usable(F.col("v")))
    )
    x = stored(good.select("vec_id", "label", "anchor", whole(F.col("v"), scale).alias("x")), "negatives-rows")
    d = commonest_length(x, "x")
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    kinds = ["long", "long", "int", "long", "long", "long"]
    empty = rows.sparkSession.createDataFrame([], ", ".join(f"{c} {k}" for c, k in zip(names, kinds)))
    x = x.where(F.size("x") == d)
    chosen = stored(
        x.where("anchor").groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("row")).select("vec_id", "row.*"),
        "negatives-anchors",
    )
    count = chosen.count()
    if not count:
        return empty
    reach = x.agg(F.max(F.array_max("x")), F.min(F.array_min("x"))).first()
    bits = max(int(reach[0]).bit_length(), (-1 - int(reach[1])).bit_length() if reach[1] < 0 else 0) + 1
    if bits > MOST_BITS:
        raise ValueError(f"components need {bits} bits, at most {MOST_BITS} are supported")
    blocks = stored(_blocks(x.select("vec_id", "label", "x"), bits), "negatives-blocks")

    rounds = -(-count * d * 8 // ROUND_BYTES)
    out = []
    for number in range(rounds):
        part = chosen if rounds == 1 else chosen.where(F.pmod(F.xxhash64("vec_id"), F.lit(rounds)) == number)
        found = _round(blocks, part, bits, positives, negatives, low, high)
        if found is not None:
            out.append(found)
    done = empty
    for part in out:
        done = done.unionByName(part.select(*(F.col(c).cast(k) for c, k in zip(names, kinds))))
    return done


def _round(blocks: DataFrame, part: DataFrame, bits: int, positives: int, negatives: int, low: int, high: int):
    """All rows of one bounded set of anchors, written out; None if no anchor has a positive."""
    table = part.orderBy("vec_id").toArrow()  # a round's anchors: bounded by ROUND_BYTES
    if not table.num_rows:
        return None
    ids, labels = (table.column(c).to_numpy() for c in ("vec_id", "label"))
    anchors = table.column("x").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)

    best = blocks.mapInArrow(_same_label(bits, ids, labels, anchors, positives), FOUND)
    order = [F.desc("score"), F.asc("other")]
    top = top_per_key(best, ["list"], order, positives).orderBy("list", *order).toArrow()  # ``positives`` a list
    at, score, other = (top.column(c).to_numpy() for c in ("list", "score", "other"))
    if not len(at):
        return None
    place = np.arange(len(at)) - np.searchsorted(at, at)
    # Without a positive nothing lies between the bounds.
    floor = np.full((len(ids), positives), -NOTHING, np.int64)
    ceiling = np.full((len(ids), positives), NOTHING, np.int64)
    floor[at, place] = -(-score * low // 100)
    ceiling[at, place] = score * high // 100

    near = blocks.mapInArrow(_other_labels(bits, ids, labels, anchors, floor, ceiling, negatives), FOUND)
    ranked = top_per_key(near, ["list"], order, negatives)
    lists = _lists(part.sparkSession, at * positives + place, ids[at], other, score)
    rank = F.row_number().over(Window.partitionBy("list").orderBy(*order))
    named = ranked.withColumn("rank", rank).join(F.broadcast(lists), "list")  # ``positives`` rows an anchor of a round
    return stored(
        named.select(
            "anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"),
        ),
        "negatives-round",
    )


def _lists(spark: SparkSession, lists: np.ndarray, anchors: np.ndarray, positives: np.ndarray, scores_: np.ndarray) -> DataFrame:
    """Which anchor and positive each list of a round belongs to."""
    columns = [pa.array(c) for c in (lists, anchors, positives, scores_)]
    return spark.createDataFrame(pa.table(columns, ["list", "anchor_id", "positive_id", "positive_score"]))
