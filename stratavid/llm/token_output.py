"""Token ids as binary: frequency-ranked, byte-aligned variable-length codes with control bytes."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratavid.llm.common import scratch
from stratavid.llm.tokens import encoder, slices, vocabulary_path

END_ID = 2
# Ids handled at once; a longer document is handled alone.
SLICE_IDS = 1 << 20

CODED = "part long, doc_id long, start long, n_tokens long, control binary, data binary"
CODED_NAMES = [c.split(" ")[0] for c in CODED.split(", ")]

# Bytes of each of the four values that a control byte describes, two bits a value.
LENGTHS = (((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1).astype(np.int64)


def encode_values(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Control bytes and data bytes of many lists of values, with the byte bounds of each list."""
    values = values.astype("<u4")
    size = 1 + (values > 0xFF) + (values > 0xFFFF) + (values > 0xFFFFFF)
    count = np.diff(bounds)
    controls = -(-count // 4)
    control_bounds = np.concatenate([[0], np.cumsum(controls)])
    at = np.arange(len(values)) + np.repeat(control_bounds[:-1] * 4 - bounds[:-1], count)
    codes = np.zeros(control_bounds[-1] * 4, np.uint8)
    codes[at] = size - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]]
    data_bounds = np.concatenate([[0], np.cumsum(size)])[bounds]
    return control, control_bounds, data, data_bounds


def decode_values(control: np.ndarray, data: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Values of many lists, their control and data bytes one after the other, by table lookup."""
    controls = -(-count // 4)
    starts = (np.cumsum(controls) - controls) * 4
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total) + np.repeat(starts - (ends - count), count)
    size = LENGTHS[control].ravel()[at]
    first = np.cumsum(size) - size
    values = data[first].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        values[more] |= data[first[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return values


def _slices(batch: pa.RecordBatch, count: str) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about SLICE_IDS ids, however few bytes these take in packed form."""
    ends = np.cumsum(batch.column(count).to_numpy())
    block = (ends - 1).clip(0) // SLICE_IDS
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [len(ends)]])
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def _binary(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    if bounds[-1] > np.iinfo(np.int32).max:
        raise OverflowError("the codes of one document exceed what a binary column can hold")
    data = np.ascontiguousarray(data, np.uint8)
    return pa.Array.from_buffers(
        pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)]
    )


def _bytes(column: pa.Array) -> np.ndarray:
    """All bytes of a binary column, one value after the other."""
    bounds = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    if not len(column) or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8)
    return np.frombuffer(column.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]


@dataclass
class TokenFiles:
    """Where the files are: documents' codes in ascending id order, and the id of each rank."""

    documents: str
    ranks: str


def write_token_files(
    docs: DataFrame,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    vocabulary: str | None = None,
) -> TokenFiles:
    """Encodes every text, ranks the ids by their frequency in all documents, and writes the files.

    Ids are written once, compressed, to the shared folder, counted there (one row per id and task
    reaches the shuffle), and coded after a range partitioning by document id; file ``part`` numbers
    and the order within a file give the ascending order. Each row has the number of values, two-bit
    lengths in ``control`` and the ranks' significant bytes in ``data``. The rank table has one row
    per vocabulary entry, which bounds what the driver holds.

    Nulls: a null text is empty; null ids come first. Documents that repeat an id keep an order by
    their ids' bytes. Empty tables give empty files; further columns are ignored.
    """
    spark = docs.sparkSession
    path = vocabulary or vocabulary_path()

    def to_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pack = encoder(path), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, bounds = words.encode(part.column("text"))
                n, packed = [], []
                for lo, hi in zip(bounds[:-1], bounds[1:]):
                    own = np.append(ids[lo:hi], np.uint32(end_id))
                    n.append(len(own))
                    packed.append(pack.compress(own.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()))
                yield pa.record_batch([part.column("id"), pa.array(n, pa.int64()), pa.array(packed, pa.binary())], ["id", "n", "ids"])

    ids_path = scratch(spark, "token-ids")
    docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        to_ids, "id long, n long, ids binary"
    ).write.option("compression", "none").parquet(ids_path)
    ids = spark.read.schema("id long, n long, ids binary").parquet(ids_path)

    ranks = _ranks(ids)
    spark.createDataFrame(
        pa.table({"rank": pa.array(range(len(ranks)), pa.int64()), "id": pa.array(ranks.tolist(), pa.int64())})
    ).coalesce(1).write.parquet(f"{folder}/ranks")
    rank_of = np.zeros(int(ranks.max()) + 1 if len(ranks) else 1, np.uint32)
    rank_of[ranks] = np.arange(len(ranks), dtype=np.uint32)

    def to_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for some in _slices(batch, "n"):
                values, bounds = _unpacked(some)
                control, control_bounds, data, data_bounds = encode_values(rank_of[values], bounds)
                yield pa.record_batch(
                    [
                        pa.array(np.full(some.num_rows, part, np.int64)),
                        some.column("id"),
                        pa.array(before + bounds[:-1]),
                        some.column("n"),
                        _binary(control, control_bounds),
                        _binary(data, data_bounds),
                    ],
                    CODED_NAMES,
                )
                before += len(values)

    ids.repartitionByRange("id").sortWithinPartitions("id", "ids").mapInArrow(
        to_codes, CODED
    ).write.option("compression", "none").parquet(f"{folder}/documents")
    return TokenFiles(f"{folder}/documents", f"{folder}/ranks")


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the batch's documents one after the other, and their bounds."""
    unpack = zstandard.ZstdDecompressor()
    own = [
        np.ascontiguousarray(np.frombuffer(unpack.decompress(x.as_py()), np.uint8).reshape(4, -1).T).view("<u4").ravel()
        for x in batch.column("ids")
    ]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in own], dtype=np.int64)])
    return (np.concatenate(own) if own else np.zeros(0, np.uint32)), bounds


def _ranks(ids: DataFrame) -> np.ndarray:
    """All ids that occur, the most frequent first, ties by id."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for some in _slices(batch, "n"):
                own = np.bincount(_unpacked(some)[0])
                if len(own) > len(total):
                    total, own = own, total
                total[: len(own)] += own
        found = np.flatnonzero(total)
        yield pa.record_batch([pa.array(found), pa.array(total[found])], ["id", "n"])

    counts = ids.select("n", "ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    table = counts.toPandas()  # at most one row per vocabulary entry
    return table.sort_values(["n", "id"], ascending=[False, True])["id"].to_numpy(np.int64)


def read_token_files(spark: SparkSession, files: TokenFiles, with_ids: bool = False) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids_crc32, and with ``with_ids`` the ids (little-endian).

    ``start`` counts the ids of all documents before: within a part it is in the file, and the sums
    of the parts before (one row for each part) are added. Files without documents give no rows; null and
    repeated ids are given back as they were written, and a long document is decoded alone.
    """
    ranks = spark.read.parquet(files.ranks).toPandas().sort_values("rank")["id"].to_numpy(np.uint32)
    names = ["part", "doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids]
    kinds = "part long, doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in _slices(batch, "n_tokens"):
                count = some.column("n_tokens").to_numpy()
                codes = decode_values(_bytes(some.column("control")), _bytes(some.column("data")), count)
                ids, ends = ranks[codes].astype("<u4"), np.cumsum(count)
                own = [ids[lo:hi].tobytes() for lo, hi in zip(ends - count, ends)]
                columns = [some.column(c) for c in names[:4]]
                columns.append(pa.array([zlib.crc32(x) for x in own], pa.int64()))
                if with_ids:
                    columns.append(pa.array(own, pa.binary()))
                yield pa.record_batch(columns, names)

    coded = spark.read.schema(CODED).parquet(files.documents)
    sums = coded.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return (
        coded.mapInArrow(decode, kinds)
        .join(F.broadcast(bases), "part")  # one row for each file part
        .withColumn("start", F.col("base") + F.col("start"))
        .select(*names[1:])
    )
