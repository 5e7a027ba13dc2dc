"""Document fingerprints: content-defined chunks and their digests, weighted by length."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavid.llm.tokens import slices

# Chunk lengths in bytes: no boundary before LEAST, a strict one up to NORMAL, then a loose one.
LEAST, NORMAL, MOST = 16, 40, 160
# Leading zero bits of the rolling hash at a strict and at a loose boundary.
STRICT_BITS, LOOSE_BITS = 6, 3
# Text bytes fingerprinted at once; a longer text is handled alone.
SLICE_BYTES = 2 << 20


def _gear() -> np.ndarray:
    """A fixed pseudo-random number for each byte (a multiplicative mixer over 0..255)."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.uint32)


GEAR = _gear()


def rolling(data: np.ndarray) -> np.ndarray:
    """Gear hash of the 16 bytes that end at each byte: the sum of GEAR[byte] << distance."""
    h = GEAR[data]
    for step in (1, 2, 4, 8):
        shifted = h[:-step] << np.uint32(step)
        h = h.copy()
        h[step:] += shifted
    return h


def boundaries(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunks (text number, start, end) of texts that lie one after the other in ``data``.

    All texts move forward together, one chunk a step. As no chunk but the last is shorter than the
    hash window, a boundary depends on bytes of its own text only.
    """
    h = rolling(data)
    loose = np.append(np.flatnonzero(h >> np.uint32(32 - LOOSE_BITS) == 0), len(data) + MOST)
    strict = np.append(np.flatnonzero(h >> np.uint32(32 - STRICT_BITS) == 0), len(data) + MOST)
    text = np.flatnonzero(bounds[1:] > bounds[:-1])
    at, end = bounds[:-1][text], bounds[1:][text]
    found = []
    while len(text):
        early = strict[np.searchsorted(strict, at + LEAST - 1)]
        late = loose[np.searchsorted(loose, at + NORMAL - 1)]
        cut = np.minimum(np.where(early < at + NORMAL, early, late) + 1, np.minimum(at + MOST, end))
        found.append((text, at, cut))
        on = cut < end
        text, at, end = text[on], cut[on], end[on]
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    return tuple(np.concatenate(part) for part in zip(*found))


def chunk_weights(texts: list[str]) -> list[dict[int, int]]:
    """Per text its chunk digests (48 bits) with the bytes they stand for."""
    raw = [t.encode() for t in texts]
    joined = b"".join(raw)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in raw], dtype=np.int64)])
    out: list[dict[int, int]] = [{} for _ in texts]
    view, digest = memoryview(joined), xxhash.xxh3_64_intdigest
    text, start, end = boundaries(np.frombuffer(joined, np.uint8), bounds)
    for n, lo, hi in zip(text.tolist(), start.tolist(), end.tolist()):
        own, key = out[n], digest(view[lo:hi]) >> 16
        own[key] = own.get(key, 0) + hi - lo
    return out


def as_text(weights: dict[int, int]) -> str:
    """Digests in ascending order, each with its bytes: ``digest:bytes`` in hex, comma-joined."""
    return ",".join([f"{key:012x}:{weights[key]:x}" for key in sorted(weights)])


def from_text(fingerprint: str) -> dict[int, int]:
    pairs = (part.split(":") for part in fingerprint.split(",") if part)
    return {int(key, 16): int(size, 16) for key, size in pairs}


def containment(one: dict[int, int], other: dict[int, int]) -> float:
    """Share of the bytes of ``one`` in chunks that ``other`` has too; empty texts equal each other."""
    if not one:
        return 1.0 if not other else 0.0
    if len(other) < len(one):
        both = sum(min(size, one[key]) for key, size in other.items() if key in one)
    else:
        both = sum(min(size, other[key]) for key, size in one.items() if key in other)
    return both / sum(one.values())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint of every text, in one pass without a shuffle; a null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                weights = chunk_weights([t or "" for t in part.column("text").to_pylist()])
                yield pa.record_batch([part.column("doc_id"), pa.array(map(as_text, weights), pa.string())], ["doc_id", "fingerprint"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fingerprint string")


def edited(text: str, following: str) -> str:
    """``text`` with its last half (floor) replaced by as much of the start of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


COLUMNS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def edit_resistance(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """How far each fingerprint survives an edit: the text against its edited form and the next text.

    Texts are dealt by id ranges and sorted within them, which moves each text once. Range borders
    are ids of the table (percentiles, as many as shuffle partitions); the rows at a border go to the
    range before it too, as the last row's neighbour, and the first rows to the last range. So no task
    sees more than its range.

    Nulls: a null text is empty; null ids come before all others. Rows with equal ids are ordered
    by text. The only row of a table follows itself. Empty tables give empty results; further
    columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("key"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    ways = int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = [n / ways for n in range(1, ways)] or [0.5]
    found = rows.agg(F.min("key").alias("least"), F.percentile_approx("key", steps, 100 * ways).alias("at")).first()
    borders = sorted({b for b in found["at"] or [] if b > found["least"]})[: ways - 1]
    least = found["least"] if found["least"] is not None else 0

    border = F.array(*map(F.lit, borders)) if borders else F.expr("cast(array() AS array<bigint>)")
    part = F.aggregate(border, F.lit(0), lambda n, b: n + (b <= F.col("key")).cast("int"))
    last = len(borders)
    # A row's own place, and the place where it is the neighbour behind the last row.
    before = F.when(F.col("key") == F.lit(least), F.lit(last)).when(F.array_contains(border, F.col("key")), F.col("part") - 1)
    placed = rows.withColumn("part", part).withColumn("before", before)
    spots = F.filter(
        F.array(
            F.struct(F.col("part").alias("part"), F.lit(False).alias("tail")),
            F.struct(F.col("before").alias("part"), F.lit(True).alias("tail")),
        ),
        lambda spot: spot["part"].isNotNull(),
    )
    dealt = (
        placed.select("doc_id", "key", "text", F.explode(spots).alias("spot"))
        .select("doc_id", "key", "text", "spot.part", "spot.tail")
        .repartitionById(last + 1, F.col("part"))
        .sortWithinPartitions("tail", "key", "text")
        .select("doc_id", "text", "tail")
    )
    return dealt.mapInArrow(_compare, COLUMNS)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with the row behind it; the first tail row only ends the list."""
    held: tuple | None = None  # id, text, chunk weights
    names = [c.split(" ")[0] for c in COLUMNS.split(", ")]
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            texts = part.column("text").to_pylist()
            tails = part.column("tail").to_pylist()
            size = tails.index(True) + 1 if True in tails else len(texts)
            ids, texts = part.column("doc_id").to_pylist()[:size], texts[:size]
            rows = ([held] if held else []) + list(zip(ids, texts, chunk_weights(texts)))
            changed = [edited(a[1], b[1]) for a, b in zip(rows, rows[1:])]
            out = []
            for (doc_id, text, own), (_, _, following), other, new in zip(rows, rows[1:], changed, chunk_weights(changed)):
                out.append(
                    (
                        doc_id, len(text), hashlib.sha256(other.encode()).hexdigest(), as_text(own), as_text(new),
                        containment(own, new), containment(own, following),
                    )
                )
            if out:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
            if True in tails:
                for _ in batches:  # what is left are further tail rows
                    pass
                return
            held = rows[-1]
