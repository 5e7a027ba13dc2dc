"""Repeated passages: Rabin-Karp hashes of every word window, counted in Spark, merged into removal intervals."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratavid.llm.common import sieve, sifted, stored
from stratavid.llm.tokens import slices

# Words of a window.
WINDOW = 20
# Windows hashed before a task sorts and sends them.
FLUSH = 3_000_000
# Text bytes whose windows one bucket of the hash space holds on average.
BUCKET_BYTES = 16 << 20
# A sieve of this many bits at most chooses the documents that are joined with their intervals.
SIEVE_BITS = 28
# Standing for a null id, before all others.
NULL_ID = -(1 << 63)

# Multipliers of the two polynomials, both 3 modulo 8.
BASES = (0x9E3779B97F4A7C13, 0xD1342543DE82EF93)

ENTRIES, REMOVED = b"e", b"r"


# --- words and window hashes --------------------------------------------------------------


def word_lists(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts one after the other, split at ASCII white space, and each text's bounds."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.fill_null(texts, "")))
    ends = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
    words = lists.flatten()
    real = pc.greater(pc.binary_length(words), 0)  # an empty text splits into one empty word
    if pc.all(real).as_py() is False:
        before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
        words, ends = words.filter(real), before[ends]
    return words, ends


def window_hashes(words: pa.Array, bounds: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every window inside one text: 64 hash bits, 32 bits of a second hash, its text and its start.

    Both are polynomials of the words' 128-bit digests modulo 2**64. They are built by doubling: a
    hash of 2k words from two of k, so a window of 20 words takes five multiplications.
    """
    coded = words.dictionary_encode()
    digests = b"".join(xxhash.xxh3_128_digest(w) for w in coded.dictionary.to_pylist())
    at = coded.indices.to_numpy(zero_copy_only=False)
    value = np.frombuffer(digests, np.uint64).reshape(-1, 2)
    count = np.diff(bounds)
    fits = np.maximum(count - window + 1, 0)
    total = int(fits.sum())
    doc = np.repeat(np.arange(len(count), dtype=np.int32), fits)
    start = (np.arange(total) - np.repeat(np.cumsum(fits) - fits, fits)).astype(np.int32)
    if not total:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32), doc, start
    first = np.repeat(bounds[:-1], fits) + start
    lanes = [_polynomial(value[at, n], window, BASES[n])[first] for n in (0, 1)]
    return lanes[0], (lanes[1] >> np.uint64(32)).astype(np.uint32), doc, start


def _polynomial(values: np.ndarray, window: int, base: int) -> np.ndarray:
    """Hash of each ``window`` consecutive values, as if no text ended."""
    power = lambda n: np.uint64(pow(base, n, 1 << 64))
    done, size, run, length = None, 0, values, 1
    while True:
        if window & length:
            if done is None:
                done, size = run, length
            else:
                n = len(values) - size - length + 1
                done, size = done[:n] * power(length) + run[size : size + n], size + length
        if 2 * length > window:
            return done
        n = len(values) - 2 * length + 1
        run, length = run[:n] * power(length) + run[length : length + n], 2 * length


# --- packed messages ----------------------------------------------------------------------


def _planes(values: np.ndarray) -> bytes:
    """The bytes of an array by significance, so that those which hardly vary lie together."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _unplanes(data: memoryview, dtype, count: int) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    flat = np.frombuffer(data, np.uint8, count * size).reshape(size, count)
    return np.ascontiguousarray(flat.T).view(dtype).ravel()


def _deltas(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=values.dtype.type(0))


def _message(kind: bytes, ids: np.ndarray, rows: np.ndarray, columns: list[np.ndarray]) -> bytes:
    """A message: the documents it speaks of, and columns with a value for each of its entries."""
    body = [_planes(_deltas(ids)), _planes(rows), *map(_planes, columns)]
    head = struct.pack("<qq", len(ids), len(columns[0]))
    return kind + zstandard.ZstdCompressor(level=1).compress(head + b"".join(body))


def _opened(message: bytes, kinds: tuple) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    raw = memoryview(zstandard.ZstdDecompressor().decompress(memoryview(message)[1:]))
    docs, n = struct.unpack_from("<qq", raw)
    at = struct.calcsize("<qq")
    found = []
    for kind, count in [(np.int64, docs), (np.int64, docs), *((k, n) for k in kinds)]:
        found.append(_unplanes(raw[at:], kind, count))
        at += count * np.dtype(kind).itemsize
    return np.cumsum(found[0]), found[1], found[2:]


def _few(doc: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The documents in use, and each entry's number among them."""
    used = np.zeros(len(ids), bool)
    used[doc] = True
    number = np.cumsum(used, dtype=np.int32) - np.int32(1)
    return ids[used], rows[used], number[doc]


ENTRY_KINDS = (np.uint64, np.uint32, np.int32, np.int32)  # hash deltas, second hash, document, start
REMOVED_KINDS = (np.int32, np.int32)  # document, start


def _removed_messages(ids: np.ndarray, rows: np.ndarray, doc: np.ndarray, start: np.ndarray, buckets: int):
    """Messages (bucket, message) with the windows to remove, by the bucket of their document."""
    target = ((rows.view(np.uint64) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    order = np.lexsort((start, doc, target[doc]))
    doc, start = doc[order], start[order]
    to = target[doc].astype(np.int64)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(to)) + 1, [len(to)]])
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        if hi > lo:
            few, few_rows, number = _few(doc[lo:hi], ids, rows)
            yield int(to[lo]), _message(REMOVED, few, few_rows, [number, _deltas(start[lo:hi])])


# --- the two exchanges --------------------------------------------------------------------


def _sent(buckets: int, window: int):
    """Tasks over texts: sorted window hashes by bucket of the hash space, each sequence once a flush."""

    def flush(held: list[tuple]) -> Iterator[tuple[int, bytes]]:
        ids, rows = (np.concatenate([h[n] for h in held]) for n in (0, 1))
        shift = np.cumsum([0] + [len(h[0]) for h in held])
        key, check, doc, start = (np.concatenate([h[n] for h in held]) for n in (2, 3, 4, 5))
        doc += np.repeat(shift[:-1], [len(h[4]) for h in held]).astype(np.int32)
        place = np.unique(ids, return_inverse=True)[1][doc] << 32 | start
        order = _ordered(key, check, place)
        key, check, doc, start, place = key[order], check[order], doc[order], start[order], place[order]
        least = _group_least(key, check, place)
        stays = place == least
        bucket = ((key[stays] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        cuts = np.searchsorted(bucket, np.arange(buckets + 1))
        columns = [c[stays] for c in (key, check, doc, start)]
        for n in np.flatnonzero(np.diff(cuts)):
            key_, check_, doc_, start_ = (c[cuts[n] : cuts[n + 1]] for c in columns)
            few, few_rows, number = _few(doc_, ids, rows)
            yield int(n), _message(ENTRIES, few, few_rows, [_deltas(key_), check_, number, start_])
        if not stays.all():  # repeats inside the flush are known to go; they only pass through
            for _, message in _removed_messages(ids, rows, doc[~stays], start[~stays], buckets):
                yield crc32(message) % buckets, message

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                words, bounds = word_lists(part.column("text"))
                key, check, doc, start = window_hashes(words, bounds, window)
                if len(key):
                    ids, rows = (part.column(c).to_numpy(zero_copy_only=False) for c in ("id", "row"))
                    held.append((ids, rows, key, check, doc, start))
                    size += len(key)
                if size >= FLUSH:
                    yield from _batches(flush(held))
                    held, size = [], 0
        if held:
            yield from _batches(flush(held))

    return run


def _batches(messages: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    for bucket, message in messages:
        yield pa.record_batch([pa.array([bucket], pa.int32()), pa.array([message], pa.binary())], ["bucket", "message"])


def _ordered(key: np.ndarray, check: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Order by hash, then second hash, then place."""
    if len(place) > 1 and np.any(place[1:] < place[:-1]):
        by_place = np.argsort(place, kind="stable")
        order = by_place[np.argsort(key[by_place], kind="stable")]
    else:
        order = np.argsort(key, kind="stable")
    k, c = key[order], check[order]
    if np.any((k[1:] == k[:-1]) & (c[1:] != c[:-1])):  # one hash, two sequences
        order = np.lexsort((place, check, key))
    return order


def _group_least(key: np.ndarray, check: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For each of the ordered windows the place where its sequence comes first."""
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (check[1:] != check[:-1])
    return place[np.flatnonzero(new)[np.cumsum(new) - 1]]


def _compared(buckets: int):
    """Tasks over buckets of the hash space: which windows come first elsewhere, by bucket of their document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, passed = [], []
        for batch in batches:
            for message in batch.column("message").to_pylist():
                (entries if message[:1] == ENTRIES else passed).append(message)
        for message in passed:
            ids, rows, (doc, start) = _opened(message, REMOVED_KINDS)
            yield from _batches(_removed_messages(ids, rows, doc, np.cumsum(start, dtype=np.int32), buckets))
        if not entries:
            return
        ids, rows, columns, n = [], [], [], 0
        while entries:
            few, few_rows, (key, check, doc, start) = _opened(entries.pop(), ENTRY_KINDS)
            ids.append(few)
            rows.append(few_rows)
            columns.append((np.cumsum(key), check, doc + np.int32(n), start))
            n += len(few)
        ids, rows = np.concatenate(ids), np.concatenate(rows)
        key, check, doc, start = (np.concatenate([c[n] for c in columns]) for n in range(4))
        del columns
        order = np.argsort(key, kind="stable")  # merges runs that are sorted already
        same = key[order][1:] == key[order][:-1]
        again = np.zeros(len(order), bool)
        again[1:] |= same
        again[:-1] |= same
        order = order[again]
        key, check, doc, start = key[order], check[order], doc[order], start[order]
        place = np.unique(ids, return_inverse=True)[1][doc] << 32 | start
        order = _ordered(key, check, place)
        key, check, doc, start, place = key[order], check[order], doc[order], start[order], place[order]
        goes = place > _group_least(key, check, place)
        if goes.any():
            yield from _batches(_removed_messages(ids, rows, doc[goes], start[goes], buckets))

    return run


def _merged(window: int):
    """Tasks over buckets of documents: maximal intervals of words to remove, one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, docs, starts, n = [], [], [], [], 0
        for batch in batches:
            for message in batch.column("message").to_pylist():
                few, few_rows, (doc, start) = _opened(message, REMOVED_KINDS)
                ids.append(few)
                rows.append(few_rows)
                docs.append(doc + np.int32(n))
                starts.append(np.cumsum(start, dtype=np.int32))
                n += len(few)
        if not ids:
            return
        ids, rows, doc, start = (np.concatenate(x) for x in (ids, rows, docs, starts))
        by_row = np.lexsort((rows, ids))
        new = np.ones(len(ids), bool)
        new[1:] = (ids[by_row][1:] != ids[by_row][:-1]) | (rows[by_row][1:] != rows[by_row][:-1])
        number = np.empty(len(ids), np.int64)
        number[by_row] = np.cumsum(new) - 1
        heads = by_row[new]
        spot = np.unique(number[doc] << 32 | start)  # repeats come from rows that are alike
        doc, start = spot >> 32, (spot & 0xFFFFFFFF).astype(np.int64)
        first = np.ones(len(spot), bool)  # of an interval: no window before it touches or overlaps
        first[1:] = (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + window)
        last = np.append(first[1:], True)
        begin, end = start[first], start[last] + window
        owner = doc[first]
        offsets = np.searchsorted(owner, np.arange(len(heads) + 1)).astype(np.int32)
        spans = pa.StructArray.from_arrays([pa.array(begin, pa.int32()), pa.array(end, pa.int32())], ["start", "end"])
        lists = pa.ListArray.from_arrays(pa.array(offsets), spans)
        for lo in range(0, len(heads), 8192):
            part = slice(lo, lo + 8192)
            yield pa.record_batch([pa.array(ids[heads[part]]), pa.array(rows[heads[part]]), lists[part]], ["id", "row", "spans"])

    return run


SPANS = "array<struct<start: int, end: int>>"


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id (never null), a hash that tells rows of one id apart, and text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"),
        F.xxhash64(F.col(id_col).cast("long"), text).alias("row"),
        text.alias("text"),
    )


def _intervals(rows: DataFrame, window: int, bucket_bytes: int) -> DataFrame:
    """Per document with something to remove: id, row and its intervals, written out."""
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(1, -(-size // bucket_bytes))
    message = "bucket int, message binary"
    sent = rows.mapInArrow(_sent(buckets, window), message).repartitionById(buckets, F.col("bucket"))
    compared = sent.mapInArrow(_compared(buckets), message).repartitionById(buckets, F.col("bucket"))
    return stored(compared.mapInArrow(_merged(window), f"id long, row long, spans {SPANS}"), "passage-intervals")


def repeated_passages(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """Maximal word intervals to remove: doc_id, spans (start, end exclusive, in words), documents with any only.

    A word goes where a window of ``window`` words covers it whose sequence also starts earlier: in a
    smaller id, or earlier in the same one.

    1. Every window is hashed (two polynomials, 96 bits). A task sorts its windows and sends each
       sequence once, with its first place, to a bucket of the hash space: bounded messages of sorted
       differences, so a passage that a third of the rows share reaches its bucket once per flush.
    2. A bucket compares the first places of equal hashes and answers to a bucket of documents.
    3. There the windows of a document merge into intervals.

    The number of buckets follows the bytes of text, so a bucket holds about ``bucket_bytes`` of it at
    any size. Equal hashes count as equal sequences: among n windows some pair is taken for equal
    wrongly with a chance of about n**2 / 2**97 (8e9 windows, 30 GB: 4e-10; 2.5e13, 100 TB: 4e-3).

    Null and empty texts and those of fewer words than a window have no interval. Null ids come before
    all others. Rows of one id are told apart by their texts and compared by start alone; repeated
    rows are alike and keep the same words. An empty table gives no rows; further columns are ignored.
    """
    found = _intervals(_named(docs, id_col, text_col), window, bucket_bytes)
    return found.select(F.when(F.col("id") != NULL_ID, F.col("id")).alias("doc_id"), "spans")


def without_repeats(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept (the other words, joined by one space).

    See ``repeated_passages`` for what is removed and for nulls, ties, repeats and empty input. Only
    documents with an interval are joined with it, chosen by a sieve as large as their number asks
    for; beyond its limit all texts are joined.
    """
    rows = _named(docs, id_col, text_col)
    found = _intervals(rows, window, bucket_bytes)
    count = found.count()
    bits = max(16, (8 * count).bit_length())
    nothing = F.lit(None).cast(SPANS).alias("spans")
    if bits > SIEVE_BITS:
        return _kept(rows.join(found, ["id", "row"], "left").select("id", "text", "spans"))
    bitmap = stored(sieve(found, "id", bits), "passage-sieve")
    hit = sifted(rows, "id", bitmap, bits).join(found, ["id", "row"], "left").select("id", "text", "spans")
    free = sifted(rows, "id", bitmap, bits, keep=False).select("id", "text", nothing)
    return _kept(free).unionByName(_kept(hit))


def _kept(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words, bounds = word_lists(part.column("text"))
                spans = part.column("spans")
                edge = np.zeros(len(words) + 1, np.int64)
                flat = spans.flatten()
                base = np.repeat(bounds[:-1], pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False))
                if len(flat):
                    np.add.at(edge, base + flat.field("start").to_numpy(), 1)
                    np.add.at(edge, base + flat.field("end").to_numpy(), -1)
                stays = np.cumsum(edge[:-1]) == 0
                before = np.concatenate([[0], np.cumsum(stays)])
                lists = pa.ListArray.from_arrays(pa.array(before[bounds], pa.int32()), words.filter(pa.array(stays)))
                yield pa.record_batch(
                    [
                        part.column("id"),
                        pa.array(np.diff(bounds)),
                        pa.array(np.diff(bounds) - np.diff(before[bounds])),
                        pc.binary_join(lists, " "),
                    ],
                    ["id", "n_words", "n_removed", "kept"],
                )

    out = rows.mapInArrow(run, "id long, n_words long, n_removed long, kept string")
    known: Column = F.when(F.col("id") != NULL_ID, F.col("id"))
    return out.select(known.alias("doc_id"), "n_words", "n_removed", "kept")
