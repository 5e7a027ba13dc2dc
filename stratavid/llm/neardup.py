"""Near-duplicate documents: min-max hashing in bands, links confirmed on full shingle sets."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavid.llm.common import components, in_small_batches, sieve, sifted, stored
from stratavid.llm.tokens import slices

# Text whose shingles are made at a time; they take many times as much in a worker.
SLICE_BYTES = 1 << 20
# Chance that a pair at the threshold shares no band, and signature values spent on it at most.
MISS = 1e-9
VALUES = 270
# Positions of the sieves over bands and ids: 2**26 bits are 8 MB.
SIEVE_BITS = 26
# Documents and shingles of one block; two blocks are compared in one task.
BLOCK_DOCS = 512
BLOCK_SHINGLES = 400_000
# Common elements of pairs of sets that wait in a worker to be counted.
HELD_PAIRS = 500_000
# Standing for a null id, above all others.
NULL_ID = (1 << 63) - 1


@dataclass(frozen=True)
class Rule:
    """Shingle length in words, and the similarity in hundredths from which documents are linked."""

    words: int = 5
    percent: int = 80

    @property
    def bands(self) -> tuple[int, int]:
        """Values per band and bands: the longest bands that miss a pair at the threshold with MISS."""
        fit = []
        for rows in range(1, 9):
            chance = (self.percent / 100) ** rows
            bands = math.ceil(math.log(MISS) / math.log(1 - chance)) if chance < 1 else 1
            if rows * bands <= VALUES:
                fit.append((rows, bands))
        return fit[-1]

    def linked(self, both: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        return 100 * both >= self.percent * (one + other - both)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: shifts and odd multipliers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, one text after the other, and their bounds.

    A-Z is lower-cased, words are split at ASCII white space. A text of fewer words has its whole
    sequence as one shingle; one without words has none.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    tokens = lists.flatten()
    ends = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
    real = pc.greater(pc.binary_length(tokens), 0).to_numpy(zero_copy_only=False)
    count = np.add.reduceat(np.append(real, False).astype(np.int64), ends[:-1]) * (np.diff(ends) > 0) if len(ends) > 1 else ends[:0]
    coded = tokens.filter(pa.array(real)).dictionary_encode()
    digest = xxhash.xxh3_64_intdigest
    names = np.array([digest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    word = names[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else names
    bounds = np.concatenate([[0], np.cumsum(count)])

    size = np.where(count >= words, count - words + 1, (count > 0).astype(np.int64))
    starts = np.cumsum(size) - size
    total = int(size.sum())
    doc = np.repeat(np.arange(len(count)), size)
    first = np.arange(total) + np.repeat(bounds[:-1] - starts, size)
    left = np.minimum(words, count)[doc]
    shingle = np.zeros(total, np.uint64)
    for n in range(words):
        inside = left > n
        shingle[inside] = _mixed(shingle[inside] * np.uint64(0x9E3779B97F4A7C15) + word[first[inside] + n] + np.uint64(n + 1))
    order = np.lexsort((shingle, doc))
    doc, shingle = doc[order], shingle[order]
    new = np.ones(total, bool)
    new[1:] = (doc[1:] != doc[:-1]) | (shingle[1:] != shingle[:-1])
    own = np.bincount(doc[new], minlength=len(count))
    return shingle[new], np.concatenate([[0], np.cumsum(own)])


def band_keys(shingles: np.ndarray, bounds: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """Band keys (one line per non-empty set) of min-max signatures.

    One hash evaluation per shingle and permutation gives two signature values, the least and the
    greatest. A band is ``rows`` consecutive values, hashed with the band's number.
    """
    starts = bounds[:-1][bounds[1:] > bounds[:-1]]
    if not len(starts):
        return np.zeros((0, bands), np.int64)
    perms = -(-rows * bands // 2)
    draw = np.random.default_rng(11)
    factor = draw.integers(1 << 63, size=perms, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shift = draw.integers(1 << 63, size=perms, dtype=np.uint64)
    values = np.empty((2 * perms, len(starts)), np.uint64)
    for p in range(perms):
        h = (shingles * factor[p] + shift[p]) >> np.uint64(32)
        values[2 * p] = np.minimum.reduceat(h, starts)
        values[2 * p + 1] = np.maximum.reduceat(h, starts)
    keys = np.empty((bands, len(starts)), np.uint64)
    for b in range(bands):
        key = np.full(len(starts), b + 1, np.uint64)
        for value in values[b * rows : (b + 1) * rows]:
            key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + value)
        keys[b] = key
    return keys.T.view(np.int64) if keys.T.flags["C_CONTIGUOUS"] else np.ascontiguousarray(keys.T).view(np.int64)


def signatures(docs: DataFrame, rule: Rule) -> DataFrame:
    """id, tag, n (distinct shingles), digest of the set and band keys (null for an empty set) of every text."""
    rows, bands = rule.bands

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                shingles, bounds = shingle_sets(part.column("text"), rule.words)
                size = np.diff(bounds)
                digest = [xxhash.xxh3_128_digest(shingles[a:b]) if b > a else None for a, b in zip(bounds, bounds[1:])]
                keys = band_keys(shingles, bounds, rows, bands)
                offsets = np.concatenate([[0], np.cumsum(np.where(size > 0, bands, 0))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()))
                yield pa.record_batch(
                    [part.column("id"), part.column("tag"), pa.array(size), pa.array(digest, pa.binary()), lists],
                    ["id", "tag", "n", "digest", "bands"],
                )

    return in_small_batches(docs).mapInArrow(run, "id long, tag long, n long, digest binary, bands array<long>")


def full_sets(docs: DataFrame, words: int) -> DataFrame:
    """n, digest and the whole set (ascending hashes as bytes) of every text with a shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                shingles, bounds = shingle_sets(part.column("text"), words)
                found = [(b - a, xxhash.xxh3_128_digest(shingles[a:b]), shingles[a:b].tobytes())
                         for a, b in zip(bounds, bounds[1:]) if b > a]
                kinds = [pa.int64(), pa.binary(), pa.binary()]
                columns = zip(*found) if found else [[]] * 3
                yield pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds)], ["n", "digest", "shingles"])

    return in_small_batches(docs).mapInArrow(run, "n long, digest binary, shingles binary")


def _placed(docs: DataFrame, rule: Rule, id_col: str, text_col: str) -> DataFrame:
    """One row per input row: id, tag (a hash of its text), n, and the least id and set digest of its component."""
    text = F.col(text_col)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"), text.alias("text"), F.xxhash64(text).alias("tag"))
    signed = stored(signatures(rows, rule), "near-signatures")
    classes = stored(
        signed.where("n > 0").groupBy("digest").agg(F.min("id").alias("least"), F.first("bands").alias("bands")),
        "near-classes",
    )
    spread = classes.select(F.col("digest").alias("rep"), F.explode("bands").alias("key"))
    heads = stored(
        spread.groupBy("key").agg(F.min("rep").alias("head"), F.count("*").alias("m")).where("m > 1").drop("m"),
        "near-heads",
    )
    bitmap = stored(sieve(heads, "key", SIEVE_BITS), "near-band-sieve")
    shared = sifted(spread, "key", bitmap, SIEVE_BITS).join(heads, "key").where("rep <> head")
    pairs = stored(shared.groupBy("rep", "head").agg(F.count("*").alias("bands")), "near-pairs")
    groups = components(pairs.select(F.col("rep").alias("a"), F.col("head").alias("b")), "near-groups")

    ids = stored(sieve(groups.join(classes, F.col("id") == F.col("digest")).select("least"), "least", SIEVE_BITS), "near-id-sieve")
    sets = stored(
        full_sets(sifted(rows.select("id", "text"), "id", ids, SIEVE_BITS), rule.words)
        .withColumnRenamed("digest", "id")
        .join(groups, "id")
        .groupBy("id")
        .agg(*(F.first(c).alias(c) for c in ("root", "n", "shingles"))),
        "near-sets",
    )
    first = _links_to_heads(pairs, sets, rule)
    joined = components(first, "near-first")
    rest = _links_in_blocks(sets, joined, rule)
    linked = components(first.unionByName(rest), "near-all").select(F.col("id").alias("digest"), "root")

    known = classes.select("digest", "least")
    own = F.struct("least", "digest")
    tops = linked.join(known, "digest").groupBy("root").agg(F.min(own).alias("top"))
    named = stored(
        known.join(linked.join(tops, "root").select("digest", "top"), "digest", "left")
        .select("digest", F.coalesce("top", own).alias("top")),
        "near-named",
    )
    placed = signed.where("n > 0").select("id", "tag", "n", "digest").join(named, "digest")
    alone = signed.where("n = 0").select("id", "tag", "n", F.lit(None).cast("binary").alias("digest"))
    alone = alone.select("*", F.struct(F.col("id").alias("least"), "digest").alias("top"))
    return placed.select("id", "tag", "n", "digest", "top").unionByName(alone)


def near_groups(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest linked id), kept.

    1. Texts with the same shingle set are one class, known by the 128-bit digest of the set.
    2. Classes that share a band with a bucket's head form candidate groups. A pair at the
       threshold shares no band with a chance of MISS.
    3. Every candidate is compared on full sets with the bucket head it shares most bands with.
    4. What this leaves apart within a candidate group is compared block by block: blocks of bounded
       size, pairs of blocks in one task each, and only blocks that are not of one component already.
       A task returns links between components only, so neither pairs nor copies are ever listed.
    5. Components over all confirmed links.

    Nothing is capped: a group of any size is cut into more blocks. Hot bands and hot copies are
    pre-aggregated; where rows are joined to them, both sides are written tables that AQE can
    split. Full sets are built again from the texts of candidates only, which a sieve of fixed
    size (SIEVE_BITS) selects without a shuffle of the others.

    Nulls and empty texts have no shingles and are linked with nothing. Links join texts, not ids, so rows
    that repeat an id are each judged by their own text. Rows without an id are linked too; a component's id
    is the smallest there is in it, null where none of its rows has one, and a row without an id is kept
    only where it is linked with none that has one. Empty tables give empty results; further columns
    are ignored. Long texts are handled alone.
    """
    known = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return _placed(docs, rule, id_col, text_col).select(
        known("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        known("top.least").alias("component_id"),
        (F.col("id") == F.col("top.least")).alias("kept"),
    )


def _links_to_heads(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Confirmed links (a, b) of each candidate and the head it shares most bands with."""
    best = pairs.groupBy("rep").agg(F.max(F.struct("bands", "head")).alias("top")).select("rep", "top.head")
    best = stored(best, "near-best")
    one = sets.select(F.col("id").alias("rep"), F.col("n").alias("n1"), F.col("shingles").alias("s1"))
    other = sets.select(F.col("id").alias("head"), F.col("n").alias("n2"), F.col("shingles").alias("s2"))
    near = F.greatest("n1", "n2") * rule.percent <= F.least("n1", "n2") * 100  # else too unlike in size
    both = best.join(one, "rep").join(other, "head").where(near)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = []
            for a, b in zip(batch.column("s1"), batch.column("s2")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (a, b))
                common = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                hit.append(bool(rule.linked(common, len(x), len(y))))
            yield batch.select(["rep", "head"]).filter(pa.array(hit, pa.bool_())).rename_columns(["a", "b"])

    found = in_small_batches(both.select("rep", "head", "s1", "s2")).mapInArrow(run, "a binary, b binary")
    return stored(found, "near-head-links")


def _links_in_blocks(sets: DataFrame, joined: DataFrame, rule: Rule) -> DataFrame:
    """Confirmed links between components of one candidate group, compared block by block.

    A component large enough has blocks of its own; the others of a group share blocks. Pairs
    of blocks of one component are left out.
    """
    nodes = (
        sets.join(joined.withColumnRenamed("root", "part"), "id", "left")
        .withColumn("part", F.coalesce("part", "id"))
        .select("id", "root", "part", "n", "shingles")
    )
    sizes = stored(
        nodes.groupBy("root", "part").agg(F.count("*").alias("m"), F.sum("n").alias("w")), "near-parts"
    )
    open_ = sizes.groupBy("root").agg(F.count("*").alias("parts")).where("parts > 1").select("root")
    sizes = sizes.join(open_, "root")
    ways = F.ceil(F.greatest(F.col("m") / BLOCK_DOCS, F.col("w") / BLOCK_SHINGLES)).cast("long")
    large = (F.col("m") >= BLOCK_DOCS) | (F.col("w") >= BLOCK_SHINGLES)
    kinds = sizes.withColumn("kind", F.when(large, F.col("part")).otherwise(F.lit(None).cast("binary")))
    blocks = stored(
        kinds.groupBy("root", "kind").agg(F.sum("m").alias("m"), F.sum("w").alias("w")).select("root", "kind", ways.alias("ways")),
        "near-blocks",
    )
    spots = blocks.select("root", "kind", F.explode(F.sequence(F.lit(0), F.col("ways") - 1)).alias("slot"))
    left, right = (spots.select("root", F.col("kind").alias(f"kind{n}"), F.col("slot").alias(f"slot{n}")) for n in (1, 2))
    own = lambda n: F.struct(F.coalesce(F.hex(f"kind{n}"), F.lit("")), f"slot{n}")
    unlike = F.col("kind1").isNull() | ~F.col("kind1").eqNullSafe(F.col("kind2"))
    meets = stored(
        left.join(right, "root").where(own(1) <= own(2)).where(unlike).withColumn("task", F.monotonically_increasing_id()),
        "near-meets",
    )
    calls = meets.select("root", F.col("kind1").alias("kind"), F.col("slot1").alias("slot"), "task").unionByName(
        meets.where(~own(1).eqNullSafe(own(2))).select("root", F.col("kind2").alias("kind"), F.col("slot2").alias("slot"), "task")
    )
    # Where each document goes: first its block by component size, then the tasks of that block.
    spot = (
        nodes.select("id", "root", "part")
        .join(kinds.select("root", "part", "kind"), ["root", "part"])
        .join(blocks.withColumnsRenamed({"root": "_root", "kind": "_kind"}), (F.col("root") == F.col("_root")) & F.col("kind").eqNullSafe(F.col("_kind")))
        .select("id", "root", "part", "kind", F.pmod(F.xxhash64("id"), F.col("ways")).alias("slot"))
        .distinct()
    )
    sent = (
        spot.join(calls.withColumnsRenamed({"root": "_root", "kind": "_kind", "slot": "_slot"}),
                  (F.col("root") == F.col("_root")) & F.col("kind").eqNullSafe(F.col("_kind")) & (F.col("slot") == F.col("_slot")))
        .select("id", "part", "task")
    )
    dealt = sent.join(sets.select("id", "shingles"), "id").select("task", "part", "shingles")
    return stored(dealt.groupBy("task").applyInArrow(_block_links(rule), "a binary, b binary"), "near-block-links")


def _block_links(rule: Rule):
    def run(table: pa.Table) -> pa.Table:
        sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in table.column("shingles")]
        parts = table.column("part").combine_chunks().dictionary_encode()
        links = np.array(spanning_links(sets, parts.indices.to_numpy(), rule), np.int64).reshape(-1, 2)
        return pa.table({name: parts.dictionary.take(pa.array(links[:, n])) for n, name in enumerate("ab")})

    return run


def spanning_links(sets: list[np.ndarray], part: np.ndarray, rule: Rule) -> list[tuple[int, int]]:
    """Links that join the parts as all pairs of sets would: a spanning forest over parts.

    Intersections are counted over an inverted list: at each distance d, neighbours in the list of
    sorted shingles that are still the same shingle are one common element of two sets.
    """
    size = np.array([len(s) for s in sets])
    n = len(sets)
    shingle = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(n), size)
    order = np.lexsort((owner, shingle))
    shingle, owner = shingle[order], owner[order]
    again = np.zeros(len(shingle), bool)  # only shingles of two sets or more count
    if len(shingle) > 1:
        same = shingle[1:] == shingle[:-1]
        again[1:] |= same
        again[:-1] |= same
    shingle, owner = shingle[again], owner[again]
    counts, waiting, held = np.zeros(n * n, np.int32), [], 0
    for d in range(1, len(shingle)):
        hit = np.flatnonzero(shingle[d:] == shingle[:-d])
        if not len(hit):
            break
        waiting.append(owner[hit] * n + owner[hit + d])
        held += len(hit)
        if held > HELD_PAIRS:
            counts += np.bincount(np.concatenate(waiting), minlength=n * n).astype(np.int32)
            waiting, held = [], 0
    if waiting:
        counts += np.bincount(np.concatenate(waiting), minlength=n * n).astype(np.int32)
    pair = np.flatnonzero(counts)
    one, other = pair // n, pair % n
    good = rule.linked(counts[pair].astype(np.int64), size[one], size[other]) & (part[one] != part[other])
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    links = []
    for a, b in zip(part[one[good]].tolist(), part[other[good]].tolist()):
        x, y = top(a), top(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            links.append((a, b))
    return links


def drop_near(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged: of each component the text of the least id.

    Rows go by their id and text together, so a row never goes for another one of its id. Of a component
    without ids one text stays; rows that are alike in id and text stay or go together. Nulls,
    ties, empty and long texts, empty tables and clashing names are treated as in ``near_groups``. The rows
    to drop are selected by a sieve, so only documents that may go are joined.
    """
    top = (F.col("id") == F.col("top.least")) & F.col("digest").eqNullSafe(F.col("top.digest"))
    gone = stored(
        _placed(docs, rule, "doc_id", "text").where(~top).select(F.col("id").alias("_gone"), F.col("tag").alias("_tag")).distinct(),
        "near-gone",
    )
    bitmap = stored(sieve(gone, "_gone", SIEVE_BITS), "near-gone-sieve")
    packed = docs.select(
        F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("_id"), F.xxhash64("text").alias("_text")
    )
    safe = sifted(packed, "_id", bitmap, SIEVE_BITS, keep=False).select("row.*")
    same = (F.col("_id") == F.col("_gone")) & (F.col("_text") == F.col("_tag"))
    spared = sifted(packed, "_id", bitmap, SIEVE_BITS).join(gone, same, "left_anti").select("row.*")
    return safe.unionByName(spared)
