"""Quality scores learned from preference pairs (Bradley-Terry), cut at a score quantile."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavid.llm.common import in_small_batches, stored
from stratavid.llm.tokens import slices

# Labelled rows of each label that are fitted at most, and pairs drawn from them.
SAMPLE = 2000
PAIRS = 10_000
# Score at which a document counts as good.
CUT = 0.3
# Steps into which the strengths of labelled documents are counted to find the quantile.
STEPS = 65_536

# Byte classes: white space, line ends, digits, lower and upper case, bytes beyond ASCII, and
# single punctuation marks or groups of them. Others are control bytes.
GROUPS = (
    b" \t", b"\n\r", b"0123456789", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", bytes(range(128, 256)),
    b".", b",", b"!?", b"|", b"*#$%&@^~", b"<>{}[]/\\=+_`", b"-()'\";:",
)
KINDS = len(GROUPS) + 1
CLASS = np.full(256, KINDS - 1, np.uint8)
for _n, _group in enumerate(GROUPS):
    CLASS[list(_group)] = _n
WIDTH = KINDS * KINDS + 4
# Bytes whose pairs are counted at a time: counting takes many bytes for each.
BLOCK = 1 << 16
# Shares are taken as if a text had so many more bytes of no class, so a few bytes prove little.
PRIOR = 120


def features(texts: pa.Array) -> np.ndarray:
    """One row of numbers per text, of whole texts only; null is empty.

    Shares of neighbouring byte classes; distinct words and lines, word length. Beside the texts and the result, memory is
    that of a block of bytes and of one text's words.
    """
    texts = pc.fill_null(texts, "")
    out = np.zeros((len(texts), WIDTH))
    for n, text in enumerate(texts.to_numpy(zero_copy_only=False)):
        raw = np.frombuffer(text.encode(), np.uint8)
        pairs = np.zeros(KINDS * KINDS, np.int64)
        for lo in range(0, len(raw) - 1, BLOCK):
            kind = CLASS[raw[lo : lo + BLOCK + 1]]  # a pair's code fits into a byte, too
            pairs += np.bincount(kind[:-1] * np.uint8(KINDS) + kind[1:], minlength=KINDS * KINDS)
        out[n, : KINDS * KINDS] = 3 * pairs / (len(raw) + PRIOR)
        words, lines = text.split(), text.split("\n")
        kinds = len(set(words))
        out[n, KINDS * KINDS :] = (
            (kinds + 5) / (len(words) + 5),
            np.log(5 + kinds) / np.log(5 + len(words)),
            (len(set(lines)) + 2) / (len(lines) + 2),
            len(text) / (5 + len(words)) / 10,
        )
    return out


@dataclass
class Ranker:
    """Linear strength of standardised features, shifted so that the cut is at zero."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    cut: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6) @ self.weight

    def score(self, strength: np.ndarray) -> np.ndarray:
        """Between 0 and 1; at least CUT where the strength is at least the cut."""
        odds = np.clip(strength - self.cut, -30, 30)
        return 1 / (1 + (1 - CUT) / CUT * np.exp(-odds))


def fit_pairs(good: np.ndarray, bad: np.ndarray, pairs: int = PAIRS, ridge: float = 1e-2) -> Ranker:
    """Strengths under which a good text beats a bad one: logistic loss on feature differences.

    Pairs are drawn evenly with a fixed seed and the loss is minimised by Newton steps. The cut is
    left to ``place_cut``. Without rows of both labels every text gets the same score, above the cut.
    """
    both = np.concatenate([good, bad])
    width = both.shape[1]
    if not len(good) or not len(bad):
        return Ranker(np.zeros(width), np.ones(width), np.zeros(width), -1.0)
    mean, scale = both.mean(axis=0), both.std(axis=0) + 0.02
    a, b = (np.clip((x - mean) / scale, -6, 6) for x in (good, bad))
    draw = np.random.default_rng(7)
    diff = a[draw.integers(len(a), size=pairs)] - b[draw.integers(len(b), size=pairs)]
    weight = np.zeros(width)
    for _ in range(10):
        p = 1 / (1 + np.exp(-np.clip(diff @ weight, -30, 30)))
        slope = diff.T @ (1 - p) / pairs - ridge * weight
        curve = (diff * (p * (1 - p))[:, None]).T @ diff / pairs + ridge * np.eye(width)
        weight = weight + np.linalg.solve(curve, slope)
    return Ranker(mean, scale, weight, 0.0)


def held_out(doc_id) -> F.Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def usable(labels: DataFrame) -> DataFrame:
    """One row per labelled id that may be learned from: doc_id, quality.

    Labels other than 0 and 1 and null ids are left out, and so are held-out ids; an id with several labels
    counts as bad if one of them says so.
    """
    return (
        labels.where("quality IN (0, 1) AND doc_id IS NOT NULL")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ranker:
    """A ranker from at most ``sample`` usable labelled rows of each label, the first by a hash of their id.

    Of an id with several texts the one with the least features counts. Only the sampled rows' features reach the driver.
    """
    known = usable(labels)
    picked = [
        known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for q in (1, 0)
    ]
    chosen = picked[0].unionByName(picked[1])
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # 2 * sample rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                x = features(part.column("text")).tolist()
                yield pa.record_batch(
                    [part.column("doc_id"), part.column("quality"), pa.array(x, pa.list_(pa.float64()))],
                    ["doc_id", "quality", "x"],
                )

    rows = in_small_batches(texts).mapInArrow(run, "doc_id long, quality int, x array<double>").groupBy("doc_id", "quality").agg(F.min("x").alias("x"))
    found = sorted(rows.collect(), key=lambda r: r["doc_id"])
    good, bad = (np.array([r["x"] for r in found if r["quality"] == q]).reshape(-1, WIDTH) for q in (1, 0))
    return fit_pairs(good, bad)


def strengths(docs: DataFrame, ranker: Ranker, *kept) -> DataFrame:
    """The ``kept`` columns of every row and the ``strength`` of its whole ``text``; one pass, a few texts at a time."""

    @F.arrow_udf("double")
    def strength(texts: pa.Array) -> pa.Array:
        batch = pa.record_batch([texts.cast(pa.string())], ["text"])
        parts = [ranker.strength(features(p.column("text"))) for p in slices(batch, "text")]
        return pa.array(np.concatenate(parts or [np.zeros(0)]))

    return in_small_batches(docs).select(*kept, strength(F.col("text")).alias("strength"))


def place_cut(rated: DataFrame, labels: DataFrame, ranker: Ranker) -> Ranker:
    """The ranker with its cut at a quantile of the strengths of all usable labelled rows of ``rated`` (doc_id, strength).

    The quantile is that at which the fewest labels are on the wrong side, the lowest of several. Strengths are counted in
    STEPS equal steps between the least and the greatest, so counts of steps alone reach the driver, and the
    cut lies in the middle of the gap above the quantile's step. Without labels of both kinds all rows are above it.
    """
    known = rated.join(usable(labels), "doc_id").select("strength", "quality")
    lo, hi, kinds = known.agg(F.min("strength"), F.max("strength"), F.count_distinct("quality")).first()
    if kinds < 2:
        return replace(ranker, cut=-math.inf)
    size = (hi - lo) / STEPS or 1.0
    step = F.least(F.floor((F.col("strength") - lo) / size), F.lit(STEPS - 1)).alias("step")
    counted = known.groupBy(step).agg(F.sum("quality").alias("good"), F.count("*").alias("rows")).orderBy("step").collect()
    wrong = np.cumsum([2 * r["good"] - r["rows"] for r in counted])
    level = int(wrong.argmin())
    if wrong[level] >= 0:
        return replace(ranker, cut=lo - size)
    above = counted[level + 1]["step"] if level + 1 < len(counted) else STEPS + 1
    return replace(ranker, cut=lo + size * (counted[level]["step"] + 1 + above) / 2)


def score_documents(docs: DataFrame, labels: DataFrame, ranker: Ranker) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    One pass over the texts; their strengths are written, the cut is placed among them (``place_cut``), and they are
    read again. Scores depend on the text and the cut alone. A null text is empty and is scored as such, a very long
    one alone; a null id is not held out. Repeated rows get equal scores; further columns of any name are ignored; empty
    tables give empty results.
    """
    rated = stored(strengths(docs, ranker, F.col("doc_id").cast("long").alias("doc_id")), "strengths")
    placed = place_cut(rated, labels, ranker)

    @F.arrow_udf("double")
    def score(strength: pa.Array) -> pa.Array:
        return pa.array(placed.score(strength.to_numpy(zero_copy_only=False)))

    rows = rated.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("strength")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, ranker: Ranker) -> DataFrame:
    """The rows of ``docs`` whose text scores at or above the cut (``place_cut``), all columns unchanged.

    A null text is scored as an empty one; ids only bring labels to the cut, so null and repeated ones do not matter, and
    rows that are alike stay or go together. Columns of any name travel along; an empty table stays empty. Texts are
    scored a few at a time, a very long one alone; rows are written with their strengths, not scored twice.
    """
    rated = stored(strengths(docs, ranker, F.struct("*").alias("row")), "strengths")
    cut = place_cut(rated.select("row.doc_id", "strength"), labels, ranker).cut
    return rated.where(F.col("strength") >= cut).select("row.*")
