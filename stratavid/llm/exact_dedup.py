"""Exact deduplication by 128-bit content hash, confirmed byte by byte. Built-in functions only."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratavid.llm.common import sieve, sifted, stored

# Positions of the sieve over ids of rows that share a hash: 2**26 bits are 8 MB.
SIEVE_BITS = 26


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case and nothing else changed; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))


def content_hash(text: Column) -> Column:
    """128 bits of the UTF-8 bytes."""
    return F.unhex(F.md5(text))


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    normalise: Callable[[Column], Column] = ascii_lower,
    digest: Callable[[Column], Column] = content_hash,
    sieve_bits: int = SIEVE_BITS,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Rows are grouped by a 128-bit hash of the normalised text. Only rows whose hash occurs more
    than once have their texts compared: those texts are grouped by hash and whole text, which
    pre-aggregates before the shuffle, so a hot group costs one row per input split. Texts with
    equal hashes and unlike bytes fall into groups of their own. ``keep`` is ``smallest`` or
    ``largest`` id of a group.

    Text is normalised once; what follows moves hashes and ids. Texts that occur once are never
    shuffled. The id sieve that selects the rest has a fixed size (``sieve_bits``).

    Nulls: a null text equals an empty one; a null id loses to any other id and is kept only in a
    group without ids. Repeated rows (same id, same text) count towards group_size and are all marked
    alike. Empty tables give empty results; further columns are ignored.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep is 'smallest' or 'largest', not {keep!r}")
    best = F.min if keep == "smallest" else F.max
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    norm = normalise(F.col("text"))
    hashed = stored(
        rows.select("id", norm.alias("norm")).select(
            "id", digest(F.col("norm")).alias("h"), F.unhex(F.sha2("norm", 256)).alias("sha")
        ),
        "exact-hashes",
    )
    shared = stored(hashed.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "exact-shared")
    suspects = sieve(hashed.join(shared, "h").select("id"), "id", sieve_bits)
    texts = (
        sifted(rows, "id", suspects, sieve_bits)
        .select("id", norm.alias("norm"))
        .groupBy(digest(F.col("norm")).alias("h"), "norm")
        .agg(F.count("*").alias("n"), best("id").alias("keep"))
        .where("n > 1")
        .select("h", F.unhex(F.sha2("norm", 256)).alias("sha"), "n", "keep")
    )
    # Both digests name a compared text; a text they cannot tell from another ends the job.
    groups = stored(
        texts.groupBy("h", "sha")
        .agg(F.count("*").alias("texts"), F.first("n").alias("n"), F.first("keep").alias("keep"))
        .select(
            "h",
            "sha",
            F.when(F.col("texts") > 1, F.raise_error(F.lit("unlike texts share both digests")).cast("long"))
            .otherwise(F.col("n"))
            .alias("n"),
            "keep",
        ),
        "exact-groups",
    )
    return hashed.join(groups, ["h", "sha"], "left").select(
        F.col("id").alias(id_col),
        F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (F.col("n").isNull() | F.col("id").eqNullSafe(F.col("keep"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that exact_groups keeps, all columns unchanged; repeated rows become one.

    The rows to drop are named by id and text digest and filtered by a sieve first, so only rows
    that may go are joined; all others pass without a shuffle.
    """
    bits = options.get("sieve_bits", SIEVE_BITS)
    normalise = options.get("normalise", ascii_lower)
    groups = exact_groups(docs, id_col, text_col, **options).where("group_size > 1")
    groups = stored(groups.select(F.col(id_col).alias("_id"), F.col("text_sha256").alias("_sha"), "kept").distinct(), "exact-verdicts")
    bitmap = stored(sieve(groups, "_id", bits), "exact-sieve")
    packed = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    suspects = sifted(packed, "_id", bitmap, bits).withColumn("_sha", F.sha2(normalise(F.col("_text")), 256))
    judged = (
        suspects.join(
            groups.withColumnsRenamed({"_id": "_gid", "_sha": "_gsha"}),
            F.col("_id").eqNullSafe(F.col("_gid")) & (F.col("_sha") == F.col("_gsha")),
            "left",
        )
        .where("kept IS NULL OR kept")
        .withColumn("_order", F.xxhash64("row"))
    )
    grouped = (
        judged.where("kept")
        .groupBy("_id", "_sha")
        .agg(F.min_by("row", "_order").alias("row"))
        .select("row.*")
    )
    alone = judged.where("kept IS NULL").select("row.*")
    return _unsifted(docs, id_col, bitmap, bits).unionByName(alone).unionByName(grouped)


def _unsifted(docs: DataFrame, id_col: str, bitmap: DataFrame, bits: int) -> DataFrame:
    """Rows that the sieve says are in no group."""
    packed = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("_id"))
    return sifted(packed, "_id", bitmap, bits, keep=False).select("row.*")
