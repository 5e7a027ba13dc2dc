"""Mixing sources to target weights by Pfair scheduling. DataFrame and SQL functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratavid.llm.common import stored

# Blocks of a schedule, about: rows of a block follow from it unless they are given.
SLOTS = 1 << 15
# Rows of a source that are numbered together; a larger source has more such buckets.
BUCKET_ROWS = 1 << 12
# Whole numbers that stand for weights: their sum is about this, so decimal fractions are exact.
WEIGHT_SUM = 10**13
# Slots by which a window that rounding moved over a whole slot is put back.
NEAR = 1e-6
# Target weights are the row counts to this power unless they are given.
TEMPERATURE = 0.7


def target_weights(counts: DataFrame, weights: dict[str, float] | None, temperature: float) -> DataFrame:
    """Per source its rows and target weight: given, or its row count to a power."""
    if weights is None:
        return counts.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(temperature)))
    if not weights or any(not w > 0 for w in weights.values()):
        raise ValueError("weights are positive numbers by source")
    given = counts.sparkSession.createDataFrame(list(weights.items()), "source string, weight double")
    known = counts.join(F.broadcast(given), "source", "left")  # as large as the caller's dict
    missing = F.raise_error(F.concat(F.lit("no weight for source "), F.coalesce("source", F.lit("null"))))
    return known.withColumn("weight", F.coalesce("weight", missing.cast("double")))


def schedule(sources: DataFrame) -> DataFrame:
    """Pfair schedule of all blocks: one row per slot with i (source), k (block from 0), release and deadline.

    ``sources`` has one row per source: i (from 0, dense), blocks and weight. With the share w of a
    source among the live ones, its block k may not begin before floor(k / w) and must end by
    ceil((k + 1) / w), in slots since the live set last changed. Each slot goes to the released
    block with the earliest deadline, ties to the smaller i. Windows of shares that add up to one can
    always be met, so at every slot a live source has had its exact share to within less than one block.
    When a source has no blocks left, the others go on by their shares among themselves.

    Weights enter as whole numbers, so all comparisons are exact; where rounding them would move a window's
    edge over a whole slot, it is put back. The schedule is one sequence, built by one task
    from one row per source; about SLOTS steps bound it whatever the number of documents.
    """
    total = F.sum("weight").over(Window.partitionBy(F.lit(0)))
    whole = F.greatest(F.round(F.col("weight") / total * F.lit(WEIGHT_SUM)).cast("long"), F.lit(1).cast("long"))
    listed = F.array_sort(F.collect_list(F.struct("i", "blocks", "v")))
    state = sources.withColumn("v", whole).agg(listed.alias("all")).selectExpr(
        "transform(all, x -> x.v) AS v", "transform(all, x -> x.blocks) AS blocks"
    )
    planned = state.where("size(v) > 0").selectExpr(f"{EDF} AS plan")
    return planned.selectExpr("posexplode(flatten(plan)) AS (slot, pick)").select(F.col("slot").cast("long").alias("slot"), "pick.*")


PICK = "struct<late: int, deadline: bigint, i: int, release: bigint, k: bigint>"
# Steps that are collected before they join the plan, so that no long array is copied at every step.
CHUNK = 256

# One step: ``done`` has the blocks a source was given since the live set changed at slot ``since``,
# ``left`` those it still has, ``own`` its weight while it lives and ``sum`` that of all live ones.
_NEAR = f"cast(v * {NEAR}D AS bigint)"
_RELEASE = f"(s.done[i] * s.sum + {_NEAR}) DIV v"
_CHOICE = f"""
array_min(transform(s.own, (v, i) -> if(s.left[i] = 0, NULL, named_struct(
  'late', if({_RELEASE} <= t - s.since, 0, 1),
  'deadline', s.since + ((s.done[i] + 1) * s.sum + v - 1 - {_NEAR}) DIV v,
  'i', i,
  'release', s.since + {_RELEASE},
  'k', blocks[i] - s.left[i]))))
"""
_STEP = f"""
transform(array({_CHOICE}), w -> if(s.left[w.i] > 1,
  named_struct('since', s.since, 'sum', s.sum, 'own', s.own,
    'done', transform(s.done, (n, i) -> if(i = w.i, n + 1, n)),
    'left', transform(s.left, (n, i) -> if(i = w.i, n - 1, n)),
    'part', concat(s.part, array(w))),
  named_struct('since', t + 1, 'sum', s.sum - s.own[w.i], 'own', s.own,
    'done', transform(s.done, n -> 0L),
    'left', transform(s.left, (n, i) -> if(i = w.i, 0L, n)),
    'part', concat(s.part, array(w)))))[0]
"""
EDF = f"""
aggregate(
  sequence(0L, (aggregate(blocks, 0L, (a, n) -> a + n) - 1) DIV {CHUNK}L),
  named_struct('since', 0L, 'sum', aggregate(v, 0L, (a, n) -> a + n), 'own', v, 'done', transform(v, n -> 0L),
    'left', blocks, 'plan', cast(array() AS array<array<{PICK}>>)),
  (o, c) -> aggregate(
    sequence(c * {CHUNK}L, least((c + 1) * {CHUNK}L, aggregate(blocks, 0L, (a, n) -> a + n)) - 1),
    named_struct('since', o.since, 'sum', o.sum, 'own', o.own, 'done', o.done, 'left', o.left,
      'part', cast(array() AS array<{PICK}>)),
    (s, t) -> {_STEP},
    s -> named_struct('since', s.since, 'sum', s.sum, 'own', s.own, 'done', s.done, 'left', s.left,
      'plan', concat(o.plan, array(s.part)))),
  o -> o.plan)
"""


def mix(
    rows: DataFrame,
    source: str = "source",
    order: str = "doc_id",
    weights: dict[str, float] | None = None,
    temperature: float = TEMPERATURE,
    block: int | None = None,
    slots: int = SLOTS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``rows`` as a struct column ``row`` with their place in the mixture; every row exactly once.

    Further columns: source, block (number within the source), release, deadline and slot (in blocks,
    over the whole schedule) and position, which orders all rows.

    Rows of a source are put in a pseudo-random but repeatable order and cut into blocks of ``block``
    rows; by default all rows make about ``slots`` blocks. ``schedule`` gives each block its slot: at
    every slot each live source has had its target share to within less than one block.

    A source is numbered in buckets of about ``bucket_rows`` rows, so a hot source is many buckets, and the counts
    of the buckets before are added; they meet their bucket's rows in the exchange that numbers them.
    Broadcast are one row per source and one per block of the schedule, at most about ``slots`` together with
    the sources: a schedule that ``block`` makes longer than that is an error. Sources are meant to be
    names, not keys: a schedule costs sources x slots steps.

    Nulls: rows with a null source form a source of their own, a null order key sorts first in its
    bucket. Rows that repeat are all kept, in any order among themselves. Long texts only travel along.
    Empty tables give empty results; columns of any name may be in ``rows``.
    """
    key = F.col(f"row.{source}").cast("string")
    base = rows.select(F.struct("*").alias("row")).select(
        "row", key.alias("source"), F.xxhash64(F.col(f"row.{order}")).alias("_hash")
    )
    totals = stored(base.groupBy("source").agg(F.count("*").alias("n")), "mix-totals")
    size = totals.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    block = block or max(1, -(-size[0] // slots))
    if size[0] // block > slots:
        raise ValueError(f"{size[0]} rows in blocks of {block} make a schedule of more than {slots} slots")
    number = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.asc_nulls_first("source"))) - 1
    sources = target_weights(totals, weights, temperature).select(
        number.alias("i"),
        "source",
        F.ceil(F.col("n") / F.lit(block)).alias("blocks"),
        F.ceil(F.col("n") / F.lit(bucket_rows)).alias("buckets"),
        "weight",
    )
    sources = stored(sources, "mix-sources")
    plan = stored(schedule(sources), "mix-slots")

    named = sources.select("i", F.col("source").alias("_name"), "buckets")
    spread = base.join(F.broadcast(named), F.col("source").eqNullSafe(F.col("_name"))).select(
        "row", "source", "_hash", "i", F.pmod(F.xxhash64("_hash"), F.col("buckets")).alias("_bucket")
    )
    counts = stored(spread.groupBy("i", "_bucket").agg(F.count("*").alias("m")), "mix-counts")
    before = Window.partitionBy("i").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("i", "_bucket", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("_before"))
    local = F.row_number().over(
        Window.partitionBy("i", "_bucket").orderBy("_hash", F.col(f"row.{order}"), F.xxhash64("row"))
    )
    numbered = (
        spread.withColumn("_local", local)
        .join(offsets.hint("merge"), ["i", "_bucket"])
        .withColumn("_n", F.col("_before") + F.col("_local") - 1)
        .withColumn("block", F.floor(F.col("_n") / F.lit(block)).cast("long"))
    )
    spots = plan.select("i", F.col("k").alias("block"), "release", "deadline", "slot")
    placed = numbered.join(F.broadcast(spots), ["i", "block"])
    return placed.select(
        "row",
        "source",
        "block",
        "release",
        "deadline",
        "slot",
        (F.col("slot") * F.lit(block) + F.col("_n") % F.lit(block)).alias("position"),
    )


def mixed_rows(rows: DataFrame, **options) -> DataFrame:
    """The rows in the order of the mixture, their columns unchanged, range-partitioned by position.

    Nulls, ties, repeated rows, long texts, empty tables and clashing names are treated as ``mix`` does.
    """
    placed = mix(rows, **options)
    return placed.repartitionByRange("position").sortWithinPartitions("position").select("row.*")
