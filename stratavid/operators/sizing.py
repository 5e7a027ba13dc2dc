"""Decisions that depend on how large an input is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A broadcast side is held once per executor.
BROADCAST_LIMIT = 32 << 20

# Input files per shuffle partition. Rows in a task take many times what their compressed columns take in files.
PARTITION_BYTES = 4 << 20


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate; for a file scan, the size of the files."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """``df`` marked for broadcast if its estimated size allows it, else left to the join planner."""
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


def input_bytes(df: DataFrame) -> int:
    """Bytes of what a plan reads, each source once; a source of unknown size counts nothing."""
    plan = df._jdf.queryExecution().analyzed()
    unknown = int(plan.conf().defaultSizeInBytes())
    leaves = plan.collectLeaves()
    found = [leaves.apply(i) for i in range(leaves.size())]
    sizes = {leaf.semanticHash(): int(leaf.stats().sizeInBytes()) for leaf in found}
    return sum(size for size in sizes.values() if size < unknown)


def dealt(df: DataFrame, *keys: str, joined: bool = True) -> DataFrame:
    """Rows dealt by ``keys``, into more partitions the more the plan reads, so that no task's sort outgrows its memory.

    At least as many as the session's shuffle width; AQE joins what turns out small. It goes by compressed bytes, so for rows
    that shrink much in a shuffle pass ``joined=False``: partitions stay as they are, and hot keys are not split either.
    """
    width = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes(df) // PARTITION_BYTES))
    if not joined:
        return df.repartition(width, *keys)
    return df.hint("rebalance", width, *[F.col(k) for k in keys])
