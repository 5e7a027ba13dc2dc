"""Vectors as whole numbers: what whitening and negative mining share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True for a vector that has entries, all of them finite numbers."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def whole(vector: Column, scale: int, offset: int = 0) -> Column:
    """floor(scale * c) + offset of each entry c, as long."""
    return F.transform(vector, lambda c: F.floor(c * F.lit(float(scale))) + F.lit(offset))


def commonest_length(rows: DataFrame, column: str) -> int:
    """The length most arrays have, the larger of two as common; 0 without rows.

    One row per length reaches the driver's limit-1 query, none but the first is collected.
    """
    sizes = rows.groupBy(F.size(column).alias("d")).agg(F.count("*").alias("n"))
    top = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    return top["d"] if top else 0
