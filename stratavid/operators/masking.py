"""Per-role projections of one query."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FULL = "analyst_full"
LIMITED = "analyst_limited"


@dataclass(frozen=True)
class MaskedColumn:
    """A hidden column: the name it is shown under and how its value is replaced."""

    shown_as: str
    mask: Callable[[Column], Column]


def masked_view(df: DataFrame, policy: Mapping[str, MaskedColumn], role: str) -> DataFrame:
    """``df`` as ``role`` may see it: unchanged for the full role, masked for any other."""
    if role == FULL:
        return df
    return df.select(
        *[
            policy[c].mask(F.col(c)).alias(policy[c].shown_as) if c in policy else F.col(c)
            for c in df.columns
        ]
    )
