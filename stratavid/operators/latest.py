"""Newest or first row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratavid.operators.sizing import dealt

_RANK = "__rank"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def top_per_key(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows per key in ``order``.

    The rank filter sits directly on the window, so Spark cuts each input split to
    ``n`` rows per key before the exchange (``WindowGroupLimit``). A hot key then
    sends ``n`` rows per split instead of all its rows.
    """
    window = Window.partitionBy(*[_col(k) for k in keys]).orderBy(*order)
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.filter(F.col(_RANK) <= n).drop(_RANK)


def latest_by_key(
    df: DataFrame,
    keys: Sequence[Column | str],
    version: Column | str,
    tiebreak: Sequence[Column | str] = (),
) -> DataFrame:
    """Last write wins: the row with the largest ``version`` per key.

    ``tiebreak`` columns, largest first, settle equal versions; without them the
    choice among equal versions is arbitrary.
    """
    order = [_col(c).desc_nulls_last() for c in (version, *tiebreak)]
    return top_per_key(df, keys, order)


def daily_latest(
    df: DataFrame,
    keys: Sequence[Column | str],
    ts: Column | str,
    tiebreak: Sequence[Column | str] = (),
) -> DataFrame:
    """Newest row per key and calendar day of ``ts``."""
    return latest_by_key(df, [*keys, F.to_date(_col(ts))], ts, tiebreak)


def first_by_key(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column | str]) -> DataFrame:
    """Distinct keys, keeping the row that comes first in ``order``."""
    return top_per_key(df, keys, [_col(c).asc_nulls_last() for c in order])


def dealt_anew(union: DataFrame, *keys: str) -> DataFrame:
    """Rows of a union, dealt by ``keys`` in an exchange of their own.

    Parts that are dealt by the keys already make Spark take their union as dealt, too. AQE then joins
    the shuffle partitions of each part on its own, and windows over the union miss rows on large tables
    (seen with Spark 4.1.2). The planner leaves out a repartition there, but not a rebalance.
    """
    return dealt(union, *keys)
