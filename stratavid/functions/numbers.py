"""Numeric coercion, sanity rules and statistics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"

# Texts that count as true in landed CSV files.
TRUE_TEXTS = ("true", "1", "yes")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_long(c: Column | str) -> Column:
    """Whole number from text; decimals are cut, anything else gives 0.

    The integer cast goes first so that counters above 2^53 keep every digit;
    the double is only a second chance for ``12.7`` or ``1e3``.
    """
    text = _col(c).cast("string")
    number = F.when(text.rlike(_NUMBER), text)
    return F.coalesce(
        number.try_cast("bigint"), number.try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint")
    )


def lenient_bool(c: Column | str) -> Column:
    """True for the accepted true texts in any case, else false; null is false."""
    return F.coalesce(F.lower(_col(c).cast("string")).isin(*TRUE_TEXTS), F.lit(False))


def non_negative(c: Column | str) -> Column:
    """Null instead of a negative value."""
    c = _col(c)
    return F.when(c >= 0, c)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division as double; a zero denominator gives null instead of an error."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def round_half_even(c: Column, scale: int = 0) -> Column:
    return F.bround(c, scale)


def round_half_up(c: Column, scale: int = 0) -> Column:
    return F.round(c, scale)


def correlation(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation as an aggregate; null for a constant column, one row or none.

    ``corr`` raises on a constant column under ANSI arithmetic, and float drift can
    make a constant look variable, so the extremes are compared first. A pair with
    a null on either side is left out of every term.
    """
    x, y = _col(x).cast("double"), _col(y).cast("double")
    both = x.isNotNull() & y.isNotNull()
    px, py = F.when(both, x), F.when(both, y)
    flat = (F.min(px) == F.max(px)) | (F.min(py) == F.max(py))
    spread = F.stddev_pop(px) * F.stddev_pop(py)
    return F.when(flat, F.lit(None).cast("double")).otherwise(
        F.try_divide(F.covar_pop(px, py), spread)
    )
