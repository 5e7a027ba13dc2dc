"""Text clean-up and text predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """Trim spaces (not tabs) and turn an empty result into null."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def truncate(c: Column | str, length: int = 500) -> Column:
    """First ``length`` characters."""
    return F.substring(_col(c), 1, length)


def join_list(c: Column | str, separator: str = ", ") -> Column:
    """One text from an array column; a null array gives an empty text."""
    return F.coalesce(F.concat_ws(separator, _col(c)), F.lit(""))


def normalise_list_text(c: Column | str) -> Column:
    """``['x', "y"]`` and ``x, y`` both become ``x, y``; apostrophes inside an item stay."""
    text = F.trim(_col(c))
    inner = F.regexp_replace(text, r"^\[\s*|\s*\]$", "")
    opened = F.regexp_replace(inner, r"""(^|,\s*)['"]""", "$1")
    unquoted = F.regexp_replace(opened, r"""['"](?=\s*,|$)""", "")
    return F.when(text.startswith("[") & text.endswith("]"), unquoted).otherwise(text)


def lacks_text(c: Column | str, text: str) -> Column:
    """True where ``text`` does not occur, case-sensitively; a null passes."""
    return ~F.coalesce(_col(c).contains(text), F.lit(False))


def contains_any_case(c: Column | str, text: str) -> Column:
    """True where ``text`` occurs in any letter case."""
    return F.lower(_col(c)).contains(text.lower())


def equals_or_missing(c: Column | str, value: str) -> Column:
    """True where the column equals ``value`` in any case, or is null or empty."""
    c = _col(c)
    return (F.upper(c) == value.upper()) | c.isNull() | (c == "")
