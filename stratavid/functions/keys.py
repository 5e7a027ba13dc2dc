"""Surrogate keys and masking."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text hashed in place of a null, and the text shown for a hidden value.
NULL_MARKER = "_dbt_utils_surrogate_key_null_"
MASK = "***"


def surrogate_key(*cols: Column | str) -> Column:
    """MD5 of the fields joined by ``-``; null and the empty text hash differently."""
    fields = [F.col(c) if isinstance(c, str) else c for c in cols]
    texts = [F.coalesce(c.cast("string"), F.lit(NULL_MARKER)) for c in fields]
    return F.md5(F.concat_ws("-", *texts))


def pseudonym(c: Column | str, salt: str) -> Column:
    """Salted hash text: equal values stay equal, the plain text is hidden, null stays null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sha2(F.concat(F.lit(salt), c.cast("string")), 256)


def constant_mask(text: str = MASK) -> Column:
    return F.lit(text)
