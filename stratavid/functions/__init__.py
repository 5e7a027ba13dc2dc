"""Column functions: each takes and returns ``Column`` and stays inside the JVM."""

from stratavid.functions.keys import constant_mask, pseudonym, surrogate_key
from stratavid.functions.numbers import (
    correlation,
    lenient_bool,
    lenient_long,
    non_negative,
    ratio,
    round_half_even,
    round_half_up,
)
from stratavid.functions.text import (
    blank_to_null,
    contains_any_case,
    equals_or_missing,
    join_list,
    lacks_text,
    normalise_list_text,
    truncate,
)
from stratavid.functions.times import (
    interval_seconds,
    iso_duration_seconds,
    iso_weekday,
    length_seconds,
    not_future,
    parse_timestamp,
    year_month,
)

__all__ = [
    "blank_to_null",
    "constant_mask",
    "contains_any_case",
    "correlation",
    "equals_or_missing",
    "interval_seconds",
    "iso_duration_seconds",
    "iso_weekday",
    "join_list",
    "length_seconds",
    "lacks_text",
    "lenient_bool",
    "lenient_long",
    "non_negative",
    "normalise_list_text",
    "not_future",
    "parse_timestamp",
    "pseudonym",
    "ratio",
    "round_half_even",
    "round_half_up",
    "surrogate_key",
    "truncate",
    "year_month",
]
