"""Time parsing, ISO durations and calendar parts.

Timestamps are handled as ``timestamp_ntz`` holding UTC wall-clock time, so a day
or month never depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# How hours, minutes and seconds are found in an ISO-8601 duration.
# Only the part after ``PT`` counts, so a day part is not read here.
HOURS_PATTERN = r"PT(\d+)H"
MINUTES_PATTERN = r"PT.*?(\d+)M"
SECONDS_PATTERN = r"PT.*?(\d+)S"
DAYS_PATTERN = r"^P(\d+)D"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_duration_seconds(c: Column | str, days: bool = False) -> Column:
    """Seconds in a text like ``PT1H2M3S``; a missing part, or null, counts as 0.

    A text with a day part, like ``P1DT2H``, counts as 0 unless ``days`` is set.
    """
    text = _col(c)

    def part(source: Column, pattern: str, seconds: int) -> Column:
        found = F.regexp_extract(source, pattern, 1).try_cast("bigint")
        return F.coalesce(found, F.lit(0).cast("bigint")) * seconds

    clock = F.regexp_replace(text, DAYS_PATTERN, "P") if days else text
    total = (
        part(clock, HOURS_PATTERN, 3600)
        + part(clock, MINUTES_PATTERN, 60)
        + part(clock, SECONDS_PATTERN, 1)
    )
    return total + part(text, DAYS_PATTERN, 86400) if days else total


def interval_seconds(c: Column | str) -> Column:
    """Seconds in a day-time interval, as double."""
    c = _col(c)
    units = (("DAY", 86400), ("HOUR", 3600), ("MINUTE", 60), ("SECOND", 1))
    parts = [F.extract(F.lit(unit), c).cast("double") * seconds for unit, seconds in units]
    return parts[0] + parts[1] + parts[2] + parts[3]


def length_seconds(df: DataFrame, column: str) -> Column:
    """Seconds of a length stored as a day-time interval or as ISO text."""
    kind = df.schema[column].dataType
    return interval_seconds(column) if isinstance(kind, T.DayTimeIntervalType) else iso_duration_seconds(column)


def iso_weekday(c: Column | str) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(_col(c)) + 1


def year_month(c: Column | str) -> Column:
    """``yyyyMM`` as text, the month-partition value."""
    return F.date_format(_col(c), "yyyyMM")


def not_future(c: Column | str, as_of: Column) -> Column:
    """Null instead of a time after ``as_of``."""
    c = _col(c)
    return F.when(c <= as_of, c)


def parse_timestamp(c: Column | str) -> Column:
    """UTC wall-clock time from text; ``Z`` or none is UTC, an offset is converted, bad text is null."""
    text = F.trim(_col(c))
    plain = F.regexp_replace(text, r"[zZ]$", "").try_cast("timestamp_ntz")
    local = text.try_cast("timestamp").cast("timestamp_ntz")
    shifted = F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)
    return F.when(text.rlike(r"\d[+-]\d{2}:?\d{2}$") & text.contains(":"), shifted).otherwise(plain)
