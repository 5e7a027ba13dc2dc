"""Raw observations to one clean row per entity and day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratavid.functions import blank_to_null, equals_or_missing, lacks_text, non_negative, not_future
from stratavid.operators.latest import daily_latest
from stratavid.operators.sizing import dealt


@dataclass(frozen=True)
class SnapshotRules:
    """How one raw table becomes a daily snapshot.

    ``columns`` maps output name to raw name, in output order. The other fields name
    output columns: the entity ``key``, ``texts`` to trim and blank to null,
    ``counters`` that may not be negative, ``times`` that may not lie after the load,
    and ``evidence``, of which at least one must be present for a row to count.
    """

    key: str
    version: str
    columns: Mapping[str, str]
    texts: Sequence[str] = ()
    counters: Sequence[str] = ()
    times: Sequence[str] = ()
    evidence: Sequence[str] = ()
    tiebreak: Sequence[str] = field(default=())


def silver_snapshot(raw: DataFrame, rules: SnapshotRules, as_of: Column) -> DataFrame:
    """One clean row per entity and day, with ``loaded_at`` and ``date_key``.

    The day's newest row is picked first and cleaned afterwards, so an all-null
    newest row drops the day instead of uncovering an older row.

    Rows are dealt by the entity alone, before they are ranked. Histories, joins and windows
    over the same key then need no exchange of their own, and no input split sorts its wide
    rows (which spills) to cut the few that share an entity and a day.
    """
    wanted = [F.col(raw_name).alias(name) for name, raw_name in rules.columns.items()]
    version = F.col(rules.version)
    staged = raw.select(
        *wanted, version.alias("loaded_at"), F.to_date(version).alias("date_key"), *_extra(rules)
    )
    newest = daily_latest(dealt(staged, rules.key), [rules.key], "loaded_at", rules.tiebreak).select(
        *rules.columns, "loaded_at", "date_key"
    )

    def cleaned(name: str) -> Column:
        if name in rules.texts:
            return blank_to_null(name).alias(name)
        if name in rules.counters:
            return non_negative(name).alias(name)
        if name in rules.times:
            return not_future(name, as_of).alias(name)
        return F.col(name)

    clean = newest.select(*[cleaned(c) for c in newest.columns])
    return clean.na.drop(how="all", subset=list(rules.evidence)) if rules.evidence else clean


def _extra(rules: SnapshotRules) -> list[Column]:
    return [F.col(c) for c in rules.tiebreak if c not in (*rules.columns, "date_key")]


def clean_channels(
    df: DataFrame,
    country: str = "EE",
    unwanted: str = "topic",
    min_views: int | None = None,
    max_videos: int = 1000,
) -> DataFrame:
    """Channels worth following: some videos but not too many, wanted country or none, no mirror titles.

    ``unwanted`` is matched case-sensitively and a missing title is kept.
    """
    kept = df.filter(
        (F.col("videos") > 0)
        & (F.col("videos") <= max_videos)
        & lacks_text("title", unwanted)
        & equals_or_missing("country", country)
    )
    return kept if min_views is None else kept.filter(F.col("views") > min_views)
