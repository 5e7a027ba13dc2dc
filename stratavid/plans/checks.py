"""The data checks declared on each warehouse table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame

from stratavid.operators.quality import (
    WARN,
    KeyCheck,
    RowCheck,
    accepted_range,
    check_entries,
    check_state,
    not_null,
    report,
    row_checks,
    unique,
    verdicts,
)

# The declared columns, keys and relations.
# Columns that must be present, per table.
REQUIRED = {
    "fact_channel_metrics": ("id", "channel_sk", "date_key"),
    "fact_video_performance": ("id", "video_sk", "channel_sk", "date_key"),
    "dim_channel": ("channel_sk", "natural_channel_id", "valid_from", "is_current"),
    "dim_video": ("video_sk", "video_id", "valid_from", "is_current"),
    "dim_date": ("date_key",),
    "dim_keyword": ("keyword_id", "keyword"),
    "dim_tag": ("tag_id", "tag_name"),
    "bridge_channel_keyword": ("channel_sk", "keyword_id", "valid_from", "is_current"),
    "bridge_video_tag": ("video_sk", "tag_id", "valid_from", "is_current"),
}

# A versioned dimension repeats its entity key, so its version key is the unique one.
UNIQUE = {
    "fact_channel_metrics": "id",
    "fact_video_performance": "id",
    "dim_channel": "version_sk",
    "dim_video": "version_sk",
    "dim_date": "date_key",
    "dim_keyword": "keyword_id",
    "dim_tag": "tag_id",
}

# Child table, key column and parent table.
RELATIONS = (
    ("fact_channel_metrics", "channel_sk", "dim_channel"),
    ("fact_channel_metrics", "date_key", "dim_date"),
    ("fact_video_performance", "video_sk", "dim_video"),
    ("fact_video_performance", "channel_sk", "dim_channel"),
    ("fact_video_performance", "date_key", "dim_date"),
    ("bridge_channel_keyword", "channel_sk", "dim_channel"),
    ("bridge_channel_keyword", "keyword_id", "dim_keyword"),
    ("bridge_video_tag", "video_sk", "dim_video"),
    ("bridge_video_tag", "tag_id", "dim_tag"),
)


def check_stg_channels(df: DataFrame) -> DataFrame:
    """Report on channel snapshots."""
    checks = [
        not_null("channel_id"),
        not_null("date_key"),
        not_null("loaded_at"),
        not_null("total_views", WARN),
        accepted_range("total_views", 0, severity=WARN),
        accepted_range("subscribers", 0, severity=WARN),
    ]
    return _check_staging("stg_channels", df, "channel_id", checks)


def check_stg_videos(df: DataFrame) -> DataFrame:
    """Report on video snapshots."""
    checks = [
        not_null("video_id"),
        not_null("channel_id"),
        not_null("date_key"),
        accepted_range("view_count", 0, severity=WARN),
        accepted_range("like_count", 0, severity=WARN),
        accepted_range("comment_count", 0, severity=WARN),
    ]
    return _check_staging("stg_videos", df, "video_id", checks)


def _check_staging(table: str, df: DataFrame, key: str, checks: list[RowCheck]) -> DataFrame:
    """The key repeats once per day, so its uniqueness is only a warning."""
    return report(table, [row_checks(df, checks), unique(df, key, WARN)])


Declared = list[tuple[str, list[RowCheck], list[KeyCheck]]]


def gold_checks(only: Sequence[str]) -> Declared:
    """The declared checks of the named gold tables."""
    declared = []
    for name in only:
        rows = [not_null(c) for c in REQUIRED[name]]
        if name == "fact_video_performance":
            rows.append(accepted_range("view_count", 0))
        keys = [KeyCheck(UNIQUE[name])] if name in UNIQUE else []
        keys += [KeyCheck(column, relation=_relation(name, column, parent)) for child, column, parent in RELATIONS if child == name]
        declared.append((name, rows, keys))
    return declared


def _relation(child: str, column: str, parent: str) -> str:
    return f"{child}.{column} in {parent}"


def gold_state(tables: dict[str, DataFrame], only: Sequence[str]) -> DataFrame:
    """The state of all checks on the tables named in ``only``: one pass over each table, parents included.

    Every relation declared for them is checked; a parent that is not given is an error.
    """
    entries = []
    declared = {name: (rows, keys) for name, rows, keys in gold_checks(only)}
    asked = [r for r in RELATIONS if r[0] in declared]
    for child, column, parent in asked:
        if parent not in tables:
            raise ValueError(f"{child}.{column} refers to {parent}, which is not given")
    for name, df in tables.items():
        rows, keys = declared.get(name, ([], []))
        parent_of = {_relation(*r): r[1] for r in asked if r[2] == name}
        if rows or keys or parent_of:
            entries.append(check_entries(name, df, rows, keys, parent_of))
    return check_state(reduce(DataFrame.unionByName, entries))


def check_gold(tables: dict[str, DataFrame], only: Sequence[str] | None = None) -> DataFrame:
    """Report on the gold tables of ``tables``, or on those named in ``only``, from one pass over each table."""
    names = tuple(tables if only is None else only)
    return verdicts(gold_state(tables, names), gold_checks(names))
