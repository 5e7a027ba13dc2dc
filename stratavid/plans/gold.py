"""Dimensions, bridges and facts over the daily snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratavid.functions import surrogate_key
from stratavid.operators.history import (
    scd2_history,
    versioned_view,
    with_version_key,
)
from stratavid.operators.sizing import broadcast_small
from stratavid.operators.star import DimensionLink, build_fact
from stratavid.operators.tokens import first_bridge_snapshot, token_bridge, token_dim

# The columns whose change opens a version.
CHANNEL_CHECKS = (
    "title", "description", "custom_url", "hidden_subscribers", "country", "default_language",
    "topics",
)
VIDEO_CHECKS = (
    "title", "category_id", "duration", "definition", "caption", "licensed_content",
    "privacy_status", "license", "topic_categories", "region_restriction",
)


def channel_snapshot_rows(stg: DataFrame) -> DataFrame:
    """Snapshot columns of a channel observation."""
    return stg.select(
        surrogate_key("channel_id").alias("channel_sk"),
        F.col("channel_id").alias("natural_channel_id"),
        "title", "description", "custom_url", "hidden_subscribers", "published_at", "country",
        "default_language", "uploads_playlist_id", "topics", "loaded_at",
    )


def video_snapshot_rows(stg: DataFrame) -> DataFrame:
    """Snapshot columns of a video observation."""
    return stg.select(
        surrogate_key("video_id").alias("video_sk"),
        "video_id", "title", "published_at", "category_id", "duration", "definition", "caption",
        "licensed_content", "privacy_status", "license", "region_restriction", "topic_categories",
        "loaded_at",
    )


def channel_snapshot(stg: DataFrame) -> DataFrame:
    """All channel versions."""
    rows = channel_snapshot_rows(stg)
    return scd2_history(rows, ["natural_channel_id"], "loaded_at", CHANNEL_CHECKS, daily=True)


def video_snapshot(stg: DataFrame) -> DataFrame:
    """All video versions."""
    rows = video_snapshot_rows(stg)
    return scd2_history(rows, ["video_id"], "loaded_at", VIDEO_CHECKS, daily=True)


def dim_channel(snapshot: DataFrame) -> DataFrame:
    """Channel dimension: every version, the open one flagged."""
    return with_version_key(versioned_view(snapshot), "natural_channel_id")


def dim_video(snapshot: DataFrame, categories: DataFrame) -> DataFrame:
    """Video dimension with its category name; a category outside the seed has none."""
    seed = broadcast_small(categories)
    named = snapshot.join(seed, "category_id", "left").drop("category_id")
    return with_version_key(versioned_view(named), "video_id").select(
        "video_sk", "video_id", "title", "published_at", "category_name", "duration", "definition",
        "caption", "licensed_content", "privacy_status", "license", "region_restriction",
        "topic_categories", "valid_from", "valid_to", "is_current", "version_sk",
    )


def dim_keyword(stg_channels: DataFrame) -> DataFrame:
    return token_dim(stg_channels, "keywords", "keyword_id", "keyword")


def dim_tag(stg_videos: DataFrame) -> DataFrame:
    return token_dim(stg_videos, "tags", "tag_id", "tag_name")


def channel_keyword_pairs(stg: DataFrame, channels: DataFrame, as_of: Column) -> DataFrame:
    """Channel-keyword pairs with their newest sighting."""
    return token_bridge(
        stg, channels, "channel_id", "natural_channel_id", "channel_sk",
        "keywords", "keyword", "keyword_id", as_of,
    )


def video_tag_pairs(stg: DataFrame, videos: DataFrame, as_of: Column) -> DataFrame:
    """Video-tag pairs with their newest sighting."""
    return token_bridge(
        stg, videos.withColumnRenamed("video_id", "__video_id"), "video_id", "__video_id",
        "video_sk", "tags", "tag_name", "tag_id", as_of,
    )


opened = first_bridge_snapshot
versions = versioned_view


def bridge(pairs: DataFrame) -> DataFrame:
    """Bridge with its validity, as its first snapshot builds it."""
    return versions(opened(pairs))


def fact_channel_metrics(
    stg: DataFrame, channels: DataFrame, asof: bool = False, horizon: Column | None = None
) -> DataFrame:
    """Daily counters per channel."""
    links = [DimensionLink(channels, "channel_id", "natural_channel_id", "channel_sk")]
    measures = {"subscribers": "subscribers", "views": "total_views", "videos": "total_videos"}
    return build_fact(stg, links, ["channel_id", "date_key"], measures, asof, horizon)


def fact_video_performance(
    stg: DataFrame,
    videos: DataFrame,
    channels: DataFrame,
    asof: bool = False,
    horizon: Column | None = None,
) -> DataFrame:
    """Daily counters per video, with the keys of its video and channel."""
    links = [
        DimensionLink(videos, "video_id", "video_id", "video_sk"),
        DimensionLink(channels, "channel_id", "natural_channel_id", "channel_sk"),
    ]
    measures = {c: c for c in ("view_count", "like_count", "comment_count")}
    return build_fact(stg, links, ["video_id", "date_key"], measures, asof, horizon)
