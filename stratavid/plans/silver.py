"""Rules of the two daily snapshot tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame

from stratavid.operators.snapshot import SnapshotRules, silver_snapshot

CHANNEL_RULES = SnapshotRules(
    key="channel_id",
    version="ts",
    columns={
        "channel_id": "channelId",
        "title": "title",
        "description": "description",
        "custom_url": "customUrl",
        "subscribers": "subscribers",
        "total_views": "views",
        "total_videos": "videos",
        "hidden_subscribers": "hiddenSubscribers",
        "published_at": "publishedAt",
        "country": "country",
        "default_language": "defaultLanguage",
        "keywords": "keywords",
        "uploads_playlist_id": "uploadsPlaylistId",
        "topics": "topics",
    },
    texts=("title", "description", "custom_url", "country", "default_language"),
    counters=("subscribers", "total_views", "total_videos"),
    times=("published_at",),
    evidence=("title", "subscribers", "total_views", "total_videos", "hidden_subscribers"),
)

VIDEO_RULES = SnapshotRules(
    key="video_id",
    version="ts",
    columns={
        "video_id": "videoId",
        "channel_id": "channelId",
        "title": "title",
        "published_at": "publishedAt",
        "tags": "tags",
        "category_id": "categoryId",
        "duration": "duration",
        "definition": "definition",
        "caption": "caption",
        "licensed_content": "licensedContent",
        "region_restriction": "regionRestriction",
        "view_count": "viewCount",
        "like_count": "likeCount",
        "comment_count": "commentCount",
        "privacy_status": "privacyStatus",
        "license": "license",
        "topic_categories": "topicCategories",
    },
    texts=("title",),
    counters=("view_count", "like_count", "comment_count"),
    times=("published_at",),
    evidence=("title", "view_count", "like_count", "comment_count"),
)


def daily(raw: DataFrame, rules: SnapshotRules, as_of: Column, tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """One row per entity and day by the given rules."""
    return silver_snapshot(raw, replace(rules, tiebreak=tiebreak), as_of)


def stg_channels(raw: DataFrame, as_of: Column, tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """One row per channel and day."""
    return daily(raw, CHANNEL_RULES, as_of, tiebreak)


def stg_videos(raw: DataFrame, as_of: Column, tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """One row per video and day."""
    return daily(raw, VIDEO_RULES, as_of, tiebreak)
