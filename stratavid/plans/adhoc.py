"""Ad-hoc questions asked of plain channel and video tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavid.functions import (
    contains_any_case,
    correlation,
    length_seconds,
    ratio,
    round_half_up,
)
from stratavid.operators.tokens import token_rows
from stratavid.plans.analytics import _top


def _interactions():
    return F.coalesce("like_count", F.lit(0)) + F.coalesce("comment_count", F.lit(0))


def top_topic(channels: DataFrame, theme: str) -> DataFrame:
    """The topic around a theme with the most subscribers."""
    topics = token_rows(channels.select("topics", "subscribers"), "topics", "topic")
    totals = (
        topics.filter(contains_any_case("topic", theme))
        .groupBy("topic")
        .agg(F.sum("subscribers").alias("total_subscribers"))
    )
    return _top(totals, "total_subscribers", "topic", n=1)


def top_channels_in_topic(channels: DataFrame, theme: str) -> DataFrame:
    """Largest channels with a topic around a theme."""
    cols = ("channel_id", "title", "subscribers", "total_views")
    topics = token_rows(channels.select(*cols, "topics"), "topics", "topic")
    matching = topics.filter(contains_any_case("topic", theme)).select(*cols).distinct()
    return _top(matching, "subscribers", "channel_id", "title", "total_views")


def best_category(videos: DataFrame) -> DataFrame:
    """Videos and views per category, most viewed first."""
    seen = videos.filter(F.col("view_count").isNotNull())
    totals = seen.groupBy("category_id").agg(
        F.count("video_id").alias("video_count"),
        F.sum("view_count").alias("total_views"),
        F.avg("view_count").alias("avg_views"),
    )
    return totals.orderBy(F.col("total_views").desc_nulls_last(), F.col("category_id").asc_nulls_last())


def category_duration(videos: DataFrame) -> DataFrame:
    """Mean length, views and likes per category, most viewed first."""
    timed = videos.filter(F.col("duration").isNotNull())
    means = timed.groupBy("category_id").agg(
        (F.avg(length_seconds(timed, "duration")) / 60).alias("avg_duration_minutes"),
        F.avg("view_count").alias("avg_views"),
        F.avg("like_count").alias("avg_likes"),
        F.count("*").alias("video_count"),
    )
    return means.orderBy(F.col("avg_views").desc_nulls_last(), F.col("category_id").asc_nulls_last())


def duration_correlation(videos: DataFrame) -> DataFrame:
    """Correlation of length and views over all rows."""
    known = videos.filter(F.col("duration").isNotNull() & F.col("view_count").isNotNull())
    seconds = known.withColumn("duration_seconds", length_seconds(known, "duration"))
    return seconds.agg(correlation("duration_seconds", "view_count").alias("duration_view_correlation"))


def tag_engagement(videos: DataFrame, n: int = 20) -> DataFrame:
    """Tags with the highest interactions per view over all their videos together."""
    tags = token_rows(
        videos.select("tags", "view_count", _interactions().alias("interactions")), "tags", "tag"
    )
    totals = tags.groupBy("tag").agg(
        ratio(F.sum("interactions"), F.sum("view_count")).alias("engagement_rate")
    )
    return _top(totals, "engagement_rate", "tag", n=n)


def optimal_length(videos: DataFrame, categories: Sequence[int]) -> DataFrame:
    """Lengths in minutes with the highest mean interactions per view within some categories."""
    viewed = videos.filter(
        F.col("duration").isNotNull()
        & (F.col("view_count") > 0)
        & F.col("category_id").isin(list(categories))
    )
    rates = viewed.select(
        round_half_up(length_seconds(viewed, "duration") / 60).alias("duration_minutes"),
        ratio(_interactions(), F.col("view_count")).alias("engagement_rate"),
    )
    means = rates.groupBy("duration_minutes").agg(F.avg("engagement_rate").alias("avg_engagement_rate"))
    return _top(means, "avg_engagement_rate", "duration_minutes")


def top_videos_in_topic(videos: DataFrame, theme: str, n: int = 10) -> DataFrame:
    """Most viewed videos whose topics mention a theme."""
    cols = ("video_id", "title", "view_count", "like_count", "comment_count", "topic_categories")
    matching = videos.select(*cols).filter(contains_any_case("topic_categories", theme))
    return _top(matching, "view_count", *[c for c in cols if c != "view_count"], n=n)
