"""Business questions on the star schema. Every top list has a full tie-break."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratavid.functions import correlation, iso_duration_seconds, ratio, round_half_even
from stratavid.operators.latest import latest_by_key

TOP = 10


def latest_metrics(fact: DataFrame, sk: str, *measures: str) -> DataFrame:
    """Newest fact row per entity."""
    return latest_by_key(fact.select(sk, "date_key", *measures), [sk], "date_key").drop("date_key")


def latest_viewed(fact_videos: DataFrame) -> DataFrame:
    """Newest fact row with any views per video, with its interactions per view.

    Rows without views go before the ranking, so the newest positive row counts.
    """
    viewed = fact_videos.filter(F.col("view_count") > 0)
    newest = latest_metrics(viewed, "video_sk", "view_count", "like_count", "comment_count")
    interactions = F.coalesce("like_count", F.lit(0)) + F.coalesce("comment_count", F.lit(0))
    return newest.select("video_sk", ratio(interactions, F.col("view_count")).alias("engagement_rate"))


def current(versions: DataFrame, *cols: str) -> DataFrame:
    """Chosen columns of the open versions."""
    return versions.filter("is_current").select(*cols)


def current_durations(videos: DataFrame, *cols: str) -> DataFrame:
    """Length in seconds of every current video that states one."""
    timed = current(videos.filter(F.col("duration").isNotNull()), "video_sk", "duration", *cols)
    return timed.withColumn("duration_seconds", iso_duration_seconds("duration")).drop("duration")


def _top(df: DataFrame, measure: str, *ties: str, n: int = TOP) -> DataFrame:
    order = [F.col(measure).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties]]
    return df.orderBy(*order).limit(n)


def top_channels(fact_channels: DataFrame, channels: DataFrame) -> DataFrame:
    """Channel titles with the most views."""
    newest = latest_metrics(fact_channels, "channel_sk", "views")
    titled = newest.join(current(channels, "channel_sk", "title"), "channel_sk")
    totals = titled.groupBy("title").agg(F.sum("views").alias("total_views"))
    return _top(totals, "total_views", "title")


def top_videos(fact_videos: DataFrame, videos: DataFrame) -> DataFrame:
    """Video titles and categories with the most views."""
    newest = latest_metrics(fact_videos, "video_sk", "view_count")
    named = newest.join(current(videos, "video_sk", "title", "category_name"), "video_sk")
    totals = named.groupBy("title", "category_name").agg(F.sum("view_count").alias("total_views"))
    return _top(totals, "total_views", "title", "category_name")


def popular_keywords(fact_channels: DataFrame, bridge: DataFrame, keywords: DataFrame) -> DataFrame:
    """Keywords whose channels have the most subscribers."""
    newest = latest_metrics(fact_channels, "channel_sk", "subscribers")
    tagged = newest.join(current(bridge, "channel_sk", "keyword_id"), "channel_sk")
    totals = tagged.groupBy("keyword_id").agg(
        F.sum("subscribers").alias("total_subscribers"),
        F.count_distinct("channel_sk").alias("channel_count"),
    )
    # Keyword text and id are one to one, so names join the totals, not the pairs.
    named = totals.join(keywords, "keyword_id").select("keyword", "total_subscribers", "channel_count")
    return _top(named, "total_subscribers", "keyword")


def duration_view_correlation(fact_videos: DataFrame, videos: DataFrame) -> DataFrame:
    """Correlation of length and views over current videos."""
    newest = latest_metrics(fact_videos, "video_sk", "view_count").filter("view_count is not null")
    both = newest.join(current_durations(videos), "video_sk")
    return both.agg(correlation("duration_seconds", "view_count").alias("duration_view_correlation"))


def tag_engagement(
    fact_videos: DataFrame, bridge: DataFrame, tags: DataFrame, min_videos: int = 10
) -> DataFrame:
    """Tags with the highest mean interactions per view among tags on enough videos."""
    rates = latest_viewed(fact_videos)
    tagged = rates.join(current(bridge, "video_sk", "tag_id"), "video_sk")
    means = tagged.groupBy("tag_id").agg(
        F.avg("engagement_rate").alias("avg_engagement_rate"),
        F.count_distinct("video_sk").alias("video_count"),
    )
    enough = means.filter(F.col("video_count") >= min_videos)
    named = enough.join(tags, "tag_id").select("tag_name", "avg_engagement_rate", "video_count")
    return _top(named, "avg_engagement_rate", "tag_name")


def category_performance(fact_videos: DataFrame, videos: DataFrame, min_videos: int = 50) -> DataFrame:
    """Length, views and likes per category with enough videos, most viewed first."""
    newest = latest_metrics(fact_videos, "video_sk", "view_count", "like_count")
    both = newest.join(current_durations(videos, "category_name"), "video_sk")
    totals = both.groupBy("category_name").agg(
        (F.avg("duration_seconds") / 60).alias("avg_duration_minutes"),
        F.sum("view_count").alias("total_views"),
        F.sum("like_count").alias("total_likes"),
        F.count_distinct("video_sk").alias("video_count"),
    )
    return totals.filter(F.col("video_count") >= min_videos).orderBy(
        F.col("total_views").desc_nulls_last(), F.col("category_name").asc_nulls_last()
    )


def top_categories(fact_videos: DataFrame, videos: DataFrame) -> DataFrame:
    """Categories with the most views."""
    newest = latest_metrics(fact_videos, "video_sk", "view_count")
    named = newest.join(current(videos, "video_sk", "category_name"), "video_sk")
    totals = named.groupBy("category_name").agg(
        F.sum("view_count").alias("total_views"), F.count_distinct("video_sk").alias("video_count")
    )
    return _top(totals, "total_views", "category_name")


def minute_bucket(seconds: Column) -> Column:
    """Whole minutes, half a minute going to the even side."""
    return round_half_even(seconds / 60)


def optimal_length(fact_videos: DataFrame, videos: DataFrame, more_than: int = 10) -> DataFrame:
    """Lengths in minutes with the highest mean interactions per view."""
    both = latest_viewed(fact_videos).join(current_durations(videos), "video_sk")
    bucketed = both.withColumn("duration_minutes", minute_bucket(F.col("duration_seconds")))
    means = bucketed.groupBy("duration_minutes").agg(
        F.avg("engagement_rate").alias("avg_engagement_rate"),
        F.count_distinct("video_sk").alias("video_count"),
    )
    return _top(
        means.filter(F.col("video_count") > more_than), "avg_engagement_rate", "duration_minutes"
    )
