"""Top lists per role, without merging equal titles."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stratavid.functions import constant_mask, pseudonym
from stratavid.operators.masking import FULL, MaskedColumn, masked_view
from stratavid.plans.analytics import _top, current, latest_metrics


def _hidden(salt: str | None):
    """Pseudonyms under a secret salt, without which a plain value could be found by hashing guesses."""
    if not salt:
        raise ValueError("a masking policy needs a salt")
    return lambda c: pseudonym(c, salt)


def channel_policy(salt: str | None) -> dict[str, MaskedColumn]:
    return {"title": MaskedColumn("channel_title_masked", _hidden(salt))}


def video_policy(salt: str | None) -> dict[str, MaskedColumn]:
    return {
        "title": MaskedColumn("video_title_masked", _hidden(salt)),
        "category_name": MaskedColumn("category_title_masked", lambda _: constant_mask()),
    }


def top_channels(fact_channels: DataFrame, channels: DataFrame, role: str, salt: str | None = None) -> DataFrame:
    """Channels with the most views, titles hidden under ``salt`` from a limited role."""
    newest = latest_metrics(fact_channels, "channel_sk", "views")
    rows = newest.join(current(channels, "channel_sk", "title"), "channel_sk")
    best = _top(rows.select("title", "views", "channel_sk"), "views", "title", "channel_sk")
    return masked_view(best.select("title", "views"), {} if role == FULL else channel_policy(salt), role)


def top_videos(
    fact_videos: DataFrame, videos: DataFrame, role: str, salt: str | None = None, every_version: bool = False
) -> DataFrame:
    """Videos with the most views, titles and categories hidden from a limited role.

    ``every_version`` joins all versions of a video instead of the current one, which
    lists a video once per version.
    """
    newest = latest_metrics(fact_videos, "video_sk", "view_count")
    cols = ("video_sk", "title", "category_name", "valid_from")
    named = videos.select(*cols) if every_version else current(videos, *cols)
    rows = newest.join(named, "video_sk")
    best = _top(rows, "view_count", "title", "category_name", "video_sk", "valid_from")
    return masked_view(best.select("title", "category_name", "view_count"), {} if role == FULL else video_policy(salt), role)
