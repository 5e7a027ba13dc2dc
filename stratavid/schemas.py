"""Schemas of the landed data, with the descriptions that travel with the tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _field(name: str, kind: T.DataType, comment: str = "", nullable: bool = True) -> T.StructField:
    return T.StructField(name, kind, nullable, {"comment": comment} if comment else {})


_text, _count, _flag = T.StringType(), T.LongType(), T.BooleanType()
_time, _day = T.TimestampNTZType(), T.DateType()

RAW_CHANNELS = T.StructType(
    [
        _field("ts", _time, "Time of the observation"),
        _field("channelId", _text, "Channel identifier"),
        _field("title", _text),
        _field("description", _text, "Channel description, at most 500 characters"),
        _field("customUrl", _text),
        _field("subscribers", _count),
        _field("views", _count),
        _field("videos", _count),
        _field("hiddenSubscribers", _flag),
        _field("publishedAt", _time, "Time the channel was created"),
        _field("country", _text),
        _field("defaultLanguage", _text),
        _field("keywords", _text, "Comma-separated list"),
        _field("uploadsPlaylistId", _text),
        _field("topics", _text, "Comma-separated list"),
        _field("loaded_at", _day, "Load day"),
    ]
)

RAW_VIDEOS = T.StructType(
    [
        _field("ts", _time, "Time of the observation"),
        _field("videoId", _text, "Video identifier"),
        _field("title", _text),
        _field("publishedAt", _time, "Time the video was published"),
        _field("tags", _text, "Comma-separated list"),
        _field("categoryId", _count),
        _field("channelId", _text, "Channel the video belongs to"),
        _field("duration", _text, "ISO-8601 duration"),
        _field("definition", _text),
        _field("caption", _flag),
        _field("licensedContent", _flag),
        _field("regionRestriction", _text),
        _field("viewCount", _count),
        _field("likeCount", _count),
        _field("commentCount", _count),
        _field("privacyStatus", _text),
        _field("license", _text),
        _field("topicCategories", _text, "Comma-separated list"),
        _field("loaded_at", _day, "Load day"),
    ]
)

CATEGORIES = T.StructType([_field("category_id", _count), _field("category_name", _text)])


def _all_text(*names: str) -> T.StructType:
    return T.StructType([_field(n, _text) for n in names])


# Landed CSV files hold text only; coercion happens in the columns, not in the reader.
CHANNELS_CSV = _all_text(
    "channelId", "title", "description", "customUrl", "subscribers", "views", "videos",
    "hiddenSubscribers", "publishedAt", "country", "defaultLanguage", "keywords",
    "uploadsPlaylistId", "topics", "query",
)

VIDEOS_CSV = _all_text(
    "videoId", "title", "publishedAt", "tags", "categoryId", "channelId", "duration",
    "definition", "caption", "licensedContent", "regionRestriction", "viewCount",
    "likeCount", "commentCount", "privacyStatus", "license", "topicCategories",
)

# Columns of the collector's full video file that are dropped when its batches are combined.
UNUSED_VIDEO_COLUMNS = (
    "description", "dimension", "embeddable", "publicStatsViewable", "recordingDate",
    "recordingLocation",
)

VIDEO_BATCH_CSV = _all_text(
    "videoId", "title", "description", "publishedAt", "tags", "categoryId", "channelId", "duration",
    "dimension", "definition", "caption", "licensedContent", "regionRestriction", "viewCount",
    "likeCount", "commentCount", "privacyStatus", "license", "embeddable", "publicStatsViewable",
    "topicCategories", "recordingDate", "recordingLocation",
)

CHANNEL_PAYLOAD = T.StructType(
    [
        _field(
            "items",
            T.ArrayType(
                T.StructType(
                    [
                        _field("id", _text),
                        _field(
                            "snippet",
                            _all_text(
                                "title", "description", "customUrl", "publishedAt", "country",
                                "defaultLanguage",
                            ),
                        ),
                        _field(
                            "statistics",
                            T.StructType(
                                [
                                    _field("subscriberCount", _text),
                                    _field("viewCount", _text),
                                    _field("videoCount", _text),
                                    _field("hiddenSubscriberCount", _flag),
                                ]
                            ),
                        ),
                        _field(
                            "brandingSettings",
                            T.StructType([_field("channel", _all_text("keywords"))]),
                        ),
                        _field(
                            "contentDetails",
                            T.StructType([_field("relatedPlaylists", _all_text("uploads"))]),
                        ),
                        _field(
                            "topicDetails",
                            T.StructType([_field("topicCategories", T.ArrayType(_text))]),
                        ),
                    ]
                )
            ),
        )
    ]
)

VIDEO_PAYLOAD = T.StructType(
    [
        _field(
            "items",
            T.ArrayType(
                T.StructType(
                    [
                        _field("id", _text),
                        _field(
                            "snippet",
                            T.StructType(
                                [
                                    _field("title", _text),
                                    _field("description", _text),
                                    _field("publishedAt", _text),
                                    _field("tags", T.ArrayType(_text)),
                                    _field("categoryId", _text),
                                    _field("channelId", _text),
                                ]
                            ),
                        ),
                        _field(
                            "contentDetails",
                            T.StructType(
                                [
                                    _field("duration", _text),
                                    _field("dimension", _text),
                                    _field("definition", _text),
                                    _field("caption", _text),
                                    _field("licensedContent", _flag),
                                    # Kept as the JSON text of the nested object.
                                    _field("regionRestriction", _text),
                                ]
                            ),
                        ),
                        _field("statistics", _all_text("viewCount", "likeCount", "commentCount")),
                        _field(
                            "status",
                            T.StructType(
                                [
                                    _field("privacyStatus", _text),
                                    _field("license", _text),
                                    _field("embeddable", _flag),
                                    _field("publicStatsViewable", _flag),
                                ]
                            ),
                        ),
                        _field(
                            "topicDetails",
                            T.StructType([_field("topicCategories", T.ArrayType(_text))]),
                        ),
                        # The place stays the JSON text of the nested object.
                        _field("recordingDetails", _all_text("recordingDate", "location")),
                    ]
                )
            ),
        )
    ]
)
