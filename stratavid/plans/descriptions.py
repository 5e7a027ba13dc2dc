"""What the stored tables' columns mean; readers find it in the column metadata."""

from __future__ import annotations

_VALIDITY = {
    "valid_from": "Observation that opened this version",
    "valid_to": "Observation or load that closed it; null while it is open",
    "is_current": "Whether the version is open",
}
_LOADED = {
    "loaded_at": "Time of the newest observation of the day",
    "date_key": "Day of the observation",
}

DESCRIPTIONS = {
    "stg_channels": {"channel_id": "Channel", **_LOADED},
    "stg_videos": {"video_id": "Video", "channel_id": "Channel that published the video", **_LOADED},
    "dim_channel": {
        "channel_sk": "Key of the channel, shared by its versions",
        "natural_channel_id": "Channel as the platform names it",
        "version_sk": "Key of this version",
        **_VALIDITY,
    },
    "dim_video": {
        "video_sk": "Key of the video, shared by its versions",
        "video_id": "Video as the platform names it",
        "category_name": "Category by the seed; null outside of it",
        "version_sk": "Key of this version",
        **_VALIDITY,
    },
    "dim_date": {"date_key": "Day", "week_day": "1 for Monday to 7 for Sunday"},
    "dim_keyword": {"keyword_id": "Key of the keyword", "keyword": "Keyword of a channel"},
    "dim_tag": {"tag_id": "Key of the tag", "tag_name": "Tag of a video"},
    "bridge_channel_keyword": {"channel_sk": "Channel", "keyword_id": "Its keyword", **_VALIDITY},
    "bridge_video_tag": {"video_sk": "Video", "tag_id": "Its tag", **_VALIDITY},
    "fact_channel_metrics": {
        "id": "Key of channel and day",
        "channel_sk": "Channel",
        "date_key": "Day of the counters",
    },
    "fact_video_performance": {
        "id": "Key of video and day",
        "video_sk": "Video",
        "channel_sk": "Channel that published the video",
        "date_key": "Day of the counters",
    },
}
