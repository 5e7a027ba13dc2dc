"""Nested API payloads to flat raw rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratavid.functions import join_list, lenient_long, parse_timestamp, truncate
from stratavid.schemas import CHANNEL_PAYLOAD, VIDEO_PAYLOAD

# Descriptions are stored up to this length unless the caller says otherwise.
DESCRIPTION_LENGTH = 500


def rejected_payloads(payloads: DataFrame, column: str, kind: str) -> DataFrame:
    """The payloads that flattening leaves out, as they were landed, each with a ``reason``.

    ``kind`` is ``channel`` or ``video``. A payload is left out if it is no JSON of that kind
    (``malformed``) or holds no items (``no items``); the batch goes on without it.
    """
    reason = _reason(F.from_json(column, _ITEM_TEXTS), F.col(column))
    _item_schema(kind)
    return payloads.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def payload_items(payloads: DataFrame, column: str, kind: str) -> DataFrame:
    """One row per item of the payloads that have items, good or bad.

    Next to the columns of ``payloads`` (less the payload) it has ``position`` (from 0), ``item_text``
    (the item as landed), ``item`` (the item read, null where it is bad) and ``item_reason``: why
    it is bad, or null. Every item is read on its own, so a bad one costs none of its neighbours:

    * ``null item`` and ``not an object``: nothing to read;
    * ``no id``: without it a row has no key;
    * ``unreadable <part>``: a part that should be an object is something else.
    """
    schema = _item_schema(kind)
    others = [F.col(c) for c in payloads.columns if c != column]
    whole = _computed_once(payloads, "__parsed", F.from_json(column, _ITEM_TEXTS))
    # The list of a payload that is left out is null, which gives no rows.
    listed = F.when(_reason(F.col("__parsed"), F.col(column)).isNull(), F.col("__parsed.items"))
    texts = whole.select(*others, F.posexplode(listed).alias("position", "item_text"))
    parts = [f.name for f in schema.fields if isinstance(f.dataType, T.StructType)]
    part_texts = F.from_json("item_text", ", ".join(f"{p} string" for p in parts))
    read = _computed_once(texts, "__item", F.from_json("item_text", schema))
    # Texts are read only where the name of a missing part occurs, or an escape that may hide it.
    hides = F.contains("item_text", F.lit("\\"))
    in_doubt = [F.col(f"__item.{p}").isNull() & (hides | F.contains("item_text", F.lit(p))) for p in parts]
    read = _computed_once(read, "__texts", F.when(reduce(Column.__or__, in_doubt), part_texts))
    # A part that is there, but of which the reader made nothing.
    lost = [
        F.when(F.col(f"__item.{p}").isNull() & F.col(f"__texts.{p}").isNotNull(), f"unreadable {p}") for p in parts
    ]
    text = F.col("item_text")
    reason = (
        F.when(text.isNull(), "null item")
        .when(~F.ltrim(text).startswith("{") | F.col("__item").isNull(), "not an object")
        .when(F.coalesce(F.trim(F.col("__item.id")), F.lit("")) == "", "no id")
        .otherwise(F.coalesce(*lost))
    )
    judged = read.withColumn("item_reason", reason)
    return judged.select(
        *others,
        "position",
        "item_text",
        F.when(F.col("item_reason").isNull(), F.col("__item")).alias("item"),
        "item_reason",
    )


def _computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with one column more, computed once a row however many columns and filters read it.

    Spark moves filters below plain columns and repeats the column for each mention, which parsed an
    item some fifteen times. It does not move them below a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def rejected_items(payloads: DataFrame, column: str, kind: str) -> DataFrame:
    """The items that flattening leaves out of otherwise good payloads: their position, text and ``item_reason``."""
    return payload_items(payloads, column, kind).filter(F.col("item_reason").isNotNull()).drop("item")


# Items stay texts at first: one that is no object must not spoil the reading of the others.
_ITEM_TEXTS = "struct<items: array<string>>"


def _item_schema(kind: str) -> T.StructType:
    return {"channel": CHANNEL_PAYLOAD, "video": VIDEO_PAYLOAD}[kind]["items"].dataType.elementType


def _reason(parsed: Column, text: Column) -> Column:
    """Why a payload has no rows, or null. Text that is no JSON parses to no value at all."""
    well_formed = F.get_json_object(text, "$").isNotNull()
    items = F.size(parsed["items"])
    return F.when(~well_formed | text.isNull(), "malformed").when(F.coalesce(items, F.lit(-1)) < 1, "no items")


def _items(payloads: DataFrame, column: str, kind: str) -> DataFrame:
    found = payload_items(payloads.select(column), column, kind)
    return found.filter(F.col("item_reason").isNull()).select(F.col("item").alias("i"))


def _text(path: str) -> Column:
    """Nested text, empty where any level of the path is absent."""
    return F.coalesce(F.col(path), F.lit(""))


def _flag(path: str) -> Column:
    return F.coalesce(F.col(path), F.lit(False))


def flatten_channel_payload(
    payloads: DataFrame, column: str, as_of: Column, description_length: int | None = DESCRIPTION_LENGTH
) -> DataFrame:
    """One raw channel row per good item of each JSON payload.

    ``rejected_payloads`` has the payloads without items, ``rejected_items`` the bad items of the others.

    Descriptions longer than ``description_length`` are cut; ``None`` keeps them whole.
    """
    description = _text("i.snippet.description")
    if description_length is not None:
        description = truncate(description, description_length)
    return _items(payloads, column, "channel").select(
        as_of.alias("ts"),
        F.col("i.id").alias("channelId"),
        _text("i.snippet.title").alias("title"),
        description.alias("description"),
        _text("i.snippet.customUrl").alias("customUrl"),
        lenient_long("i.statistics.subscriberCount").alias("subscribers"),
        lenient_long("i.statistics.viewCount").alias("views"),
        lenient_long("i.statistics.videoCount").alias("videos"),
        _flag("i.statistics.hiddenSubscriberCount").alias("hiddenSubscribers"),
        F.coalesce(parse_timestamp("i.snippet.publishedAt"), as_of).alias("publishedAt"),
        _text("i.snippet.country").alias("country"),
        _text("i.snippet.defaultLanguage").alias("defaultLanguage"),
        _text("i.brandingSettings.channel.keywords").alias("keywords"),
        _text("i.contentDetails.relatedPlaylists.uploads").alias("uploadsPlaylistId"),
        join_list("i.topicDetails.topicCategories").alias("topics"),
        F.to_date(as_of).alias("loaded_at"),
    )


def flatten_video_payload(
    payloads: DataFrame, column: str, as_of: Column, full: bool = False
) -> DataFrame:
    """One raw video row per good item of each JSON payload; ``full`` adds the columns of a full file.

    ``rejected_payloads`` has the payloads without items, ``rejected_items`` the bad items of the others.
    """
    return _items(payloads, column, "video").select(
        as_of.alias("ts"),
        F.col("i.id").alias("videoId"),
        _text("i.snippet.title").alias("title"),
        F.coalesce(parse_timestamp("i.snippet.publishedAt"), as_of).alias("publishedAt"),
        join_list("i.snippet.tags").alias("tags"),
        lenient_long("i.snippet.categoryId").alias("categoryId"),
        _text("i.snippet.channelId").alias("channelId"),
        _text("i.contentDetails.duration").alias("duration"),
        _text("i.contentDetails.definition").alias("definition"),
        F.coalesce(F.col("i.contentDetails.caption") == "true", F.lit(False)).alias("caption"),
        _flag("i.contentDetails.licensedContent").alias("licensedContent"),
        _text("i.contentDetails.regionRestriction").alias("regionRestriction"),
        lenient_long("i.statistics.viewCount").alias("viewCount"),
        lenient_long("i.statistics.likeCount").alias("likeCount"),
        lenient_long("i.statistics.commentCount").alias("commentCount"),
        _text("i.status.privacyStatus").alias("privacyStatus"),
        _text("i.status.license").alias("license"),
        join_list("i.topicDetails.topicCategories").alias("topicCategories"),
        F.to_date(as_of).alias("loaded_at"),
        *(_full_columns() if full else []),
    )


def _full_columns() -> list[Column]:
    """Columns that are collected but not loaded; absent ones stay null."""
    return [
        F.col("i.snippet.description").alias("description"),
        F.col("i.contentDetails.dimension").alias("dimension"),
        F.col("i.status.embeddable").alias("embeddable"),
        F.col("i.status.publicStatsViewable").alias("publicStatsViewable"),
        F.col("i.recordingDetails.recordingDate").alias("recordingDate"),
        F.col("i.recordingDetails.location").alias("recordingLocation"),
    ]
