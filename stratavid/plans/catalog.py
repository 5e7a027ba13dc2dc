"""Registered queries: name to ``(spark, sf_dir) -> DataFrame``.

Results hold dates and times as text and doubles rounded to 4 places, so they
compare exactly with another engine.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratavid.functions import (
    contains_any_case,
    interval_seconds,
    iso_duration_seconds,
    join_list,
    lenient_bool,
    lenient_long,
    normalise_list_text,
    parse_timestamp,
    surrogate_key,
    truncate,
    year_month,
)
from stratavid.operators import quality
from stratavid.operators.history import (
    asof_join,
    extend_open,
    merge_late,
    merge_open,
    scd2_history,
    scd2_merge,
    scd2_merge_timestamp,
    split_versions,
    versioned_view,
)
from stratavid.operators.incremental import (
    append_new_dates,
    evolve_schema,
    union_promoted,
    incremental_load,
    unexpired,
)
from stratavid.operators.latest import daily_latest, dealt_anew, first_by_key, latest_by_key, top_per_key
from stratavid.operators.masking import FULL, LIMITED
from stratavid.operators.snapshot import SnapshotRules, clean_channels, silver_snapshot
from stratavid.operators.star import calendar, date_dim, date_spine
from stratavid.operators.tokens import token_rows
from stratavid.plans import adhoc, analytics, checks, gold, secure, silver
from stratavid.plans.layers import Layers, StoredLayers, scratch_folder
from stratavid.plans.raw import CHANNEL_TIEBREAK, part_duration
from stratavid.plans.silver import CHANNEL_RULES
from stratavid.sources.files import (
    read_many_csv,
    read_parquet,
    rejected_rows,
    tolerant_parse,
    union_batches,
)
from stratavid.sources.payloads import (
    flatten_channel_payload,
    flatten_video_payload,
    rejected_items,
    rejected_payloads,
)
from stratavid.sources.sinks import write_csv

Query = Callable[[SparkSession, str], DataFrame]
_BUILDERS: dict[str, Callable[[Layers], DataFrame]] = {}

PLACES = 4
# Salt of the registered masked lists, which are compared with SQL; a deployment keeps its own secret.
SALT = "registered"


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as text, doubles rounded."""

    def shown(field: T.StructField) -> Column:
        c = F.col(field.name)
        if isinstance(field.dataType, (T.DateType, T.TimestampNTZType, T.TimestampType)):
            return c.cast("string").alias(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return F.round(c, PLACES).alias(field.name)
        return c

    return df.select(*[shown(f) for f in df.schema.fields])


def query(build: Callable[[Layers], DataFrame]) -> Callable[[Layers], DataFrame]:
    """Register ``build`` under its own name, less a trailing underscore."""
    _BUILDERS[build.__name__.rstrip("_")] = build
    return build


def queries() -> dict[str, Query]:
    """Every query over a folder of source tables."""

    def over_sources(build: Callable[[Layers], DataFrame]) -> Query:
        return lambda spark, sf_dir: plain(build(Layers(spark, sf_dir)))

    return {name: over_sources(build) for name, build in _BUILDERS.items()}


def ask(name: str, tables) -> DataFrame:
    """One query over any object with the warehouse tables, such as a stored ``Warehouse``."""
    return plain(_BUILDERS[name](tables))


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


# Sources and bronze


@query
def scan_parquet_count(w: Layers) -> DataFrame:
    return read_parquet(w.spark, f"{w.sf_dir}/lineite*.parquet").agg(F.count("*").alias("row_count"))


@query
def json_flatten(w: Layers) -> DataFrame:
    props = F.from_json("props", "struct<k: bigint, source: string>")
    return w.source("events").select(
        "event_id",
        F.coalesce(props["k"], F.lit(0)).alias("k"),
        F.coalesce(props["source"], F.lit("")).alias("source"),
    )


def _channel_items(w: Layers, *more: str) -> DataFrame:
    """Channel observations as items of API payloads, with ``more`` columns of theirs."""
    r = w.raw_channels
    item = F.struct(
        F.col("channelId").alias("id"),
        F.struct(
            "title",
            F.repeat("description", 40).alias("description"),
            F.when(F.col("videos") > 100, F.col("customUrl")).alias("customUrl"),
            F.concat(F.col("publishedAt").cast("string"), F.lit("Z")).alias("publishedAt"),
            F.when(F.col("country") != "", F.col("country")).alias("country"),
            "defaultLanguage",
        ).alias("snippet"),
        F.struct(
            F.when(F.col("videos") > 100, F.col("subscribers")).cast("string").alias("subscriberCount"),
            F.col("views").cast("string").alias("viewCount"),
            F.col("videos").cast("string").alias("videoCount"),
            F.when(F.col("hiddenSubscribers"), True).alias("hiddenSubscriberCount"),
        ).alias("statistics"),
        F.struct(F.struct("keywords").alias("channel")).alias("brandingSettings"),
        F.struct(F.struct(F.col("uploadsPlaylistId").alias("uploads")).alias("relatedPlaylists")).alias(
            "contentDetails"
        ),
        F.when(
            F.col("defaultLanguage") != "F",
            F.struct(F.array("country", "defaultLanguage").alias("topicCategories")),
        ).alias("topicDetails"),
    )
    return r.select(F.floor(F.col("o_orderkey") / 8).alias("payload_id"), item.alias("item"), *more)


def _landed(items: DataFrame) -> DataFrame:
    """Payloads of several items each; some are cut off, some hold no item, some nothing at all."""
    body = F.to_json(F.struct(F.collect_list("item").alias("items")))
    kind = F.col("payload_id") % 30
    return items.groupBy("payload_id").agg(body.alias("whole")).select(
        "payload_id",
        F.when(kind == 0, F.expr("left(whole, length(whole) - 9)"))
        .when(kind == 1, '{"items": []}')
        .when(kind == 2, F.lit(None).cast("string"))
        .when(kind == 3, "not json")
        .when(kind == 4, '{"error": {"code": 403}}')
        .otherwise(F.col("whole"))
        .alias("payload"),
    )


@query
def channel_payload_flatten(w: Layers) -> DataFrame:
    """Channel observations written as API payloads, then flattened again."""
    return flatten_channel_payload(_landed(_channel_items(w)), "payload", w.as_of)


@query
def payload_rejects(w: Layers) -> DataFrame:
    """The payloads that flattening leaves out, and why."""
    return rejected_payloads(_landed(_channel_items(w)), "payload", "channel").select("payload_id", "reason")


def _spoilt_payloads(w: Layers) -> DataFrame:
    """Payloads whose items are channels by order key, every 17th of four kinds spoilt."""
    items = _channel_items(w, "o_orderkey")
    kind = F.col("o_orderkey") % 17
    text = (
        F.when(kind == 0, "5")
        .when(kind == 1, "null")
        .when(kind == 2, F.to_json(F.struct("item.snippet", "item.statistics")))
        .when(kind == 3, F.to_json(F.struct("item.id", F.col("item.snippet.title").alias("snippet"))))
        .otherwise(F.to_json("item"))
    )
    ordered = F.array_sort(F.collect_list(F.struct("o_orderkey", text.alias("text"))))
    body = F.concat(F.lit('{"items": ['), F.array_join(ordered["text"], ", "), F.lit("]}"))
    return items.groupBy("payload_id").agg(body.alias("payload"))


@query
def payload_item_rejects(w: Layers) -> DataFrame:
    """The bad items of payloads that have good ones too: where they stand, and why they are bad."""
    return rejected_items(_spoilt_payloads(w), "payload", "channel").select("payload_id", "position", "item_reason")


@query
def payload_items_kept(w: Layers) -> DataFrame:
    """The good items of payloads that have bad ones too."""
    rows = flatten_channel_payload(_spoilt_payloads(w), "payload", w.as_of)
    return rows.select("channelId", "title", "views", "videos", "publishedAt", "topics")


@query
def csv_files_drift(w: Layers) -> DataFrame:
    """Orders landed as CSV files of three layouts: as agreed, reordered with a column more, and with one fewer."""
    columns = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    orders = w.source("orders").select(*columns)
    folder = scratch_folder(w.spark, "landed")
    third = F.pmod("o_orderkey", F.lit(3))
    layouts = {
        "base": orders.filter(third == 0),
        "batch0": orders.filter(third == 1).select(
            "o_orderpriority", F.concat(F.lit("a \"note\",\n"), "o_custkey").alias("note"), "o_custkey", "o_orderkey", "o_orderstatus"
        ),
        "batch1": orders.filter(third == 2).drop("o_orderpriority"),
    }
    for name, rows in layouts.items():
        write_csv(rows, f"{folder}/{name}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    read = read_many_csv(w.spark, f"{folder}/base", [f"{folder}/batch0", f"{folder}/batch1"], schema, rescued="others")
    return read.select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        F.col("o_custkey").cast("bigint").alias("o_custkey"),
        "o_orderstatus", "o_orderpriority", F.col("others")["note"].alias("note"),
    )


@query
def video_payload_flatten(w: Layers) -> DataFrame:
    """Video observations written as API payloads, then flattened again."""
    r = w.raw_videos
    item = F.struct(
        F.col("videoId").alias("id"),
        F.struct(
            "title",
            F.col("publishedAt").cast("string").alias("publishedAt"),
            F.split("tags", ", ").alias("tags"),
            F.col("categoryId").cast("string").alias("categoryId"),
            "channelId",
        ).alias("snippet"),
        F.struct(
            "duration",
            "definition",
            F.col("caption").cast("string").alias("caption"),
            F.when(F.col("licensedContent"), True).alias("licensedContent"),
            F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit("blocked "), "definition")).alias("regionRestriction"),
        ).alias("contentDetails"),
        F.struct(
            F.col("viewCount").cast("string").alias("viewCount"),
            F.col("likeCount").cast("string").alias("likeCount"),
            F.col("commentCount").cast("string").alias("commentCount"),
        ).alias("statistics"),
        F.struct("privacyStatus", "license").alias("status"),
        F.struct(F.split("topicCategories", ", ").alias("topicCategories")).alias("topicDetails"),
    )
    items = r.select(F.floor(F.col("l_orderkey") / 4).alias("payload_id"), item.alias("item"))
    return flatten_video_payload(_landed(items), "payload", w.as_of)


@query
def bronze_latest(w: Layers) -> DataFrame:
    newest = latest_by_key(w.raw_channels, ["channelId", "loaded_at"], "ts", CHANNEL_TIEBREAK)
    return newest.select("channelId", "loaded_at", "ts", "subscribers", "views", "videos")


@query
def monthly_partition_counts(w: Layers) -> DataFrame:
    months = w.source("lineitem").select(year_month("l_shipdate").alias("yyyymm"))
    return months.groupBy("yyyymm").agg(F.count("*").alias("row_count"))


@query
def retention_90d(w: Layers) -> DataFrame:
    orders = w.source("orders").select("o_orderkey", F.to_date("o_orderdate").alias("loaded_at"))
    today = orders.select(F.max("loaded_at")).scalar()
    return unexpired(orders, "loaded_at", today, 90)


@query
def csv_coercion(w: Layers) -> DataFrame:
    """Order columns as untidy text, coerced."""
    kind = F.col("o_orderkey") % 5
    text = w.source("orders").select(
        "o_orderkey",
        F.when(kind == 0, "n/a")
        .when(kind == 1, "")
        .when(kind == 2, F.concat(F.col("o_custkey").cast("string"), F.lit(".75")))
        .when(kind == 3, F.lit(None).cast("string"))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("subscribers"),
        F.when(F.col("o_orderstatus") == "F", "True")
        .when(F.col("o_orderstatus") == "O", "yes")
        .otherwise("no")
        .alias("hidden"),
        F.when(kind == 0, "not a date")
        .when(kind == 1, F.concat(F.col("o_orderdate").cast("string"), F.lit("Z")))
        .otherwise(F.col("o_orderdate").cast("string"))
        .alias("published"),
        F.when(kind == 3, F.col("o_orderpriority")).alias("country"),
    )
    return text.select(
        "o_orderkey",
        lenient_long("subscribers").alias("subscribers"),
        lenient_bool("hidden").alias("hidden"),
        F.coalesce(parse_timestamp("published"), w.as_of).alias("published"),
        F.coalesce("country", F.lit("")).alias("country"),
    )


def _untidy_prices(w: Layers) -> tuple[DataFrame, dict[str, Column]]:
    """Order rows as text, some of which do not convert."""
    text = w.source("orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "unknown")
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("custkey"),
        F.when(F.col("o_orderpriority") == "5-LOW", "soon")
        .otherwise(F.col("o_orderdate").cast("string"))
        .alias("ordered"),
    )
    return text, {
        "custkey": F.col("custkey").try_cast("bigint"),
        "ordered": parse_timestamp("ordered"),
    }


@query
def tolerant_rows(w: Layers) -> DataFrame:
    return tolerant_parse(*_untidy_prices(w))


@query
def rejected_text_rows(w: Layers) -> DataFrame:
    return rejected_rows(*_untidy_prices(w))


@query
def union_drop(w: Layers) -> DataFrame:
    """Events landed as three batches, one without ``props``, put together by column name."""
    events = w.source("events")
    base = events.filter(F.col("ts") < moment("2024-01-11"))
    second = events.filter((F.col("ts") >= moment("2024-01-11")) & (F.col("ts") < moment("2024-01-21")))
    third = events.filter(F.col("ts") >= moment("2024-01-21"))
    reordered = second.select("value", "event_type", "user_id", "ts", "event_id", "props")
    return union_batches([base, reordered, third.drop("props")]).drop("ts", "event_type")


@query
def schema_evolution(w: Layers) -> DataFrame:
    """Stored events lose ``value`` and gain ``event_type`` when the model changes."""
    events = w.source("events")
    stored = events.filter(F.col("ts") < moment("2024-01-16")).select("event_id", "user_id", "value")
    batch = events.filter(F.col("ts") >= moment("2024-01-16")).select(
        "event_id", "user_id", "event_type"
    )
    return evolve_schema(stored, batch)


@query
def schema_changed_types(w: Layers) -> DataFrame:
    """Stored events whose columns become wider when the model changes: more bits, and text."""
    events = w.source("events").withColumn("hour", F.hour("ts"))
    stored = events.filter(F.col("ts") < moment("2024-01-16")).select(
        "event_id", F.floor("value").cast("int").alias("value"), "hour"
    )
    batch = events.filter(F.col("ts") >= moment("2024-01-16")).select(
        F.col("event_id").cast("string").alias("event_id"), "value", F.col("hour").cast("long").alias("hour")
    )
    return evolve_schema(stored, batch)


@query
def loads_of_changed_types(w: Layers) -> DataFrame:
    """Events landed as three loads whose types differ, put together in types that hold all of them."""
    events = w.source("events")
    first = events.filter(F.col("ts") < moment("2024-01-11")).select(
        "event_id", F.hour("ts").cast("short").alias("hour"), F.to_date("ts").alias("seen")
    )
    second = events.filter((F.col("ts") >= moment("2024-01-11")) & (F.col("ts") < moment("2024-01-21"))).select(
        F.col("ts").cast("timestamp_ntz").alias("seen"), F.hour("ts").cast("decimal(4,1)").alias("hour"), "event_id"
    )
    third = events.filter(F.col("ts") >= moment("2024-01-21")).select(F.col("event_id").cast("string").alias("event_id"), F.hour("ts").alias("hour"))
    return union_promoted([first, second, third]).select(
        "event_id", F.col("hour").cast("double").alias("hour"), F.date_format("seen", "yyyy-MM-dd HH:mm:ss").alias("seen")
    )


@query
def first_hit_left_join(w: Layers) -> DataFrame:
    """Each source with the first search that found it, searches taken in order."""
    documents = w.source("documents")
    searches = ("fr", "de", "es")
    hits = reduce(
        DataFrame.unionByName,
        [
            documents.filter(F.col("lang") == word).select(
                "source", F.lit(word).alias("query"), F.lit(i).alias("rank"), "doc_id"
            )
            for i, word in enumerate(searches)
        ],
    )
    first = first_by_key(hits, ["source"], ["rank", "doc_id"]).select("source", "query", "doc_id")
    stats = documents.groupBy("source").agg(
        F.count("*").alias("videos"), F.sum("n_chars").alias("views")
    )
    return stats.join(first, "source", "left")


@query
def array_join_text(w: Layers) -> DataFrame:
    words = F.split("text", " ")
    return w.source("conversations").select(
        "conv_id", "turn", F.size(words).alias("words"), join_list(words).alias("joined")
    )


@query
def truncate_text(w: Layers) -> DataFrame:
    return w.source("documents").select(
        "doc_id", F.length("text").alias("full_length"), truncate("text", 500).alias("description")
    )


@query
def tag_normalise(w: Layers) -> DataFrame:
    """Part words as Python list text, normalised and counted as tags."""
    quoted = F.concat(F.lit("['"), F.array_join(F.split("p_name", " "), "', '"), F.lit("']"))
    tags = w.source("part").select(normalise_list_text(quoted).alias("tags"))
    return token_rows(tags, "tags", "tag").groupBy("tag").agg(F.count("*").alias("part_count"))


@query
def duration_seconds(w: Layers) -> DataFrame:
    parts = w.source("part").select("p_partkey", part_duration().alias("duration"))
    return parts.withColumn("seconds", iso_duration_seconds("duration"))


@query
def duration_seconds_with_days(w: Layers) -> DataFrame:
    day_part = F.concat(F.lit("P"), (F.col("p_size") % 4).cast("string"), F.lit("DT2H"))
    parts = w.source("part").select("p_partkey", day_part.alias("duration"))
    return parts.select(
        "p_partkey",
        iso_duration_seconds("duration").alias("seconds"),
        iso_duration_seconds("duration", days=True).alias("seconds_with_days"),
    )


@query
def surrogate_key_(w: Layers) -> DataFrame:
    maybe = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    empty = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderpriority"))
    return w.source("orders").select(
        "o_orderkey",
        surrogate_key("o_custkey", F.to_date("o_orderdate")).alias("day_key"),
        surrogate_key("o_custkey", maybe).alias("null_key"),
        surrogate_key("o_custkey", empty).alias("empty_key"),
    )



# Silver


@query
def silver_clean(w: Layers) -> DataFrame:
    return w.stg_channels


@query
def silver_videos(w: Layers) -> DataFrame:
    return w.stg_videos


@query
def silver_uncleaned(w: Layers) -> DataFrame:
    """Daily snapshot as landed: renamed and deduplicated, nothing cleaned or dropped."""
    rules = replace(
        CHANNEL_RULES, texts=(), counters=(), times=(), evidence=(), tiebreak=CHANNEL_TIEBREAK
    )
    return silver_snapshot(w.raw_channels, rules, w.as_of)


@query
def channel_cleaning(w: Layers) -> DataFrame:
    """Channels with a 7 in their title go, and with them those of other or busy channels."""
    kept = clean_channels(w.raw_channels, country="building", unwanted="7", min_views=500)
    return kept.select("o_orderkey", "channelId", "title", "country", "views", "videos")


def cleaned_head(w: Layers, rows: int) -> DataFrame:
    """The first cleaned rows in a stated order."""
    cleaned = clean_channels(w.raw_channels, country="BUILDING")
    return cleaned.select("o_orderkey", "channelId", "videos").orderBy("o_orderkey").limit(rows)


@query
def cleaned_channel_head(w: Layers) -> DataFrame:
    """The collector's run size, 100 rows."""
    return cleaned_head(w, 100)


def untidy_channels(w: Layers) -> DataFrame:
    """Channel observations with cells missing, negative or in the future, some with no evidence at all."""
    raw = w.raw_channels
    key = F.col("o_orderkey")
    void = key % 13 == 0
    blank = lambda c, when: F.when(~when, F.col(c))
    return raw.withColumns(
        {
            "title": blank("title", void),
            "description": blank("description", key % 3 == 0),
            "subscribers": F.when(~void, F.when(key % 11 == 0, -F.col("subscribers")).otherwise(F.col("subscribers"))),
            "views": F.when(~void, F.when(key % 7 == 0, F.lit(-1)).otherwise(F.col("views"))),
            "videos": blank("videos", void),
            "hiddenSubscribers": blank("hiddenSubscribers", void),
            "publishedAt": F.when(key % 5 == 0, w.as_of + F.expr("interval 1 day")).otherwise(F.col("publishedAt")),
            "country": blank("country", key % 2 == 0),
        }
    )


@query
def silver_untidy(w: Layers) -> DataFrame:
    """Untidy observations cleaned: bad cells become null, and days without evidence go."""
    rows = silver.stg_channels(untidy_channels(w), w.as_of, CHANNEL_TIEBREAK)
    return rows.select(
        "channel_id", "date_key", "title", "subscribers", "total_views", "total_videos", "published_at", "country"
    )


@query
def history_untidy(w: Layers) -> DataFrame:
    """Versions whose checked columns change from and to null."""
    rows = silver.stg_channels(untidy_channels(w), w.as_of, CHANNEL_TIEBREAK)
    versions = scd2_history(
        rows.select("channel_id", "description", "country", "loaded_at"), ["channel_id"], "loaded_at",
        ["description", "country"], daily=True,
    )
    return versioned_view(versions)


EVENT_RULES = SnapshotRules(
    key="user_id",
    version="ts",
    columns={"user_id": "user_id", "event_type": "event_type", "value": "value"},
    texts=("event_type",),
    counters=("value",),
    evidence=("event_type", "value"),
)


@query
def incremental_upsert(w: Layers) -> DataFrame:
    """A target loaded up to noon of one day takes the rest, replacing that day's rows."""
    events = w.source("events")
    clock = moment("2024-12-31")
    early = events.filter(F.col("ts") <= moment("2024-01-15 12:00:00"))
    target = silver_snapshot(early, EVENT_RULES, clock)
    return incremental_load(target, events, EVENT_RULES, clock)


@query
def daily_latest_(w: Layers) -> DataFrame:
    newest = daily_latest(w.source("events"), ["user_id"], "ts", ["event_id"])
    return newest.select("user_id", F.to_date("ts").alias("date_key"), "ts", "event_type", "value")



@query
def daily_event_metrics(w: Layers) -> DataFrame:
    days = w.source("events").withColumn("date_key", F.to_date("ts"))
    return days.groupBy("user_id", "date_key").agg(
        F.count("*").alias("event_count"), F.sum("value").alias("total_value")
    )


# History


def _order_history(w: Layers) -> DataFrame:
    return w.source("orders").select("o_custkey", "o_orderstatus", "o_orderdate", "o_orderkey")


def _order_versions(w: Layers, orders: DataFrame) -> DataFrame:
    return scd2_history(orders, ["o_custkey"], "o_orderdate", ["o_orderstatus"], ["o_orderkey"])


SPLIT = "2000-01-01"


def _before_and_after(w: Layers) -> tuple[DataFrame, DataFrame]:
    """Versions from the orders before the split, and each customer's newest order after it."""
    orders = _order_history(w)
    current = _order_versions(w, orders.filter(F.col("o_orderdate") < moment(SPLIT)))
    later = orders.filter(F.col("o_orderdate") >= moment(SPLIT))
    return current, latest_by_key(later, ["o_custkey"], "o_orderdate", ["o_orderkey"])


@query
def scd2_history_(w: Layers) -> DataFrame:
    return versioned_view(_order_versions(w, _order_history(w)))



@query
def scd2_merge_(w: Layers) -> DataFrame:
    current, batch = _before_and_after(w)
    return scd2_merge(current, batch, ["o_custkey"], ["o_orderstatus"], "o_orderdate", w.as_of)



@query
def scd2_hard_delete(w: Layers) -> DataFrame:
    """The batch is a full snapshot: customers without a later order are closed."""
    current, batch = _before_and_after(w)
    return scd2_merge(
        current, batch, ["o_custkey"], ["o_orderstatus"], "o_orderdate", w.as_of, full_snapshot=True
    )


@query
def scd2_timestamp(w: Layers) -> DataFrame:
    """Customer-priority pairs versioned by their newest order."""
    orders = w.source("orders").select("o_custkey", "o_orderpriority", "o_orderdate")
    keys = ["o_custkey", "o_orderpriority"]

    def newest(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(F.max("o_orderdate").alias("loaded_at"))

    early = newest(orders.filter(F.col("o_orderdate") < moment(SPLIT)))
    current = early.withColumnRenamed("loaded_at", "valid_from").withColumn(
        "valid_to", F.lit(None).cast("timestamp_ntz")
    )
    return scd2_merge_timestamp(current, newest(orders), keys, "loaded_at", w.as_of)


@query
def scd2_asof_join(w: Layers) -> DataFrame:
    """Every order with its customer's status version on that day."""
    orders = _order_history(w).select("o_orderkey", "o_custkey", "o_orderdate")
    versions = _order_versions(w, _order_history(w)).select(
        F.col("o_custkey").alias("v_custkey"), "o_orderstatus", "valid_from", "valid_to"
    )
    return asof_join(orders, versions, "o_custkey", "v_custkey", "o_orderdate", w.as_of).drop("v_custkey")


@query
def scd2_late_rows(w: Layers) -> DataFrame:
    """Customers' status versions where a third of the orders arrive after the others, in two late loads."""
    orders = _order_history(w)
    third = F.col("o_orderkey") % 6
    arrived, keys, checked = orders.filter(~third.isin(0, 3)), ["o_custkey"], ["o_orderstatus"]
    versions = _order_versions(w, arrived)
    for load in (0, 3):
        late = orders.filter(third == load)
        arrived = arrived.unionByName(late)
        touched = dealt_anew(arrived.join(late.select(*keys).distinct(), keys, "left_semi"), *keys)
        days = daily_latest(touched, keys, "o_orderdate", ["o_orderkey"])
        versions = merge_late(versions, late, days, keys, "o_orderdate", checked)
    return versioned_view(versions)


LOADS = ("1995-06-01", "1998-06-01")


def _loads(rows: DataFrame, column: str = "loaded_at", loads: tuple[str, ...] = LOADS) -> list[DataFrame]:
    """The rows as they arrive: up to each load time, then the rest."""
    marks = [None, *loads, None]
    return [
        rows.filter(
            (F.lit(True) if a is None else F.col(column) >= moment(a)) & (F.lit(True) if b is None else F.col(column) < moment(b))
        )
        for a, b in zip(marks, marks[1:])
    ]


def _folded(first: DataFrame, batches: list[DataFrame], fold: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """Versions after several loads, as the warehouse keeps them: only open ones meet a batch."""
    opened, closed = split_versions(first)
    for batch in batches:
        opened, gone = split_versions(fold(opened, batch))
        closed = closed.unionByName(gone)
    return versioned_view(opened.unionByName(closed))


@query
def channel_history_loads(w: Layers) -> DataFrame:
    """Channel versions built from the first load and extended by the second."""
    first, second = _loads(gold.channel_snapshot_rows(w.stg_channels), loads=LOADS[1:])
    key, checked = ["natural_channel_id"], gold.CHANNEL_CHECKS
    start = scd2_history(first, key, "loaded_at", checked, daily=True)
    return _folded(start, [second], lambda o, b: extend_open(o, b, key, "loaded_at", checked))


@query
def video_history_loads(w: Layers) -> DataFrame:
    """Video versions over three loads."""
    first, *rest = _loads(gold.video_snapshot_rows(w.stg_videos))
    key, checked = ["video_id"], gold.VIDEO_CHECKS
    start = scd2_history(first, key, "loaded_at", checked, daily=True)
    return _folded(start, rest, lambda o, b: extend_open(o, b, key, "loaded_at", checked))


@query
def video_tag_loads(w: Layers) -> DataFrame:
    """Video-tag pairs over three loads; a load that sees a pair again opens a version."""
    first, *rest = (gold.video_tag_pairs(rows, w.dim_video, w.as_of) for rows in _loads(w.star_videos))
    keys = ["video_sk", "tag_id"]
    return _folded(gold.opened(first), rest, lambda o, b: merge_open(o, b, keys, "loaded_at", w.as_of))


@query
def channel_keyword_loads(w: Layers) -> DataFrame:
    """Channel-keyword pairs over three loads, each a full snapshot: pairs a load lacks are closed."""
    first, *rest = (gold.channel_keyword_pairs(rows, w.dim_channel, w.as_of) for rows in _loads(w.stg_channels))
    keys = ["channel_sk", "keyword_id"]
    return _folded(
        gold.opened(first), rest, lambda o, b: merge_open(o, b, keys, "loaded_at", w.as_of, True, keys)
    )


# Gold


@query
def calendar_from_start(w: Layers) -> DataFrame:
    """Calendar from its fixed first day to the last event."""
    last = w.source("events").select(F.max("ts")).scalar()
    return date_dim(w.spark, last)


@query
def shipping_intervals(w: Layers) -> DataFrame:
    """Seconds between order and shipping, from an interval."""
    items = w.source("lineitem").join(w.source("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    waited = F.col("l_shipdate") - F.col("o_orderdate")
    return items.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", interval_seconds(waited).alias("seconds"))


@query
def dim_date(w: Layers) -> DataFrame:
    """Calendar over the days the orders span."""
    bounds = w.source("orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last")
    )
    return calendar(date_spine(bounds, "first", "last"))


@query
def dim_tag(w: Layers) -> DataFrame:
    return w.dim_tag


@query
def dim_keyword(w: Layers) -> DataFrame:
    return w.dim_keyword


@query
def dim_channel(w: Layers) -> DataFrame:
    return w.dim_channel.drop("version_sk")


@query
def dim_video(w: Layers) -> DataFrame:
    return w.dim_video.drop("version_sk")


@query
def dim_video_category(w: Layers) -> DataFrame:
    counted = w.dim_video.filter("is_current").groupBy("category_name")
    return counted.agg(F.count("*").alias("video_count"))


@query
def fact_channel_metrics(w: Layers) -> DataFrame:
    return w.fact_channel_metrics


@query
def fact_video_performance(w: Layers) -> DataFrame:
    return w.fact_video_performance


@query
def fact_channel_asof(w: Layers) -> DataFrame:
    """Channel counters on the version that was valid when they were loaded."""
    fact = gold.fact_channel_metrics(w.stg_channels, w.dim_channel, asof=True, horizon=w.as_of)
    versions = w.dim_channel.select(F.col("version_sk").alias("channel_version_sk"), "valid_from")
    return fact.join(versions, "channel_version_sk").drop("channel_version_sk")


@query
def incremental_fact_append(w: Layers) -> DataFrame:
    """A fact built up to one day takes the days after it."""
    built = w.fact_channel_metrics
    stored = built.filter(F.col("date_key") <= F.lit("1999-06-30").cast("date"))
    return append_new_dates(stored, built)


@query
def bridge_channel_keyword(w: Layers) -> DataFrame:
    return w.bridge_channel_keyword


@query
def bridge_video_tag(w: Layers) -> DataFrame:
    return w.bridge_video_tag


@query
def latest_metric(w: Layers) -> DataFrame:
    return analytics.latest_metrics(w.fact_channel_metrics, "channel_sk", "views", "subscribers")


@query
def latest_positive_metric(w: Layers) -> DataFrame:
    return analytics.latest_viewed(w.fact_video_performance)


# Analytics


@query
def top_10_channels(w: Layers) -> DataFrame:
    return analytics.top_channels(w.fact_channel_metrics, w.dim_channel)


@query
def top_10_videos(w: Layers) -> DataFrame:
    return analytics.top_videos(w.fact_video_performance, w.dim_video)


@query
def popular_keywords(w: Layers) -> DataFrame:
    return analytics.popular_keywords(
        w.fact_channel_metrics, w.bridge_channel_keyword, w.dim_keyword
    )


@query
def duration_view_corr(w: Layers) -> DataFrame:
    return analytics.duration_view_correlation(w.fact_video_performance, w.dim_video)


@query
def tag_engagement(w: Layers) -> DataFrame:
    return analytics.tag_engagement(w.fact_video_performance, w.bridge_video_tag, w.dim_tag)


@query
def category_performance(w: Layers) -> DataFrame:
    return analytics.category_performance(w.fact_video_performance, w.dim_video)


@query
def top_categories(w: Layers) -> DataFrame:
    return analytics.top_categories(w.fact_video_performance, w.dim_video)


@query
def optimal_length(w: Layers) -> DataFrame:
    return analytics.optimal_length(w.fact_video_performance, w.dim_video)


@query
def secure_top_channels(w: Layers) -> DataFrame:
    return secure.top_channels(w.fact_channel_metrics, w.dim_channel, FULL)


@query
def secure_top_videos(w: Layers) -> DataFrame:
    return secure.top_videos(w.fact_video_performance, w.dim_video, FULL)


@query
def secure_top_videos_every_version(w: Layers) -> DataFrame:
    return secure.top_videos(w.fact_video_performance, w.dim_video, FULL, every_version=True)


@query
def masked_top_channels(w: Layers) -> DataFrame:
    return secure.top_channels(w.fact_channel_metrics, w.dim_channel, LIMITED, SALT)


@query
def masked_top_videos(w: Layers) -> DataFrame:
    return secure.top_videos(w.fact_video_performance, w.dim_video, LIMITED, SALT)


# Ad-hoc questions on the silver rows


@query
def legacy_top_topic(w: Layers) -> DataFrame:
    return adhoc.top_topic(w.stg_channels, "MACHIN")


@query
def legacy_top_channels_topic(w: Layers) -> DataFrame:
    return adhoc.top_channels_in_topic(w.stg_channels, "machin")


@query
def legacy_best_category(w: Layers) -> DataFrame:
    return adhoc.best_category(w.stg_videos)


@query
def legacy_category_duration(w: Layers) -> DataFrame:
    return adhoc.category_duration(w.stg_videos)


@query
def legacy_duration_corr(w: Layers) -> DataFrame:
    return adhoc.duration_correlation(w.stg_videos)


@query
def legacy_tag_engagement(w: Layers) -> DataFrame:
    return adhoc.tag_engagement(w.stg_videos)


@query
def legacy_optimal_length(w: Layers) -> DataFrame:
    return adhoc.optimal_length(w.stg_videos, (1, 3, 10))


@query
def legacy_top_videos_ilike(w: Layers) -> DataFrame:
    return adhoc.top_videos_in_topic(w.stg_videos, "Promo")


# Data checks


@query
def dq_not_null(w: Layers) -> DataFrame:
    """Staging columns, comment counts of which some are missing."""
    columns = ("video_id", "channel_id", "date_key", "category_id", "comment_count")
    return quality.row_checks(w.stg_videos, [quality.not_null(c) for c in columns])


@query
def dq_unique(w: Layers) -> DataFrame:
    fact, stg = w.fact_channel_metrics, w.stg_channels
    return quality.unique(fact, "id").unionByName(quality.unique(stg, "channel_id", quality.WARN))


@query
def dq_accepted_range(w: Layers) -> DataFrame:
    rows = [
        quality.accepted_range("view_count", 0),
        quality.accepted_range("like_count", 10, 40, quality.WARN),
        quality.accepted_range("comment_count", 2, severity=quality.WARN),
    ]
    return quality.row_checks(w.stg_videos, rows)


@query
def dq_relationships(w: Layers) -> DataFrame:
    """Line items all have a part; labels miss the documents that are not French."""
    parts = quality.relationships(w.source("lineitem"), "l_partkey", w.source("part"), "p_partkey")
    french = w.source("documents").filter(F.col("lang") == "fr")
    labels = quality.relationships(w.source("labels"), "doc_id", french, "doc_id", quality.WARN)
    return parts.unionByName(labels)


@query
def dq_expression(w: Layers) -> DataFrame:
    rows = [
        quality.expression_is_true("view_count >= 0", "view_count"),
        quality.expression_is_true("comment_count >= 3", "comment_count", severity=quality.WARN),
        quality.expression_is_true("comment_count >= 3", "comment_count_or_null", nulls_fail=True),
    ]
    return quality.row_checks(w.stg_videos, rows)


@query
def dq_staging_report(w: Layers) -> DataFrame:
    return checks.check_stg_channels(w.stg_channels).unionByName(checks.check_stg_videos(w.stg_videos))


@query
def dq_channel_star_report(w: Layers) -> DataFrame:
    """Every declared check on the channel side of the star schema, on tables written once."""
    w = StoredLayers(w.spark, w.sf_dir)
    tables = {
        "fact_channel_metrics": w.fact_channel_metrics,
        "dim_channel": w.dim_channel,
        "dim_date": dim_date(w),
        "dim_keyword": w.dim_keyword,
        "bridge_channel_keyword": w.bridge_channel_keyword,
    }
    return checks.check_gold(tables)


@query
def dq_video_star_report(w: Layers) -> DataFrame:
    """Every declared check on the video side of the star schema, on tables written once."""
    w = StoredLayers(w.spark, w.sf_dir)
    tables = {
        "fact_video_performance": w.fact_video_performance,
        "dim_video": w.dim_video,
        "dim_tag": w.dim_tag,
        "bridge_video_tag": w.bridge_video_tag,
    }
    parents = {"dim_channel": w.dim_channel, "dim_date": dim_date(w)}
    return checks.check_gold(tables | parents, only=tuple(tables))
