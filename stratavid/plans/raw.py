"""Raw observation tables derived from the supplied star-schema tables.

Orders play the part of channel observations (the customer is the channel) and line
items the part of video observations (the part is the video).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# All supplied observations are older than this load time.
AS_OF = datetime(2001, 12, 31)

# Category of each part type; 3 is not in the category seed.
TYPE_CATEGORIES = {"ECONOMY": 1, "LARGE": 2, "MEDIUM": 10, "PROMO": 15, "SMALL": 17, "STANDARD": 3}

CHANNEL_TIEBREAK = ("o_orderkey",)
VIDEO_TIEBREAK = (
    "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus",
)


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel observations, with the order key as tie-break."""
    orders = table(spark, sf_dir, "orders")
    rows = orders.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    born = F.date_add(F.lit("1995-01-01").cast("date"), ((F.col("c_custkey") * 7) % 4000).cast("int"))
    blank_home = F.col("c_nationkey") % 7 == 0
    return rows.select(
        F.col("o_orderdate").alias("ts"),
        F.concat(F.lit("C"), "o_custkey").alias("channelId"),
        F.col("c_name").alias("title"),
        F.when(F.col("c_nationkey") % 5 == 0, "   ")
        .otherwise(F.concat(F.lit("  "), "c_mktsegment", F.lit(" channel ")))
        .alias("description"),
        F.concat(F.lit("@"), F.lower("c_mktsegment"), "c_custkey").alias("customUrl"),
        F.floor(F.col("o_totalprice") / 100).cast("bigint").alias("subscribers"),
        F.floor("o_totalprice").cast("bigint").alias("views"),
        (F.col("o_orderkey") % 1200).alias("videos"),
        (F.col("o_orderstatus") == "P").alias("hiddenSubscribers"),
        born.cast("timestamp_ntz").alias("publishedAt"),
        F.when(blank_home, "").otherwise(F.col("c_mktsegment")).alias("country"),
        F.col("o_orderstatus").alias("defaultLanguage"),
        F.concat(F.translate("o_orderpriority", "-", ","), F.lit(", "), "c_mktsegment").alias("keywords"),
        F.concat(F.lit("UU"), "o_custkey").alias("uploadsPlaylistId"),
        F.concat("c_mktsegment", F.lit(", "), "o_orderpriority").alias("topics"),
        F.to_date("o_orderdate").alias("loaded_at"),
        "o_orderkey",
    )


def part_duration() -> Column:
    """ISO duration text of a part; a part of zero is left out."""

    def unit(amount: Column, letter: str) -> Column:
        return F.when(amount > 0, F.concat(amount.cast("string"), F.lit(letter)))

    pieces = [
        unit(F.col("p_size") % 3, "H"),
        unit(F.col("p_size"), "M"),
        unit(F.col("p_partkey") % 60, "S"),
    ]
    return F.concat_ws("", F.lit("PT"), *pieces)


def part_category() -> Column:
    chosen = None
    for kind, category in TYPE_CATEGORIES.items():
        matches = F.col("p_type") == kind
        chosen = F.when(matches, category) if chosen is None else chosen.when(matches, category)
    return chosen.cast("bigint")


def raw_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Video observations, with the remaining line-item columns as tie-break."""
    items = table(spark, sf_dir, "lineitem")
    rows = items.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    channels = table(spark, sf_dir, "customer").select(F.count("*")).scalar()
    born = F.date_add(F.lit("1994-01-01").cast("date"), ((F.col("p_partkey") * 11) % 3000).cast("int"))
    words = F.split("p_name", " ")
    return rows.select(
        F.col("l_shipdate").alias("ts"),
        F.concat(F.lit("V"), "l_partkey").alias("videoId"),
        F.concat_ws(" ", "p_name", "p_brand").alias("title"),
        born.cast("timestamp_ntz").alias("publishedAt"),
        F.concat_ws(", ", words).alias("tags"),
        part_category().alias("categoryId"),
        F.concat(F.lit("C"), F.col("l_partkey") % channels).alias("channelId"),
        part_duration().alias("duration"),
        F.col("p_brand").alias("definition"),
        (F.col("l_returnflag") == "A").alias("caption"),
        (F.col("p_size") % 2 == 0).alias("licensedContent"),
        F.lit("").alias("regionRestriction"),
        F.when(F.col("l_linenumber") == 7, 0)
        .otherwise(F.floor("l_extendedprice"))
        .cast("bigint")
        .alias("viewCount"),
        F.floor("l_quantity").cast("bigint").alias("likeCount"),
        F.when(F.col("l_discount") != 0, F.col("l_linenumber")).cast("bigint").alias("commentCount"),
        F.lit("public").alias("privacyStatus"),
        F.col("l_linestatus").alias("license"),
        F.concat_ws(", ", "p_type", words[0]).alias("topicCategories"),
        F.to_date("l_shipdate").alias("loaded_at"),
        *VIDEO_TIEBREAK,
    )
