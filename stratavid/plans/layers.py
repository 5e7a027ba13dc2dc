"""Every warehouse table as a lazy DataFrame over one folder of source tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from stratavid.operators.sizing import dealt
from stratavid.plans import gold, silver
from stratavid.plans.raw import (
    CHANNEL_TIEBREAK,
    VIDEO_TIEBREAK,
    as_of,
    raw_channels,
    raw_videos,
    table,
)
from stratavid.session import shared_folder
from stratavid.sources.files import category_seed


class Layers:
    """Tables by name; each is a plan that Spark runs only as far as a query needs."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.as_of = as_of()

    def source(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    @cached_property
    def raw_channels(self) -> DataFrame:
        return raw_channels(self.spark, self.sf_dir)

    @cached_property
    def raw_videos(self) -> DataFrame:
        return raw_videos(self.spark, self.sf_dir)

    @cached_property
    def categories(self) -> DataFrame:
        return category_seed(self.spark)

    @cached_property
    def stg_channels(self) -> DataFrame:
        return silver.stg_channels(self.raw_channels, self.as_of, CHANNEL_TIEBREAK)

    @cached_property
    def stg_videos(self) -> DataFrame:
        return silver.stg_videos(self.raw_videos, self.as_of, VIDEO_TIEBREAK)

    @cached_property
    def star_videos(self) -> DataFrame:
        """``stg_videos`` as the star tables read it.

        All its columns settle ties, so whatever a table needs of it, the rows are dealt in the same
        exchange, and a query over several star tables makes and reuses one. Every raw row has an id, by
        the join with its part; saying so spares the planner one exchange with that filter and one without.
        """
        settled = (*VIDEO_TIEBREAK, *silver.VIDEO_RULES.columns, "date_key")
        return silver.stg_videos(self.raw_videos.filter("videoId IS NOT NULL"), self.as_of, settled)

    @cached_property
    def listed_videos(self) -> DataFrame:
        """``star_videos`` for tables that deal its rows by other keys or anew."""
        return self.star_videos

    @cached_property
    def dim_channel(self) -> DataFrame:
        return gold.dim_channel(gold.channel_snapshot(self.stg_channels))

    @cached_property
    def dim_video(self) -> DataFrame:
        return gold.dim_video(gold.video_snapshot(self.star_videos), self.categories)

    @cached_property
    def dim_keyword(self) -> DataFrame:
        return gold.dim_keyword(self.stg_channels)

    @cached_property
    def dim_tag(self) -> DataFrame:
        return gold.dim_tag(self.listed_videos)

    @cached_property
    def bridge_channel_keyword(self) -> DataFrame:
        return gold.bridge(
            gold.channel_keyword_pairs(self.stg_channels, self.dim_channel, self.as_of)
        )

    @cached_property
    def bridge_video_tag(self) -> DataFrame:
        return gold.bridge(
            gold.video_tag_pairs(self.listed_videos, self.dim_video, self.as_of)
        )

    @cached_property
    def fact_channel_metrics(self) -> DataFrame:
        return gold.fact_channel_metrics(self.stg_channels, self.dim_channel)

    @cached_property
    def fact_video_performance(self) -> DataFrame:
        return gold.fact_video_performance(self.star_videos, self.dim_video, self.dim_channel)


def scratch_folder(spark: SparkSession, tag: str) -> str:
    """A new folder name in the shared folder; in a local one only for a local master without that setting."""
    local = spark.sparkContext.master.startswith("local[")
    return f"{shared_folder(spark, tempfile.gettempdir() if local else None)}/{tag}-{uuid.uuid4().hex}"


STORED = (
    "stg_channels", "stg_videos", "dim_channel", "dim_video", "dim_keyword", "dim_tag",
    "bridge_channel_keyword", "bridge_video_tag", "fact_channel_metrics", "fact_video_performance",
)


class StoredLayers(Layers):
    """The same tables, each written to the shared folder when it is first asked for.

    For work that reads tables many times, such as the check reports.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark, sf_dir)
        self.folder = scratch_folder(spark, "layers")

    @cached_property
    def star_videos(self) -> DataFrame:
        """The written rows, dealt by the size of their files, so that no sort of versions outgrows its task.

        They have one row per video and day, so no key is hot.
        """
        return dealt(self.stg_videos, "video_id", joined=False)

    @cached_property
    def listed_videos(self) -> DataFrame:
        return self.stg_videos


def _written(name: str) -> cached_property:
    def get(self: StoredLayers) -> DataFrame:
        df = getattr(Layers, name).func(self)
        df.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    prop = cached_property(get)
    prop.__set_name__(StoredLayers, name)
    return prop


for _name in STORED:
    setattr(StoredLayers, _name, _written(_name))
