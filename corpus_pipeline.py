"""Corpus pipeline: from raw documents to packed training windows, one stage after the other.

Each stage gets the session, its predecessor's rows and the folder of the tables. Null texts count as
empty, null ids are kept, repeated rows are treated as the stage's operator says, further columns travel
along whatever their names, and an empty table gives an empty result. Its result is
written as Parquet to the shared folder and read again, so a lost executor repeats tasks of one
stage only, and each stage plans with the sizes its predecessor left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratavid.llm.common import documents, stored
from stratavid.llm.exact_dedup import drop_copies
from stratavid.llm.mixing import mixed_rows
from stratavid.llm.neardup import Rule, drop_near
from stratavid.llm.packing import pack, written_order
from stratavid.llm.quality import keep_good, train


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose pairwise-ranked quality reaches the cut."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return keep_good(docs, labels, train(docs, labels))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each normalised text."""
    return drop_copies(docs, keep="smallest")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group linked on word 5-shingles at 0.8."""
    return drop_near(docs, Rule(words=5, percent=80))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order in which sources at their target weights take turns."""
    return mixed_rows(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of at most 4096 tokens with their ids, filled with neighbours of the mixture and numbered along it.

    One row per piece of a document, as ``pack`` gives them.
    """
    return pack(written_order(docs.select("doc_id", "text")))


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("near dedup", near),
    ("mixing sources", mixture),
    ("packing", packing),
]

# Neither learned scores nor token ids are expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
