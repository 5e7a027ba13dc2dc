"""Delimited lists: token rows, token dimensions and validity-aware bridges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratavid.functions import surrogate_key
from stratavid.operators.history import VALID_FROM, VALID_TO, asof_join


def token_rows(df: DataFrame, column: str, token: str, separator: str = ",") -> DataFrame:
    """One row per non-blank token of a delimited text; the list column is replaced by ``token``."""
    others = [c for c in df.columns if c != column]
    listed = df.filter(F.col(column).isNotNull() & (F.col(column) != ""))
    split = listed.select(*others, F.explode(F.split(column, separator, -1)).alias(token))
    return split.withColumn(token, F.trim(token)).filter(F.col(token) != "")


def token_dim(df: DataFrame, column: str, id_name: str, token: str) -> DataFrame:
    """Distinct tokens with their key; duplicates collapse before the exchange."""
    tokens = token_rows(df.select(column), column, token).distinct()
    return tokens.select(surrogate_key(token).alias(id_name), token)


def token_bridge(
    staging: DataFrame,
    versions: DataFrame,
    entity: str,
    version_entity: str,
    entity_sk: str,
    column: str,
    token: str,
    token_id: str,
    horizon: Column,
) -> DataFrame:
    """Entity-token pairs seen while some version of the entity was valid, newest sighting as ``loaded_at``.

    The as-of join runs on the short list rows, over the entity alone, as a daily ``staging`` has one a day of it at most.
    Tokens are split after it, and an entity's pairs collapse in its task before they are exchanged. A token's key is the
    hash that the token dimension has for it, so no join with the dimension is needed; the
    declared relationship check compares the two.
    """
    # A null entity equals no other.
    lists = staging.select(entity, column, "loaded_at").filter(
        F.col(entity).isNotNull() & F.col(column).isNotNull() & (F.col(column) != "")
    )
    spans = versions.select(version_entity, entity_sk, VALID_FROM, VALID_TO).filter(F.col(version_entity).isNotNull())
    matched = asof_join(lists, spans, entity, version_entity, "loaded_at", horizon, span=None)
    pairs = (
        token_rows(matched.select(entity_sk, "loaded_at", column), column, token)
        .groupBy(entity_sk, token)
        .agg(F.max("loaded_at").alias("loaded_at"))
    )
    return pairs.select(entity_sk, surrogate_key(token).alias(token_id), "loaded_at")


def first_bridge_snapshot(pairs: DataFrame) -> DataFrame:
    """Bridge as its first snapshot: every pair open from its newest sighting."""
    opened = pairs.withColumnRenamed("loaded_at", VALID_FROM)
    no_end = F.lit(None).cast(opened.schema[VALID_FROM].dataType)
    return opened.withColumn(VALID_TO, no_end)
