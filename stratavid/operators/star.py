"""Calendar dimension and facts."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratavid.functions import iso_weekday, surrogate_key
from stratavid.operators.history import asof_join

# Fixed value: first day of the calendar.
CALENDAR_START = date(2005, 1, 1)


def date_dim(spark: SparkSession, as_of: Column, start: date = CALENDAR_START) -> DataFrame:
    """One row per day from ``start`` to the day of ``as_of``."""
    bounds = spark.range(1).select(F.lit(start).alias("first"), F.to_date(as_of).alias("last"))
    return calendar(date_spine(bounds, "first", "last"))


def date_spine(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """Every day between two date columns, both included, as ``date_key``."""
    days = F.sequence(F.col(first), F.col(last), F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias("date_key"))


def calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes of a frame of distinct ``date_key`` days."""
    day = F.col("date_key")
    return days.select(
        day,
        day.alias("date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        iso_weekday(day).alias("week_day"),
        iso_weekday(day).isin(6, 7).alias("is_weekend"),
    )


@dataclass(frozen=True)
class DimensionLink:
    """How a fact finds a dimension: staging column, dimension column and the key it brings."""

    dim: DataFrame
    staging_key: str
    dim_key: str
    sk: str


def build_fact(
    staging: DataFrame,
    links: Sequence[DimensionLink],
    id_cols: Sequence[str],
    measures: dict[str, str],
    asof: bool = False,
    horizon: Column | None = None,
) -> DataFrame:
    """Daily fact: surrogate ``id``, one key per dimension, ``date_key`` and the measures.

    Rows without an open version in some dimension are dropped. ``measures`` maps
    output name to staging name. By default history is restated on the current
    versions; ``asof=True`` keeps the version valid at load time instead and needs a
    ``version_sk`` in each dimension.
    """
    rows = staging
    keys: list[Column] = []
    for link in links:
        if asof:
            version = f"{link.sk.removesuffix('_sk')}_version_sk"
            dim = link.dim.select(
                F.col(link.dim_key).alias(f"__{link.sk}"),
                F.col(link.sk),
                F.col("version_sk").alias(version),
                "valid_from",
                "valid_to",
            )
            rows = asof_join(rows, dim, link.staging_key, f"__{link.sk}", "loaded_at", horizon)
            rows = rows.drop(f"__{link.sk}", "valid_from", "valid_to")
            keys += [F.col(link.sk), F.col(version)]
        else:
            dim = link.dim.filter("is_current").select(
                F.col(link.dim_key).alias(link.staging_key), F.col(link.sk)
            )
            rows = rows.join(dim, link.staging_key)
            keys.append(F.col(link.sk))
    return rows.select(
        surrogate_key(*id_cols).alias("id"),
        *keys,
        "date_key",
        *[F.col(source).alias(name) for name, source in measures.items()],
    )
