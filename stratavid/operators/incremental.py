"""High-water marks, upserts and schema evolution."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratavid.functions import year_month
from stratavid.operators.snapshot import SnapshotRules, silver_snapshot

# Fixed value: the mark of an empty target.
EPOCH = datetime(1970, 1, 1)

# Decimal digits that integers of each width need.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}

# Types that hold all values of a type, besides itself, text and decimals.
_WIDER = {
    T.ByteType: (T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType),
    T.ShortType: (T.IntegerType, T.LongType, T.FloatType, T.DoubleType),
    T.IntegerType: (T.LongType, T.DoubleType),
    T.FloatType: (T.DoubleType,),
    T.DateType: (T.TimestampNTZType,),
}


def high_water_mark(target: DataFrame, column: str) -> Column:
    """Largest value in ``target``, or the epoch if it is empty, as a scalar subquery.

    Spark runs the subquery once, reading that one column, and pushes the result
    into the scan of whatever is filtered with it.
    """
    floor = F.lit(EPOCH).cast(target.schema[column].dataType)
    return target.select(F.coalesce(F.max(column), floor)).scalar()


def above_mark(
    source: DataFrame,
    target: DataFrame,
    source_column: str,
    target_column: str,
    month_column: str | None = None,
) -> DataFrame:
    """Rows strictly newer than anything in ``target``.

    ``month_column`` names a ``yyyyMM`` partition column of the source, if it has one:
    months before the mark's are then not listed at all.
    """
    mark = high_water_mark(target, target_column)
    newer = source.filter(F.col(source_column) > mark)
    return newer if month_column is None else newer.filter(F.col(month_column) >= year_month(mark))


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` replace target rows with the same key; the others are kept."""
    kept = target.join(batch.select(*keys), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(batch, allowMissingColumns=True)


def incremental_load(target: DataFrame, raw: DataFrame, rules: SnapshotRules, as_of: Column) -> DataFrame:
    """Daily snapshot ``target`` brought up to date with the raw rows above its mark."""
    fresh = above_mark(raw, target, rules.version, "loaded_at")
    return upsert(target, silver_snapshot(fresh, rules, as_of), [rules.key, "date_key"])


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of ``old`` keeps its value in ``new``: wider numbers, day to moment, single values to text."""
    if old == new:
        return True
    if isinstance(new, T.StringType):
        return isinstance(old, T.AtomicType) and not isinstance(old, T.BinaryType)
    if isinstance(new, T.DecimalType):
        digits, scale = (old.precision, old.scale) if isinstance(old, T.DecimalType) else (_DIGITS.get(type(old)), 0)
        return digits is not None and new.scale >= scale and new.precision - new.scale >= digits - scale
    return type(new) in _WIDER.get(type(old), ())


def opens_as(old: T.StructType, new: T.StructType) -> bool:
    """Whether files of the schema ``old`` can be read in the types of ``new`` as they are.

    Readers widen numbers of files; what has become text or a moment, or integers that have become decimals, must be rewritten.
    """
    def reads(a: T.DataType, b: T.DataType) -> bool:
        kept = isinstance(a, T.DecimalType) or not isinstance(b, (T.StringType, T.TimestampNTZType, T.DecimalType))
        return a == b or (widens(a, b) and kept)

    return all(reads(old[f.name].dataType, f.dataType) for f in new.fields if f.name in old.names)


def common_type(one: T.DataType, other: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both exactly; an error if there is none."""
    if widens(one, other):
        return other
    if widens(other, one):
        return one
    if {type(one), type(other)} <= {*_DIGITS, T.DecimalType}:
        pair = [(t.precision, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS[type(t)], 0) for t in (one, other)]
        scale = max(s for _, s in pair)
        whole = max(p - s for p, s in pair)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    elif {type(one), type(other)} <= {T.ByteType, T.ShortType, T.IntegerType, T.FloatType}:
        return T.DoubleType()
    raise TypeError(f"no type holds both {one.simpleString()} and {other.simpleString()}")


def evolve_schema(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Both sets of rows with the columns of ``batch``: new ones are null in old rows, removed ones go.

    A column whose type changed takes that of ``batch`` if it holds all old values (``widens``); a narrower one is an
    error, raised before anything is read.
    """
    changed = {}
    for field in batch.schema.fields:
        old = target.schema[field.name].dataType if field.name in target.columns else field.dataType
        if not widens(old, field.dataType):
            raise TypeError(f"{field.name} cannot go from {old.simpleString()} to {field.dataType.simpleString()}")
        if old != field.dataType:
            changed[field.name] = F.col(field.name).cast(field.dataType)
    return target.withColumns(changed).unionByName(batch, allowMissingColumns=True).select(*batch.columns)


def union_promoted(batches: Sequence[DataFrame]) -> DataFrame:
    """Batches put together by column name, each column in the narrowest type that holds all of them.

    Columns that a batch lacks are null in its rows.
    """
    types: dict[str, T.DataType] = {}
    for batch in batches:
        for field in batch.schema.fields:
            types[field.name] = common_type(types.get(field.name, field.dataType), field.dataType)
    cast = [b.select(*(F.col(c).cast(types[c]).alias(c) for c in b.columns)) for b in batches]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cast)


def append_new_dates(fact: DataFrame, built: DataFrame, date_column: str = "date_key") -> DataFrame:
    """Fact extended by the rows of ``built`` dated after everything it holds."""
    return fact.unionByName(above_mark(built, fact, date_column, date_column))


def unexpired(df: DataFrame, date_column: str, as_of: Column, days: int = 90) -> DataFrame:
    """Rows whose retention of ``days`` has not run out at ``as_of``."""
    return df.filter(F.col(date_column) > F.date_sub(as_of, days))
