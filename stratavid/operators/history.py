"""Slowly changing dimensions, type 2.

A version is valid over ``[valid_from, valid_to)``; the open one has a null end.
``valid_from`` is the observation time, never the time of the run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratavid.functions import surrogate_key
from stratavid.operators.latest import daily_latest, dealt_anew

VALID_FROM = "valid_from"
VALID_TO = "valid_to"


def scd2_history(
    history: DataFrame,
    keys: Sequence[str],
    ts: str,
    check_cols: Sequence[str],
    tiebreak: Sequence[str] = (),
    daily: bool = False,
) -> DataFrame:
    """All versions from a full history: a new one wherever a checked column changes.

    One observation per key and day enters, so a key's window holds at most as many
    rows as the history has days, however many raw rows a hot key has. Pass
    ``daily=True`` for input that already has that grain. Both windows share one
    exchange and one sort.
    """
    observed = history if daily else daily_latest(history, keys, ts, tiebreak)
    along = Window.partitionBy(*keys).orderBy(ts)
    state = F.struct(*check_cols)
    # The state struct is never null itself, so a null lag means "first row" even
    # where every checked column is null.
    compared = observed.withColumn("__before", F.lag(state).over(along))
    before = F.col("__before")
    changes = compared.filter(before.isNull() | ~state.eqNullSafe(before)).drop(
        "__before", *tiebreak
    )
    return changes.withColumnRenamed(ts, VALID_FROM).withColumn(
        VALID_TO, F.lead(VALID_FROM).over(Window.partitionBy(*keys).orderBy(VALID_FROM))
    )


def scd2_merge(
    current: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    check_cols: Sequence[str],
    ts: str,
    as_of: Column,
    full_snapshot: bool = False,
) -> DataFrame:
    """Versions after one batch, opening a version where a checked column changed.

    ``batch`` holds one row per key, observed at ``ts``. With ``full_snapshot`` a key
    missing from the batch is closed at ``as_of``; a partial batch must leave it off.
    An observation no newer than the open version changes nothing.
    """
    opened, closed = split_versions(current)
    return closed.unionByName(
        merge_open(opened, batch, keys, ts, as_of, full_snapshot, check_cols)
    )


def scd2_merge_timestamp(
    current: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    updated_at: str,
    as_of: Column,
    full_snapshot: bool = False,
) -> DataFrame:
    """Versions after one batch, opening a version where ``updated_at`` moved on."""
    opened, closed = split_versions(current)
    return closed.unionByName(merge_open(opened, batch, keys, updated_at, as_of, full_snapshot))


def split_versions(versions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Open and closed versions."""
    is_open = F.col(VALID_TO).isNull()
    return versions.filter(is_open), versions.filter(~is_open)


def merge_open(
    opened: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    ts: str,
    as_of: Column,
    full_snapshot: bool = False,
    check_cols: Sequence[str] | None = None,
) -> DataFrame:
    """What a batch makes of the open versions: kept, closed and newly opened rows.

    A newer observation opens a version if a checked column differs or, without
    ``check_cols``, by being newer alone. Closed history is not read.
    """
    attributes = [c for c in opened.columns if c not in (VALID_FROM, VALID_TO)]
    # Both sides hold one row per key, so no join key can be hot.
    pairs = opened.withColumn("__open", F.lit(True)).alias("o").join(
        batch.withColumn("__in", F.lit(True)).alias("b"),
        [F.col(f"o.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys],
        "full_outer",
    )
    known, arrived = F.col("o.__open").isNotNull(), F.col("b.__in").isNotNull()
    seen = F.col(f"b.{ts}")
    changed = seen > F.col(f"o.{VALID_FROM}")
    if check_cols is not None:
        old_state = F.struct(*[F.col(f"o.{c}") for c in check_cols])
        new_state = F.struct(*[F.col(f"b.{c}") for c in check_cols])
        changed = changed & ~old_state.eqNullSafe(new_state)

    end = F.when(arrived & changed, seen)
    if full_snapshot:
        end = F.when(~arrived, as_of).otherwise(end)
    end_type = opened.schema[VALID_TO].dataType
    old_row = F.struct(
        *[F.col(f"o.{c}").alias(c) for c in attributes],
        F.col(f"o.{VALID_FROM}").alias(VALID_FROM),
        end.cast(end_type).alias(VALID_TO),
    )
    new_row = F.struct(
        *[F.col(f"b.{c}").alias(c) for c in attributes],
        seen.alias(VALID_FROM),
        F.lit(None).cast(end_type).alias(VALID_TO),
    )
    # A pair yields the old row, the new row or both, in one pass over the join.
    rows = F.array_compact(
        F.array(F.when(known, old_row), F.when(arrived & (~known | changed), new_row))
    )
    return pairs.select(F.inline(rows))


def extend_open(
    opened: DataFrame, history: DataFrame, keys: Sequence[str], ts: str, check_cols: Sequence[str]
) -> DataFrame:
    """What several days of newer observations make of the open versions, in one pass.

    Each open version joins the history as its first observation, so the result equals
    merging day by day. ``history`` holds one row per key and day, all newer than the
    open versions.
    """
    attributes = [c for c in opened.columns if c != VALID_TO]
    start = opened.select(*attributes).withColumnRenamed(VALID_FROM, ts)
    both = dealt_anew(start.unionByName(history.select(*start.columns)), *keys)
    return scd2_history(both, keys, ts, check_cols, daily=True).select(*opened.columns)


def merge_late(
    versions: DataFrame,
    late: DataFrame,
    observed: DataFrame,
    keys: Sequence[str],
    ts: str,
    check_cols: Sequence[str],
) -> DataFrame:
    """Versions after observations that arrive late: older than versions that are stored already.

    ``late`` has at least the keys and times of the late rows, ``observed`` every daily row (one per key
    and day, the late ones included) of the keys in ``late``; days before a key's first late
    one are not needed, and rows of other keys are passed over. Loading in any order
    gives what one rebuild from all rows gives.

    A late row falls into the version that was valid then and cuts it. From that day on the key's
    versions are derived anew, as sightings between two stored versions count too; what ended
    before is kept, and so is every version of the other keys. A version that ended without a
    successor (a key that was gone) still ends there.

    Stored versions, sightings and first late days meet in windows over the key, with no join, so no row of
    an earlier load is read twice.
    """
    attributes = [c for c in versions.columns if c not in (VALID_FROM, VALID_TO, "is_current")]
    moment = versions.schema[VALID_FROM].dataType
    # A key with a null in it equals no other key, so nothing is late for it.
    cuts = late.na.drop(subset=list(keys)).groupBy(*keys).agg(F.date_trunc("day", F.min(ts)).cast(moment).alias("__late"))
    stored = versions.select(*attributes, F.col(VALID_FROM).alias("__at"), F.col(VALID_TO).alias("__to"), F.lit("stored").alias("__kind"))
    sighted = observed.select(*attributes, F.col(ts).alias("__at"), F.lit("sighted").alias("__kind"))
    gathered = (
        stored.unionByName(sighted, allowMissingColumns=True)
        .unionByName(cuts.withColumn("__kind", F.lit("cut")), allowMissingColumns=True)
    )
    gathered = (
        dealt_anew(gathered, *keys)
        .withColumn("__cut", F.max("__late").over(Window.partitionBy(*keys)))
        .withColumn("__touched", F.max(F.col("__kind") == "cut").over(Window.partitionBy(*keys)))
        .withColumn("__next", F.lead("__at").over(Window.partitionBy(*keys, "__kind").orderBy("__at")))
    )
    at, to, cut = F.col("__at"), F.col("__to"), F.col("__cut")
    is_stored, is_sighted = F.col("__kind") == "stored", F.col("__kind") == "sighted"
    kept = is_stored & (~F.col("__touched") | F.coalesce(to < cut, F.lit(False)))
    redone = is_stored & ~kept

    def event(when: Column, start: Column, end: Column, alive: bool, settled: bool) -> Column:
        end_type = stored.schema["__to"].dataType
        fields = {"__start": start, "__end": end.cast(end_type), "__alive": F.lit(alive), "__settled": F.lit(settled)}
        return F.when(when, F.struct(*[c.alias(name) for name, c in fields.items()]))

    no_end = F.lit(None)
    events = F.array_compact(
        F.array(
            event(kept, at, to, True, True),
            event(redone & (at < cut), at, no_end, True, False),
            event(redone & to.isNotNull() & ~to.eqNullSafe(F.col("__next")), to, no_end, False, False),
            event(is_sighted & (at >= cut), at, no_end, True, False),
        )
    )
    all_events = gathered.select(*attributes, F.inline(events))
    # At equal times the end comes first: who is seen then is back.
    order = Window.partitionBy(*keys, "__settled").orderBy("__start", "__alive")
    state = F.when(F.col("__alive"), F.struct(*check_cols))
    compared = all_events.withColumn("__state", F.struct("__alive", state.alias("s"))).withColumn(
        "__before", F.lag("__state").over(order)
    )
    changed = F.col("__before").isNull() | ~F.col("__state").eqNullSafe(F.col("__before"))
    changes = compared.filter(F.col("__settled") | changed)
    until = F.when(F.col("__settled"), F.col("__end")).otherwise(F.lead("__start").over(order))
    derived = changes.withColumn("__until", until).filter("__alive")
    return derived.select(*attributes, F.col("__start").alias(VALID_FROM), F.col("__until").alias(VALID_TO))


def versioned_view(snapshot: DataFrame) -> DataFrame:
    """Versions with an ``is_current`` flag, which stored versions already carry."""
    if "is_current" in snapshot.columns:
        return snapshot
    return snapshot.withColumn("is_current", F.col(VALID_TO).isNull())


def with_version_key(versions: DataFrame, key: str, name: str = "version_sk") -> DataFrame:
    """Key that is unique per version, next to the entity key shared by all versions."""
    return versions.withColumn(name, surrogate_key(key, VALID_FROM))


def asof_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    version_key: str,
    at: str,
    horizon: Column,
    how: str = "inner",
    span: str | None = "month",
) -> DataFrame:
    """Each fact with the version valid at its time; a fact exactly at ``valid_to`` gets the newer one.

    Versions and facts meet in windows over (key, ``span``), so a hot key is spread over as many
    groups as it has spans with facts. A version lies in the span it starts in; each span with
    facts also gets the last version from before it. Rows in flight are therefore versions
    and facts and at most one row per key and span of facts, however long a version is open.
    ``horizon`` (or later) is the span of all later times; it affects balance, not the result.

    Where a key has few facts, one a day at most, pass ``span=None``: both meet in windows over the key alone. Each
    version and fact then travels once, and what is made of one key's facts needs no rows of other tasks.
    """
    if how not in ("inner", "left"):
        raise ValueError("an as-of join is inner or left")

    def bucket(c: Column) -> Column:
        if span is None:
            return F.lit(None)
        return F.least(F.trunc(F.to_date(c), span), F.trunc(F.to_date(horizon), span))

    groups = ["__key"] if span is None else ["__key", "__span"]
    extra = [c for c in versions.columns if c not in facts.columns]
    # The start leads the struct, so the largest one is the latest version.
    started = versions.select(
        F.col(version_key).alias("__key"),
        bucket(F.col(VALID_FROM)).alias("__span"),
        F.struct(
            F.col(VALID_FROM).alias("__from"),
            F.col(VALID_TO).alias("__to"),
            F.struct(*extra).alias("__row"),
        ).alias("__version"),
    )
    placed = facts.select(
        F.col(key).alias("__key"),
        bucket(F.col(at)).alias("__span"),
        F.col(at).alias("__at"),
        F.struct(*facts.columns).alias("__fact"),
    )
    no_version = F.lit(None).cast(started.schema["__version"].dataType)
    known = started
    if span is not None:
        marks = started.select("__key", "__span", "__version", F.lit(False).alias("__wanted")).unionByName(
            placed.select("__key", "__span", no_version.alias("__version"), F.lit(True).alias("__wanted")).distinct()
        )
        marks = (
            dealt_anew(marks, "__key")
            .groupBy("__key", "__span")
            .agg(F.max("__version").alias("__last"), F.max("__wanted").alias("__wanted"))
        )
        earlier = Window.partitionBy("__key").orderBy("__span").rowsBetween(Window.unboundedPreceding, -1)
        carried = (
            marks.withColumn("__version", F.last("__last", ignorenulls=True).over(earlier))
            .filter("__wanted AND __version IS NOT NULL")
            .select("__key", "__span", "__version")
        )
        known = started.unionByName(carried)
    no_fact = F.lit(None).cast(placed.schema["__fact"].dataType)
    events = known.select(*groups, F.col("__version.__from").alias("__at"), no_fact.alias("__fact"), "__version").unionByName(
        placed.select(*groups, "__at", "__fact", no_version.alias("__version"))
    )
    # At equal times the version comes first: a fact at its start belongs to it.
    order = Window.partitionBy(*groups).orderBy("__at", F.col("__fact").isNotNull())
    found = dealt_anew(events, *groups).withColumn("__version", F.last("__version", ignorenulls=True).over(order)).filter(
        F.col("__fact").isNotNull()
    )
    ended = F.col("__version.__to")
    valid = F.col("__version").isNotNull() & F.col("__key").isNotNull() & (ended.isNull() | (F.col("__at") < ended))
    if span is None:  # as with spans, a version without a start is known in the last month alone
        late = F.trunc(F.to_date("__at"), "month") >= F.trunc(F.to_date(horizon), "month")
        valid = valid & (F.col("__version.__from").isNotNull() | F.coalesce(late, F.lit(True)))
    if how == "inner":
        found = found.filter(valid)
    return found.select(
        "__fact.*", *[F.when(valid, F.col(f"__version.__row.{c}")).alias(c) for c in extra]
    )
