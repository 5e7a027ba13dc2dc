import re
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratavid.operators import quality, sizing
from stratavid.operators.incremental import (
    above_mark,
    append_new_dates,
    evolve_schema,
    incremental_load,
    opens_as,
    unexpired,
    union_promoted,
    upsert,
)
from stratavid.operators.history import scd2_history
from stratavid.operators.latest import daily_latest, first_by_key, latest_by_key
from stratavid.operators.masking import FULL, LIMITED
from stratavid.operators.snapshot import SnapshotRules, clean_channels, silver_snapshot
from stratavid.operators.star import date_dim
from stratavid.operators.tokens import token_dim, token_rows
from stratavid.plans import adhoc, analytics, secure
from stratavid.plans.layers import StoredLayers
from tests.conftest import final_plan, rows_of

RULES = SnapshotRules(
    key="id",
    version="ts",
    columns={"id": "rawId", "title": "rawTitle", "views": "rawViews", "born": "born"},
    texts=("title",),
    counters=("views",),
    times=("born",),
    evidence=("title", "views"),
)
RAW = "rawId string, rawTitle string, rawViews bigint, born timestamp_ntz, ts timestamp_ntz"


def at(text):
    return F.lit(text).cast("timestamp_ntz")


def test_daily_latest_splits_days_at_midnight(frame):
    df = frame(
        "id string, ts timestamp_ntz",
        ("a", "2024-01-01 08:00:00"), ("a", "2024-01-01 23:59:59"), ("a", "2024-01-02 00:00:00"),
        ("b", "2024-01-01 20:00:00"),
    )
    assert rows_of(daily_latest(df, ["id"], "ts")) == [
        ("a", "2024-01-01 23:59:59"), ("a", "2024-01-02 00:00:00"), ("b", "2024-01-01 20:00:00"),
    ]


def test_latest_ties_are_stable_and_nulls_lose(frame):
    df = frame("k string, v int, tie int", ("a", 1, 1), ("a", 1, 2), ("a", None, 9), ("b", None, 1))
    assert rows_of(latest_by_key(df, ["k"], "v", ["tie"])) == [("a", 1, 2), ("b", None, 1)]
    assert rows_of(first_by_key(df, ["k"], ["v", "tie"])) == [("a", 1, 1), ("b", None, 1)]


def test_latest_cuts_hot_keys_before_the_exchange(spark):
    hot = spark.range(0, 30000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    newest = latest_by_key(hot, ["k"], "v")
    plan = newest._jdf.queryExecution().executedPlan().toString()
    before_exchange = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_exchange and "Partial" in before_exchange
    assert newest.filter("k = 0").collect() == [(0, 29997)]


def test_silver_cleans_the_days_newest_row(frame):
    raw = frame(
        RAW,
        ("a", " x ", 5, "2020-01-01", "2024-01-01 08:00:00"),
        ("a", "  ", -1, "2020-01-01", "2024-01-01 20:00:00"),  # newest, but nothing in it
        ("b", " y ", -1, "2030-01-01", "2024-01-01 08:00:00"),
        ("c", "\t", None, None, "2024-01-01 08:00:00"),  # a tab is not blank
        ("d", None, 3, None, "2024-01-02 08:00:00"),
    )
    assert rows_of(silver_snapshot(raw, RULES, at("2024-06-01")), "id", "title", "views", "born") == [
        ("b", "y", None, None), ("c", "\t", None, None), ("d", None, 3, None),
    ]


def test_incremental_load_is_idempotent_and_skips_late_rows(frame):
    first = frame(RAW, ("a", "x", 1, None, "2024-01-01 08:00:00"), ("b", "x", 1, None, "2024-01-01 09:00:00"))
    more = frame(
        RAW,
        ("a", "x", 2, None, "2024-01-01 20:00:00"),  # same day, newer
        ("b", "x", 9, None, "2024-01-01 08:30:00"),  # late: at or below the mark
        ("b", "x", 8, None, "2024-01-01 09:00:00"),  # equal to the mark
        ("c", "x", 3, None, "2024-01-02 08:00:00"),
    )
    clock = at("2024-06-01")
    target = silver_snapshot(first, RULES, clock)
    once = incremental_load(target, first.union(more), RULES, clock)
    expected = [
        ("a", 2, "2024-01-01 20:00:00"), ("b", 1, "2024-01-01 09:00:00"), ("c", 3, "2024-01-02 08:00:00"),
    ]
    assert rows_of(once, "id", "views", "loaded_at") == expected
    twice = incremental_load(once, first.union(more), RULES, clock)
    assert rows_of(twice, "id", "views", "loaded_at") == expected


def test_empty_target_takes_everything(frame):
    raw = frame(RAW, ("a", "x", 1, None, "2024-01-01"))
    empty = silver_snapshot(raw.limit(0), RULES, at("2024-06-01"))
    assert incremental_load(empty, raw, RULES, at("2024-06-01")).count() == 1


def test_mark_reaches_the_scan(spark, frame, tmp_path):
    frame("ts timestamp_ntz, v int", ("2024-01-01", 1), ("2024-01-03", 2)).write.parquet(str(tmp_path / "r"))
    target = frame("loaded_at timestamp_ntz", ("2024-01-02",))
    fresh = above_mark(spark.read.parquet(str(tmp_path / "r")), target, "ts", "loaded_at")
    assert "GreaterThan(ts" in fresh._jdf.queryExecution().executedPlan().toString()
    assert rows_of(fresh, "v") == [(2,)]


def test_upsert_replaces_and_keeps(frame):
    target = frame("id int, day string, v int", (1, "a", 1), (1, "b", 2), (2, "a", 3))
    batch = frame("id int, day string, v int", (1, "b", 20), (3, "a", 30))
    expected = [(1, "a", 1), (1, "b", 20), (2, "a", 3), (3, "a", 30)]
    once = upsert(target, batch, ["id", "day"])
    assert rows_of(once) == expected
    assert rows_of(upsert(once, batch, ["id", "day"])) == expected


def test_schema_evolution(frame):
    old = frame("id int, gone string", (1, "x"))
    new = frame("added string, id int", ("y", 2))
    evolved = evolve_schema(old, new)
    assert evolved.columns == ["added", "id"]
    assert rows_of(evolved) == [("y", 2), (None, 1)]


def test_changed_types_widen_or_raise(frame):
    old = frame("a int, b float, c date, d bigint", (2**31 - 1, 0.5, date(2024, 1, 2), 7))
    new = frame("a bigint, b double, c timestamp_ntz, d string", (2**40, 0.1, "2024-01-03 04:00:00", "x"))
    evolved = evolve_schema(old, new)
    assert evolved.schema == new.schema
    assert rows_of(evolved) == [(2**40, 0.1, "2024-01-03 04:00:00", "x"), (2**31 - 1, 0.5, "2024-01-02 00:00:00", "7")]
    for narrow in ("a short", "b float, a int, c string, d int", "c date, a bigint, d int", "a float"):
        with pytest.raises(TypeError, match="cannot go from"):
            evolve_schema(old, frame(narrow))
    assert opens_as(frame("a int, b float").schema, frame("a bigint, b double, c string").schema)
    assert not opens_as(old.schema, frame("d string").schema)


def test_loads_of_unlike_types_are_put_together(frame):
    one = frame("id int, v string", (1, "2.5")).withColumn("v", F.col("v").cast("decimal(4,1)"))
    two = frame("v bigint, id string, w float", (2**62, "x", 0.5))
    both = union_promoted([one, two])
    assert both.dtypes == [("id", "string"), ("v", "decimal(20,1)"), ("w", "float")]
    assert rows_of(both) == [("1", Decimal("2.5"), None), ("x", Decimal(2**62), 0.5)]
    with pytest.raises(TypeError, match="no type holds"):
        union_promoted([one, frame("v boolean")])


def test_append_new_dates(frame):
    fact = frame("id int, date_key string", (1, "2024-01-01"), (2, "2024-01-02")).withColumn(
        "date_key", F.col("date_key").cast("date")
    )
    built = frame("id int, date_key string", (3, "2024-01-02"), (4, "2024-01-03")).withColumn(
        "date_key", F.col("date_key").cast("date")
    )
    assert rows_of(append_new_dates(fact, built), "id") == [(1,), (2,), (4,)]
    assert rows_of(append_new_dates(fact.limit(0), built), "id") == [(3,), (4,)]


def test_retention(frame):
    df = frame("d string", ("2024-01-01",), ("2024-01-02",)).select(F.col("d").cast("date").alias("d"))
    kept = unexpired(df, "d", F.lit("2024-03-31").cast("date"), 90)
    assert rows_of(kept) == [("2024-01-02",)]


def test_clean_channels(frame):
    df = frame(
        "title string, country string, views bigint, videos bigint",
        ("A topic", "EE", 900, 5), ("A Topic", "ee", 900, 5), (None, "", 900, 5), ("b", None, 900, 5),
        ("c", "LV", 900, 5), ("d", "EE", 900, 0), ("e", "EE", 900, 1001), ("f", "EE", 500, 1000),
    )
    assert rows_of(clean_channels(df), "title") == [("A Topic",), ("b",), ("f",), (None,)]
    assert rows_of(clean_channels(df, min_views=500), "title") == [("A Topic",), ("b",), (None,)]


def test_tokens(frame):
    df = frame("id int, tags string", (1, "a, b,,a "), (2, ""), (3, None), (4, "  "), (5, "b"))
    assert rows_of(token_rows(df, "tags", "tag")) == [(1, "a"), (1, "a"), (1, "b"), (5, "b")]
    dim = token_dim(df, "tags", "tag_id", "tag")
    assert rows_of(dim, "tag") == [("a",), ("b",)]
    assert dim.select("tag_id").distinct().count() == 2


def test_date_dim(spark):
    days = date_dim(spark, at("2005-01-09"))
    assert days.count() == 9
    assert rows_of(days.filter("is_weekend"), "date_key", "week_day") == [
        ("2005-01-01", 6), ("2005-01-02", 7), ("2005-01-08", 6), ("2005-01-09", 7),
    ]


def test_checks(frame):
    df = frame("k int, v int", (1, -1), (1, None), (None, 5), (2, 7), (None, 20))
    found = quality.row_checks(
        df,
        [
            quality.not_null("k"),
            quality.accepted_range("v", 0, 10, quality.WARN),
            quality.expression_is_true("v < 10", "v"),
            quality.expression_is_true("v < 10", "v_known", nulls_fail=True),
        ],
    )
    assert [r.failing_rows for r in found.collect()] == [2, 2, 1, 2]
    assert quality.unique(df, "k").first().failing_rows == 1
    parent = frame("id int", (1,))
    assert quality.relationships(df, "k", parent, "id").first().failing_rows == 1
    assert quality.relationships(df.limit(0), "k", parent, "id").first().failing_rows == 0
    assert rows_of(quality.row_checks(df.limit(0), [quality.not_null("k")]), "failing_rows") == [(0,)]


def test_only_errors_raise(frame):
    df = frame("k int", (None,))
    quality.enforce(quality.row_checks(df, [quality.not_null("k", quality.WARN)]))
    with pytest.raises(quality.DataCheckError, match="not_null"):
        quality.enforce(quality.row_checks(df, [quality.not_null("k")]))


def facts(frame, *rows):
    df = frame(
        "video_sk string, date_key string, view_count bigint, like_count bigint, comment_count bigint", *rows
    )
    return df.withColumn("date_key", F.col("date_key").cast("date"))


def test_latest_viewed_looks_back_over_rows_without_views(frame):
    fact = facts(
        frame,
        ("a", "2024-01-01", 10, 4, 1), ("a", "2024-01-02", 0, 5, 5), ("b", "2024-01-01", 0, 5, 0),
        ("c", "2024-01-01", 4, None, 1),
    )
    assert rows_of(analytics.latest_viewed(fact)) == [("a", 0.5), ("c", 0.25)]


def test_equal_titles_merge_only_in_the_open_report(frame):
    fact = frame("channel_sk string, date_key string, views bigint", ("a", "1", 5), ("b", "1", 7))
    dim = frame("channel_sk string, title string, is_current boolean", ("a", "t", True), ("b", "t", True))
    assert rows_of(analytics.top_channels(fact, dim)) == [("t", 12)]
    assert rows_of(secure.top_channels(fact, dim, FULL)) == [("t", 5), ("t", 7)]
    masked = secure.top_channels(fact, dim, LIMITED, "salt")
    assert masked.columns == ["channel_title_masked", "views"]
    assert len({r[0] for r in masked.collect()}) == 1 and masked.first()[0] != "t"


def test_closed_versions_do_not_multiply_rows(frame):
    fact = facts(frame, ("a", "2024-01-01", 10, 0, 0))
    dim = frame(
        "video_sk string, title string, category_name string, valid_from string, is_current boolean",
        ("a", "old", None, "1", False), ("a", "new", None, "2", True),
    )
    assert rows_of(secure.top_videos(fact, dim, FULL)) == [("new", None, 10)]
    assert secure.top_videos(fact, dim, FULL, every_version=True).count() == 2
    hidden = secure.top_videos(fact, dim, LIMITED, "salt")
    assert hidden.columns == ["video_title_masked", "category_title_masked", "view_count"]
    assert hidden.first()[1] == "***"


def test_rates_without_views_come_last(frame):
    videos = frame(
        "tags string, like_count bigint, comment_count bigint, view_count bigint",
        ("a, b", 5, None, 0), ("b", 1, 1, 4), (None, 9, 9, 1),
    )
    assert [tuple(r) for r in adhoc.tag_engagement(videos).collect()] == [("b", 7 / 4), ("a", None)]


def test_hot_join_key_is_split(spark, frame):
    """A third of the rows under one key: AQE cuts the hot partition, the result stays whole."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 60000, 1, 8).select(
            F.concat(F.lit("k"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000)).alias("k"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        dim = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("sk"))
        joined = rows.join(dim, "k")
        assert "skew=true" in final_plan(joined)
        assert joined.count() == 60000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_snapshot_and_its_history_share_one_exchange(frame):
    """The snapshot deals its rows by entity, unsorted; versions of the entity need no exchange more."""
    rules = SnapshotRules(key="id", version="ts", columns={"id": "id", "v": "v"}, tiebreak=("v", "tie"))
    raw = frame(
        "id string, v int, tie int, ts timestamp_ntz",
        ("a", 1, 1, "2024-01-01 08:00:00"), ("a", 2, 2, "2024-01-01 08:00:00"), ("a", 2, 0, "2024-01-02"), ("b", None, 1, "2024-01-01"),
    )
    daily = silver_snapshot(raw, rules, F.lit("2024-02-01").cast("timestamp_ntz"))
    assert daily.columns == ["id", "v", "loaded_at", "date_key"]
    versions = scd2_history(daily, ["id"], "loaded_at", ["v"], daily=True)
    assert rows_of(versions, "id", "v", "valid_to") == [("a", 2, None), ("b", None, None)]
    assert versions._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_snapshots_are_dealt_wider_the_more_they_read(spark, tmp_path, monkeypatch):
    """A task sorts a bounded share of the input, whatever the session's shuffle width."""
    raw = spark.range(4000).select(
        F.concat(F.lit("k"), F.col("id") % 50).alias("rawId"), F.sha2(F.col("id").cast("string"), 256).alias("rawTitle"),
        F.col("id").alias("rawViews"), F.lit("2024-01-01").cast("timestamp_ntz").alias("born"),
        F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, int(id % 90))").alias("ts"),
    )
    raw.repartition(1).write.parquet(f"{tmp_path}/raw")
    stored = spark.read.parquet(f"{tmp_path}/raw")
    size = sizing.input_bytes(stored)
    assert size > 0 and sizing.input_bytes(stored.unionByName(stored).filter("rawViews > 1")) == size
    assert sizing.input_bytes(spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "a int")) == 0

    def snapshot():
        return silver_snapshot(stored, RULES, at("2024-06-01"))

    def width(df):
        return re.findall(r"hashpartitioning\(id#\d+, (\d+)\)", df._jdf.queryExecution().executedPlan().toString())

    assert width(snapshot()) == ["4"]  # the session's width
    few = rows_of(snapshot().drop("rawViews"), "id", "date_key")
    monkeypatch.setattr(sizing, "PARTITION_BYTES", 10_000)
    assert width(snapshot()) == [str(-(-size // 10_000))] and size > 50_000
    assert rows_of(snapshot(), "id", "date_key") == few


def test_written_layers_deal_daily_rows_by_the_size_of_their_files(spark, tmp_path, monkeypatch):
    """Rows that shrink much in a shuffle are not joined into a few large sorts."""
    spark.range(4000).selectExpr("concat('v', id % 50) AS video_id", "sha2(cast(id AS string), 256) AS title").repartition(
        1
    ).write.parquet(f"{tmp_path}/days")
    layers = StoredLayers(spark, "")
    layers.stg_videos = spark.read.parquet(f"{tmp_path}/days")
    monkeypatch.setattr(sizing, "PARTITION_BYTES", 10_000)
    width = -(-sizing.input_bytes(layers.stg_videos) // 10_000)
    assert width > 4 and layers.star_videos.rdd.getNumPartitions() == width
    assert rows_of(layers.star_videos) == rows_of(layers.stg_videos) and layers.listed_videos is layers.stg_videos
