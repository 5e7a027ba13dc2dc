import shutil
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from stratavid.operators.history import merge_late
from stratavid.operators.latest import daily_latest
from stratavid.operators.quality import KeyCheck, check_entries, check_state, not_null, verdicts
from stratavid.operators.sizing import broadcast_small
from stratavid.plans import catalog, gold
from stratavid.plans.layers import Layers
from stratavid.plans.raw import CHANNEL_TIEBREAK, VIDEO_TIEBREAK
from stratavid.plans import silver
from stratavid.plans.warehouse import Warehouse
from stratavid.schemas import RAW_CHANNELS, RAW_VIDEOS
from stratavid.session import shared_folder
from stratavid.sources import sinks
from stratavid.sources.sinks import descriptions, touched_months
from stratavid.streaming.ingest import landed_files, star_stream
from tests.conftest import final_plan, rows_of
from tests.test_oracle import SF_DIR

SPLIT = "2000-06-01"
QUESTIONS = (
    "top_10_channels", "top_10_videos", "popular_keywords", "duration_view_corr", "tag_engagement",
    "category_performance", "top_categories", "optimal_length", "secure_top_videos",
    "masked_top_channels",
)


def before(df):
    return df.filter(F.col("ts") < F.lit(SPLIT).cast("timestamp_ntz"))


@pytest.fixture(scope="module")
def layers(spark):
    return Layers(spark, SF_DIR)


@pytest.fixture(scope="module")
def warehouse(spark, layers, tmp_path_factory):
    """Built up to the split, then refreshed with the rest."""
    built = Warehouse(spark, str(tmp_path_factory.mktemp("warehouse")))
    built.build(
        before(layers.raw_channels), before(layers.raw_videos), layers.as_of, CHANNEL_TIEBREAK, VIDEO_TIEBREAK
    )
    args = (layers.raw_channels, layers.raw_videos, layers.as_of, "day1", CHANNEL_TIEBREAK, VIDEO_TIEBREAK)
    built.refresh(*args)
    return built


@pytest.mark.parametrize("name", ["stg_channels", "stg_videos", "dim_channel", "dim_keyword", "dim_tag",
                                  "fact_channel_metrics", "fact_video_performance"])
def test_refresh_equals_rebuild(warehouse, layers, name):
    stored, derived = getattr(warehouse, name), getattr(layers, name)
    cols = sorted(derived.columns)
    assert rows_of(stored, *cols) == rows_of(derived, *cols)


def test_refresh_extends_versions(warehouse, layers):
    cols = [c for c in layers.dim_video.columns]
    assert rows_of(warehouse.dim_video, *cols) == rows_of(layers.dim_video, *cols)


def test_current_bridges(warehouse, layers):
    for name in ("bridge_channel_keyword", "bridge_video_tag"):
        keys = [c for c in getattr(layers, name).columns if c.endswith(("_sk", "_id"))]
        stored = getattr(warehouse, name).filter("is_current")
        assert rows_of(stored, *keys) == rows_of(getattr(layers, name), *keys)


@pytest.mark.parametrize("name", QUESTIONS)
def test_questions_on_stored_tables(spark, warehouse, name):
    stored = catalog.ask(name, warehouse).collect()
    assert stored == catalog.queries()[name](spark, SF_DIR).collect()


def test_repeated_refresh_changes_nothing(warehouse, layers):
    names = ("stg_videos", "dim_video", "bridge_video_tag", "fact_video_performance")
    counts = {n: getattr(warehouse, n).count() for n in names}
    warehouse.refresh(
        layers.raw_channels, layers.raw_videos, layers.as_of, "day2", CHANNEL_TIEBREAK, VIDEO_TIEBREAK
    )
    assert {n: getattr(warehouse, n).count() for n in names} == counts


def test_declared_checks(warehouse):
    report = warehouse.check()
    assert report.count() == 59
    failing = {(r.table, r.column) for r in report.collect() if r.failing_rows}
    assert failing == {("stg_channels", "channel_id"), ("stg_videos", "video_id")}


def test_current_rows_are_read_from_their_partition(warehouse):
    for dim in (warehouse.dim_channel, warehouse.dim_video, warehouse.bridge_video_tag):
        plan = dim.filter("is_current")._jdf.queryExecution().executedPlan().toString()
        assert "(state#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_upsert_reads_only_touched_months(spark, warehouse):
    stored = spark.read.parquet(warehouse.path("stg_videos"))
    batch = warehouse.stg_videos.filter("date_key = '2000-03-03'")
    plan = touched_months(stored, batch, "date_key")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_broadcast_is_for_small_sides(layers):
    plan = broadcast_small(layers.categories)._jdf.queryExecution().analyzed().toString()
    assert "strategy=broadcast" in plan
    orders = layers.source("orders")
    assert broadcast_small(orders, limit=10) is orders


def test_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_folder(spark, "/some/share/") == (named or "/some/share")
    if named is None:
        with pytest.raises(ValueError):
            shared_folder(spark)


@pytest.fixture(scope="module")
def landed(spark):
    """Channel and video rows of a small world: (id, title, list, views, time); videos are of channel c1."""

    def build(channels, videos):
        out = []
        for rows, names, schema in (
            (channels, ("channelId", "title", "keywords", "views", "ts"), RAW_CHANNELS),
            (videos, ("videoId", "title", "tags", "viewCount", "ts"), RAW_VIDEOS),
        ):
            kinds = ", ".join(f"{n} {'bigint' if n[:4] == 'view' else 'string'}" for n in names)
            df = spark.createDataFrame(rows, kinds).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
            if schema is RAW_VIDEOS:
                df = df.withColumn("channelId", F.lit("c1"))
            out.append(df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in df.columns}))
        return out

    return build


CLOCK = "2024-06-01"
TABLES = (
    "stg_channels", "stg_videos", "dim_channel", "dim_video", "dim_date", "dim_keyword", "dim_tag",
    "bridge_channel_keyword", "bridge_video_tag", "fact_channel_metrics", "fact_video_performance",
)
DAY1 = [("c1", "t", "k", 1, "2024-01-01 08:00:00")], [("v1", "A", "x, y", 1, "2024-01-01 08:00:00")]
DAY2 = (
    [*DAY1[0], ("c1", "t", "k, l", 2, "2024-01-02 08:00:00")],
    [*DAY1[1], ("v1", "B", "x, y", 2, "2024-01-02 08:00:00"), ("v2", "N", "z", 1, "2024-01-02 09:00:00")],
)
DAY3 = [*DAY2[0], ("c1", "t", "k, l", 3, "2024-02-03 08:00:00")], [*DAY2[1], ("v1", "C", "y", 3, "2024-02-03 20:00:00")]


def clock():
    return F.lit(CLOCK).cast("timestamp_ntz")


def contents(store, current=False):
    """All tables as rows; of versions only what a rebuild gives too, their keys and whether they are open."""
    out = {}
    for name in TABLES:
        df = getattr(store, name)
        cols = sorted(c for c in df.columns if not (name.startswith("bridge") and c.startswith("valid")))
        df = df.filter("is_current") if name.startswith("bridge") or (current and "is_current" in df.columns) else df
        out[name] = rows_of(df, *cols)
    return out


@pytest.fixture(scope="module")
def built(spark, landed, tmp_path_factory):
    """A store of each day's rows, built once; tests that write take a copy."""
    stores = {}

    def get(day):
        key = len(day[1])
        if key not in stores:
            stores[key] = Warehouse(spark, str(tmp_path_factory.mktemp("built") / "w"), buckets=4)
            stores[key].build(*landed(*day), clock())
        return stores[key]

    return get


@pytest.fixture
def copy(spark, built, tmp_path):
    def get(day):
        root = tmp_path / "w"
        shutil.copytree(built(day).root, root)
        return Warehouse(spark, str(root), buckets=4)

    return get


def test_one_load_name_used_twice_loses_nothing(copy, landed, built):
    store = copy(DAY1)
    store.refresh(*landed(*DAY2), clock(), "history")
    store.refresh(*landed(*DAY3), clock(), "history")
    assert contents(store) == contents(built(DAY3))
    assert rows_of(store.dim_video.filter("video_id = 'v1'"), "title", "is_current") == [
        ("A", False), ("B", False), ("C", True)
    ]
    store.check()


@pytest.mark.parametrize("step, published", [("snapshot_video", False), ("bridge_video_tag", True)])
def test_a_run_cut_off_is_finished_by_the_next(spark, copy, landed, built, step, published, monkeypatch):
    """Cut off right after a step's result is written aside, or right after it is published."""
    store = copy(DAY1)
    note, publish, by_month = Warehouse._note, sinks.publish, sinks.write_by_month

    def dying(write):
        def run(rows, path, *args, **kwargs):
            write(rows, path, *args, **kwargs)
            if path.endswith(step):
                raise KeyboardInterrupt

        return run

    def dying_note(self, run, name, text=""):
        note(self, run, name, text)
        if name == step:
            raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        if published:
            patch.setattr(sinks, "publish", dying(publish))
            patch.setattr(sinks, "write_by_month", dying(by_month))
        else:
            patch.setattr(Warehouse, "_note", dying_note)
        with pytest.raises(KeyboardInterrupt):
            store.refresh(*landed(*DAY2), clock(), "day2")
    again = Warehouse(spark, store.root, buckets=4)
    again.refresh(*landed(*DAY3), clock(), "day3")
    assert contents(again) == contents(built(DAY3))


def test_a_rebuild_replaces_all_months_and_a_cut_off_one_none(spark, copy, landed, built, monkeypatch):
    store = copy(DAY3)
    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "_publish_calendar", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            store.build(*landed(*DAY1), clock())
    assert contents(Warehouse(spark, store.root, buckets=4)) == contents(built(DAY3))
    store.build(*landed(*DAY1), clock())
    assert contents(Warehouse(spark, store.root, buckets=4)) == contents(built(DAY1))


def test_a_correction_on_a_stored_day_closes_what_it_withdraws(copy, landed):
    evening = DAY1[0], [*DAY1[1], ("v1", "A", "y", 1, "2024-01-01 20:00:00")]
    store = copy(DAY1)
    before = {r.tag_name: r.tag_id for r in store.dim_tag.collect()}
    store.refresh(*landed(*evening), clock(), "evening")
    assert rows_of(store.bridge_video_tag, "tag_id", "is_current") == sorted(
        [(before["x"], False), (before["y"], True)] + [(before["y"], False)], key=repr
    )
    store.check()


def test_a_full_snapshot_closes_what_it_lacks(copy, landed):
    store = copy(DAY2)
    third = DAY2[0] + [("c1", "t", "l", 3, "2024-01-03 08:00:00")], DAY2[1] + [("v1", "B", "x", 3, "2024-01-03 08:00:00")]
    store.refresh(*landed(*third), clock(), "day3", full_snapshot=True)
    assert rows_of(store.dim_video.filter("is_current"), "video_id") == [("v1",)]
    assert rows_of(store.dim_video.filter("video_id = 'v2'"), "valid_to") == [("2024-06-01 00:00:00",)]
    assert store.bridge_video_tag.filter("is_current").count() == 1
    assert store.bridge_channel_keyword.filter("is_current").count() == 1


def test_stored_tables_take_new_columns_and_drop_old_ones(spark, copy, landed):
    store = copy(DAY1)
    columns = {k: v for k, v in silver.VIDEO_RULES.columns.items() if k != "caption"} | {"extra": "title"}
    later = Warehouse(spark, store.root, buckets=4, video_rules=replace(silver.VIDEO_RULES, columns=columns))
    rows = later._silver("stg_videos", landed(*DAY2)[1], clock(), ())
    later._upsert("r-test", "stg_videos", rows.filter("date_key = '2024-01-02'"), ["video_id", "date_key"], "video_id")
    plain = Warehouse(spark, store.root, buckets=4).stg_videos
    assert "caption" not in plain.columns
    assert rows_of(plain, "date_key", "extra") == [("2024-01-01", None), ("2024-01-02", "B"), ("2024-01-02", "N")]


def test_stored_columns_become_wider_over_all_months(copy, landed):
    store = copy(DAY1)
    later = DAY2[0], [("v1", "C", "y", 3, "2024-02-03 20:00:00")]
    rows = store._silver("stg_videos", landed(*later)[1], clock(), ())
    text = rows.withColumn("view_count", F.col("view_count").cast("string"))
    keys = ["video_id", "date_key"]
    store._upsert("r-text", "stg_videos", text, keys, "video_id")
    assert dict(store.stg_videos.dtypes)["view_count"] == "string"
    assert rows_of(store.stg_videos, "date_key", "view_count")[-1][0] == "2024-02-03"
    assert all(v is None or isinstance(v, str) for (v,) in rows_of(store.stg_videos, "view_count"))
    with pytest.raises(TypeError, match="view_count cannot go from string"):
        store._upsert("r-number", "stg_videos", rows, keys, "video_id")


def test_facts_of_a_refresh_join_touched_buckets_only(copy, landed, monkeypatch):
    store, read = copy(DAY2), []
    kept = store._touched_versions
    monkeypatch.setattr(store, "_touched_versions", lambda *a: read.append(kept(*a)) or read[-1])
    store.refresh(*landed(DAY2[0], [*DAY2[1], ("v1", "C", "y", 3, "2024-02-03 20:00:00")]), clock(), "day3")
    assert len(read) == 5  # two for bridges, three for facts
    current = store.dim_video.filter("is_current")
    assert store.fact_video_performance.join(current, "video_sk").filter("date_key = '2024-02-03'").count() == 1


def test_a_daily_load_touches_its_month_and_buckets_only(spark, copy, landed):
    store = copy(DAY2)

    def files(name):
        return {r[0]: r[1] for r in spark.read.parquet(store.path(name)).selectExpr("_metadata.file_path AS p", "_metadata.file_modification_time AS t").distinct().collect()}

    names = ("stg_videos", "fact_video_performance", "snapshot_video", "bridge_video_tag")
    before = {n: files(n) for n in names}
    later = DAY2[0], [*DAY2[1], ("v1", "C", "y", 3, "2024-02-03 20:00:00")]
    store.refresh(*landed(*later), clock(), "day3")
    for name in names:
        kept = {p for p in before[name] if p in files(name)}
        changed = set(before[name]) - kept
        if "/yyyymm=" in next(iter(before[name])):
            assert not changed  # old months are as they were
        else:
            assert len({p.split("/part=")[1].split("/")[0] for p in changed}) == 1


def test_columns_are_described(warehouse):
    assert descriptions(warehouse.dim_video)["valid_to"].startswith("Observation or load")
    assert "version_sk" in descriptions(warehouse.dim_channel)
    assert set(descriptions(warehouse.fact_channel_metrics)) == {"id", "channel_sk", "date_key"}


def test_last_day_can_be_restated(spark, frame, tmp_path):
    """A second load on a day updates the snapshot; the fact follows only on request."""
    def channels(*rows):
        raw = frame("channelId string, views bigint, ts timestamp_ntz", *rows)
        others = {f.name: F.lit(None).cast(f.dataType) for f in RAW_CHANNELS if f.name not in raw.columns}
        return raw.withColumns({**others, "keywords": F.lit("k"), "title": F.lit("t")})

    def videos(*rows):
        raw = frame("videoId string, channelId string, viewCount bigint, ts timestamp_ntz", *rows)
        others = {f.name: F.lit(None).cast(f.dataType) for f in RAW_VIDEOS if f.name not in raw.columns}
        return raw.withColumns({**others, "tags": F.lit("x"), "title": F.lit("t")})

    store = Warehouse(spark, str(tmp_path / "w"))
    clock = F.lit("2024-06-01").cast("timestamp_ntz")
    morning = ("v1", "c1", 1, "2024-01-01 08:00:00"), ("v1", "c1", 2, "2024-01-01 20:00:00")
    one, two = ("c1", 1, "2024-01-01 08:00:00"), ("c1", 5, "2024-01-01 20:00:00")
    store.build(channels(one), videos(morning[0]), clock)
    store.refresh(channels(one, two), videos(*morning), clock, "evening")
    assert rows_of(store.stg_channels, "total_views") == [(5,)]
    assert rows_of(store.fact_channel_metrics, "views") == [(1,)]
    three = ("c1", 9, "2024-01-01 22:00:00")
    store.refresh(
        channels(one, two, three), videos(*morning), clock, "night",
        restate_last_day=True, version_per_sighting=True,
    )
    assert rows_of(store.fact_channel_metrics, "views") == [(9,)]
    bridge = rows_of(store.bridge_channel_keyword, "valid_from", "valid_to")
    assert bridge == [
        ("2024-01-01 08:00:00", "2024-01-01 22:00:00"), ("2024-01-01 22:00:00", None),
    ]
    assert rows_of(store.dim_channel, "valid_from", "valid_to") == [("2024-01-01 08:00:00", None)]


# --- streams, expiry, compaction and files of a store ---


def land_days(landed, folder):
    """The rows of each day as one file per side, in order of time."""
    for first, days in zip(("", "2024-01-02"), ("2024-01-02", "9999")):
        for name, df in zip(("channels", "videos"), landed(*DAY2)):
            df.filter((F.col("ts") >= (first or "2000-01-01")) & (F.col("ts") < days)).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def test_streams_fed_file_by_file_equal_a_build(spark, copy, landed, built, tmp_path):
    """Two micro-batches a side, all replayed once more: the first holds what is stored already."""
    store = copy(DAY1)
    land_days(landed, tmp_path)
    for attempt in ("first", "replayed"):
        for kind in ("channel", "video"):
            rows = spark.read.parquet(f"{tmp_path}/{kind}s").schema
            stream = landed_files(spark, f"{tmp_path}/{kind}s", rows, files_per_batch=1)
            star_stream(stream, kind, store, clock(), f"{tmp_path}/{attempt}-{kind}").awaitTermination()
    assert contents(store) == contents(built(DAY2))
    assert len([r for r in store.log() if r.step == "done"]) == 4  # two batches a side, none twice
    assert store.late_rows("stg_videos").select("videoId", "batch").collect() == [("v1", "video-0")]


def test_a_batch_cut_off_is_finished_when_it_is_replayed(spark, copy, landed, built, monkeypatch):
    store, step = copy(DAY1), "bridge_video_tag"
    staged = Warehouse._staged

    def cut(self, run, name, make):
        if name == step:
            raise RuntimeError("cut off")
        return staged(self, run, name, make)

    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "_staged", cut)
        with pytest.raises(RuntimeError, match="cut off"):
            store.take_batch("b-1", *landed(*DAY2), clock())
    store = Warehouse(spark, store.root, buckets=4)
    assert store.take_batch("b-1", *landed(*DAY2), clock()) is False  # finished, then passed over
    assert contents(store) == contents(built(DAY2))


def test_rows_that_come_too_late_are_set_aside_and_merged(copy, landed):
    store = copy(DAY2)
    late = landed([], [("v1", "L", "x", 9, "2024-01-01 20:00:00"), ("v9", "N", "x", 1, "2023-12-01 20:00:00")])[1]
    assert store.take_batch("late", None, late, clock()) is True
    assert rows_of(store.late_rows("stg_videos"), "videoId") == [("v1",), ("v9",)]
    history = store._versions("snapshot_video").drop("is_current")
    rows = gold.video_snapshot_rows(store._silver("stg_videos", store.late_rows("stg_videos"), clock(), ()))
    stored = gold.video_snapshot_rows(store.stg_videos)
    seen = daily_latest(stored.unionByName(rows.select(*stored.columns)), ["video_id"], "loaded_at")
    merged = merge_late(history, rows, seen, ["video_id"], "loaded_at", gold.VIDEO_CHECKS)
    assert rows_of(merged, "video_id", "title", "valid_from", "valid_to") == [
        ("v1", "B", "2024-01-02 08:00:00", None), ("v1", "L", "2024-01-01 20:00:00", "2024-01-02 08:00:00"),
        ("v2", "N", "2024-01-02 09:00:00", None), ("v9", "N", "2023-12-01 20:00:00", None),
    ]


def test_expiry_and_compaction_of_a_store(copy):
    store = copy(DAY3)
    assert store.expire(F.lit("2024-04-20").cast("date"), 90) == {"stg_channels": ["202401"], "stg_videos": ["202401"]}
    assert rows_of(store.stg_videos, "date_key") == [("2024-02-03",)]
    assert store.dim_video.filter("video_id = 'v1'").count() == 3  # history keeps its versions
    assert store.compact() == {"stg_channels": {}, "stg_videos": {}}
    with pytest.raises(ValueError, match="expire"):
        store.expire(clock(), tables=("dim_video",))


def test_files_lists_every_generation(copy, landed):
    store = copy(DAY1)
    store.build(*landed(*DAY3), clock())
    lines = store.files().collect()
    assert len({r["generation"] for r in lines}) == 2 and {r["generation"] for r in lines if r["current"]} == {store.generation}
    videos = [r["rows"] for r in lines if r["table"] == "stg_videos"]
    assert videos == [1, 4] and all(r["bytes"] > 0 and r["data_files"] > 0 for r in lines)
    assert {r["path"] for r in lines if r["current"] and r["table"] == "stg_videos"} == {store.path("stg_videos")}


def test_check_states_of_parts_add_up_and_each_table_is_scanned_once(spark, frame, tmp_path):
    fact = frame("id string, channel_sk string, day string",
                 ("1", "a", "2024-01-01"), ("1", "b", "2024-02-01"), ("2", None, "2024-01-01"), (None, "z", "2024-02-01"))
    dim = frame("channel_sk string, n int", ("a", 1), ("b", None))
    for name, df in (("fact", fact), ("dim", dim)):
        df.write.parquet(str(tmp_path / name))
    fact, dim = (spark.read.parquet(str(tmp_path / n)) for n in ("fact", "dim"))
    keys = [KeyCheck("id"), KeyCheck("channel_sk", "warn", "r")]
    declared = [("fact", [not_null("id")], keys), ("dim", [not_null("n")], [])]

    def entries(part):
        return check_entries("fact", part, *declared[0][1:])

    parents = check_entries("dim", dim, declared[1][1], [], {"r": "channel_sk"})
    whole = verdicts(check_state(entries(fact).unionByName(parents)), declared)
    assert rows_of(whole) == [
        ("dim", "not_null", "n", "error", 1), ("fact", "not_null", "id", "error", 1),
        ("fact", "relationships", "channel_sk", "warn", 1), ("fact", "unique", "id", "error", 1),
    ]
    assert final_plan(whole).split("Initial Plan")[0].count("Scan parquet") == 2
    parts = [check_state(entries(fact.filter(F.col("day") == d))) for d in ("2024-01-01", "2024-02-01")]
    merged = check_state(parts[0].unionByName(parts[1]).unionByName(check_state(parents)))
    assert rows_of(verdicts(merged, declared)) == rows_of(whole)
