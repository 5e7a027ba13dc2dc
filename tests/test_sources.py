import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratavid.functions import parse_timestamp
from stratavid.operators.history import merge_open
from stratavid.schemas import (
    CATEGORIES,
    CHANNELS_CSV,
    RAW_CHANNELS,
    RAW_VIDEOS,
    VIDEO_BATCH_CSV,
    VIDEOS_CSV,
)
from stratavid.sources import sinks
from stratavid.sources.files import (
    category_seed,
    coerce_channels_csv,
    coerce_videos_csv,
    fill_load_time,
    read_csv,
    read_csv_infer,
    read_many_csv,
    read_parquet,
    read_table_latest,
    read_video_batches,
    rejected_rows,
    tolerant_parse,
    union_batches,
)
from stratavid.sources.payloads import (
    flatten_channel_payload,
    flatten_video_payload,
    payload_items,
    rejected_items,
    rejected_payloads,
)
from tests.conftest import final_plan, rows_of


def at(text):
    return F.lit(text).cast("timestamp_ntz")


def landed(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


CHANNEL_CSV = (
    ",".join(CHANNELS_CSV.names) + "\n"
    'c1,"A ""quoted"" title","two\nlines",@a,12.7,abc,5,True,2020-01-02T03:04:05Z,EE,,"x, y",UU1,,tallinn\n'
    "c2,,,,,100,,no,never,,et,,,,\n"
)


def test_channel_csv_is_coerced(spark, tmp_path):
    text = read_csv(spark, landed(tmp_path, "channels.csv", CHANNEL_CSV), CHANNELS_CSV)
    rows = coerce_channels_csv(text, at("2024-06-01 12:00:00"))
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in RAW_CHANNELS]
    first, second = sorted(rows.collect(), key=lambda r: r.channelId)
    assert (first.title, first.description, first.subscribers, first.views, first.hiddenSubscribers) == (
        'A "quoted" title', "two\nlines", 12, 0, True,
    )
    assert str(first.publishedAt) == "2020-01-02 03:04:05" and first.keywords == "x, y"
    assert (second.title, second.subscribers, second.views, second.videos) == ("", 0, 100, 0)
    # A time that cannot be read becomes the load time.
    assert str(second.publishedAt) == "2024-06-01 12:00:00" and str(second.loaded_at) == "2024-06-01"


def test_video_csv_is_coerced(spark, tmp_path):
    line = "v1,t,2020-01-02,\"['a', 'b']\",10,c1,PT5M,hd,yes,0,,7,x,,public,cc,\n"
    text = read_csv(spark, landed(tmp_path, "v.csv", ",".join(VIDEOS_CSV.names) + "\n" + line), VIDEOS_CSV)
    rows = coerce_videos_csv(text, at("2024-06-01"))
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in RAW_VIDEOS]
    [row] = rows.collect()
    assert (row.categoryId, row.caption, row.licensedContent, row.viewCount, row.likeCount) == (
        10, True, False, 7, 0,
    )


def test_inferred_csv(spark, tmp_path):
    inferred = read_csv_infer(spark, landed(tmp_path, "i.csv", "a,b\n1,x\n2,y\n"))
    assert dict(inferred.dtypes) == {"a": "int", "b": "string"}


def test_many_csv_and_union(spark, frame, tmp_path):
    paths = [
        landed(tmp_path, f"b{i}.csv", f"category_id,category_name\n{i},n{i}\n") for i in range(3)
    ]
    assert read_many_csv(spark, paths[0], paths[1:], CATEGORIES).count() == 3
    united = union_batches([frame("a int, b int", (1, 2)), frame("b int", (3,))])
    assert rows_of(united, "a", "b") == [(1, 2), (None, 3)]


def test_category_seed(spark, tmp_path):
    seed = category_seed(spark)
    assert seed.count() == 15 and seed.filter("category_id = 10").first().category_name == "Music"
    path = landed(tmp_path, "seed.csv", "category_id,category_name\n7,Seven\n")
    assert rows_of(category_seed(spark, path)) == [(7, "Seven")]


def test_tolerant_parse(frame):
    text = frame("id string, n string, t string", ("a", "1", "2024-01-01"), ("b", "x", ""), ("c", "", "soon"), ("d", None, None))
    conversions = {"n": F.col("n").try_cast("bigint"), "t": parse_timestamp("t")}
    assert rows_of(tolerant_parse(text, conversions)) == [
        ("a", 1, "2024-01-01 00:00:00"), ("d", None, None),
    ]
    assert rows_of(rejected_rows(text, conversions), "id") == [("b",), ("c",)]


def test_channel_payload_defaults(frame):
    body = {
        "items": [
            {
                "id": "c1",
                "snippet": {"title": "T", "description": "d" * 600, "publishedAt": "2020-01-01T00:00:00Z"},
                "statistics": {"viewCount": "12345678901", "hiddenSubscriberCount": True},
                "brandingSettings": {"channel": {"keywords": "k1, k2"}},
                "contentDetails": {"relatedPlaylists": {"uploads": "UU1"}},
                "topicDetails": {"topicCategories": ["u1", "u2"]},
            },
            {"id": "c2"},
        ]
    }
    payloads = frame("j string", (json.dumps(body),), ("{}",))
    one, two = flatten_channel_payload(payloads, "j", at("2024-06-01")).collect()
    assert (one.views, one.subscribers, one.hiddenSubscribers, one.topics) == (12345678901, 0, True, "u1, u2")
    assert len(one.description) == 500 and one.keywords == "k1, k2" and one.uploadsPlaylistId == "UU1"
    assert (two.title, two.views, two.hiddenSubscribers, two.topics, two.country) == ("", 0, False, "", "")
    assert str(two.publishedAt) == "2024-06-01 00:00:00"


def test_payload_rejects(frame):
    good = json.dumps({"items": [{"id": "c1"}, {"id": "c2"}]})
    payloads = frame("n int, j string", (1, good), (2, good[:-3]), (3, "{}"), (4, None), (5, '{"items": []}'), (6, ""))
    assert rows_of(rejected_payloads(payloads, "j", "channel"), "n", "reason") == [
        (2, "malformed"), (3, "no items"), (4, "malformed"), (5, "no items"), (6, "malformed"),
    ]
    for flatten in (flatten_channel_payload, flatten_video_payload):
        assert flatten(payloads, "j", at("2024-06-01")).count() == 2
    long = json.dumps({"items": [{"id": "c", "snippet": {"description": "d" * 700}}]})
    whole = flatten_channel_payload(frame("j string", (long,)), "j", at("2024-06-01"), description_length=None)
    assert len(whole.first().description) == 700


def test_video_payload_defaults(frame):
    body = {
        "items": [
            {
                "id": "v1",
                "snippet": {"tags": ["a", "b"], "categoryId": "10", "channelId": "c1"},
                "contentDetails": {
                    "duration": "PT5M", "caption": "true", "licensedContent": True,
                    "regionRestriction": {"blocked": ["DE"]},
                },
                "statistics": {"viewCount": "7"},
                "status": {"privacyStatus": "public"},
            },
            {"id": "v2", "contentDetails": {"caption": "false"}},
        ]
    }
    one, two = flatten_video_payload(frame("j string", (json.dumps(body),)), "j", at("2024-06-01")).collect()
    assert (one.tags, one.categoryId, one.caption, one.licensedContent) == ("a, b", 10, True, True)
    assert json.loads(one.regionRestriction) == {"blocked": ["DE"]}
    assert (two.tags, two.categoryId, two.caption, two.viewCount, two.license) == ("", 0, False, 0, "")


def test_csv_sink_round_trip(spark, tmp_path):
    df = category_seed(spark).coalesce(1)
    path = str(tmp_path / "out")
    sinks.write_csv(df, path, max_rows_per_file=4)
    assert len(list((tmp_path / "out").glob("*.csv"))) == 4
    sinks.write_csv(df, path)
    assert rows_of(read_csv(spark, path, CATEGORIES, fill=None)) == rows_of(df)


def test_append_and_refresh(spark, frame, tmp_path):
    path, df = str(tmp_path / "t"), frame("a int", (1,))
    sinks.append_rows(df, path)
    sinks.append_rows(df, path)
    assert read_parquet(spark, f"{path}/*.parquet").count() == 2
    stats = sinks.table_stats(spark.read.parquet(path))
    assert sum(r.row_count for r in stats.collect()) == 2 and stats.count() == 2
    sinks.full_refresh(spark.read.parquet(path).distinct(), path)  # it may read what it replaces
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(Exception, match="no good"):
        sinks.full_refresh(spark.read.parquet(path).select(F.raise_error(F.lit("no good"))), path)
    assert rows_of(spark.read.parquet(path)) == [(1,)]


def test_catalogue_tables(spark, frame):
    sinks.create_table_as_select(spark, frame("a int, b string", (1, "x")), "t_rebuilt")
    sinks.create_table_as_select(spark, frame("a int, b string", (2, "y")), "t_rebuilt")
    assert rows_of(spark.table("t_rebuilt")) == [(2, "y")]
    sinks.create_or_append(spark, frame("a int, b string", (1, "x")), "t_grown")
    sinks.create_or_append(spark, frame("b string, a int", ("y", 2)), "t_grown")
    assert rows_of(spark.table("t_grown")) == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError, match="extra"):
        sinks.create_or_append(spark, frame("a int, b string, extra int", (3, "z", 1)), "t_grown")
    sinks.create_or_append(spark, frame("a int", (3,)), "t_grown")
    assert rows_of(spark.table("t_grown")) == [(1, "x"), (2, "y"), (3, None)]
    with pytest.raises(Exception, match="no good"):
        sinks.create_table_as_select(spark, spark.range(0, 1, 1, 1).select(F.raise_error(F.lit("no good")).alias("a")), "t_rebuilt")
    assert rows_of(spark.table("t_rebuilt")) == [(2, "y")]
    sinks.create_table_as_select(spark, spark.table("t_rebuilt").select("b"), "t_rebuilt")
    assert rows_of(spark.table("t_rebuilt")) == [("y",)]
    sinks.describe_table(spark, "t_grown", "A channel's rows")
    comments = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED t_grown").collect()}
    assert comments["Comment"] == "A channel's rows"
    sinks.create_view(spark.table("t_grown").filter("a = 1"), "v_one")
    assert spark.sql("SELECT b FROM v_one").first()[0] == "x"


def test_descriptions_survive_parquet(spark, frame, tmp_path):
    df = sinks.with_descriptions(frame("a int, b int", (1, 2)), {"a": "First"})
    df.write.parquet(str(tmp_path / "d"))
    assert sinks.descriptions(spark.read.parquet(str(tmp_path / "d"))) == {"a": "First"}


def dated(frame, *rows):
    return frame("id int, day string, v int", *rows).withColumn("day", F.col("day").cast("date"))


def test_upsert_by_month_touches_only_its_months(spark, frame, tmp_path):
    path = str(tmp_path / "m")
    sinks.write_by_month(
        dated(frame, (1, "2024-01-01", 1), (2, "2024-01-02", 2), (1, "2024-02-01", 3)), path, "day"
    )
    untouched = sorted(p.name for p in (tmp_path / "m" / "yyyymm=202402").glob("*.parquet"))
    batch = dated(frame, (2, "2024-01-02", 20), (3, "2024-03-01", 30))
    for _ in range(2):
        sinks.upsert_by_month(spark, path, batch, ["id", "day"], "day")
        assert rows_of(spark.read.parquet(path), "id", "day", "v") == [
            (1, "2024-01-01", 1), (1, "2024-02-01", 3), (2, "2024-01-02", 20), (3, "2024-03-01", 30),
        ]
    assert sorted(p.name for p in (tmp_path / "m" / "yyyymm=202402").glob("*.parquet")) == untouched


def test_compaction_and_retention(spark, frame, tmp_path):
    path = str(tmp_path / "bronze")
    sinks.write_by_month(dated(frame, (1, "2024-01-01", 1), (1, "2024-02-01", 1)), path, "day")
    sinks.write_by_month(dated(frame, (1, "2024-01-01", 2), (1, "2024-02-01", 2)), path, "day", "append")
    newest = read_table_latest(spark, path, ["id", "day"], "v")
    assert rows_of(newest, "day", "v") == [("2024-01-01", 2), ("2024-02-01", 2)]
    sinks.compact_by_month(spark, path, ["id", "day"], "v", "day", months=["202401"])
    assert rows_of(spark.read.parquet(path), "day", "v") == [
        ("2024-01-01", 2), ("2024-02-01", 1), ("2024-02-01", 2),
    ]
    sinks.compact_by_month(spark, path, ["id", "day"], "v", "day")
    assert spark.read.parquet(path).count() == 2
    kept = str(tmp_path / "kept")
    sinks.rewrite_retained(spark, path, kept, "day", F.lit("2024-04-15").cast("date"), 90)
    assert rows_of(spark.read.parquet(kept), "day") == [("2024-02-01",)]
    sinks.write_by_month(dated(frame, (1, "2024-06-01", 3)), path, "day")
    sinks.rewrite_retained(spark, path, kept, "day", F.lit("2024-06-15").cast("date"), 90)
    assert rows_of(spark.read.parquet(kept), "day") == [("2024-06-01",)]  # the expired month is gone
    sinks.rewrite_retained(spark, path, path, "day", F.lit("2024-06-15").cast("date"), 90)
    assert rows_of(spark.read.parquet(path), "day") == [("2024-06-01",)]


def test_full_video_batches(spark, frame, tmp_path):
    header = ",".join(VIDEO_BATCH_CSV.names)
    paths = [landed(tmp_path, f"v{i}.csv", f"{header}\nv{i}{',' * 22}\n") for i in range(2)]
    rows = read_video_batches(spark, paths[0], paths[1:], VIDEO_BATCH_CSV)
    assert rows.columns == VIDEOS_CSV.names and rows_of(rows, "videoId") == [("v0",), ("v1",)]
    body = {
        "items": [
            {
                "id": "v1",
                "snippet": {"description": "d"},
                "status": {"embeddable": True},
                "recordingDetails": {"recordingDate": "2020-01-01", "location": {"latitude": 1.5}},
            }
        ]
    }
    full = flatten_video_payload(frame("j string", (json.dumps(body),)), "j", at("2024-06-01"), full=True)
    [row] = full.collect()
    assert (row.description, row.embeddable, row.publicStatsViewable) == ("d", True, None)
    assert json.loads(row.recordingLocation) == {"latitude": 1.5} and row.recordingDate == "2020-01-01"


def test_load_time_defaults(frame):
    rows = frame("id int, ts timestamp_ntz", (1, None), (2, "2024-01-01 10:00:00")).withColumn(
        "loaded_at", F.to_date("ts")
    )
    assert rows_of(fill_load_time(rows, at("2024-06-01 08:00:00"))) == [
        (1, "2024-06-01 08:00:00", "2024-06-01"), (2, "2024-01-01 10:00:00", "2024-01-01"),
    ]


def test_stored_versions(spark, frame, tmp_path):
    path = str(tmp_path / "versions")
    schema = "id string, v string, valid_from timestamp_ntz, valid_to timestamp_ntz"
    first = frame(
        schema,
        ("a", "0", "2023-01-01", "2024-01-01"), ("a", "1", "2024-01-01", None),
        ("b", "1", "2024-01-01", None),
    )
    def store(versions, run):
        sinks.publish(sinks.place_versions(versions, "id", 4, run), path, sinks.STATE, sinks.PART)

    def stored():
        return spark.read.parquet(path)

    def files(state):
        return sorted(str(p) for p in (tmp_path / "versions" / f"state={state}").glob("part=*/*.parquet"))

    store(first, "r-build")
    history = files("closed")
    batch = frame("id string, v string, ts timestamp_ntz", ("a", "2", "2024-02-01"))
    buckets = sinks.touched_buckets(batch, "id", 4)
    opened = sinks.read_open_versions(stored(), buckets)
    merged = merge_open(opened, batch, ["id"], "ts", at("2024-03-01"), check_cols=["v"])
    rows = merged.collect()
    untouched = [f for f in files("open") if f"part={buckets[0]}/" not in f]
    for _ in range(2):  # published twice, the same versions are stored
        store(spark.createDataFrame(rows, merged.schema), "r-feb")
        assert rows_of(sinks.read_versions(stored()), "id", "v", "valid_to") == [
            ("a", "0", "2024-01-01 00:00:00"), ("a", "1", "2024-02-01 00:00:00"), ("a", "2", None),
            ("b", "1", None),
        ]
    assert set(history) <= set(files("closed")) and set(untouched) <= set(files("open"))
    opened = sinks.read_open_versions(stored())
    gone = merge_open(opened, batch.limit(0), ["id"], "ts", at("2024-03-01"), full_snapshot=True)
    store(spark.createDataFrame(gone.collect(), gone.schema), "r-mar")
    assert sinks.read_open_versions(stored()).count() == 0
    assert sinks.read_versions(stored()).count() == 4


# --- items and files that drift ---


def test_bad_items_cost_none_of_their_neighbours(frame):
    items = [
        {"id": "a", "snippet": {"title": "T"}}, 5, None, {"kind": "no id"}, {"id": " "}, {"id": "b", "snippet": "text"},
        {"id": "c", "statistics": [1]}, "text", [1], {"id": "d", "snippet": None}, {"id": "e"},
    ]
    payloads = frame(
        "n int, j string", (1, json.dumps({"items": items})), (2, '{"items": [7]}'), (3, '{"items": {"id": "x"}}'), (4, None)
    )
    found = rows_of(rejected_items(payloads, "j", "channel"), "n", "position", "item_reason", "item_text")
    assert [r[:3] for r in found] == [
        (1, 1, "not an object"), (1, 2, "null item"), (1, 3, "no id"), (1, 4, "no id"), (1, 5, "unreadable snippet"),
        (1, 6, "unreadable statistics"), (1, 7, "not an object"), (1, 8, "not an object"), (2, 0, "not an object"),
    ]
    assert found[4][3] == '{"id":"b","snippet":"text"}'
    kept = flatten_channel_payload(payloads, "j", at("2024-06-01"))
    assert rows_of(kept, "channelId", "title") == [("a", "T"), ("d", ""), ("e", "")]
    assert rows_of(rejected_payloads(payloads, "j", "channel"), "n", "reason") == [(3, "no items"), (4, "malformed")]
    assert payload_items(payloads, "j", "channel").count() == 12


def test_csv_files_of_other_layouts_are_matched_by_name(spark, tmp_path):
    folder = tmp_path / "with space"
    folder.mkdir()
    texts = {
        "base.csv": 'id,title,n\n1,"x\ny",3\n2,b,\n',
        "batch0.csv": "title,id,n\nsecond,3,5\n",
        "batch1.csv": "extra,id,title,more\nE,4,four,\n,5,five,M\n",
        "batch2.csv": "id\n6\n",
        "batch3.csv": "n, title ,id\nbad,seven,7\n",
    }
    for name, text in texts.items():
        (folder / name).write_text(text)
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("title", T.StringType()), T.StructField("n", T.IntegerType())])
    df = read_many_csv(spark, f"{folder}/base.csv", [f"{folder}/batch[01].csv", f"{folder}/batch2.csv", f"{folder}/batch3.csv"],
                       schema, rescued="others")
    assert rows_of(df) == [
        ("1", "x\ny", 3, {}), ("2", "b", None, {}), ("3", "second", 5, {}), ("4", "four", None, {"extra": "E"}),
        ("5", "five", None, {"more": "M"}), ("6", "", None, {}), ("7", "seven", None, {}),
    ]
    assert final_plan(df).count("FileScan csv") == 1
    with pytest.raises(Exception, match="(?i)path|exist"):
        read_many_csv(spark, f"{folder}/none.csv", [], schema)


# --- maintenance ---


def data_files(folder):
    return {str(p.relative_to(folder)): (p.stat().st_mtime_ns, p.stat().st_ino) for p in folder.rglob("*.parquet")}


def test_expiry_drops_months_and_leaves_live_files_alone(spark, frame, tmp_path):
    table = tmp_path / "t x"
    rows = [(n, f"2024-{m:02d}-{d:02d}", n) for n, (m, d) in enumerate([(1, 5), (2, 9), (3, 1), (3, 20), (4, 2), (5, 3)])]
    sinks.write_by_month(dated(frame, *rows), str(table), "day")
    before = data_files(table)
    expire = lambda day: sinks.expire_months(spark, str(table), "day", F.lit(day).cast("date"), 30)
    days = lambda: [r[0] for r in rows_of(spark.read.parquet(str(table)), "day")]
    assert expire("2024-04-10") == ["202401", "202402", "202403"]  # the border is 11 March
    assert days() == ["2024-03-20", "2024-04-02", "2024-05-03"]
    after = data_files(table)
    live = [p for p in before if p.startswith(("yyyymm=202404", "yyyymm=202405"))]
    assert len(live) == 2 and all(after[p] == before[p] for p in live)
    assert not [p for p in after if p.startswith(("yyyymm=202401", "yyyymm=202402"))]
    assert expire("2024-04-10") == [] and data_files(table) == after  # nothing left to do
    assert expire("2024-05-02") == ["202403", "202404"] and days() == ["2024-05-03"]  # a border month without live rows
    assert spark.read.parquet(str(table)).columns == ["id", "day", "v", "yyyymm"]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("expiring")]


def test_compaction_rewrites_only_months_with_small_files(spark, frame, tmp_path):
    table = tmp_path / "t"
    one = lambda day, v: dated(frame, *[(n, day, v) for n in range(50)])
    for v in (1, 2, 3):  # three small files in each of two months, one in another
        for day in ("2024-01-01", "2024-02-01"):
            sinks.write_by_month(one(day, v).coalesce(1), str(table), "day", "append", sort_by=["id"])
    sinks.write_by_month(one("2024-03-01", 1).coalesce(1), str(table), "day", "append", sort_by=["id"])
    before = data_files(table)
    sizes = sinks.small_file_months(spark, str(table))
    assert set(sizes) == {"202401", "202402"} and set(sizes.values()) == {1}
    assert sinks.small_file_months(spark, str(table), small_bytes=1) == {}  # none is that small
    kept = rows_of(read_table_latest(spark, str(table), ["id", "day"], "v"), "id", "day", "v")
    assert sinks.compact_small_files(spark, str(table), ["id", "day"], "v", "day") == sizes
    after = data_files(table)
    assert rows_of(spark.read.parquet(str(table)), "id", "day", "v") == kept and len(kept) == 150
    assert len(after) <= 4 < len(before)
    assert [p for p in before if p in after] == [p for p in before if p.startswith("yyyymm=202403")]
    assert sinks.compact_small_files(spark, str(table), ["id", "day"], "v", "day", small_bytes=1) == {}


class CutOff(Exception):
    pass


def cut_off(*_, **__):
    raise CutOff


def test_a_rebuild_cut_off_at_any_statement_loses_nothing(spark, frame, monkeypatch):
    sinks.create_table_as_select(spark, frame("a int", (1,)), "t_cut")
    whole = type(spark).sql
    for step in ("DROP TABLE IF EXISTS t_cut__new", "ALTER TABLE t_cut RENAME", "ALTER TABLE t_cut__new", "DROP TABLE IF EXISTS t_cut__old"):
        value = spark.table("t_cut").first()["a"]

        def until(self, query, *args, **more):
            return cut_off() if query.startswith(step) else whole(self, query, *args, **more)

        with monkeypatch.context() as patch:
            patch.setattr(type(spark), "sql", until)
            with pytest.raises(CutOff):
                sinks.create_table_as_select(spark, spark.table("t_cut").select((F.col("a") + 1).alias("a")), "t_cut")
        sinks.restore_table(spark, "t_cut")
        done = spark.table("t_cut").first()["a"]
        assert done == value + (step == "DROP TABLE IF EXISTS t_cut__old")
        sinks.create_table_as_select(spark, spark.table("t_cut").select((F.col("a") + 1).alias("a")), "t_cut")
        assert [r["a"] for r in spark.table("t_cut").collect()] == [done + 1]


def test_a_refresh_cut_off_in_its_copy_is_finished_from_the_staged_rows(spark, frame, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    assert sinks.finish_refresh(spark, path) is False
    sinks.full_refresh(frame("a int", (1,)), path)
    with monkeypatch.context() as patch:
        patch.setattr(sinks, "_copy_staged", cut_off)
        with pytest.raises(CutOff):
            sinks.full_refresh(spark.read.parquet(path).select((F.col("a") + 1).alias("a")), path)
    spark.range(0).select(F.col("id").cast("int").alias("a")).write.mode("overwrite").parquet(path)  # half a copy
    assert sinks.finish_refresh(spark, path) is True
    assert rows_of(spark.read.parquet(path)) == [(2,)]
    assert sinks.finish_refresh(spark, path) is False
    sinks.full_refresh(spark.read.parquet(path).select((F.col("a") + 1).alias("a")), path)
    assert rows_of(spark.read.parquet(path)) == [(3,)]


def test_items_are_parsed_once_each(frame):
    """One reading of the payload, one of each item as its parts, and one as texts of parts that may be there unread."""
    payloads = frame("j string", (json.dumps({"items": [{"id": "a", "snippet": {"title": "t"}}, {"id": "b", "snippet": 3}, 5]}),))
    rows = flatten_video_payload(payloads, "j", at("2024-06-01"))
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 3
    assert rows_of(rows, "videoId", "title") == [("a", "t")]
    hidden = '{"items": [{"id": "c", "sn\\u0069ppet": 3}, {\'id\': "d", \'status\': 4}, {"id": "e", "kind": "snippet"}]}'
    spoilt = rejected_items(frame("j string", (hidden,)), "j", "video")
    assert rows_of(spoilt, "position", "item_reason") == [(0, "unreadable snippet"), (1, "unreadable status")]
