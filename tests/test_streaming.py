from pyspark.sql import functions as F

from stratavid.operators.snapshot import silver_snapshot
from stratavid.plans.catalog import EVENT_RULES, plain
from stratavid.plans.catalog import queries as registered
from stratavid.streaming.ingest import (
    append_stream,
    daily_metrics,
    daily_snapshot_stream,
    first_sightings,
    landed_files,
)
from tests.conftest import rows_of
from tests.test_oracle import SF_DIR

CLOCK = "2024-12-31"


def at(text):
    return F.lit(text).cast("timestamp_ntz")


def events(spark):
    return spark.read.parquet(f"{SF_DIR}/events.parquet")


def land(df, folder):
    df.coalesce(1).write.mode("append").parquet(folder)


def test_append_stream_takes_each_file_once(spark, tmp_path):
    landing, table, log = (str(tmp_path / n) for n in ("landing", "table", "log"))
    source = events(spark)
    land(source.filter("user_id < 50"), landing)
    append_stream(landed_files(spark, landing, source.schema), table, log).awaitTermination()
    land(source.filter("user_id >= 50"), landing)
    for _ in range(2):
        append_stream(landed_files(spark, landing, source.schema), table, log).awaitTermination()
        assert spark.read.parquet(table).count() == source.count()


def test_daily_snapshot_stream_equals_batch(spark, tmp_path):
    """Late files included: what arrives last may be older than what is stored."""
    landing, table, log = (str(tmp_path / n) for n in ("landing", "table", "log"))
    source = events(spark)
    parts = [F.hour("ts") >= 16, F.hour("ts") < 8, (F.hour("ts") >= 8) & (F.hour("ts") < 16)]
    for part in parts:
        land(source.filter(part), landing)
        stream = landed_files(spark, landing, source.schema, files_per_batch=1)
        daily_snapshot_stream(stream, EVENT_RULES, at(CLOCK), table, log).awaitTermination()
    expected = silver_snapshot(source, EVENT_RULES, at(CLOCK))
    cols = ("user_id", "date_key", "event_type", "value", "loaded_at")
    stored = spark.read.parquet(table)
    assert rows_of(plain(stored.select(*cols))) == rows_of(plain(expected.select(*cols)))
    daily = registered()["daily_latest"](spark, SF_DIR)
    assert stored.count() == daily.count()


def run_to_memory(spark, df, name, log, mode="append"):
    query = (
        df.writeStream.format("memory").queryName(name).outputMode(mode)
        .option("checkpointLocation", log).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.table(name)


def test_first_sightings(spark, frame, tmp_path):
    schema = "id string, ts timestamp_ntz"
    land(frame(schema, ("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:00:30"), ("b", "2024-01-01")), str(tmp_path / "l"))
    stream = landed_files(spark, str(tmp_path / "l"), frame(schema).schema)
    found = run_to_memory(spark, first_sightings(stream, ["id"], "ts", "1 hour"), "sightings", str(tmp_path / "log"))
    assert rows_of(found, "id") == [("a",), ("b",)]


def test_streamed_daily_metrics_equal_batch(spark, tmp_path):
    source = events(spark)
    landing = str(tmp_path / "landing")
    land(source, landing)
    stream = landed_files(spark, landing, source.schema)
    metrics = daily_metrics(stream, "user_id", "ts", "value")
    found = run_to_memory(spark, metrics, "metrics", str(tmp_path / "log"), "update")
    expected = registered()["daily_event_metrics"](spark, SF_DIR)
    assert rows_of(plain(found)) == rows_of(expected)
    assert rows_of(plain(daily_metrics(source, "user_id", "ts", "value"))) == rows_of(expected)
