"""Streams over landed files into the warehouse tables.

Every stream takes a checkpoint folder, which must be shared storage: it holds the
file log and the progress a restarted query resumes from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stratavid.operators.latest import latest_by_key
from stratavid.operators.snapshot import SnapshotRules, silver_snapshot
from stratavid.plans.warehouse import Warehouse
from stratavid.sources.sinks import touched_months, write_by_month


def landed_files(
    spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Stream of the Parquet files that arrive in a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def append_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append every landed row to a table exactly once, then stop."""
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def merge_daily_rows(stored: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Stored daily rows with those of a batch; per key and day the newest stays.

    A late row may be older than the stored one, so both are ranked together, in one pass over
    either. Of equally new rows the one with the larger row hash stays, whichever came first.
    """
    rows = stored.unionByName(batch)
    return latest_by_key(rows, [key, "date_key"], "loaded_at", [F.xxhash64(*rows.columns)])


def daily_snapshot_stream(
    raw: DataFrame, rules: SnapshotRules, as_of: Column, path: str, checkpoint: str
) -> StreamingQuery:
    """Keep a month-partitioned daily snapshot up to date with a raw stream, then stop.

    The checkpoint takes the place of a high-water mark, so late rows still count.
    A replayed micro-batch gives the same rows again.
    """

    def load(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        clean = silver_snapshot(batch, rules, as_of).persist()  # read for its months and its rows
        try:
            rows = clean
            if _table_exists(spark, path):
                stored = touched_months(spark.read.parquet(path), clean, "date_key")
                rows = merge_daily_rows(stored.select(*clean.columns), clean, rules.key)
            write_by_month(rows, path, "date_key")
        finally:
            clean.unpersist()

    return (
        raw.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def star_stream(
    raw: DataFrame, kind: str, store: Warehouse, as_of: Column, checkpoint: str, name: str = "", tiebreak: tuple[str, ...] = ()
) -> StreamingQuery:
    """Feed a stream of raw ``channel`` or ``video`` rows into staging, history, bridges and facts, then stop.

    Each micro-batch is a refresh that the store takes once, by the stream's ``name`` (else its kind) and the
    batch's number: one that was cut off is finished from the rows it had taken, one that is replayed is
    passed over. A store has one writer at a time, so run two streams into one store after one another.
    """
    if kind not in ("channel", "video"):
        raise ValueError("a stream has channel or video rows")

    def load(batch: DataFrame, number: int) -> None:
        sides = {f"raw_{kind}s": batch, f"{kind}_tiebreak": tiebreak}
        store.take_batch(f"{name or kind}-{number}", **({"raw_channels": None, "raw_videos": None} | sides), as_of=as_of)

    return (
        raw.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds a table, on whatever file system it names."""
    try:
        return bool(spark.read.parquet(path).columns)
    except AnalysisException:
        return False


def first_sightings(rows: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Stream without repeats of a key that come within ``delay`` of each other.

    State is bounded by the watermark. The first row wins, not the newest.
    """
    timed = rows.withColumn(ts, F.col(ts).cast("timestamp"))
    return timed.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def daily_metrics(
    rows: DataFrame, key: str, ts: str, value: str, delay: str = "1 day"
) -> DataFrame:
    """Count and sum per key and day, as a stream or a batch.

    ``withWatermark`` needs a zoned timestamp, so a zoneless one is read as UTC.
    """
    timed = rows.withColumn(ts, F.col(ts).cast("timestamp"))
    days = timed.withWatermark(ts, delay).groupBy(key, F.window(ts, "1 day").alias("w"))
    totals = days.agg(F.count("*").alias("event_count"), F.sum(value).alias("total_value"))
    return totals.select(
        key, F.to_date("w.start").alias("date_key"), "event_count", "total_value"
    )
