"""Writing warehouse tables as Parquet or CSV.

Tables are plain folders. A rewrite replaces whole partitions in dynamic overwrite
mode: new files are staged first and swapped in when the job commits, so a query may
read the partitions it replaces, a lost executor only repeats its tasks, and a rerun
of the same batch writes the same partitions again. Where a whole table is replaced, the
new rows are complete elsewhere before an old one goes.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratavid.functions import year_month
from stratavid.operators.history import VALID_TO
from stratavid.operators.incremental import unexpired, upsert
from stratavid.operators.latest import latest_by_key

MONTH = "yyyymm"
STATE = "state"
PART = "part"
OPEN, CLOSED = "open", "closed"

# Files below the first size are worth joining into files of the second.
SMALL_FILE = 32 << 20
TARGET_FILE = 256 << 20


def write_csv(df: DataFrame, path: str, max_rows_per_file: int | None = None) -> None:
    """CSV with a header, replacing what is there; optionally a new file every so many rows."""
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    if max_rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    writer.csv(path)


def append_rows(df: DataFrame, path: str, partition: str | None = None) -> None:
    """Append to a table, which is created on the first call."""
    writer = df.write.mode("append")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def create_or_append(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Append to a catalogue table if it exists, else create it with the schema of ``df``.

    Columns of the table that ``df`` lacks are null; columns the table lacks are an error.
    """
    if spark.catalog.tableExists(table):
        known = spark.table(table)
        unknown = [c for c in df.columns if c not in known.columns]
        if unknown:
            raise ValueError(f"{table} has no column {', '.join(unknown)}")
        missing = {f.name: F.lit(None).cast(f.dataType) for f in known.schema if f.name not in df.columns}
        df.withColumns(missing).select(*known.columns).write.mode("append").saveAsTable(table)
    else:
        df.write.format("parquet").saveAsTable(table)


def create_table_as_select(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Rebuild a catalogue table from a query, which may read it; a failing query leaves it as it was.

    The old table is set aside by a rename and dropped last, so at any moment one of the two is whole.
    After a run that was cut off, ``restore_table`` brings back what it set aside; call it
    before the query is made, as the query may read the table.
    """
    restore_table(spark, table)
    fresh, old = f"{table}__new", f"{table}__old"
    spark.sql(f"DROP TABLE IF EXISTS {fresh}")
    df.write.format("parquet").saveAsTable(fresh)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")


def restore_table(spark: SparkSession, table: str) -> None:
    """Undo a rebuild that was cut off between its two renames; else clear what a finished one left."""
    old = f"{table}__old"
    if not spark.catalog.tableExists(old):
        return
    if spark.catalog.tableExists(table):
        spark.sql(f"DROP TABLE {old}")
    else:
        spark.sql(f"ALTER TABLE {old} RENAME TO {table}")


def full_refresh(df: DataFrame, path: str, partition: str | None = None, staging: str | None = None) -> None:
    """Replace a whole table; ``df`` may read it.

    The rows are first written to ``staging`` (by default a folder next to the table), so a failing
    query leaves the table as it was. Until the staged rows are copied whole, a mark beside them says
    so: after a run that was cut off in the copy, ``finish_refresh`` copies them again. Call it before
    ``df`` is made, as ``df`` may read the table.
    """
    staging = staging or f"{path.rstrip('/')}__staged"
    finish_refresh(df.sparkSession, path, partition, staging)
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{staging}/rows")
    _mark(df.sparkSession, staging, True)
    _copy_staged(df.sparkSession, path, partition, staging)


def finish_refresh(spark: SparkSession, path: str, partition: str | None = None, staging: str | None = None) -> bool:
    """Copy the rows of a refresh that was cut off after staging them; whether there was one."""
    staging = staging or f"{path.rstrip('/')}__staged"
    try:
        marked = spark.read.schema("staged boolean").json(f"{staging}/mark").first()
    except AnalysisException:  # nothing was ever staged here
        return False
    if marked is None or not marked["staged"]:
        return False
    _copy_staged(spark, path, partition, staging)
    return True


def _mark(spark: SparkSession, staging: str, staged: bool) -> None:
    """Whether the staged rows are whole and wait to be copied."""
    spark.range(1).select(F.lit(staged).alias("staged")).coalesce(1).write.mode("overwrite").json(f"{staging}/mark")


def _copy_staged(spark: SparkSession, path: str, partition: str | None, staging: str) -> None:
    writer = spark.read.parquet(f"{staging}/rows").write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(partition) if partition else writer).parquet(path)
    _mark(spark, staging, False)


def create_view(df: DataFrame, name: str) -> None:
    """Name a query; it runs when read."""
    df.createOrReplaceTempView(name)


def with_month(df: DataFrame, date_column: str) -> DataFrame:
    """``df`` with its month-partition column."""
    return df.withColumn(MONTH, year_month(date_column))


def write_by_month(
    df: DataFrame,
    path: str,
    date_column: str,
    mode: str = "overwrite",
    sort_by: Sequence[str] = (),
) -> None:
    """Write month partitions; in overwrite mode only months present in ``df`` are replaced.

    With ``sort_by`` rows are dealt by ranges of (month, key), so each file holds a narrow range
    of keys and a lookup skips files and row groups by their minimum and maximum; the ranges are
    of equal size, however much larger one month is. Without it each month is rebalanced.
    """
    months = with_month(df, date_column)
    if sort_by:
        months = months.repartitionByRange(MONTH, *sort_by).sortWithinPartitions(MONTH, *sort_by)
    else:
        months = months.hint("rebalance", MONTH)
    (
        months.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(MONTH)
        .parquet(path)
    )


def touched_months(stored: DataFrame, batch: DataFrame, date_column: str) -> DataFrame:
    """Stored rows in the months a batch has rows in.

    The list of months is one short row per calendar month, which bounds what is
    broadcast; Spark prunes the other partitions with it.
    """
    months = batch.select(year_month(date_column).alias(MONTH)).distinct()
    return stored.join(F.broadcast(months), MONTH, "left_semi")


def upsert_by_month(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    date_column: str,
    sort_by: Sequence[str] = (),
) -> None:
    """Rows of ``batch`` replace stored rows with the same key, which must include the date.

    Only months the batch touches are read and written.
    """
    stored = touched_months(spark.read.parquet(path), batch, date_column).drop(MONTH)
    write_by_month(upsert(stored, batch, keys), path, date_column, sort_by=sort_by)


def compact_by_month(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    version: str,
    date_column: str,
    months: Sequence[str] | None = None,
    tiebreak: Sequence[str] = (),
) -> None:
    """Rewrite month partitions, all or the named ones, keeping the last write per key."""
    stored = spark.read.parquet(path)
    if months is not None:
        stored = stored.filter(F.col(MONTH).isin(list(months)))
    newest = latest_by_key(stored.drop(MONTH), keys, version, tiebreak)
    write_by_month(newest, path, date_column)


def small_file_months(
    spark: SparkSession, path: str, small_bytes: int = SMALL_FILE, target_bytes: int = TARGET_FILE
) -> dict[str, int]:
    """Months worth compacting, with the number of files they should have.

    Taken from the file listing, no row is read: a month is chosen if it has small files and if
    packing all its files into ones of ``target_bytes`` would leave fewer.
    """
    files = spark.read.parquet(path).select(MONTH, "_metadata.file_path", "_metadata.file_size").groupBy(MONTH, "file_path")
    sizes = files.agg(F.max("file_size").alias("size")).groupBy(MONTH)
    months = sizes.agg(
        F.count("*").alias("files"), F.count_if(F.col("size") < small_bytes).alias("small"), F.sum("size").alias("bytes")
    ).withColumn("wanted", F.greatest(F.ceil(F.col("bytes") / target_bytes), F.lit(1)))
    rows = months.filter("small > 0 AND wanted < files").select(F.col(MONTH).cast("string"), "wanted").collect()
    return {r[0]: r[1] for r in rows}  # one row per calendar month at most


def compact_small_files(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    version: str,
    date_column: str,
    tiebreak: Sequence[str] = (),
    small_bytes: int = SMALL_FILE,
    target_bytes: int = TARGET_FILE,
) -> dict[str, int]:
    """Compact only the months that ``small_file_months`` chooses, and give them back; no other file changes.

    Keeps the last write per key. A month's rows are dealt by ranges of its keys into as many files as their
    bytes ask for, so files hold narrow ranges of keys and a hot month becomes many files.
    """
    chosen = small_file_months(spark, path, small_bytes, target_bytes)
    if chosen:
        rows = spark.read.parquet(path).filter(F.col(MONTH).cast("string").isin(list(chosen)))
        newest = with_month(latest_by_key(rows.drop(MONTH), keys, version, tiebreak), date_column)
        dealt = newest.repartitionByRange(sum(chosen.values()), MONTH, *keys).sortWithinPartitions(MONTH, *keys)
        writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(MONTH).parquet(path)
    return chosen


def expire_months(spark: SparkSession, path: str, date_column: str, as_of: Column, days: int = 90) -> list[str]:
    """Delete from a table in place the rows whose retention has run out; the months that were changed.

    Whole expired months are dropped as partitions, unread. Only the month the border runs through is
    rewritten, and only if a row of it expired. Files of live months stay as they are. A run that is
    cut off leaves expired rows for the next one to delete, and no live row goes.
    """
    border = spark.range(1).select(F.date_sub(as_of, days).alias("d")).select(F.col("d"), year_month("d").alias("m")).first()
    table = f"expiring_{uuid.uuid4().hex}"
    spark.catalog.createTable(table, path, "parquet")
    try:
        spark.catalog.recoverPartitions(table)
        months = [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
        changed = sorted(m for m in months if m < border["m"])
        for month in changed:
            _drop_month(spark, table, month)
        if border["m"] in months:
            part = spark.read.parquet(path).filter(F.col(MONTH) == border["m"]).drop(MONTH)
            live = part.filter(F.col(date_column) > F.lit(border["d"]))
            counts = part.agg(F.count("*").alias("n"), F.count_if(F.col(date_column) > F.lit(border["d"])).alias("live")).first()
            if counts["live"] == 0 < counts["n"]:
                _drop_month(spark, table, border["m"])
            elif counts["live"] < counts["n"]:
                publish(with_month(live, date_column), path, MONTH)
            if counts["live"] < counts["n"]:
                changed.append(border["m"])
    finally:
        spark.sql(f"DROP TABLE {table}")  # the name alone: the files were there before it
    return changed


def _drop_month(spark: SparkSession, table: str, month: str) -> None:
    """Empty one partition of a table whose files are not the catalogue's own."""
    fields = [f for f in spark.table(table).schema if f.name != MONTH]
    nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in fields)
    spark.sql(f"INSERT OVERWRITE {table} PARTITION ({MONTH} = '{month}') SELECT {nothing} FROM range(0)")
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({MONTH} = '{month}')")


def rewrite_retained(
    spark: SparkSession, path: str, target: str, date_column: str, as_of: Column, days: int = 90
) -> None:
    """Make ``target`` hold the rows whose retention still runs, and nothing else.

    Whole expired months are not read, and what ``target`` held from an earlier run is replaced.
    ``target`` may be ``path`` itself.
    """
    first_month = year_month(F.date_sub(as_of, days))
    stored = spark.read.parquet(path).filter(F.col(MONTH) >= first_month).drop(MONTH)
    full_refresh(with_month(unexpired(stored, date_column, as_of, days), date_column), target, MONTH)


def bucket_of(key: str, buckets: int) -> Column:
    """Partition name of a key's bucket; a bucket's rows are rewritten together."""
    return F.concat(F.lit("b"), F.pmod(F.xxhash64(key), F.lit(buckets)).cast("string"))


def touched_buckets(batch: DataFrame, key: str, buckets: int) -> list[str]:
    """Buckets a batch has keys in: at most ``buckets`` names."""
    return sorted(r[0] for r in batch.select(bucket_of(key, buckets)).distinct().collect())


def place_versions(versions: DataFrame, key: str, buckets: int, run: str) -> DataFrame:
    """Versions with their partition: open ones by bucket of their key, closed ones by run.

    A bucket's partition also has the versions the run closed in it, so that it is replaced
    even where none is left open; readers of open versions pass them over.
    """
    is_open = F.col(VALID_TO).isNull()
    spot = lambda state, part: F.struct(F.lit(state).alias(STATE), part.alias(PART))
    in_bucket, in_run = spot(OPEN, bucket_of(key, buckets)), spot(CLOSED, F.lit(run))
    spots = F.when(is_open, F.array(in_bucket)).otherwise(F.array(in_run, in_bucket))
    return versions.withColumn("__spot", F.explode(spots)).select("*", f"__spot.{STATE}", f"__spot.{PART}").drop("__spot")


def publish(rows: DataFrame, path: str, *partitions: str) -> None:
    """Replace the partitions that ``rows`` have; the same rows published again change nothing."""
    (
        rows.hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def read_versions(stored: DataFrame) -> DataFrame:
    """All versions of a table of placed versions, the open ones flagged ``is_current``.

    The flag stems from the partition, so filtering by it leaves closed history
    unlisted and unread.
    """
    flagged = stored.withColumn("is_current", F.col(STATE) == OPEN)
    return flagged.filter((F.col(STATE) == CLOSED) | F.col(VALID_TO).isNull()).drop(STATE, PART)


def read_open_versions(stored: DataFrame, buckets: Sequence[str] | None = None) -> DataFrame:
    """The open versions, all or those of some buckets, without reading closed history."""
    rows = stored.filter((F.col(STATE) == OPEN) & F.col(VALID_TO).isNull())
    if buckets is not None:
        rows = rows.filter(F.col(PART).isin(list(buckets)))
    return rows.drop(STATE, PART)


def table_stats(df: DataFrame) -> DataFrame:
    """Rows and bytes per data file of a file-based table."""
    files = df.select("_metadata.file_path", "_metadata.file_size")
    return files.groupBy("file_path", "file_size").agg(F.count("*").alias("row_count"))


def with_descriptions(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Columns with descriptions, which Parquet and catalogue tables keep."""
    return df.select(
        *[
            F.col(c).alias(c, metadata={**df.schema[c].metadata, "comment": comments[c]})
            if c in comments
            else F.col(c)
            for c in df.columns
        ]
    )


def descriptions(df: DataFrame) -> dict[str, str]:
    """The described columns of a table."""
    return {f.name: f.metadata["comment"] for f in df.schema.fields if "comment" in f.metadata}


def describe_table(spark: SparkSession, table: str, comment: str) -> None:
    """Description of a catalogue table."""
    escaped = comment.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"COMMENT ON TABLE {table} IS '{escaped}'")
