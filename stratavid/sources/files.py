"""Files in: CSV, Parquet, the category seed, and tolerant conversion of text columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratavid.functions import lenient_bool, lenient_long, parse_timestamp
from stratavid.operators.latest import latest_by_key
from stratavid.schemas import CATEGORIES, CHANNELS_CSV, UNUSED_VIDEO_COLUMNS, VIDEOS_CSV

# The category seed.
VIDEO_CATEGORIES = (
    (1, "Film & Animation"),
    (2, "Autos & Vehicles"),
    (10, "Music"),
    (15, "Pets & Animals"),
    (17, "Sports"),
    (19, "Travel & Events"),
    (20, "Gaming"),
    (22, "People & Blogs"),
    (23, "Comedy"),
    (24, "Entertainment"),
    (25, "News & Politics"),
    (26, "Howto & Style"),
    (27, "Education"),
    (28, "Science & Technology"),
    (29, "Nonprofits & Activism"),
)


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    multi_line: bool = True,
    fill: str | None = "",
) -> DataFrame:
    """CSV with a header and quoted multi-line texts; missing text cells become ``fill``.

    A multi-line file cannot be split, so land large exports as many files, or pass
    ``multi_line=False`` where no text holds a line break.
    """
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path if isinstance(path, str) else list(path))
    )
    return rows if fill is None else rows.na.fill(fill)


def read_csv_infer(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """CSV with inferred types. Inference reads the file once more: pin the schema after the first load."""
    return (
        spark.read.option("header", True)
        .option("inferSchema", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .csv(path)
    )


def read_many_csv(
    spark: SparkSession,
    base: str,
    batches: Sequence[str],
    schema: T.StructType,
    multi_line: bool = True,
    fill: str | None = "",
    rescued: str | None = None,
) -> DataFrame:
    """A base file and its numbered batches in one scan, columns matched by the names in each file's header.

    Files may differ in the order of their columns, lack some (texts are ``fill`` then, others null) and have
    others, which go to the map column ``rescued`` if one is named (name to text, cells that are empty
    left out). Cells that do not convert to their column's type are null. Paths may be files, folders or wildcards.

    Only the headers are read beforehand, file by file. The scan then reads cells by position, and each
    row takes those of its file's layout; rows choose among the few layouts there are, and only
    files of other layouts than the commonest are named in the plan.
    """
    layouts = _layouts(spark, [base, *batches], multi_line)
    if not layouts:
        raise ValueError("no file to read")
    ordered = sorted(layouts, key=lambda names: -len(layouts[names]))
    width = max(map(len, ordered))
    cells = T.StructType([T.StructField(f"_c{n}", T.StringType()) for n in range(width)])
    paths = [path for files in layouts.values() for path, _ in files]
    rows = read_csv(spark, paths, cells, multi_line, fill=None)
    layout = F.lit(0)
    for number, names in enumerate(ordered[1:], 1):
        layout = F.when(F.col("_metadata.file_path").isin([encoded for _, encoded in layouts[names]]), number).otherwise(layout)
    rows = rows.select("*", layout.alias("__layout"))

    def of_layout(value: Callable[[tuple[str, ...]], Column]) -> Column:
        chosen = value(ordered[0])
        for number, names in enumerate(ordered[1:], 1):
            chosen = F.when(F.col("__layout") == number, value(names)).otherwise(chosen)
        return chosen

    def cell(name: str) -> Callable[[tuple[str, ...]], Column]:
        kind = schema[name].dataType
        empty = F.lit(fill if isinstance(kind, T.StringType) else None).cast(kind)
        return lambda names: F.coalesce(F.col(f"_c{names.index(name)}").try_cast(kind), empty) if name in names else empty

    def others(names: tuple[str, ...]) -> Column:
        unknown = [(n, c) for n, c in enumerate(names) if c not in schema.names]
        pairs = [F.struct(F.lit(c).alias("key"), F.col(f"_c{n}").alias("value")) for n, c in unknown]
        kind = "array<struct<key: string, value: string>>"
        entries = F.array(*pairs).cast(kind) if pairs else F.array().cast(kind)
        return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))

    columns = [of_layout(cell(c)).alias(c, metadata=schema[c].metadata) for c in schema.names]
    if rescued is not None:
        columns.append(of_layout(others).alias(rescued))
    return rows.select(*columns)


def _layouts(spark: SparkSession, paths: Sequence[str], multi_line: bool) -> dict[tuple[str, ...], list[tuple[str, str]]]:
    """Files, each in the plain and the encoded form of its path, by the column names of their headers. Headers are read a few at a time."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*").load(list(paths))
    # One row per file. The scan knows files by the second, encoded form of their name.
    files = {r["path"]: r["file_path"] for r in found.select("path", "_metadata.file_path").collect()}

    def names(path: str) -> tuple[str, ...]:
        reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
        return tuple(c.strip() for c in reader.csv(path).columns)

    with ThreadPoolExecutor(16) as pool:
        headers = dict(zip(files, pool.map(names, files)))
    layouts: dict[tuple[str, ...], list[tuple[str, str]]] = {}
    for path, encoded in sorted(files.items()):
        if headers[path]:
            layouts.setdefault(headers[path], []).append((path, encoded))
    return layouts


def read_video_batches(
    spark: SparkSession, base: str, batches: Sequence[str], schema: T.StructType
) -> DataFrame:
    """The collector's full video files put together, without the columns nobody queries."""
    return read_many_csv(spark, base, batches, schema).drop(*UNUSED_VIDEO_COLUMNS)


def union_batches(batches: Iterable[DataFrame]) -> DataFrame:
    """All rows of all batches, columns matched by name, absent ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def read_parquet(spark: SparkSession, pattern: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet files by wildcard."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(pattern)


def read_table_latest(
    spark: SparkSession, path: str, keys: Sequence[str], version: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Table as if every key held only its last write."""
    return latest_by_key(spark.read.parquet(path), keys, version, tiebreak)


def category_seed(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The category lookup: 15 fixed rows, or a CSV with the same two columns."""
    if path is not None:
        return read_csv(spark, path, CATEGORIES, multi_line=False, fill=None)
    rows = [F.struct(F.lit(i), F.lit(name)) for i, name in VIDEO_CATEGORIES]
    kind = T.ArrayType(CATEGORIES)
    return spark.range(1).select(F.inline(F.array(*rows).cast(kind)))


def coerce_channels_csv(rows: DataFrame, as_of: Column) -> DataFrame:
    """Landed channel CSV rows as raw channel rows; a missing publication time becomes ``as_of``."""
    counts, flags = ("subscribers", "views", "videos"), ("hiddenSubscribers",)
    return _coerce(rows, [f.name for f in CHANNELS_CSV if f.name != "query"], counts, flags, as_of)


def coerce_videos_csv(rows: DataFrame, as_of: Column) -> DataFrame:
    """Landed video CSV rows as raw video rows."""
    counts = ("categoryId", "viewCount", "likeCount", "commentCount")
    flags = ("caption", "licensedContent")
    return _coerce(rows, [f.name for f in VIDEOS_CSV], counts, flags, as_of)


def _coerce(
    rows: DataFrame, names: Sequence[str], counts: Sequence[str], flags: Sequence[str], as_of: Column
) -> DataFrame:
    def converted(name: str) -> Column:
        if name in counts:
            return lenient_long(name)
        if name in flags:
            return lenient_bool(name)
        if name == "publishedAt":
            return F.coalesce(parse_timestamp(name), as_of)
        return F.coalesce(F.col(name), F.lit(""))

    return rows.select(
        as_of.alias("ts"), *[converted(n).alias(n) for n in names], F.to_date(as_of).alias("loaded_at")
    )


def fill_load_time(rows: DataFrame, as_of: Column) -> DataFrame:
    """Rows landed without observation time or load day get those of the load."""
    return rows.withColumns(
        {
            "ts": F.coalesce("ts", as_of),
            "loaded_at": F.coalesce("loaded_at", F.to_date(as_of)),
        }
    )


def _unreadable(conversions: Mapping[str, Column]) -> Column:
    """True where some non-blank text has no value after its conversion."""
    bad = [(F.trim(name) != "") & value.isNull() for name, value in conversions.items()]
    return F.coalesce(reduce(lambda a, b: a | b, bad), F.lit(False))


def tolerant_parse(rows: DataFrame, conversions: Mapping[str, Column]) -> DataFrame:
    """Rows whose text columns all convert, converted; the others are left out, the batch goes on.

    ``conversions`` maps a text column to an expression giving null for bad text.
    """
    good = rows.filter(~_unreadable(conversions))
    return good.select(
        *[conversions[c].alias(c) if c in conversions else F.col(c) for c in rows.columns]
    )


def rejected_rows(rows: DataFrame, conversions: Mapping[str, Column]) -> DataFrame:
    """The rows ``tolerant_parse`` leaves out, as they were landed."""
    return rows.filter(_unreadable(conversions))
