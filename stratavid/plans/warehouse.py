"""The warehouse as stored tables: a first build and daily refreshes.

One call graph, silver to history to dimensions to bridges to facts to checks. Every
table is written once and read back, so no step repeats the work of an earlier one
and a lost executor costs at most its tasks of the running step.

A run can be cut off anywhere. Each step first writes its result aside and notes that in
the store's log, then publishes it by replacing partitions; both can be done again
without harm. A refresh that finds an unfinished run finishes that one first, from the
batch the run had taken, so no row is lost or taken twice. A build writes a new
generation of all tables, and only its last note makes readers see it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratavid.functions import surrogate_key
from stratavid.operators.history import VALID_FROM, VALID_TO, extend_open, merge_open
from stratavid.operators.incremental import above_mark, evolve_schema, high_water_mark, opens_as
from stratavid.operators.quality import enforce
from stratavid.operators.star import calendar, date_spine
from stratavid.operators.tokens import token_rows
from stratavid.plans import checks, gold, silver
from stratavid.plans.descriptions import DESCRIPTIONS
from stratavid.schemas import RAW_CHANNELS, RAW_VIDEOS
from stratavid.sources import sinks
from stratavid.sources.files import category_seed

LOG = "seq int, run string, step string, note string"
BUCKETS = 64


class Warehouse:
    """Stored tables under ``root``, which must be a folder all executors share.

    The table properties carry the names the questions in ``catalog`` and
    ``analytics`` use. ``buckets`` is how many parts the open versions of a table are
    stored in and must stay the same for the life of a store; choose it so that a part is
    a few files. Shuffle width is the session's (``spark.sql.shuffle.partitions``): set
    it to the bytes of the largest table over 200 MB or so; AQE joins what is too small.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        categories: DataFrame | None = None,
        buckets: int = BUCKETS,
        channel_rules=silver.CHANNEL_RULES,
        video_rules=silver.VIDEO_RULES,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.categories = category_seed(spark) if categories is None else categories
        self.buckets = buckets
        self.rules = {"stg_channels": channel_rules, "stg_videos": video_rules}
        self._notes: list[T.Row] | None = None
        self._building: str | None = None

    # --- the log: a few short rows per run ---

    def log(self) -> list[T.Row]:
        """Notes of all runs in order: begun, the steps whose result is written, done."""
        if self._notes is None:
            try:
                self._notes = self.spark.read.schema(LOG).parquet(f"{self.root}/log").orderBy("seq").collect()
            except AnalysisException:  # no store here yet
                self._notes = []
        return self._notes

    def _note(self, run: str, step: str, note: str = "") -> None:
        known = self.log()
        row = T.Row(seq=len(known), run=run, step=step, note=note)
        self.spark.createDataFrame([row], LOG).coalesce(1).write.mode("append").parquet(f"{self.root}/log")
        self._notes = [*known, row]  # a store has one writer

    def _noted(self, run: str, step: str) -> str | None:
        return next((r.note for r in reversed(self.log()) if (r.run, r.step) == (run, step)), None)

    @property
    def generation(self) -> str:
        """Folder of the tables that readers see: that of the last build that was finished."""
        if self._building:
            return self._building
        built = [r.run for r in self.log() if r.step == "built"]
        if not built:
            raise ValueError(f"nothing has been built under {self.root}")
        return f"g-{built[-1]}"

    def path(self, name: str) -> str:
        return f"{self.root}/{self.generation}/{name}"

    def _pending(self) -> tuple[str, dict] | None:
        """The refresh of this generation that has begun and is not done."""
        done = {r.run for r in self.log() if r.step == "done"}
        begun = [r for r in self.log() if r.step == "begun" and r.run not in done]
        begun = [r for r in begun if json.loads(r.note)["generation"] == self.generation]
        return (begun[-1].run, json.loads(begun[-1].note)) if begun else None

    def _staged(self, run: str, step: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The step's result as a table of the run, made at most once however often a run is resumed."""
        path = f"{self.root}/runs/{run}/{step}"
        schema = self._noted(run, step)
        if schema is None:
            rows = make()
            rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
            schema = rows.schema.json()
            self._note(run, step, schema)
        return self.spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(path)

    # --- tables ---

    def _schema(self, name: str) -> T.StructType | None:
        """The columns a table was last written with."""
        step = f"schema {self.generation}/{name}"
        note = next((r.note for r in reversed(self.log()) if r.step == step), None)
        return note and T.StructType.fromJson(json.loads(note))

    def _declare(self, run: str, name: str, rows: DataFrame, *partitions: str) -> None:
        """Note the columns of a table where they are new or changed."""
        plain = [f for f in rows.schema.fields if f.name not in partitions]
        schema = T.StructType([*plain, *(T.StructField(c, T.StringType()) for c in partitions)])
        if self._schema(name) != schema:
            self._note(run, f"schema {self.generation}/{name}", schema.json())

    def _read(self, name: str) -> DataFrame:
        """A table in its declared columns: new ones are null in old files, removed ones gone."""
        rows = self.spark.read.schema(self._schema(name)).parquet(self.path(name))
        return sinks.with_descriptions(rows, DESCRIPTIONS.get(name, {}))

    def _dated(self, name: str) -> DataFrame:
        return self._read(name).drop(sinks.MONTH)

    def _versions(self, name: str) -> DataFrame:
        rows = sinks.read_versions(self._read(name))
        return sinks.with_descriptions(rows, DESCRIPTIONS.get(name, {}))

    @property
    def stg_channels(self) -> DataFrame:
        return self._dated("stg_channels")

    @property
    def stg_videos(self) -> DataFrame:
        return self._dated("stg_videos")

    @property
    def dim_channel(self) -> DataFrame:
        rows = gold.dim_channel(self._versions("snapshot_channel"))
        return sinks.with_descriptions(rows, DESCRIPTIONS["dim_channel"])

    @property
    def dim_video(self) -> DataFrame:
        rows = gold.dim_video(self._versions("snapshot_video"), self.categories)
        return sinks.with_descriptions(rows, DESCRIPTIONS["dim_video"])

    @property
    def dim_date(self) -> DataFrame:
        return self._read("dim_date").drop(sinks.PART)

    @property
    def dim_keyword(self) -> DataFrame:
        return self._read("dim_keyword").drop(sinks.PART)

    @property
    def dim_tag(self) -> DataFrame:
        return self._read("dim_tag").drop(sinks.PART)

    @property
    def bridge_channel_keyword(self) -> DataFrame:
        return self._versions("bridge_channel_keyword")

    @property
    def bridge_video_tag(self) -> DataFrame:
        return self._versions("bridge_video_tag")

    @property
    def fact_channel_metrics(self) -> DataFrame:
        return self._dated("fact_channel_metrics")

    @property
    def fact_video_performance(self) -> DataFrame:
        return self._dated("fact_video_performance")

    # --- building ---

    def build(
        self,
        raw_channels: DataFrame,
        raw_videos: DataFrame,
        as_of: Column,
        channel_tiebreak: tuple[str, ...] = (),
        video_tiebreak: tuple[str, ...] = (),
    ) -> None:
        """Build every table from all raw rows as a new generation, which then replaces the old one.

        Readers see the old tables until the last step; a build that is cut off changes nothing.
        """
        run = f"r-{uuid.uuid4().hex}"
        self._building = f"g-{run}"
        try:
            for name, raw, tiebreak in (
                ("stg_channels", raw_channels, channel_tiebreak), ("stg_videos", raw_videos, video_tiebreak),
            ):
                rows = self._silver(name, raw, as_of, tiebreak)
                self._declare(run, name, rows, sinks.MONTH)
                sinks.write_by_month(rows, self.path(name), "date_key", sort_by=[self.rules[name].key])
            self._build_history(run, "snapshot_channel", gold.channel_snapshot(self.stg_channels), "natural_channel_id")
            self._build_history(run, "snapshot_video", gold.video_snapshot(self.stg_videos), "video_id")
            self._publish_tokens(run, "dim_keyword", gold.dim_keyword(self.stg_channels))
            self._publish_tokens(run, "dim_tag", gold.dim_tag(self.stg_videos))
            pairs = gold.channel_keyword_pairs(self.stg_channels, self.dim_channel, as_of)
            self._build_history(run, "bridge_channel_keyword", gold.opened(pairs), "channel_sk")
            pairs = gold.video_tag_pairs(self.stg_videos, self.dim_video, as_of)
            self._build_history(run, "bridge_video_tag", gold.opened(pairs), "video_sk")
            facts = {
                "fact_channel_metrics": (gold.fact_channel_metrics(self.stg_channels, self.dim_channel), "channel_sk"),
                "fact_video_performance": (
                    gold.fact_video_performance(self.stg_videos, self.dim_video, self.dim_channel), "video_sk",
                ),
            }
            for name, (fact, key) in facts.items():
                self._declare(run, name, fact, sinks.MONTH)
                sinks.write_by_month(fact, self.path(name), "date_key", sort_by=[key])
            self._publish_calendar(run, self._first_day("stg_channels", "stg_videos"), as_of)
            self._note(run, "built")
        finally:
            self._building = None

    def _silver(self, name: str, raw: DataFrame, as_of: Column, tiebreak: tuple[str, ...]) -> DataFrame:
        return silver.daily(raw, self.rules[name], as_of, tiebreak)

    def _build_history(self, run: str, name: str, versions: DataFrame, key: str) -> None:
        rows = sinks.place_versions(versions, key, self.buckets, run)
        self._declare(run, name, rows, sinks.STATE, sinks.PART)
        sinks.publish(rows, self.path(name), sinks.STATE, sinks.PART)

    def _publish_tokens(self, run: str, name: str, tokens: DataFrame) -> None:
        self._declare(run, name, tokens, sinks.PART)
        sinks.publish(tokens.withColumn(sinks.PART, F.lit(run)), self.path(name), sinks.PART)

    def _publish_calendar(self, run: str, first: Column, as_of: Column) -> None:
        bounds = self.spark.range(1).select(first.alias("first"), F.to_date(as_of).alias("last"))
        days = calendar(date_spine(bounds, "first", "last")).withColumn(sinks.PART, F.lit("all"))
        self._declare(run, "dim_date", days, sinks.PART)
        sinks.publish(days, self.path("dim_date"), sinks.PART)

    def _first_day(self, *names: str) -> Column:
        """First stored day, looked up in the first month alone."""
        days = []
        for name in names:
            stored = self._read(name)
            month = stored.select(F.min(sinks.MONTH)).scalar()
            days.append(stored.filter(F.col(sinks.MONTH) == month).select(F.min("date_key")).scalar())
        return F.least(*days)

    # --- refreshing ---

    def refresh(
        self,
        raw_channels: DataFrame,
        raw_videos: DataFrame,
        as_of: Column,
        load: str = "",
        channel_tiebreak: tuple[str, ...] = (),
        video_tiebreak: tuple[str, ...] = (),
        restate_last_day: bool = False,
        version_per_sighting: bool = False,
        full_snapshot: bool = False,
    ) -> None:
        """Take in the raw rows newer than the stored ones, reading and writing only what they change.

        ``load`` is a label for the log; runs of one label do not meet. Facts take days after
        the last stored one; ``restate_last_day`` also replaces that day's rows. With
        ``version_per_sighting`` every load opens a version of a channel's keyword.
        With ``full_snapshot`` the new rows are known to hold every live channel and video: open
        versions and pairs that they lack are closed at ``as_of``.

        Months and buckets without new rows are neither read nor written. Finishes a run that was cut off first.
        """
        pending = self._pending()
        if pending:
            self._carry_out(*pending)
        run = f"r-{uuid.uuid4().hex}"
        for name, raw, tiebreak in (
            ("stg_channels", raw_channels, channel_tiebreak), ("stg_videos", raw_videos, video_tiebreak),
        ):
            self._staged(run, f"batch-{name}", lambda: self._silver(name, self._newer(raw, name), as_of, tiebreak))
        days = self._last_fact_days()
        options = {
            "generation": self.generation,
            "load": load,
            "as_of": self.spark.range(1).select(as_of.cast("string")).first()[0],
            "restate": restate_last_day,
            "per_sighting": version_per_sighting,
            "full": full_snapshot,
            "days": days,
        }
        self._note(run, "begun", json.dumps(options))
        self._carry_out(run, options)

    def _carry_out(self, run: str, options: dict) -> None:
        """All steps of a run from its batch; a step that is done again gives the same tables."""
        as_of = F.lit(options["as_of"]).cast("timestamp_ntz")
        full = options["full"]
        channels, videos = (
            self.spark.read.schema(T.StructType.fromJson(json.loads(self._noted(run, f"batch-{n}")))).parquet(
                f"{self.root}/runs/{run}/batch-{n}"
            )
            for n in ("stg_channels", "stg_videos")
        )
        gone = {}
        for name, batch, lists, token in (
            ("stg_channels", channels, "keywords", "keyword"), ("stg_videos", videos, "tags", "tag_name"),
        ):
            gone[name] = self._withdrawn(run, name, batch, lists, token)
            self._upsert(run, name, batch, [self.rules[name].key, "date_key"], self.rules[name].key)

        self._extend(run, "snapshot_channel", gold.channel_snapshot_rows(channels), "natural_channel_id",
                     gold.CHANNEL_CHECKS, as_of, full)
        self._extend(run, "snapshot_video", gold.video_snapshot_rows(videos), "video_id",
                     gold.VIDEO_CHECKS, as_of, full)
        self._add_tokens(run, "dim_keyword", gold.dim_keyword(channels), "keyword_id")
        self._add_tokens(run, "dim_tag", gold.dim_tag(videos), "tag_id")
        first = channels.select("date_key").unionByName(videos.select("date_key")).select(F.min("date_key")).scalar()
        self._publish_calendar(run, F.least(self.dim_date.select(F.min("date_key")).scalar(), first), as_of)

        # By default a sighting alone changes nothing about a keyword: only new pairs open.
        keys = ["channel_sk", "keyword_id"]
        checked = None if options["per_sighting"] else keys
        pairs = gold.channel_keyword_pairs(channels, self._touched_versions("snapshot_channel", channels, "channel_id", "natural_channel_id"), as_of)
        self._merge_bridge(run, "bridge_channel_keyword", pairs, keys, as_of, checked, gone["stg_channels"], full)
        pairs = gold.video_tag_pairs(videos, self._touched_versions("snapshot_video", videos, "video_id", "video_id"), as_of)
        self._merge_bridge(run, "bridge_video_tag", pairs, ["video_sk", "tag_id"], as_of, None, gone["stg_videos"], full)

        facts = {
            "fact_channel_metrics": (
                gold.fact_channel_metrics(channels, gold.dim_channel(self._touched_versions("snapshot_channel", channels, "channel_id", "natural_channel_id"))),
                "channel_sk",
            ),
            "fact_video_performance": (
                gold.fact_video_performance(
                    videos,
                    gold.dim_video(self._touched_versions("snapshot_video", videos, "video_id", "video_id"), self.categories),
                    gold.dim_channel(self._touched_versions("snapshot_channel", videos, "channel_id", "natural_channel_id")),
                ),
                "video_sk",
            ),
        }
        for name, (built, sort) in facts.items():
            last = F.lit(options["days"][name]).cast("date")
            day = F.col("date_key")
            self._upsert(run, name, built.filter(day >= last if options["restate"] else day > last), ["id"], sort)
        self._note(run, "done")

    def expire(
        self, as_of: Column, days: int = 90, tables: tuple[str, ...] = ("stg_channels", "stg_videos")
    ) -> dict[str, list[str]]:
        """Delete the rows of dated tables whose retention has run out; per table the months that changed.

        Live months are neither read nor written. History, dimensions and (unless they are named) facts keep
        what they took from expired rows; a later ``build`` from raw rows would not have them.
        """
        dated = ("stg_channels", "stg_videos", "fact_channel_metrics", "fact_video_performance")
        if set(tables) - set(dated):
            raise ValueError(f"only {', '.join(dated)} expire")
        pending = self._pending()
        if pending:
            self._carry_out(*pending)
        return {name: sinks.expire_months(self.spark, self.path(name), "date_key", as_of, days) for name in tables}

    def compact(self, small_bytes: int = sinks.SMALL_FILE, target_bytes: int = sinks.TARGET_FILE) -> dict[str, dict[str, int]]:
        """Join the small files of the staging tables, month by month where that leaves fewer."""
        return {
            name: sinks.compact_small_files(
                self.spark, self.path(name), [self.rules[name].key, "date_key"], "loaded_at", "date_key",
                small_bytes=small_bytes, target_bytes=target_bytes,
            )
            for name in self.rules
        }

    def take_batch(self, batch: str, raw_channels: DataFrame | None, raw_videos: DataFrame | None, as_of: Column,
                   channel_tiebreak: tuple[str, ...] = (), video_tiebreak: tuple[str, ...] = ()) -> bool:
        """Refresh from a named batch of raw rows, once: a batch that is done is passed over; whether it was taken.

        Rows that are not newer than what is stored cannot be refreshed from; they are not lost but set aside
        under the batch's name (``late_rows``), where a replay puts them again.
        """
        label = f"batch {batch}"
        pending = self._pending()
        if pending:
            self._carry_out(*pending)
        done = {r.run for r in self.log() if r.step == "done"}
        begun = [r for r in self.log() if r.step == "begun" and r.run in done]
        if any((n := json.loads(r.note))["load"] == label and n["generation"] == self.generation for r in begun):
            return False
        for name, raw in (("stg_channels", raw_channels), ("stg_videos", raw_videos)):
            if raw is not None:
                self._set_aside(name, raw, batch)
        # A side without rows of its own takes none of those that are stored.
        nothing = {"stg_channels": RAW_CHANNELS, "stg_videos": RAW_VIDEOS}
        sides = {"stg_channels": raw_channels, "stg_videos": raw_videos}
        sides = {n: self.spark.createDataFrame([], nothing[n]) if raw is None else raw for n, raw in sides.items()}
        self.refresh(
            sides["stg_channels"], sides["stg_videos"], as_of, label,
            channel_tiebreak if raw_channels is not None else (), video_tiebreak if raw_videos is not None else (),
        )
        return True

    def _set_aside(self, name: str, raw: DataFrame, batch: str) -> None:
        """Write the rows at or below the mark to the batch's folder of late rows."""
        stored = self._read(name)
        recent = stored.filter(F.col(sinks.MONTH) == stored.select(F.max(sinks.MONTH)).scalar())
        late = raw.filter(F.col("ts") <= high_water_mark(recent, "loaded_at"))
        late.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.path('late-' + name)}/batch={batch}")

    def late_rows(self, name: str) -> DataFrame:
        """Raw rows of ``stg_channels`` or ``stg_videos`` that batches brought too late, with their ``batch``.

        ``merge_late`` takes them into a history, a ``build`` into everything.
        """
        return self.spark.read.parquet(self.path(f"late-{name}"))

    def files(self) -> DataFrame:
        """Where the tables are and what they hold: generation, table, path, data_files, bytes, rows, current.

        One line per table and generation, from the file listing and the files' own row counts; no column is read.
        """
        lines = []
        for run in dict.fromkeys(r.run for r in self.log() if r.step == "built"):
            tables = {r.step.split("/", 1)[1] for r in self.log() if r.step.startswith(f"schema g-{run}/")}
            for table in sorted(tables):
                path = f"{self.root}/g-{run}/{table}"
                try:
                    stats = sinks.table_stats(self.spark.read.parquet(path))
                except AnalysisException:  # an operator removed this generation, or the table has no file
                    continue
                totals = stats.agg(F.count("*").alias("data_files"), F.sum("file_size").alias("bytes"), F.sum("row_count").alias("rows"))
                names = {"generation": f"g-{run}", "table": table, "path": path}
                lines.append(totals.select(*(F.lit(v).alias(c) for c, v in names.items()), *totals.columns,
                                           F.lit(f"g-{run}" == self.generation).alias("current")))
        return reduce(DataFrame.unionByName, lines)

    def check(self) -> DataFrame:
        """Report of every declared check; raises if one of severity error fails."""
        names = (
            "fact_channel_metrics", "fact_video_performance", "dim_channel", "dim_video", "dim_date",
            "dim_keyword", "dim_tag", "bridge_channel_keyword", "bridge_video_tag",
        )
        reports = [
            checks.check_gold({n: getattr(self, n) for n in names}),
            checks.check_stg_channels(self.stg_channels),
            checks.check_stg_videos(self.stg_videos),
        ]
        return enforce(reduce(DataFrame.unionByName, reports))

    def _newer(self, raw: DataFrame, stg: str) -> DataFrame:
        """Raw rows above the stored mark, which is looked up in the last month alone."""
        stored = self._read(stg)
        last_month = stored.select(F.max(sinks.MONTH)).scalar()
        recent = stored.filter(F.col(sinks.MONTH) == last_month)
        month = sinks.MONTH if sinks.MONTH in raw.columns else None
        return above_mark(raw, recent, "ts", "loaded_at", month)

    def _last_fact_days(self) -> dict[str, str]:
        """Newest stored day per fact, fixed before the run adds rows: one value each."""
        last = {}
        for name in ("fact_channel_metrics", "fact_video_performance"):
            stored = self._read(name)
            month = stored.select(F.max(sinks.MONTH)).scalar()
            recent = stored.filter(F.col(sinks.MONTH) == month)
            last[name] = str(recent.agg(F.coalesce(F.max("date_key"), F.lit("1970-01-01").cast("date"))).first()[0])
        return last

    def _upsert(self, run: str, name: str, batch: DataFrame, keys: list[str], sort: str) -> None:
        """Rows of the batch replace stored rows of the same key, in the months the batch has rows in.

        Stored rows take the batch's columns, and their types where they hold the stored values; a narrower type is an
        error. If the stored files cannot be read in a new type as they are, all months are rewritten.
        """

        def merged() -> DataFrame:
            stored = self._read(name)
            if opens_as(stored.schema, batch.schema):
                stored = sinks.touched_months(stored, batch, "date_key")
            stored = stored.drop(sinks.MONTH)
            kept = stored.join(batch.select(*keys), keys, "left_anti").select(*stored.columns)
            return evolve_schema(kept, batch)

        rows = self._staged(run, name, merged)
        sinks.write_by_month(rows, self.path(name), "date_key", sort_by=[sort])
        self._declare(run, name, rows, sinks.MONTH)

    def _withdrawn(self, run: str, name: str, batch: DataFrame, lists: str, token: str) -> DataFrame:
        """Pairs (entity, token) that the batch's corrections of stored days leave without any sighting.

        Compares the stored rows that the batch replaces with the batch. Only if some token went is the
        rest of staging asked, for those entities alone, whether it was seen on another day.
        """
        key = self.rules[name].key

        def pairs(rows: DataFrame) -> DataFrame:
            return token_rows(rows.select(key, lists), lists, token).distinct()

        def corrected() -> DataFrame:
            stored = sinks.touched_months(self._read(name), batch, "date_key")
            replaced = stored.join(batch.select(key, "date_key"), [key, "date_key"], "left_semi")
            return pairs(replaced).join(pairs(batch), [key, token], "left_anti")

        lost = self._staged(run, f"lost-{name}", corrected)

        def unseen() -> DataFrame:
            stored = self._dated(name).join(lost.select(key).distinct(), key, "left_semi")
            others = stored.join(batch.select(key, "date_key"), [key, "date_key"], "left_anti")
            return lost.join(pairs(others), [key, token], "left_anti")

        return self._staged(run, f"withdrawn-{name}", (lambda: lost) if lost.isEmpty() else unseen)

    def _extend(
        self, run: str, name: str, history: DataFrame, key: str, check_cols: tuple[str, ...], as_of: Column, full: bool
    ) -> None:
        """What the batch makes of the open versions of the buckets it touches; all with a full snapshot."""

        def merged() -> DataFrame:
            buckets = None if full else sinks.touched_buckets(history, key, self.buckets)
            opened = sinks.read_open_versions(self._read(name), buckets)
            extended = extend_open(opened, history, [key], "loaded_at", check_cols)
            if full:
                missing = opened.join(history.select(key).distinct(), key, "left_anti").select(key, VALID_FROM)
                missing = missing.withColumn("__end", as_of)
                extended = (
                    extended.join(missing, [key, VALID_FROM], "left")
                    .withColumn(VALID_TO, F.coalesce(VALID_TO, F.col("__end").cast(opened.schema[VALID_TO].dataType)))
                    .select(*opened.columns)
                )
            return sinks.place_versions(extended, key, self.buckets, run)

        rows = self._staged(run, name, merged)
        sinks.publish(rows, self.path(name), sinks.STATE, sinks.PART)

    def _touched_versions(self, name: str, batch: DataFrame, batch_key: str, key: str) -> DataFrame:
        """Versions of the entities of a batch: open ones of their buckets, and those this run closed.

        Rows of a batch are newer than every version closed before it, so no other can match.
        """
        buckets = sinks.touched_buckets(batch.withColumnRenamed(batch_key, key), key, self.buckets)
        # A touched bucket's partition has both: its open versions and what the run closed there.
        stored = self._read(name).filter(
            (F.col(sinks.STATE) == sinks.OPEN) & F.col(sinks.PART).isin(buckets)
        )
        return stored.drop(sinks.STATE, sinks.PART)

    def _merge_bridge(
        self,
        run: str,
        name: str,
        pairs: DataFrame,
        keys: list[str],
        as_of: Column,
        check_cols: list[str] | None,
        gone: DataFrame,
        full: bool,
    ) -> None:
        entity, token_id = keys
        withdrawn = gone.select(*(surrogate_key(c).alias(k) for c, k in zip(gone.columns, keys)))

        def merged() -> DataFrame:
            touched = pairs.select(entity).unionByName(withdrawn.select(entity))
            buckets = None if full else sinks.touched_buckets(touched, entity, self.buckets)
            opened = sinks.read_open_versions(self._read(name), buckets)
            rows = merge_open(opened, pairs, keys, "loaded_at", as_of, full, check_cols)
            end = as_of.cast(opened.schema[VALID_TO].dataType)
            rows = (
                rows.join(withdrawn.withColumn("__end", end), keys, "left")
                .withColumn(VALID_TO, F.coalesce(VALID_TO, "__end"))
                .select(*opened.columns)
            )
            return sinks.place_versions(rows, entity, self.buckets, run)

        rows = self._staged(run, name, merged)
        sinks.publish(rows, self.path(name), sinks.STATE, sinks.PART)

    def _add_tokens(self, run: str, name: str, tokens: DataFrame, key: str) -> None:
        """Append the batch's tokens the dimension lacks; tokens stay, as closed pairs refer to them."""
        rows = self._staged(run, name, lambda: tokens.join(getattr(self, name).select(key), key, "left_anti"))
        self._publish_tokens(run, name, rows)
