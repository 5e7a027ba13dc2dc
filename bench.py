"""Benchmark: prints one JSON line with wall seconds per query.

Every registered query of the warehouse is timed. The warehouse is built once from the raw
observations, as its users would, and the business questions run on the stored tables;
the other queries run straight on the source tables. Each query is timed after one warm-up run, plan
building included; BENCH_RUNS asks for the median of several. The store lies in the shared
folder (``spark.checkpoint.dir``), or in the local temporary folder where that is unset,
and is removed at the end.
"""

from __future__ import annotations

import json
import os
import shutil
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from stratavid.plans import catalog  # noqa: E402
from stratavid.plans.layers import Layers  # noqa: E402
from stratavid.plans.raw import CHANNEL_TIEBREAK, VIDEO_TIEBREAK  # noqa: E402
from stratavid.plans.warehouse import Warehouse  # noqa: E402
from stratavid.session import local_session, shared_folder  # noqa: E402

QUESTIONS = (
    "top_10_channels", "top_10_videos", "popular_keywords", "duration_view_corr", "tag_engagement",
    "category_performance", "top_categories", "optimal_length", "secure_top_channels",
    "secure_top_videos", "masked_top_channels", "masked_top_videos", "legacy_top_topic",
    "legacy_top_channels_topic", "legacy_best_category", "legacy_category_duration",
    "legacy_duration_corr", "legacy_tag_engagement", "legacy_optimal_length",
    "legacy_top_videos_ilike",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session(cores, "bench")
    queries = catalog.queries()
    root = tempfile.mkdtemp(prefix="stratavid-bench-", dir=shared_folder(spark, tempfile.gettempdir()))
    seconds: dict[str, float] = {}

    def timed(name: str, run, times: int = runs) -> None:
        took = []
        for _ in range(times):
            start = time.perf_counter()
            run()
            took.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(took), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)

    def drain(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    queries["silver_videos"](spark, sf_dir).count()
    for name in (n for n in queries if n not in QUESTIONS):
        drain(queries[name](spark, sf_dir))
        timed(name, lambda: drain(queries[name](spark, sf_dir)))

    tables = Layers(spark, sf_dir)
    store = Warehouse(spark, root)
    build = (tables.raw_channels, tables.raw_videos, tables.as_of, CHANNEL_TIEBREAK, VIDEO_TIEBREAK)
    try:
        timed("warehouse_build", lambda: store.build(*build), 1)
        for name in QUESTIONS:
            catalog.ask(name, store).collect()
            timed(name, lambda: catalog.ask(name, store).collect())
    finally:
        spark.stop()
        shutil.rmtree(root.removeprefix("file://"), ignore_errors=True)
    print(
        json.dumps(
            {
                "metric": "total_wall_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cores": cores,
            }
        )
    )


if __name__ == "__main__":
    main()
