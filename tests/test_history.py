from datetime import date, datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratavid.operators.history import (
    asof_join,
    extend_open,
    merge_late,
    scd2_history,
    scd2_merge,
    scd2_merge_timestamp,
    split_versions,
    versioned_view,
    with_version_key,
)
from stratavid.operators.latest import daily_latest
from stratavid.operators.tokens import token_bridge
from tests.conftest import final_plan, rows_of

OBSERVED = "id string, title string, note string, ts timestamp_ntz"
VERSIONS = "id string, title string, note string, valid_from timestamp_ntz, valid_to timestamp_ntz"


def at(text):
    return F.lit(text).cast("timestamp_ntz")


def history(df):
    return scd2_history(df, ["id"], "ts", ["title"])


def test_versions_open_on_change_only(frame):
    df = frame(
        OBSERVED,
        ("a", "A", "1", "2024-01-01"), ("a", "A", "2", "2024-01-02"), ("a", "B", "3", "2024-01-03"),
        ("a", "A", "4", "2024-01-04"),
    )
    assert rows_of(history(df)) == [
        ("a", "A", "1", "2024-01-01 00:00:00", "2024-01-03 00:00:00"),
        ("a", "A", "4", "2024-01-04 00:00:00", None),
        ("a", "B", "3", "2024-01-03 00:00:00", "2024-01-04 00:00:00"),
    ]


def test_null_states(frame):
    df = frame(
        OBSERVED,
        ("a", None, "", "2024-01-01"), ("a", None, "", "2024-01-02"), ("a", "x", "", "2024-01-03"),
    )
    assert rows_of(history(df), "title", "valid_from") == [
        ("x", "2024-01-03 00:00:00"), (None, "2024-01-01 00:00:00"),
    ]


def test_a_days_last_observation_counts(frame):
    df = frame(
        OBSERVED,
        ("a", "A", "", "2024-01-01 08:00:00"), ("a", "B", "", "2024-01-01 20:00:00"),
        ("a", "B", "", "2024-01-02 08:00:00"),
    )
    assert rows_of(history(df), "title", "valid_from") == [("B", "2024-01-01 20:00:00")]


def test_merge_keeps_changes_and_opens(frame):
    current = frame(
        VERSIONS,
        ("same", "A", "old", "2024-01-01", None), ("diff", "A", "old", "2024-01-01", None),
        ("gone", "A", "old", "2024-01-01", None), ("null", None, "old", "2024-01-01", None),
        ("diff", "0", "older", "2023-01-01", "2024-01-01"),
    )
    batch = frame(
        OBSERVED,
        ("same", "A", "new", "2024-01-02"), ("diff", "B", "new", "2024-01-02"),
        ("new", "A", "new", "2024-01-02"), ("null", None, "new", "2024-01-02"),
    )
    first, second, close = "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"
    kept = [
        ("diff", "0", "older", "2023-01-01 00:00:00", first), ("diff", "A", "old", first, second),
        ("diff", "B", "new", second, None), ("new", "A", "new", second, None),
        ("null", None, "old", first, None), ("same", "A", "old", first, None),
    ]
    args = (["id"], ["title"], "ts", at("2024-01-03"))
    partial = scd2_merge(current, batch, *args)
    assert rows_of(partial) == sorted([*kept, ("gone", "A", "old", first, None)], key=repr)
    full = scd2_merge(current, batch, *args, full_snapshot=True)
    assert rows_of(full) == sorted([*kept, ("gone", "A", "old", first, close)], key=repr)
    # The same batch again changes nothing, and a vanished key that returns is reopened.
    assert rows_of(scd2_merge(full, batch, *args)) == rows_of(full)
    back = frame(OBSERVED, ("gone", "A", "back", "2024-01-05"))
    reopened = scd2_merge(full, back, *args)
    assert ("gone", "A", "back", "2024-01-05 00:00:00", None) in rows_of(reopened)


def test_timestamp_merge(frame):
    current = frame(VERSIONS, ("a", "A", "", "2024-01-02", None), ("b", "A", "", "2024-01-02", None))
    batch = frame(OBSERVED, ("a", "A", "", "2024-01-02"), ("b", "A", "", "2024-01-03"))
    merged = scd2_merge_timestamp(current, batch, ["id"], "ts", at("2024-01-09"))
    assert rows_of(merged, "id", "valid_from", "valid_to") == [
        ("a", "2024-01-02 00:00:00", None),
        ("b", "2024-01-02 00:00:00", "2024-01-03 00:00:00"),
        ("b", "2024-01-03 00:00:00", None),
    ]


def test_version_key_is_unique_per_version(frame):
    versions = frame(VERSIONS, ("a", "A", "", "2024-01-01", "2024-01-02"), ("a", "B", "", "2024-01-02", None))
    keyed = with_version_key(versioned_view(versions), "id")
    assert keyed.select("version_sk").distinct().count() == 2
    assert rows_of(keyed, "title", "is_current") == [("A", False), ("B", True)]


def test_asof_boundaries(frame):
    versions = frame(
        "vid string, title string, valid_from timestamp_ntz, valid_to timestamp_ntz",
        ("a", "A", "2024-01-10", "2024-03-01"), ("a", "B", "2024-03-01", None),
        ("b", "C", "2023-01-01", "2023-01-02"),
    )
    facts = frame(
        "id string, at timestamp_ntz",
        ("a", "2024-01-09 23:59:59"), ("a", "2024-01-10"), ("a", "2024-02-15"),
        ("a", "2024-02-29 23:59:59"), ("a", "2024-03-01"), ("a", "2030-01-01"), ("b", "2023-06-01"),
        ("c", "2024-01-10"),
    )
    expected = [
        ("2024-01-10 00:00:00", "A"), ("2024-02-15 00:00:00", "A"), ("2024-02-29 23:59:59", "A"),
        ("2024-03-01 00:00:00", "B"), ("2030-01-01 00:00:00", "B"),
    ]
    for horizon in ("2020-01-01", "2024-02-01", "2024-06-01", "2040-01-01"):
        for span in ("month", "year"):
            found = asof_join(facts, versions, "id", "vid", "at", at(horizon), span=span)
            assert rows_of(found, "at", "title") == expected
    outer = asof_join(facts, versions, "id", "vid", "at", at("2024-06-01"), how="left")
    assert outer.count() == 8 and outer.filter("title is null").count() == 3


def test_asof_join_over_the_key_alone_gives_the_same(frame):
    versions = frame(
        "vid string, title string, valid_from timestamp_ntz, valid_to timestamp_ntz",
        ("a", "A", "2024-01-10", "2024-03-01"), ("a", "B", "2024-03-01", None), ("b", "C", "2023-01-01", "2023-01-02"),
        ("d", "D", None, None), (None, "E", "2023-01-01", None),
    )
    facts = frame(
        "id string, at timestamp_ntz",
        ("a", "2024-01-09 23:59:59"), ("a", "2024-01-10"), ("a", "2024-02-15"), ("a", "2024-03-01"), ("a", "2030-01-01"),
        ("b", "2023-06-01"), ("b", "2023-01-01"), ("c", "2024-01-10"), ("d", "2024-01-10"), ("d", "2024-06-10"), ("d", None), ("a", None), (None, "2024-01-10"),
        ("a", "2024-02-15"),
    )
    for how in ("inner", "left"):
        by_month, by_key = (asof_join(facts, versions, "id", "vid", "at", at("2024-06-01"), how, span) for span in ("month", None))
        assert rows_of(by_key) == rows_of(by_month)


def test_bridge_deals_versions_and_lists_once(frame):
    staging = frame("id string, tags string, loaded_at timestamp_ntz", ("a", "x, y", "2024-01-10"), ("a", "y", "2024-02-15"),
                    ("a", "", "2024-02-16"), (None, "z", "2024-01-10"), ("b", "x", "2024-01-10"))
    versions = frame("vid string, sk string, valid_from timestamp_ntz, valid_to timestamp_ntz",
                     ("a", "A", "2024-01-01", "2024-02-01"), ("a", "A", "2024-02-01", None), (None, "N", "2024-01-01", None))
    pairs = token_bridge(staging, versions, "id", "vid", "sk", "tags", "tag", "tag_id", at("2024-06-01"))
    assert pairs._jdf.queryExecution().optimizedPlan().toString().count("RebalancePartitions") == 1
    assert rows_of(pairs, "sk", "loaded_at") == [("A", "2024-01-10 00:00:00"), ("A", "2024-02-15 00:00:00")]


def test_asof_join_spreads_a_hot_key(spark, frame):
    """The window that facts meet versions in is split by span, and an open version does not fan out."""
    versions = frame("vid int, valid_from timestamp_ntz, valid_to timestamp_ntz", (1, "2000-01-01", None))
    facts = frame("id int, at timestamp_ntz", (1, "2020-05-05"), (1, "2020-05-06"), (1, "2020-09-01"))
    joined = asof_join(facts, versions, "id", "vid", "at", at("2021-01-01"))
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    meeting = plan.split("Window [last(__version")[1].split("\n")[0]
    assert "[__key#" in meeting and "__span#" in meeting.split("windowspecdefinition")[1].split("ASC")[0]
    assert "Join" not in plan and "explode" not in plan
    assert joined.count() == 3


DAYS = [date(2024, 1, 1) + timedelta(days=i) for i in range(5)]
observations = st.lists(
    st.tuples(st.sampled_from("ab"), st.sampled_from(["x", "y", None]), st.sampled_from(DAYS)),
    min_size=1,
    max_size=12,
    unique_by=lambda o: (o[0], o[2]),
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(observations)
def test_merging_day_by_day_equals_one_rebuild(frame, observed):
    def rows(chosen):
        return frame(OBSERVED, *[(k, v, "", datetime.combine(d, datetime.min.time()).isoformat()) for k, v, d in chosen])

    rebuilt = history(rows(observed))
    merged = frame(VERSIONS)
    for day in DAYS:
        today = [o for o in observed if o[2] == day]
        if today:
            merged = scd2_merge(merged, rows(today), ["id"], ["title"], "ts", at("2024-02-01"))
    assert rows_of(merged) == rows_of(rebuilt)

    early = [o for o in observed if o[2] <= DAYS[2]]
    late = [o for o in observed if o[2] > DAYS[2]]
    opened, closed = split_versions(history(rows(early)))
    extended = closed.unionByName(extend_open(opened, rows(late), ["id"], "ts", ["title"]))
    assert rows_of(extended) == rows_of(rebuilt)

    versions = rebuilt.withColumnRenamed("id", "vid").drop("note")
    matched = asof_join(rows(observed).drop("title"), versions, "id", "vid", "ts", at("2024-01-03"))
    assert rows_of(matched, "id", "title", "ts") == rows_of(rows(observed), "id", "title", "ts")
    opened = [r for r in rows_of(rebuilt) if r[4] is None]
    assert len(opened) == len({o[0] for o in observed})


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(observations, st.randoms())
def test_loads_in_any_order_equal_one_rebuild(frame, observed, chance):
    """Late rows cut versions, also where a sighting in between left no version of its own."""

    def rows(chosen):
        return frame(OBSERVED, *[(k, v, "", datetime.combine(d, datetime.min.time()).isoformat()) for k, v, d in chosen])

    chance.shuffle(observed)
    cut = chance.randint(0, len(observed))
    versions, arrived = history(rows(observed[:cut])), observed[:cut]
    for load in (observed[cut::2], observed[cut + 1 :: 2]):
        arrived = arrived + load
        versions = merge_late(versions, rows(load), rows(arrived), ["id"], "ts", ["title"])
    assert rows_of(versions) == rows_of(history(rows(observed)))


def test_late_rows_keep_the_ends_of_keys_that_were_gone(frame):
    versions = frame(
        VERSIONS,
        ("a", "A", "", "2024-01-01", "2024-01-05"), ("a", "B", "", "2024-01-08", "2024-01-20"),
        ("b", "A", "", "2024-01-01", None),
    )
    late = frame(OBSERVED, ("a", "C", "", "2024-01-03"))
    seen = frame(OBSERVED, ("a", "A", "", "2024-01-01"), ("a", "C", "", "2024-01-03"), ("a", "B", "", "2024-01-08"),
                 ("c", "Z", "", "2024-01-02"))
    assert rows_of(merge_late(versions, late, seen, ["id"], "ts", ["title"])) == [
        ("a", "A", "", "2024-01-01 00:00:00", "2024-01-03 00:00:00"),
        ("a", "B", "", "2024-01-08 00:00:00", "2024-01-20 00:00:00"),
        ("a", "C", "", "2024-01-03 00:00:00", "2024-01-05 00:00:00"),
        ("b", "A", "", "2024-01-01 00:00:00", None),
    ]
    # A late row of the day on which a key had gone brings it back, until it changes again.
    back = frame(OBSERVED, ("a", "A", "", "2024-01-05"))
    seen = seen.unionByName(back).filter("title <> 'C'")
    assert rows_of(merge_late(versions, back, seen, ["id"], "ts", ["title"]).filter("id = 'a'"), "title", "valid_from", "valid_to") == [
        ("A", "2024-01-01 00:00:00", "2024-01-05 00:00:00"),
        ("A", "2024-01-05 00:00:00", "2024-01-08 00:00:00"),
        ("B", "2024-01-08 00:00:00", "2024-01-20 00:00:00"),
    ]


def test_a_late_row_moves_the_days_observation(frame):
    """A newer row of a stored day takes its place, so the version starts later."""
    versions = history(frame(OBSERVED, ("a", "A", "", "2024-01-01 10:00:00"), ("a", "B", "", "2024-01-02 10:00:00")))
    late = frame(OBSERVED, ("a", "B", "", "2024-01-02 12:00:00"))
    seen = frame(OBSERVED, ("a", "A", "", "2024-01-01 10:00:00"), ("a", "B", "", "2024-01-02 12:00:00"))
    assert rows_of(merge_late(versions, late, seen, ["id"], "ts", ["title"]), "title", "valid_from") == [
        ("A", "2024-01-01 10:00:00"), ("B", "2024-01-02 12:00:00"),
    ]


def test_late_rows_merge_without_joins(spark, tmp_path):
    """Joins over unions of joins fail where shuffle partitions are joined into tasks unevenly, as on large tables."""
    rows = spark.range(4000).select(
        (F.col("id") % 600).alias("k"), F.col("id").alias("row"),
        (at("2024-01-01") + F.make_dt_interval(days=(F.col("id") * 7 % 400).cast("int"))).alias("ts"),
        (F.col("id") % 5 % 3).alias("state"),
    )
    whole = ["k"], "ts", ["state"], ["row"]
    scd2_history(rows.filter("row % 3 > 0"), *whole).write.parquet(f"{tmp_path}/versions")
    late, seen = rows.filter("row % 3 = 0"), daily_latest(rows, ["k"], "ts", ["row"])
    merged = merge_late(spark.read.parquet(f"{tmp_path}/versions"), late, seen, ["k"], "ts", ["state"])
    columns = ("k", "state", "valid_from", "valid_to")
    assert rows_of(merged, *columns) == rows_of(scd2_history(rows, *whole), *columns)
    plan = final_plan(merged).split("Initial Plan")[0]
    assert "Join" not in plan and plan.count("Scan parquet") == 1
