from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stratavid import functions as S


def values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def texts(frame, *items):
    return frame("t string", *[(i,) for i in items])


@pytest.mark.parametrize(
    "text, seconds",
    [
        ("PT1H2M3S", 3723), ("PT45S", 45), ("PT5M", 300), ("PT2H", 7200), ("P1DT2H", 0), ("P0D", 0),
        ("", 0), (None, 0), ("PT1H5S", 3605), ("PT90M", 5400),
    ],
)
def test_iso_duration(frame, text, seconds):
    assert values(texts(frame, text), S.iso_duration_seconds("t")) == [seconds]


def test_iso_duration_with_days(frame):
    df = texts(frame, "P1DT2H", "P2D", "PT5M", "P1DT1H1M1S")
    assert values(df, S.iso_duration_seconds("t", days=True)) == [93600, 172800, 300, 90061]


def test_blank_to_null_trims_spaces_only(frame):
    assert values(texts(frame, "", "   ", " a ", "\t", None), S.blank_to_null("t")) == [
        None, None, "a", "\t", None,
    ]


def test_lenient_numbers(frame):
    df = texts(frame, "12", "12.7", "abc", "", None, "12d", "9007199254740993", "nan", "1e3", "-4", " 7 ")
    assert values(df, S.lenient_long("t")) == [12, 12, 0, 0, 0, 0, 9007199254740993, 0, 1000, -4, 7]


def test_lenient_booleans(frame):
    df = texts(frame, "True", "1", "yes", "no", "0", "", None)
    assert values(df, S.lenient_bool("t")) == [True, True, True, False, False, False, False]


def test_half_minutes(frame):
    df = frame("s int", (30,), (90,), (150,))
    assert values(df, S.round_half_even(F.col("s") / 60)) == [0, 2, 2]
    assert values(df, S.round_half_up(F.col("s") / 60)) == [1, 2, 3]


def test_parse_timestamp(frame, spark):
    df = texts(
        frame, "2024-01-02T03:04:05Z", "2024-01-02T03:04:05+02:00", "2024-01-02", "x", "", None,
        "2024-01-02 23:59:59",
    )
    expected = [
        datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 1, 4, 5), datetime(2024, 1, 2), None, None,
        None, datetime(2024, 1, 2, 23, 59, 59),
    ]
    assert values(df, S.parse_timestamp("t")) == expected
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert values(df, S.parse_timestamp("t")) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_iso_weekday_and_month(frame):
    df = frame("t string", ("2024-01-01",), ("2024-01-06",), ("2024-01-07",)).select(
        F.col("t").cast("date").alias("d")
    )
    assert values(df, S.iso_weekday("d")) == [1, 6, 7]
    assert values(df, S.year_month("d")) == ["202401"] * 3


def test_surrogate_key(frame):
    df = frame("a string, b string", ("x", None), ("x", ""), ("x", "y"))
    keys = values(df, S.surrogate_key("a", "b"))
    assert len(set(keys)) == 3
    assert keys[2] == values(df, F.md5(F.lit("x-y")))[0]


def test_pseudonym(frame):
    df = texts(frame, "a", "a", "b", None)
    one, two, other, none = values(df, S.pseudonym("t", salt="s"))
    assert one == two != other and none is None and "a" != one
    assert values(df, S.pseudonym("t", salt="z"))[0] != one


def test_list_text(frame):
    df = texts(frame, "['x', 'y']", """["don't", 'b']""", "a, b,,a ", "", None, "[]")
    assert values(df, S.normalise_list_text("t")) == ["x, y", "don't, b", "a, b,,a", "", None, ""]


def test_join_and_truncate(frame):
    df = frame("a array<string>", (["x", "y"],), ([],), (None,))
    assert values(df, S.join_list("a")) == ["x, y", "", ""]
    assert values(texts(frame, "abcdef", None), S.truncate("t", 3)) == ["abc", None]


def test_text_predicates(frame):
    df = texts(frame, "A topic", "A Topic", None)
    assert values(df, S.lacks_text("t", "topic")) == [False, True, True]
    df = texts(frame, "EE", "ee", "", None, "LV")
    assert df.filter(S.equals_or_missing("t", "EE")).count() == 4
    assert values(texts(frame, "https://x/Sport"), S.contains_any_case("t", "sPORT")) == [True]


@pytest.mark.parametrize(
    "pairs, expected",
    [
        ([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)], 1.0),
        ([(1.0, 3.0), (2.0, 2.0), (3.0, 1.0)], -1.0),
        ([(0.1, 1.0), (0.1, 2.0), (0.1, 5.0)], None),
        ([(1.0, 1.0)], None),
        ([], None),
        ([(1.0, 1.0), (1.0, 2.0), (5.0, None)], None),
    ],
)
def test_correlation(frame, pairs, expected):
    [(found,)] = frame("x double, y double", *pairs).agg(S.correlation("x", "y")).collect()
    assert found == (None if expected is None else pytest.approx(expected))


def test_sanity_rules(frame):
    df = frame("n bigint, t timestamp_ntz", (-1, "2024-01-02"), (0, "2024-01-01"), (None, None))
    as_of = F.lit("2024-01-01").cast("timestamp_ntz")
    assert values(df, S.non_negative("n")) == [None, 0, None]
    assert values(df, S.not_future("t", as_of)) == [None, datetime(2024, 1, 1), None]
    assert values(df, S.ratio(F.lit(3), F.col("n"))) == [-3.0, None, None]


def test_interval_lengths(spark):
    df = spark.sql("SELECT INTERVAL '1 02:03:04.5' DAY TO SECOND AS d, 'PT1M30S' AS t")
    assert values(df, S.interval_seconds("d")) == [93784.5]
    assert values(df, S.length_seconds(df, "d")) == [93784.5]
    assert values(df, S.length_seconds(df, "t")) == [90]
