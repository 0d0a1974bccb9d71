"""Edge rows for the column expressions (hand-written expectations)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from boxstar.functions import (
    arg_max,
    day_of_week_sunday0,
    decode_flag,
    mask_outside,
    mask_values,
    normalize_game_type,
    null_na_tokens,
    parse_minutes,
    parse_timestamp,
    round_half_away,
    season_end_year,
    season_label,
    threshold_ladder,
    to_double,
    to_whole,
)


def col_values(spark, values, expr, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr(F.col("v")).alias("out")).collect()]


def test_minutes_good(spark):
    got = col_values(spark, ["34:30", "12", " 7.5 ", "-1:30", "1e1", "+3:15", "0:30"], parse_minutes)
    assert got == [34.5, 12.0, 7.5, -0.5, 10.0, 3.25, 0.5]


def test_minutes_unicode_whitespace(spark):
    got = col_values(spark, ["\u00a012\u2003", "\t7.5\n", "\u00a034:30 "], parse_minutes)
    assert got == [12.0, 7.5, 34.5]


def test_minutes_bad(spark):
    got = col_values(spark, ["", "12:34:56", "abc", "12d", ":30", "5:", "PT12M", None, "   "], parse_minutes)
    assert got == [None] * 9


def test_flags(spark):
    got = col_values(spark, ["True", "false", "1", "0", "TRUE", "yes", "1.0", None, "true", "False"], decode_flag)
    assert got == [1, 0, 1, 0, None, None, None, None, 1, 0]


@pytest.mark.parametrize(
    "values,want",
    [
        (["1.0", "0.0", None, "1.0"], [1, 0, None, 1]),  # a column of numbers
        (["TRUE", "False", None], [1, 0, None]),  # a column of boolean words
        (["True", "1", "TRUE", "yes", "1.0"], [1, 1, None, None, None]),  # mixed text
    ],
)
def test_flag_columns_are_read_by_their_type(spark, values, want):
    from boxstar.plans.clean import clean_players

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, guard string")
    assert [r["guard"] for r in clean_players(df).orderBy("i").collect()] == want


def test_whole_numbers_from_text(spark):
    got = col_values(spark, ["1", "1.0", "True", "false", " 0 ", "1.5", "12d", "inf", "1e999", None], to_whole)
    assert got == [1, 1, 1, 0, 0, None, None, None, None, None]
    assert col_values(spark, ["1e999", "1e3", "inf"], to_double) == [None, 1000.0, None]
    assert col_values(spark, ["1e999", "1:1e999"], parse_minutes) == [None, None]


def test_range_masks(spark):
    h = col_values(spark, [64.0, 65.0, 90.0, 91.0, None], lambda c: mask_outside(c, 65, 90), "v double")
    w = col_values(spark, [119.0, 120.0, 400.0, 401.0], lambda c: mask_outside(c, 120, 400), "v double")
    assert h == [None, 65.0, 90.0, None, None]
    assert w == [None, 120.0, 400.0, None]


def test_draft_sentinels(spark):
    got = col_values(spark, [-1.0, -22.0, 0.0, 2003.0, None], lambda c: mask_values(c, (-1, -22)), "v double")
    assert got == [None, None, 0.0, 2003.0, None]


def test_na_tokens(spark):
    got = col_values(spark, ["", "NA", "N/A", "None", "NULL", "null", "nan", "Null", " NA", "x"], null_na_tokens)
    assert got == [None] * 7 + ["Null", " NA", "x"]


def test_game_type(spark):
    got = col_values(
        spark,
        [" Pre Season ", "pre season", "Regular Season", "in-season-knockout", "Emirates NBA Cup", "  ", None, " Playoffs "],
        normalize_game_type,
    )
    assert got == ["Preseason", "Preseason", "Regular Season", "In-Season Tournament", "In-Season Tournament", None, None, "Playoffs"]


def test_timestamp_single_format(spark):
    got = col_values(spark, ["2024-01-07 10:00:00", "2024-01-07", "2024-01-07T10:00:00Z", "garbage"], parse_timestamp)
    assert got == [dt.datetime(2024, 1, 7, 10), None, None, None]


def test_season_and_label(spark):
    df = spark.createDataFrame([(dt.date(2024, 9, 30),), (dt.date(2024, 10, 1),)], "d date")
    got = [r[0] for r in df.select(season_end_year("d")).collect()]
    assert got == [2024, 2025]
    lab = [r[0] for r in spark.createDataFrame([(2025,), (2000,)], "y int").select(season_label("y")).collect()]
    assert lab == ["2024-25", "1999-00"]


def test_day_of_week(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 7),), (dt.date(2024, 1, 6),)], "d date")
    assert [r[0] for r in df.select(day_of_week_sunday0("d")).collect()] == [0, 6]


def test_arg_max_nulls_and_ties(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, 3.0), (2.0, None), (None, None)], "a double, b double")
    got = [r[0] for r in df.select(arg_max([("a", F.col("a")), ("b", F.col("b"))])).collect()]
    assert got == ["a", "b", "a", None]


def test_threshold_ladder(spark):
    df = spark.createDataFrame([(10.0,), (7.0,), (5.0,), (1.0,), (None,)], "v double")
    ladder = [("95", F.lit(9.0)), ("75", F.lit(7.0)), ("50", F.lit(5.0))]
    assert [r[0] for r in df.select(threshold_ladder("v", ladder, "Low")).collect()] == ["95", "75", "50", "Low", "Low"]
    null_cuts = [("95", F.lit(None).cast("double"))]
    assert [r[0] for r in df.select(threshold_ladder("v", null_cuts, "Low")).collect()] == ["Low"] * 5


@pytest.mark.parametrize("x,places,expected", [(1.005, 2, 1.0), (2.675, 2, 2.68), (0.125, 2, 0.13), (-2.5, 0, -3.0), (12.345, 2, 12.35)])
def test_round_half_away_binary(spark, x, places, expected):
    got = spark.createDataFrame([(x,)], "v double").select(round_half_away("v", places)).first()[0]
    assert got == expected


def test_whole_numbers_keep_every_digit(spark):
    from boxstar.functions.cleaning import to_whole

    cases = {
        "9007199254740993": 9007199254740993, "-9007199254740993.0": -9007199254740993, " 9223372036854775807 ": 9223372036854775807,
        "9223372036854775808": None, "-9223372036854775808": -9223372036854775808, "9007199254740993.5": None, "1": 1, "1.0": 1, "1.": 1,
        "+7": 7, "1e2": 100, "1.5e1": 15, "1e-1": None, "1e-30": None, "0.5": None, "1e30": None, "1e999": None, "": None, "x": None,
        "true": 1, " FALSE ": 0, "12d": None, "nan": None, "0": 0, "-0.0": 0, "000123": 123, None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r.s: r.n for r in df.select("s", to_whole("s", "long").alias("n")).collect()}
    assert got == cases
    small = {r.s: r.n for r in df.select("s", to_whole("s", "int").alias("n")).collect()}
    assert small["9007199254740993"] is None and small["1e2"] == 100


def test_times_do_not_follow_the_session_zone(spark):
    import datetime as dt

    from boxstar.functions.cleaning import parse_timestamp

    cases = [
        ("2024-03-10 02:30:00", "yyyy-MM-dd HH:mm:ss", dt.datetime(2024, 3, 10, 2, 30)),  # no such hour in New York
        ("2024-11-03 01:30:00", "yyyy-MM-dd HH:mm:ss", dt.datetime(2024, 11, 3, 1, 30)),  # twice there
        ("1890-01-01 00:00:00", "yyyy-MM-dd HH:mm:ss", dt.datetime(1890, 1, 1)),
        ("2024-03-10", "yyyy-MM-dd", dt.datetime(2024, 3, 10)),
        ("2024-11-02T19:30:00-05:00", "yyyy-MM-dd'T'HH:mm:ssXXX", dt.datetime(2024, 11, 3, 0, 30)),  # in UTC
        ("2024-03-10T02:30:00Z", "yyyy-MM-dd'T'HH:mm:ssXXX", dt.datetime(2024, 3, 10, 2, 30)),
        ("2024-03-10T02:30:00", "yyyy-MM-dd'T'HH:mm:ss", dt.datetime(2024, 3, 10, 2, 30)),
        ("2024-02-30 00:00:00", "yyyy-MM-dd HH:mm:ss", None),
        ("2024-03-10 02:30:00 UTC", "yyyy-MM-dd HH:mm:ss", None),
        ("soon", "yyyy-MM-dd HH:mm:ss", None),
        (None, "yyyy-MM-dd HH:mm:ss", None),
    ]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            for text, fmt, want in cases:
                df = spark.createDataFrame([(text,)], "s string").select(parse_timestamp("s", fmt).alias("t"))
                assert dict(df.dtypes)["t"] == "timestamp_ntz" and df.first()["t"] == want, (zone, text)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
