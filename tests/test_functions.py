import datetime as dt

import pytest
from pyspark.sql import functions as F

from ticketlens.functions.calendar import epoch_millis_to_date, parse_date_coerce, \
    parse_date_strict, calendar_alias_columns, month_name
from ticketlens.functions.money import clean_price, round2
from ticketlens.functions.timeofday import delay_minutes, hms, hour_of_day, minutes_between, \
    minutes_between_wrapped, seconds_of_day, seconds_of_day_strict


def test_hms_and_seconds_round_trip(spark):
    df = spark.createDataFrame([(0,), (3661,), (86399,)], "s int")
    out = df.select(hms("s").alias("t")).select("t", seconds_of_day("t").alias("s2")).collect()
    assert [r.t for r in out] == ["00:00:00", "01:01:01", "23:59:59"]
    assert [r.s2 for r in out] == [0, 3661, 86399]


def test_bad_time_text_is_null(spark):
    df = spark.createDataFrame([("7:05",), ("25:00:00",), ("ab:cd:ef",), (None,)], "t string")
    assert [r[0] for r in df.select(seconds_of_day("t")).collect()] == [None] * 4
    assert [r[0] for r in df.select(hour_of_day("t")).collect()] == [None] * 4


def test_one_digit_hours_and_the_strict_parser(spark):
    df = spark.createDataFrame([("7:05:00",), ("07:05:00",), (None,)], "t string")
    assert [tuple(r) for r in df.select(seconds_of_day("t"), hour_of_day("t"), seconds_of_day_strict("t")).collect()] == \
        [(25500, 7, 25500), (25500, 7, 25500), (None, None, None)]
    bad = spark.createDataFrame([("25:00:00",)], "t string")
    with pytest.raises(Exception, match="not a time of day"):
        bad.select(seconds_of_day_strict("t")).collect()


def test_midnight_duration_and_delay(spark):
    # dep 23:50, arr 00:20 (next day), actual 00:10 / 00:40; arr 23:55, actual 00:05
    df = spark.createDataFrame([("23:50:00", "00:20:00", "00:10:00"),
                                ("23:50:00", "00:20:00", "00:40:00"),
                                ("23:00:00", "23:55:00", "00:05:00")], "dep string, arr string, act string")
    r = df.select(minutes_between("dep", "arr").alias("d"),
                  minutes_between_wrapped("dep", "arr").alias("w"),
                  delay_minutes("act", "arr").alias("late")).collect()
    assert [x.d for x in r] == [-1410.0, -1410.0, 55.0]      # upstream: no midnight fix
    assert [x.w for x in r] == [30.0, 30.0, 55.0]
    assert [x.late for x in r] == [0.0, 20.0, 0.0]           # past-midnight delay clips to 0


@pytest.mark.parametrize("text,expected", [("£43", 43), ("£1,234.50", 1235), ("2.5", 3),
                                           ("0", 0), ("£1,234.49", 1234), ("junk", None)])
def test_clean_price_half_up(spark, text, expected):
    df = spark.createDataFrame([(text,)], "p string")
    assert df.select(clean_price("p")).first()[0] == expected


def test_date_parsers(spark):
    df = spark.createDataFrame([("2024-01-05",), ("not-a-date",), ("",)], "d string")
    assert [r[0] for r in df.select(parse_date_coerce("d")).collect()] == \
        [dt.date(2024, 1, 5), None, None]
    with pytest.raises(Exception):
        df.select(parse_date_strict("d")).collect()
    ms = spark.createDataFrame([("1704067200000",), ("oops",)], "m string")
    assert [r[0] for r in ms.select(epoch_millis_to_date("m")).collect()] == [dt.date(2024, 1, 1), None]


def test_calendar_alias_columns_repeat_year_and_month(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 9),)], "d date")
    r = df.select(*[c.alias(n) for n, c in calendar_alias_columns("d").items()],
                  month_name("d").alias("mn")).first().asDict()
    assert r["2023"] == r["2024"] == 2024
    assert r["January"] == r["Feburary"] == r["December"] == 3
    assert r["mn"] == "March"


def test_round2_is_half_up_on_decimal_form(spark):
    df = spark.createDataFrame([(2.675,), (1.005,), (-0.125,)], "x double")
    assert [r[0] for r in df.select(round2("x")).collect()] == [2.68, 1.01, -0.13]
