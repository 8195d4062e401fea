import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from revlens import functions as fn


def test_strip_line_is_python_strip(column):
    texts = ["  a b ", "\t\x1ca\x1f", "　\xa0x ", "", " \t", "﻿a", "a​", "é "]
    assert column("string", texts, fn.strip_line) == [t.strip() for t in texts]


def test_trim_keeps_what_is_no_white_space(column):
    texts = ["\x1ca ", "\tX\n", " ", "X "]
    assert column("string", texts, fn.trim_whitespace) == ["\x1ca", "X", "", "X"]


def test_is_blank(column):
    texts = [None, "", "  ", "\t", "　", " x"]
    assert column("string", texts, fn.is_blank) == [True] * 5 + [False]


def test_calendar_date_edges(column):
    seconds = [0, -1, 86399, 86400, 951782400, None]
    days = ["1970-01-01", "1969-12-31", "1970-01-01", "1970-01-02", "2000-02-29"]
    expected = [dt.date.fromisoformat(d) for d in days] + [None]
    assert column("bigint", seconds, fn.calendar_date) == expected


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kathmandu"])
def test_dates_do_not_depend_on_the_session_zone(spark, column, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        keys = column("bigint", [0, 86399], lambda s: fn.date_key(fn.calendar_date(s)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert keys == [19700101, 19700101]


def test_date_parts(column):
    days = [dt.date(2024, 2, 29), dt.date(2024, 3, 2), dt.date(2024, 3, 3), dt.date(999, 1, 5)]
    assert column("date", days, fn.date_key) == [20240229, 20240302, 20240303, 9990105]
    assert column("date", days, fn.is_weekend)[:3] == [False, True, True]
    assert column("date", days, fn.month_start)[0] == dt.date(2024, 2, 1)


def test_month_name(column):
    names = column("bigint", range(1, 13), fn.month_name)
    assert names[0] == "January" and names[4] == "May" and names[11] == "December"


def test_epoch_floor_is_the_first_second_of_the_day():
    assert fn.epoch_floor(dt.date(1970, 1, 4), 3) == 0
    assert fn.epoch_floor(dt.date(1970, 1, 4)) == 3 * 86400


def test_rounding_works_on_the_binary_value(column):
    values = [201 / 200, 2.675, 0.125, 2.0, 1.994999, None]
    assert column("double", values, fn.round_half_away) == [1.0, 2.68, 0.13, 2.0, 1.99, None]


def test_ratio_is_double(frame):
    df = frame("a bigint, b bigint", (1, 3))
    assert df.select(fn.ratio(F.col("a"), F.col("b")).alias("r")).dtypes == [("r", "double")]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_price_cast(spark, column, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert column("string", [None, "3.17", "-1"], fn.strict_double) == [None, 3.17, -1.0]
        assert column("string", ["abc", "1e3"], fn.try_double) == [None, 1000.0]
        with pytest.raises(PySparkException, match="not a number: abc"):
            column("string", ["1", "abc"], fn.strict_double)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_element_or_null(column):
    arrays = [[], [1], [1, 2], None]
    assert column("array<bigint>", arrays, lambda a: fn.element_or_null(a, 0)) == [None, 1, 1, None]
    assert column("array<bigint>", arrays, lambda a: fn.element_or_null(a, 1)) == [
        None, None, 2, None,
    ]


def test_json_scalar(column):
    texts = {
        '[["A"]]': "A",
        '[["[x"]]': "[x",
        '[["null"]]': "null",
        '[[{"a":1}]]': None,
        "[[[1]]]": None,
        "[[null]]": None,
        "[[true]]": "true",
        "[[7]]": "7",
        '[[""]]': "",
        "[]": None,
        "{}": None,
        "bad": None,
        '["A"]': None,
        "": None,
    }
    found = column("string", [*texts, None], lambda t: fn.json_scalar(t, "$[0][0]"))
    assert found == [*texts.values(), None]


def test_surrogate_key(frame):
    import hashlib

    df = frame("a string, b bigint", ("r", 5), (None, 5))
    keys = [r[0] for r in df.select(fn.surrogate_key("a", "b")).collect()]
    texts = ["r-5", "_dbt_utils_surrogate_key_null_-5"]
    assert keys == [hashlib.md5(t.encode()).hexdigest() for t in texts]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(-62135596800, 253402300799), min_size=1, max_size=50))
def test_calendar_date_matches_python(spark, seconds):
    df = spark.createDataFrame([(s,) for s in seconds], "v bigint")
    got = [r[0] for r in df.select(fn.calendar_date(F.col("v"))).collect()]
    epoch = dt.date(1970, 1, 1).toordinal()
    assert got == [dt.date.fromordinal(epoch + s // 86400) for s in seconds]


def test_strict_double_takes_decimal_literals_only(column):
    from pyspark.errors import PySparkException

    from revlens.functions import strict_double

    assert column("string", ["1.5", " -2e3", ".5", "inf", None], strict_double) == [1.5, -2000.0, 0.5, float("inf"), None]
    for text in ("1.5d", "2f", "0x1p3", ""):
        with pytest.raises(PySparkException):
            column("string", [text], strict_double)
