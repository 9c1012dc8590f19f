import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from opsledger.functions import scalars as X

D = dt.date


def column(spark, values, dtype, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r.o for r in df.select("i", expression.alias("o")).orderBy("i").collect()]


@pytest.mark.parametrize("make, values, wanted", [
    (X.numeric, ["1.5", "x", None, "-2", ""], [1.5, None, None, -2.0, None]),
    (X.rounded_long, ["1.5", "2.5", "x", None], [2, 2, None, None]),
    (X.tagged_id, ["A IND ID:12 B IND ID:7", "IND ID:", None, "none", "IND ID:x9"], ["12", "No ID", "No ID", "No ID", "No ID"]),
    (X.leading_digits, ["123 Name", "Name 123", "", None, "9"], [123, None, None, None, 9]),
    (X.first_digits, ["49 minutes", "about 7 or 8", "none", None], [49, 7, None, None]),
    (X.yes_no, ["yellow", "N/A", "maybe", "", None, "Y"], ["Yes", "No", "maybe", "", None, "Yes"]),
    (X.clean_text, ["\uFEFFa\u200B b\u2060 ", "\x00x\x7f\n", None, "\u200C\u200D"], ["a b", "x", None, ""]),
    (X.blank_to_null, ["", " ", "a", None], [None, " ", "a", None]),
    (X.lenient_date, ["2024-02-29", "2023-02-29", "x", None], [D(2024, 2, 29), None, None, None]),
])
def test_text_functions(spark, make, values, wanted):
    assert column(spark, values, "string", make("v")) == wanted


def test_relabel_keeps_unknown_and_null(spark):
    assert column(spark, ["a", "b", None], "string", X.relabel("v", {"a": "z"})) == ["z", "b", None]
    assert column(spark, ["a"], "string", X.relabel("v", {})) == ["a"]


def test_lenient_timestamp_with_format(spark):
    got = column(spark, ["2024-01-02 03:04", "nope"], "string", X.lenient_timestamp("v", "yyyy-MM-dd HH:mm"))
    assert got == [dt.datetime(2024, 1, 2, 3, 4), None]


def pairs(spark, rows, expression):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a date, b date")
    return [r.o for r in df.select("i", expression.alias("o")).orderBy("i").collect()]


@pytest.mark.parametrize("start, end, wanted", [
    (D(2024, 1, 3), D(2024, 1, 3), 1), (D(2024, 1, 6), D(2024, 1, 6), 0), (D(2024, 1, 6), D(2024, 1, 7), 0),
    (D(2024, 1, 5), D(2024, 1, 8), 2), (D(2024, 1, 8), D(2024, 1, 5), 2), (None, D(2024, 1, 8), None), (D(2024, 1, 8), None, None),
    (D(1969, 12, 26), D(1970, 1, 2), 6)])
def test_business_days_cases(spark, start, end, wanted):
    assert pairs(spark, [(start, end)], X.business_days("a", "b")) == [wanted]


def test_business_days_against_counting(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(400):
        a = D(1950, 1, 1) + dt.timedelta(days=rng.randrange(60000))
        rows.append((a, a + dt.timedelta(days=rng.randrange(-900, 900))))

    def count(a, b):
        lo, hi = min(a, b), max(a, b)
        return sum((lo + dt.timedelta(days=i)).weekday() < 5 for i in range((hi - lo).days + 1))

    assert pairs(spark, rows, X.business_days("a", "b")) == [count(a, b) for a, b in rows]


def test_week_number_matches_monday_weeks(spark):
    days = [D(1969, 12, 28) + dt.timedelta(days=i) for i in range(30)] + [D(2024, 2, 29)]
    got = pairs(spark, [(d, d) for d in days], X.week_number("a"))
    assert got == [(d - D(1969, 12, 29)).days // 7 for d in days]


@pytest.mark.parametrize("days, reviewed, fast, wanted", [
    (1, 1, 1, 1), (2, 1, 1, 0), (3, 1, 0, 1), (4, 1, 0, 0), (0, 0, 1, 0), (None, 1, 0, 0)])
def test_sla(spark, days, reviewed, fast, wanted):
    df = spark.createDataFrame([(days, reviewed, fast)], "d int, r int, f int")
    assert df.select(X.sla_flag("d", "r", "f").alias("o")).first().o == wanted


def test_minutes_use_whole_seconds(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 0, 900_000), dt.datetime(2024, 1, 1, 0, 0, 30, 100_000))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert df.select(X.seconds_between("a", "b").alias("s"), X.minutes_between("a", "b").alias("m")).first() == (30, 1)


def test_flag_and_defaults(spark):
    df = spark.createDataFrame([(None,), (1,)], "v int")
    assert [r.o for r in df.select(X.flag(F.col("v") == 1).alias("o")).collect()] == [0, 1]
    assert [r.o for r in df.select(X.default("v", 0).alias("o")).collect()] == [0, 1]


def test_seconds_do_not_depend_on_the_session_zone(spark):
    """02:30 does not exist on that day in the zone below; wall-clock times have no such gap."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT timestamp_ntz'2024-03-10 01:30:00.7' AS a, timestamp_ntz'2024-03-10 02:30:00.2' AS b, "
                       "timestamp_ntz'1969-12-31 23:59:59.5' AS c, timestamp_ntz'1970-01-01 00:00:00.5' AS d")
        assert df.select(X.seconds_between("a", "b"), X.seconds_between("c", "d")).first() == (3600, 1)
        assert df.select(X.wall_micros("b") - X.wall_micros("a"), X.wall_micros("d") - X.wall_micros("c")).first() == (3_599_500_000, 1_000_000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
