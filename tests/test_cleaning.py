import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from portflow.functions.cleaning import is_blank, piped_sha256, to_event_time, to_number


def values(spark, texts, expression):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [row.v for row in rows.select("i", expression(F.col("t")).alias("v")).orderBy("i").collect()]


def test_numbers(spark):
    texts = ["12.5", " 7 ", "1e3", "-0.5", "", "  ", None, "abc", "nan", "NaN", "12d", "12F ", "12f", "inf", "-Infinity"]
    assert values(spark, texts, to_number) == [12.5, 7.0, 1000.0, -0.5] + [None] * 11


def test_blanks(spark):
    assert values(spark, [None, "", " ", "\t\n", "x", " x "], is_blank) == [True, True, True, True, False, False]


def test_event_times(spark):
    texts = [
        "2024-01-01T00:00:05",
        "2024-01-01 00:00:05.25",
        "2024-01-01",
        "2024-01-01T02:00:00+02:00",
        "2024-01-01T00:00:00Z",
        "2024-01-01T00:00:00-05:30",
        "2024",
        "2024-01",
        "soon, but not yet",
        "2024-13-01T00:00:00",
        "",
        None,
    ]
    midnight = datetime(2024, 1, 1)
    assert values(spark, texts, to_event_time) == [
        datetime(2024, 1, 1, 0, 0, 5),
        datetime(2024, 1, 1, 0, 0, 5, 250000),
        midnight,
        midnight,
        midnight,
        datetime(2024, 1, 1, 5, 30),
        None,
        None,
        None,
        None,
        None,
        None,
    ]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_event_times_do_not_depend_on_the_session_zone(spark, zone):
    texts = ["2024-03-10T02:30:00", "2024-03-10T02:30:00Z", "2024-11-03T01:30:00+00:00"]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        found = values(spark, texts, lambda c: to_event_time(c).cast("string"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found == ["2024-03-10 02:30:00", "2024-03-10 02:30:00", "2024-11-03 01:30:00"]


def test_hash_keeps_the_place_of_nulls(spark):
    row = spark.createDataFrame([("a", None, "c")], "x string, y string, z string")
    got = row.select(piped_sha256([F.col("x"), F.col("y"), F.col("z")])).first()[0]
    assert got == hashlib.sha256(b"a||c").hexdigest()
