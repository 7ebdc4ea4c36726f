"""Java split / trim / timestamp semantics of the Column expressions."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stationlake.functions.text import (file_version_parts, java_split, java_trim,
                                        parse_station_time, split_fields, station_id_parts)


def java_split_model(s: str, sep: str):
    if s == "":
        return [""]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def java_trim_model(s: str) -> str:
    i, j = 0, len(s)
    while i < j and ord(s[i]) <= 32:
        i += 1
    while j > i and ord(s[j - 1]) <= 32:
        j -= 1
    return s[i:j]


FIXED = ["", ",,", "a,,b,,", "a, ,", " , ", " ,", ", ", "\t,", "a ,,", "\x01a\x1f,b\r", ",a", "  "]


def check(spark, cases):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, v string")
    rows = df.select("i", java_split("v", ",").alias("js"), split_fields("v").alias("sf"),
                     java_trim("v").alias("tr")).collect()
    for r in rows:
        c = cases[r.i]
        assert list(r.js) == java_split_model(c, ","), c
        assert list(r.sf) == [java_trim_model(x) for x in java_split_model(c, ",")], c
        assert r.tr == java_trim_model(c), c


def test_split_fixed_cases(spark):
    check(spark, FIXED)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=list("ab, \t\r\x00\x1fé"), max_size=12), min_size=50, max_size=200))
def test_split_property(spark, cases):
    check(spark, cases)


def test_parse_station_time(spark):
    cases = {
        "2017-01-14 15:31:30": dt.datetime(2017, 1, 14, 15, 31, 30),
        "17-01-14 15:31:30": dt.datetime(17, 1, 14, 15, 31, 30),
        "2017-1-4 5:3:1": dt.datetime(2017, 1, 4, 5, 3, 1),
        "2017-001-14 00:00:00": None, "": None, "null": None, "2017-01-14 15:31:30.5": None,
        "2017-01-14": None, " 2017-01-14 15:31:30": None, "2017-02-30 00:00:00": None,
        "2017-01-14 24:00:00": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = {r.v: r.t for r in df.select("v", parse_station_time("v").alias("t")).collect()}
    assert got == cases


def test_version_and_station_parts(spark):
    df = spark.createDataFrame([("Version: A; B",), ("Version:",), ("Version:;",), ("x",)], "v string")
    v, e = file_version_parts("v")
    got = [(r.a, r.b) for r in df.select(v.alias("a"), e.alias("b")).collect()]
    assert got == [("A", None), (None, "E2"), (None, "E3"), (None, "E2")]
    df = spark.createDataFrame([("FXGL_C03-5FT-02B_1_AE-22",), ("A_B",), ("a_b_c_d_e",), (None,)], "v string")
    got = [tuple(r) for r in df.select(*station_id_parts("v")).collect()]
    assert got == [("FXGL", "C03-5FT-02B", "1", "AE-22"), ("A", "B", "", ""),
                   ("a", "b", "c", "d"), (None, None, None, None)]


def test_times_read_by_a_cast_are_those_of_the_pattern(spark):
    year, part = ["0000", "0001", "0999", "1582", "1900", "2000", "9999", "99", "0", "12345"], ["0", "00", "1", "02", "12", "29", "30", "31", "60", "123"]
    rows = [(f"{y}-{m}-{d} {t}",) for y in year for m in part for d in part
            for t in ("00:00:00", "7:5:9", "23:59:60", "24:00:00", "12:60:00", "12:00", "12:00:00 ", "12:00:00Z", "12:00:00.0", "1:2:3\n")]
    rows += [(x,) for x in ("+2024-01-05 10:00:00", "2024-01-05T10:00:00", "\u0662024-01-05 10:00:00", "2024-1-5  1:2:3", None)]
    df = spark.createDataFrame(rows, "v string")
    shape = F.col("v").rlike(r"^\d{1,4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}\z")
    plain = F.when(shape, F.try_to_timestamp("v", F.lit("y-M-d H:m:s")).cast("timestamp_ntz"))
    both = df.select("v", parse_station_time("v").cast("string").alias("a"), plain.cast("string").alias("b"))
    assert both.where("NOT a <=> b").limit(5).collect() == [] and both.where("a IS NOT NULL").count() > 100
