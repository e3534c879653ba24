"""Scalar expressions and the traps they guard against."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from vistra.functions import (
    clip_at_zero,
    duration_days,
    parse_long,
    parse_person_id,
    parse_timestamp,
    period_label,
    truncate_to_millis,
)
from vistra.functions.draws import objective, uniform, uniform_from_hash


def one(spark, expr_col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr_col).collect()]


FORMS = [
    ("2010-03-01 10:00:00", dt.datetime(2010, 3, 1, 10)),
    ("2010-03-01T10:00:00.5", dt.datetime(2010, 3, 1, 10, 0, 0, 500000)),
    ("2010-03-01", dt.datetime(2010, 3, 1)),
    (" 2010-03-01 10:00\t", dt.datetime(2010, 3, 1, 10)),
    ("2010-3-1 9:05:07", dt.datetime(2010, 3, 1, 9, 5, 7)),
    ("20100301", dt.datetime(2010, 3, 1)),
    ("20100301 10:00:01", dt.datetime(2010, 3, 1, 10, 0, 1)),
    ("03/01/2010", dt.datetime(2010, 3, 1)),  # month first
    ("3/1/2010 23:59", dt.datetime(2010, 3, 1, 23, 59)),
    ("2010-03-01 10:00:00.123456789", dt.datetime(2010, 3, 1, 10, 0, 0, 123456)),
    ("2010-03-01T10:00:00Z", dt.datetime(2010, 3, 1, 10)),
    ("2010-03-01T10:00:00.25+05:30", dt.datetime(2010, 3, 1, 4, 30, 0, 250000)),
    ("2010-03-01 22:00-0230", dt.datetime(2010, 3, 2, 0, 30)),
    ("2010-03-14 02:30:00", dt.datetime(2010, 3, 14, 2, 30)),  # in a gap of some zones
    ("2010", None), ("not-a-date", None), ("2010-02-30 00:00:00", None), ("13/05/2010", None),
    ("2010-03-01 25:00:00", None), ("2010-03-01 10:00:00 x", None), ("", None), (None, None),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_parse_timestamp_forms(spark, zone):
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, zone)
        got = one(spark, parse_timestamp("s"), [(t,) for t, _ in FORMS], "s string")
    finally:
        spark.conf.set(key, before)
    assert got == [v for _, v in FORMS]


def test_duration_fixture(spark):
    rows = [
        ("2010-01-02 00:00:00", "2010-01-01 00:00:00"),
        ("2010-01-01 00:00:00", None),
        ("2010-01-01 00:00:00", "2010-01-02 12:00:00.9"),
    ]
    d = clip_at_zero(duration_days(parse_timestamp("s"), parse_timestamp("e")))
    assert one(spark, d, rows, "s string, e string") == [0.0, None, 1.5000104166666666]


def test_clip_keeps_null_unlike_greatest(spark):
    got = spark.createDataFrame([(None,), (-2.0,), (3.0,)], "d double").select(
        clip_at_zero("d").alias("c"), F.greatest("d", F.lit(0.0)).alias("g")
    ).collect()
    assert [r.c for r in got] == [None, 0.0, 3.0]
    assert got[0].g == 0.0  # the trap: greatest turns missing into 0


def test_truncate_is_zone_independent(spark):
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "America/New_York")  # 02:30 on this day is in a DST gap
        v = one(spark, truncate_to_millis(parse_timestamp("s")), [("2010-03-14 02:30:00.123456",)], "s string")
    finally:
        spark.conf.set(key, before)
    assert v == [dt.datetime(2010, 3, 14, 2, 30, 0, 123000)]


def test_period_label(spark):
    assert one(spark, period_label("y", "m"), [(2010, 3)], "y int, m int") == ["2010-03"]


def test_person_id_rule(spark):
    assert one(spark, parse_person_id("s"), [(" 12 ",), ("12.0",), ("",), ("x",)], "s string") == [
        12, None, None, None]


def test_visit_id_parse_goes_through_number(spark):
    assert one(spark, parse_long(F.col("s")), [("12",), ("12.0",), (" 7 ",), ("NaN",), ("x",), (None,)],
               "s string") == [12, 12, 7, None, None, None]


def test_objective_optimum(spark):
    assert one(spark, objective("x", "y"), [(0.0, 0.0)], "x double, y double") == [40.0]


def test_draw_chunk_bounds():
    # an md5 holds four 32-bit draws; asking for a fifth is an error
    with pytest.raises(ValueError):
        uniform_from_hash(None, 4)


def test_draw_matches_sql_form(spark):
    got = spark.range(1).select(F.conv(F.substring(F.md5(F.lit("a|1")), 1, 8), 16, 10)).first()[0]
    assert got == "225584429"
    u = spark.range(1).select(uniform(F.lit(1), F.lit(2), F.lit(3), F.lit(4), "t")).first()[0]
    assert 0.0 <= u < 1.0


def _expected_time(text):
    """The accepted forms by one pattern each and Python's own datetime."""
    import re

    t = text.strip(" \t\r\n")
    time = r"(?:[ T](\d{1,2}):(\d\d)(?::(\d\d)(?:\.(\d{1,9}))?)?(Z|[+-]\d\d:?\d\d)?)?$"
    for pattern, order in ((r"(\d{4})-(\d{1,2})-(\d{1,2})", (0, 1, 2)), (r"(\d{4})(\d\d)(\d\d)", (0, 1, 2)), (r"(\d{1,2})/(\d{1,2})/(\d{4})", (2, 0, 1))):
        m = re.match("^" + pattern + time, t, re.ASCII)
        if m:
            g = m.groups()
            try:
                v = dt.datetime(*(int(g[i]) for i in order), int(g[3] or 0), int(g[4] or 0), int(g[5] or 0), int((g[6] or "0").ljust(6, "0")[:6]))
            except ValueError:
                return None
            if g[7] and g[7] != "Z":
                minutes = int(g[7][1:3]) * 60 + int(g[7][-2:])
                v -= dt.timedelta(minutes=minutes if g[7][0] == "+" else -minutes)
            return v
    return None


def test_whole_columns_of_mixed_and_damaged_times(spark):
    import random

    from vistra.functions.dates import parse_texts

    rng = random.Random(4)
    texts = [t for t, _ in FORMS if t] + ["2010-3-1 5", "2010-3-1T", "1/2/2010/5", "2010-3-1 1:2", "20101-1-", "2010-03-01 10:00-02:3", "+2010-03-01", "2010-03-01 10:00:00.1234567890"]
    whole = ["2010-03-01 10:00:00", "2010-3-1T9:05:07.25Z", "20100301 10:00", "3/1/2010 23:59:59.5+0130", "2010-03-01T10:00:00.123456789-11:15"]
    for _ in range(3000):
        t = rng.choice(whole)
        for _ in range(rng.randrange(3)):
            i = rng.randrange(len(t) + 1)
            t = t[:i] + rng.choice(["", "0", "1", ":", "-", "/", " ", "T", "Z", "+", ".", "9"]) + t[i + rng.randrange(2) :]
        texts.append(t)
    df = parse_texts(spark.createDataFrame([(i, t, t) for i, t in enumerate(texts)], "i int, a string, b string"), ["a", "b"])
    got = {r.i: (r.a, r.b) for r in df.collect()}
    for i, t in enumerate(texts):
        want = _expected_time(t)
        assert got[i] == (want, want), t
