"""C7-C11, C14, C15 and the time helpers, directly."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyflow.functions import (
    as_text, index_name, millis_to_ntz, millis_to_ts, nested_field, ntz_to_millis,
    null_to_zero, parse_int)
from tallyflow.functions.jsonfields import key_path
from tallyflow.operators.windows import interval


def test_nested_json_text(spark):
    rows = ['{"returnCode":"10000","meta":"{\\"code\\":\\"0\\"}"}',   # meta as JSON text
            '{"meta":{"code":"1"}}',                                  # meta as an object
            '{"returnCode":"10002"}', 'bad', None]
    df = spark.createDataFrame([(r,) for r in rows], "info string")
    got = [r.code for r in df.select(nested_field("info", "meta", "code").alias("code")).collect()]
    assert got == ["0", "1", None, None, None]


def test_parse_int_and_text(spark):
    df = spark.createDataFrame([("0",), ("x",), (None,), ("12",)], "s string")
    assert [r.i for r in df.select(parse_int("s").alias("i")).collect()] == [0, None, None, 12]
    df2 = spark.createDataFrame([(5,), (None,)], "n long")
    r = df2.select(null_to_zero("n").alias("z"), as_text("n").alias("t")).collect()
    assert [(x.z, x.t) for x in r] == [(5, "5"), (0, None)]


def test_millis_round_trip_zone_free(spark):
    ms = 1704067209999  # 2024-01-01T00:00:09.999Z
    df = spark.createDataFrame([(ms,)], "ms long")
    r = df.select(millis_to_ntz("ms").alias("ntz"), millis_to_ts("ms").alias("ts")).first()
    assert r.ntz == dt.datetime(2024, 1, 1, 0, 0, 9, 999000)
    back = df.select(millis_to_ntz("ms").alias("t")).select(ntz_to_millis("t").alias("m")).first()
    assert back.m == ms


def test_index_name(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 31, 23, 59, 59),)], "t timestamp_ntz")
    assert df.select(index_name("t").alias("i")).first().i == "logcount-2024.01.31"


def test_interval_parsing(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 1, 0, 0),)], "t timestamp_ntz")
    r = df.select((F.col("t") - interval("1 hour")).alias("a"),
                  (F.col("t") - interval("10 seconds")).alias("b")).first()
    assert r.a == dt.datetime(2024, 1, 1) and r.b == dt.datetime(2024, 1, 1, 0, 59, 50)
    with pytest.raises(ValueError):
        interval("1 fortnight")


def test_key_path_quotes():
    assert key_path("projectName") == "$['projectName']"
    assert key_path("it's") == '$["it\'s"]'
    with pytest.raises(ValueError):
        key_path("""a'b"c""")
