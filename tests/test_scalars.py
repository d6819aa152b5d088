import datetime as dt

import pytest
from pyspark.sql import functions as F

from runtide.functions.clock import business_day, instant_ms, stamp, wall_clock
from runtide.functions.scalars import (
    clock_text,
    local_clock,
    minute_of_day,
    minutes_1,
    on_epoch_day,
    or_default,
    parse_sla,
    path_get,
    sla_met,
)
from tests.conftest import eastern_ms


def column_of(df, column):
    return [row[0] for row in df.select(column).collect()]


@pytest.fixture(scope="module")
def nested(spark):
    return spark.sql("""
        select * from values
          (1, named_struct('b', named_struct('c', 'deep', 'n', 7)), map('k', 'v'), '{"x": {"y": 5}, "e": {}}'),
          (2, named_struct('b', null), map('other', 'v'), '{"x": null}'),
          (3, null, null, null)
        as t(id, a, m, js)""").withColumn("v", F.try_parse_json("js")).orderBy("id")


@pytest.mark.parametrize(
    "path, cast_type, wanted",
    [
        ("a/b/c", None, ["deep", None, None]),
        ("/a//b/c/", None, ["deep", None, None]),
        ("a/b/n", "string", ["7", None, None]),
        ("a/b/absent", None, [None, None, None]),
        ("absent/b/c", "int", [None, None, None]),
        ("id/below_a_number", None, [None, None, None]),
        ("m/k", None, ["v", None, None]),
        ("js/x/y", "int", [5, None, None]),
        ("js/e", None, [None, None, None]),
        ("v/x/y", "int", [5, None, None]),
        ("v/e", None, [None, None, None]),
        ("", None, [None, None, None]),
    ],
)
def test_path_get(nested, path, cast_type, wanted):
    assert column_of(nested, path_get(nested, path, cast_type)) == wanted


def test_path_get_example(spark):
    run = spark.sql("select named_struct('result_state', 'SUCCESS') as state")
    assert column_of(run, path_get(run, "state/result_state")) == ["SUCCESS"]


def test_empty_object_is_missing(spark, folder):
    spark.createDataFrame([('{"a": {"b": {}}}',), ('{"a": {"b": {"c": 1}}}',)], "value string").coalesce(1).write.text(
        f"{folder}/t"
    )
    read = spark.read.schema("a struct<b: struct<c: int>>").json(f"{folder}/t")
    assert column_of(read, path_get(read, "a/b").isNull()) == [True, False]


def test_keys_with_quotes(spark):
    odd = spark.createDataFrame([({"it's": "1", "back\\slash": "2"},)], "m map<string, string>")
    assert column_of(odd, path_get(odd, "m/it's")) == ["1"]
    assert column_of(odd, path_get(odd, "m/back\\slash")) == ["2"]


def test_local_clock(spark):
    ms = [eastern_ms("2024-01-15 06:00:00"), eastern_ms("2024-07-15 06:00:00"), 0, None]
    df = spark.createDataFrame([(m,) for m in ms], "ms bigint")
    assert column_of(df, local_clock("ms", "US/Eastern")) == [
        dt.datetime(2024, 1, 15, 6), dt.datetime(2024, 7, 15, 6), None, None,
    ]
    assert column_of(df, local_clock("ms", "US/Pacific"))[:2] == [
        dt.datetime(2024, 1, 15, 3), dt.datetime(2024, 7, 15, 3),
    ]


def test_local_clock_in_the_hour_that_comes_twice(spark):
    first = int(dt.datetime(2024, 11, 3, 5, 30, tzinfo=dt.timezone.utc).timestamp() * 1000)
    df = spark.createDataFrame([(first,), (first + 3_600_000,)], "ms bigint")
    assert column_of(df, local_clock("ms", "US/Eastern")) == [dt.datetime(2024, 11, 3, 1, 30)] * 2


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "US/Pacific"])
def test_session_zone_does_not_matter(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.range(1).select(F.lit(eastern_ms("2024-01-15 06:00:00")).alias("ms"), F.lit("4:30 AM EST").alias("s"))
        got = df.select(
            local_clock("ms", "US/Eastern").cast("string"), parse_sla("s").cast("string"),
            stamp(dt.datetime(2024, 1, 16, 4, 59, 59)).cast("string"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(got) == ("2024-01-15 06:00:00", "1970-01-01 04:30:00", "2024-01-15 23:59:59")


def test_minutes_1(spark):
    ms = [0, None, 1, 2999, 3000, 9000, 15000, 60000, 123456789]
    df = spark.createDataFrame([(m,) for m in ms], "ms bigint")
    assert [None if v is None else round(v, 1) for v in column_of(df, minutes_1("ms"))] == [
        None, None, 0.0, 0.0, 0.1, 0.2, 0.3, 1.0, 2057.6,
    ]


def test_or_default(spark):
    df = spark.createDataFrame([("a",), ("",), (None,), (" ",)], "c string")
    assert column_of(df, or_default("c", "CUSTOM")) == ["a", "CUSTOM", "CUSTOM", " "]


def test_clock_functions(spark):
    times = ["2024-01-15 00:05:59", "2024-01-15 12:00:00", "2024-01-15 16:30:30", None]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp_ntz"))
    assert column_of(df, clock_text("t")) == ["12:05 AM EST", "12:00 PM EST", "4:30 PM EST", None]
    assert column_of(df, minute_of_day("t")) == [5, 720, 990, None]
    assert column_of(df, on_epoch_day("t"))[2] == dt.datetime(1970, 1, 1, 16, 30)


def test_parse_sla(spark):
    df = spark.createDataFrame([("4:30 AM EST",), ("5:30 PM",), ("soon",), (None,)], "s string")
    assert column_of(df, minute_of_day(parse_sla("s"))) == [270, 1050, None, None]


@pytest.mark.parametrize(
    "latest, sla, wanted",
    [
        ("2024-01-15 04:30:59", "4:30 AM EST", "Y"),
        ("2024-01-15 04:31:00", "4:30 AM EST", "N"),
        ("2024-01-16 00:10:00", "4:30 AM EST", "Y"),
        (None, "4:30 AM EST", "N"),
        ("2024-01-15 04:00:00", None, "N"),
    ],
)
def test_sla_met(spark, latest, sla, wanted):
    df = spark.createDataFrame([(latest, sla)], "t string, s string")
    assert column_of(df, sla_met(F.col("t").cast("timestamp_ntz"), parse_sla("s"))) == [wanted]


def test_as_of():
    as_of = dt.datetime(2024, 1, 16, 4, 59, 59)
    assert instant_ms(as_of) == 1705381199000 == instant_ms(as_of.replace(tzinfo=dt.timezone.utc))
    assert wall_clock(as_of) == dt.datetime(2024, 1, 15, 23, 59, 59)
    assert business_day(as_of) == dt.date(2024, 1, 15)
    assert business_day(as_of, "UTC") == dt.date(2024, 1, 16)
