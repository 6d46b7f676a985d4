import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ingot import schemas
from ingot.functions import columns as C


def test_category_split_edge_rows(spark):
    rows = [("a.b.c",), ("electronics",), (None,), (".x",), ("x.",), ("",)]
    df = spark.createDataFrame(rows, "code string")
    got = df.select("code", C.category_head("code").alias("h"), C.category_tail("code").alias("t")).collect()
    got = {r.code: (r.h, r.t) for r in got}
    assert got["a.b.c"] == ("a", "b.c")
    assert got["electronics"] == ("UNKNOWN", "UNKNOWN")
    assert got[None] == ("UNKNOWN", "UNKNOWN")
    assert got[".x"] == ("", "x")
    assert got["x."] == ("x", "")
    assert got[""] == ("UNKNOWN", "UNKNOWN")


def test_fill_unknown_keeps_empty_string(spark):
    df = spark.createDataFrame([(None,), ("",), ("apple",)], "b string")
    got = sorted(r[0] for r in df.select(C.fill_unknown("b")).collect())
    assert got == ["", "UNKNOWN", "apple"]


def test_time_of_day_rounds_half_up_and_wraps(spark):
    rows = [
        (dt.datetime(2024, 1, 1, 12, 34, 56, 400000),),
        (dt.datetime(2024, 1, 1, 12, 34, 56, 500000),),
        (dt.datetime(2024, 1, 1, 23, 59, 59, 700000),),
    ]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    got = df.select(C.event_date("ts").alias("d"), C.time_of_day("ts").alias("t")).collect()
    assert [r.t for r in got] == ["12:34:56", "12:34:57", "00:00:00"]
    assert got[2].d == dt.date(2024, 1, 1)  # the date does not move


def test_month_bucket_original_bounds(spark):
    dates = ["2018-01-01", "2019-11-30", "2019-12-01", "2020-02-29", "2020-04-30", "2020-05-01", None]
    df = spark.createDataFrame([(d,) for d in dates], "s string").select(F.col("s").cast("date").alias("d"))
    got = df.select(C.range_left_bucket("d").alias("b"), C.storage_group(C.range_left_bucket("d")).alias("g")).collect()
    assert [r.b for r in got] == [1, 1, 2, 4, 6, 7, 1]
    assert got[0].g == "FG_201911" and got[5].g == "FG_Extra" and got[2].g == "FG_201912"


def test_group_names_follow_bounds():
    assert schemas.group_names() == [
        "FG_201911", "FG_201912", "FG_202001", "FG_202002", "FG_202003", "FG_202004", "FG_Extra"
    ]


def test_null_tokens_each_token(spark):
    rows = [(t,) for t in schemas.NA_TOKENS] + [("Apple",), (" NA",), (None,)]
    df = spark.createDataFrame(rows, "s string")
    got = [r[0] for r in df.select(C.null_tokens("s")).collect()]
    assert got[: len(schemas.NA_TOKENS)] == [None] * len(schemas.NA_TOKENS)
    assert got[len(schemas.NA_TOKENS):] == ["Apple", " NA", None]


def test_parse_event_time(spark):
    df = spark.createDataFrame(
        [("2019-11-01 00:00:00 UTC",), ("bad-time",), ("2019-11-01 02:00:00+02:00",),
         ("2019-11-01 00:00:00",), ("2020-03-08 02:30:00 UTC",)], "s string"
    )
    want = [dt.datetime(2019, 11, 1, 0, 0), None, dt.datetime(2019, 11, 1, 0, 0),
            dt.datetime(2019, 11, 1, 0, 0), dt.datetime(2020, 3, 8, 2, 30)]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert [r[0] for r in df.select(C.parse_event_time("s")).collect()] == want, tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_time_of_day_ignores_session_zone(spark):
    # 02:30 on 2020-03-08 does not exist in New York: must stay 02:30 anyway
    df = spark.createDataFrame([(dt.datetime(2020, 3, 8, 2, 29, 59, 600000),)], "ts timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert df.select(C.time_of_day("ts")).first()[0] == "02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_decimal_rounds_half_up_and_overflow_is_null(spark):
    df = spark.createDataFrame([("1.239",), ("1234567890.12",)], "s string")
    got = [r[0] for r in df.select(F.col("s").try_cast(schemas.PRICE_TYPE)).collect()]
    assert got == [Decimal("1.24"), None]
