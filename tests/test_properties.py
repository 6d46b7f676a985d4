import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from ingot import schemas
from ingot.functions import columns as C

codes = st.one_of(st.none(), st.text(alphabet="ab.xY_", max_size=12))
stamps = st.datetimes(min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(2030, 12, 31))
dates = st.one_of(st.none(), st.dates(min_value=dt.date(2018, 1, 1), max_value=dt.date(2021, 12, 31)))


@settings(max_examples=5, deadline=None)
@given(st.lists(codes, min_size=1, max_size=60))
def test_category_split_properties(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "code string")
    for r in df.select("code", C.category_head("code").alias("h"), C.category_tail("code").alias("t")).collect():
        has_dot = r.code is not None and "." in r.code
        assert (r.h == "UNKNOWN") == (r.t == "UNKNOWN") or has_dot
        if has_dot:
            assert r.h + "." + r.t == r.code and "." not in r.h
        else:
            assert r.h == r.t == "UNKNOWN"


@settings(max_examples=5, deadline=None)
@given(st.lists(stamps, min_size=1, max_size=60))
def test_time_of_day_matches_python_rounding(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "ts timestamp_ntz")
    got = [r[0] for r in df.select(C.time_of_day("ts")).collect()]
    want = [(v + dt.timedelta(microseconds=500_000)).strftime("%H:%M:%S") for v in values]
    assert got == want


@settings(max_examples=5, deadline=None)
@given(st.lists(dates, min_size=1, max_size=60))
def test_range_left_bucket_matches_bounds(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "d date")
    got = [r[0] for r in df.select(C.range_left_bucket("d")).collect()]
    ends = schemas.month_bounds()
    want = [1 if v is None else 1 + sum(v > e for e in ends) for v in values]
    assert got == want
