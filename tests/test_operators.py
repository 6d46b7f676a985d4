import datetime as dt

from pyspark.sql import functions as F

from ingot.operators import keys as K
from ingot.operators import quality as Q
from ingot.operators import sessions as X
from ingot.operators import transforms as T
from ingot.operators.constraints import ConstraintViolation, length_split, not_null_split
from ingot.operators.joins import anti_join


def test_anti_join_keeps_nulls_and_duplicates(spark):
    fact = spark.createDataFrame([(1,), (None,), (3,), (3,)], "product_id long")
    dim = spark.createDataFrame([(1,), (2,)], "product_id long")
    got = sorted((r[0] for r in anti_join(fact, dim, "product_id").collect()), key=lambda v: (v is not None, v))
    assert got == [None, 3, 3]


def test_dim_max_binary_vs_lcase(spark):
    silver = spark.createDataFrame(
        [(1, 10, "UNKNOWN"), (1, 12, "apple"), (2, 5, "b"), (None, 99, "z")],
        "product_id long, category_id long, brand string",
    )
    binary = {r.product_id: (r.category_id, r.brand) for r in T.to_dim_products(silver).collect()}
    assert binary == {1: (12, "apple"), 2: (5, "b")}
    lcase = {r.product_id: r.brand for r in T.to_dim_products(silver, collation="UTF8_LCASE").collect()}
    assert lcase[1] == "UNKNOWN"
    plain = {r.product_id: r.brand for r in T.to_dim_products(silver, dedupe_first=False).collect()}
    assert plain == {1: "apple", 2: "b"}


def test_profile_of_empty_table_and_report(spark):
    empty = spark.createDataFrame([], "event_key long, event_date date, event_time_only string, "
                                      "event_type string, product_id long, category string, "
                                      "subcategory string, price decimal(10,2), user_id long, "
                                      "user_session string")
    p = Q.fact_profile(empty).collect()[0]
    assert p.total_rows == 0 and p.event_key_null_count is None
    rep = Q.report(Q.fact_profile(empty), "gold", "fact").collect()
    assert len(rep) == 16 and all(r.value == 0 and r.status == "OK" for r in rep)


def test_report_warns_only_on_null_and_unknown_metrics(spark):
    one = spark.createDataFrame([(5, 2, 3)], "total_rows long, price_null_count long, total_distinct_x long")
    st = {r.metric: r.status for r in Q.report(one, "l", "c").collect()}
    assert st == {"total_rows": "OK", "price_null_count": "WARN", "total_distinct_x": "OK"}


def test_surrogate_key_dense_and_continues(spark):
    df = spark.range(10_000).repartition(3).withColumn("v", F.col("id") * 2)
    keyed = K.with_surrogate_key(df)
    stats = keyed.agg(F.min("event_key"), F.max("event_key"), F.countDistinct("event_key"), F.count("*")).first()
    assert tuple(stats) == (1, 10_000, 10_000, 10_000)
    start = K.next_key_start(keyed)
    assert start == 10_000
    more = K.with_surrogate_key(spark.range(7).repartition(2), start=start)
    assert sorted(r.event_key for r in more.collect()) == list(range(10_001, 10_008))
    assert K.next_key_start(None) == 0


def test_duplicate_checks_count_keys_not_rows(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,), (3,)], "product_id long")
    assert Q.duplicate_products(df).first().total_duplicates == 2  # 1 and the NULL group
    fact = spark.createDataFrame([(1,), (1,), (2,)], "event_key long")
    assert [tuple(r) for r in Q.event_key_duplicates(fact).collect()] == [(1, 2)]


def test_not_null_and_length_rejects(spark):
    df = spark.createDataFrame([(None, "abcdef"), ("x", "abc"), ("y", None)], "a string, b string")
    ok, bad = not_null_split(df, ["a"])
    assert ok.count() == 2 and bad.first().reject_reason == "a is null"
    ok, bad = length_split(df, {"b": 4})
    assert ok.count() == 2 and bad.first().reject_reason == "b>4"
    try:
        not_null_split(df, ["a"], strict=True)
        raise AssertionError("expected a violation")
    except ConstraintViolation:
        pass


def _ts(h, m=0, s=0, day=1):
    return dt.datetime(2024, 1, day, h, m, s)


def test_session_gap_boundary(spark):
    rows = [
        (1, 1, _ts(10)), (2, 1, _ts(12)),            # exactly 2 h: same session
        (3, 1, _ts(14, 0, 1)),                       # 2 h + 1 s: new session
        (4, 2, _ts(23, 30)), (5, 2, _ts(0, 30, 0, day=2)),  # crosses midnight: same
        (6, 2, _ts(3, 0, 0, day=2)),                 # 2.5 h later: new
        (7, 3, _ts(22)), (8, 3, _ts(1, 0, 0, day=2)),  # 3 h over midnight: new
    ]
    ev = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz")
    want = {1: 1, 2: 1, 3: 2, 4: 1, 5: 1, 6: 2, 7: 1, 8: 2}
    for chunk in (X.CHUNK_SECONDS, 60, 10**6):
        got = {r.event_id: r.session_seq for r in X.sessionize(ev, chunk_seconds=chunk).collect()}
        assert got == want, chunk


def test_sessionize_matches_brute_force(spark):
    import random

    rnd = random.Random(7)
    rows, eid = [], 0
    for user in range(5):
        t = dt.datetime(2024, 1, 1)
        for _ in range(200):
            t += dt.timedelta(seconds=rnd.choice([60, 3600, 7200, 7201, 20000, 90000]))
            rows.append((eid, user, t, rnd.choice(["view", "purchase"])))
            eid += 1
    expected, last = {}, {}
    for e, u, t, _ in rows:
        n, prev = last.get(u, (0, None))
        if prev is None or (t - prev).total_seconds() > 7200:
            n += 1
        last[u] = (n, t)
        expected[e] = n
    ev = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz, event_type string")
    for chunk in (X.CHUNK_SECONDS, 3600, 86400):
        got = {r.event_id: r.session_seq for r in X.sessionize(ev, chunk_seconds=chunk).collect()}
        assert got == expected, chunk
    j = X.journeys(X.sessionize(ev)).agg(F.sum("n_events")).first()[0]
    assert j == len(rows)


def test_sessionize_hot_user_single_day_is_split(spark):
    # one user with most events inside one day: their timeline is many chunks
    rows = [(i, 1, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=7 * i)) for i in range(5000)]
    rows += [(10_000 + i, 2 + i % 3, dt.datetime(2024, 1, 1, 5) + dt.timedelta(hours=3 * i)) for i in range(30)]
    ev = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz")
    s = X.sessionize(ev)
    got = {r.event_id: r.session_seq for r in s.collect()}
    assert all(got[i] == 1 for i in range(5000))      # 7 s gaps: one session
    assert max(got[10_000 + i] for i in range(30)) == 10  # 9 h gaps per user: all new
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(user_id" in plan and "_ss_chunk" in plan


def test_sessions_without_user_or_time_and_ordered_journey(spark):
    rows = [(1, None, _ts(10)), (2, None, _ts(15)), (3, 1, _ts(10)), (4, 1, None), (5, None, None)]
    ev = spark.createDataFrame([(*r, "view", 7) for r in rows], "event_id long, user_id long, ts timestamp_ntz, event_type string, product_id long")
    got = {r.event_id: r.session_seq for r in X.sessionize(ev).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 1, 5: 1}
    tied = [(9, 1, _ts(10), "purchase", 1), (2, 1, _ts(10), "view", 2), (5, 1, _ts(10), "cart", 3)]
    ev = spark.createDataFrame(tied, ev.schema)
    s = X.sessionize(ev)
    j = X.journeys(s, tie="event_id").first()
    assert (j.first_event_type, j.last_event_type) == ("view", "purchase")
    assert [(r.step, r.event_type, r.product_id) for r in X.journey_steps(s).orderBy("step").collect()] == [(1, "view", 2), (2, "cart", 3), (3, "purchase", 1)]
