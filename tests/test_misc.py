import os
import pytest
from pyspark.sql import functions as F

from ingot.operators import quality as Q
from ingot.operators.constraints import ConstraintViolation, assert_unique
from ingot.operators.joins import join_dimension
from ingot.sources.jdbc import jdbc_options
from ingot.sources import csv as CSV


def test_approximate_profile_is_close(spark):
    df = spark.range(5000).select((F.col("id") % 1000).alias("product_id"),
                                  F.lit("x").alias("category_code"), F.lit(None).cast("string").alias("brand"))
    df = df.select("product_id", "category_code", "brand", *[F.lit(1).alias(c) for c in
                   ("event_time", "event_type", "category_id", "price", "user_id", "user_session")])
    exact = Q.bronze_profile(df).first()
    approx = Q.bronze_profile(df, exact=False).first()
    assert exact.total_distinct_product_id == 1000 and exact.null_brand == 5000
    assert abs(approx.total_distinct_product_id - 1000) < 60


def test_assert_unique(spark):
    assert_unique(spark.range(5), "id")
    with pytest.raises(ConstraintViolation):
        assert_unique(spark.createDataFrame([(1,), (1,)], "id long"), "id")


def test_jdbc_options():
    o = jdbc_options("jdbc:sqlserver://h;databaseName=d", table="bronze.ecommerce_behavior",
                     partition_column="user_id", lower_bound=0, upper_bound=10**6, num_partitions=64)
    assert o["dbtable"] == "bronze.ecommerce_behavior" and o["numPartitions"] == "64"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", table="t", query="select 1")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", table="t", partition_column="id")


def test_overlong_text_is_rejected_not_fatal(spark, tmp_path):
    p = tmp_path / "long.csv"
    p.write_text("event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n"
                 "2019-11-01 00:00:00 UTC,view,1,2,a.b," + "x" * 60 + ",1.5,3,s\n"
                 "2019-11-01 00:00:01 UTC,view,1,2,a.b,ok,abc,3,s\n"
                 "2019-11-01 00:00:02 UTC,view,1,2,a.b,ok,1.5,3,s\n")
    ok, bad = CSV.to_bronze_rows(CSV.read_events_text(spark, str(p)), on_error="quarantine")
    reasons = sorted(r.reject_reason for r in bad.collect())
    assert ok.count() == 1 and reasons == ["brand>50", "price is not a valid number"]


def test_preview_is_ordered_top_k(spark):
    df = spark.range(1000).withColumn("product_id", -F.col("id"))
    rows = Q.preview(Q.invalid_ids(df.withColumn("category_id", F.lit(1))), ["id"], 5).collect()
    assert [r.id for r in rows] == [0, 1, 2, 3, 4]


def test_collation_option_on_checks(spark):
    silver = spark.createDataFrame(
        [(1, 10, "Apple"), (1, 10, "apple"), (2, 5, "Sony")],
        "product_id long, category_id long, brand string")
    dim = spark.createDataFrame([(1, 10, "apple"), (2, 5, "sony")],
                                "product_id long, category_id long, brand string")
    binary = Q.consistency(silver, dim).first()
    lcase = Q.consistency(silver, dim, collation="UTF8_LCASE").first()
    assert binary.mismatched_brands_silver == 2 and lcase.mismatched_brands_silver == 0
    p = Q.profile(silver, distincts=[("brand", "d"), ("product_id", "p")], collation="UTF8_LCASE").first()
    assert p.d == 2 and p.p == 2
    assert Q.profile(silver, distincts=[("brand", "d")]).first().d == 3


def test_shuffle_sizing():
    from ingot.session import shuffle_partitions_for

    assert shuffle_partitions_for(10) == 8
    assert shuffle_partitions_for(100 * 1024**4) == 819_200


def test_replaced_files_give_new_answers(spark, tmp_path):
    """No result outlives its input: the dimension is not kept anywhere."""
    from ingot.plans.registry import QUERIES

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    answers = []
    for keep in (F.lit(True), F.col("event_id") % 3 == 0):
        rows = events.where(keep).collect()  # the folder is replaced under the query
        spark.createDataFrame(rows, events.schema).write.mode("overwrite").parquet(str(tmp_path / "events.parquet"))
        part.write.mode("overwrite").parquet(str(tmp_path / "part.parquet"))
        spark.catalog.refreshByPath(str(tmp_path))
        answers.append(tuple(QUERIES["dq_consistency"](spark, str(tmp_path)).first()))
    assert answers[0] != answers[1]
    fresh = tmp_path / "fresh"
    spark.createDataFrame(rows, events.schema).write.parquet(str(fresh / "events.parquet"))
    part.write.parquet(str(fresh / "part.parquet"))
    assert answers[1] == tuple(QUERIES["dq_consistency"](spark, str(fresh)).first())


def test_joins_with_a_hot_key(spark):
    # one key holds a third of the rows
    silver = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 11 == 0, F.lit(None))
        .otherwise(F.col("id") % 100).alias("product_id"),
        F.when(F.col("id") % 5 == 0, F.lit("a")).otherwise(F.lit("b")).alias("brand"),
        (F.col("id") % 4).alias("category_id"))
    dim = spark.range(90).select(F.col("id").alias("product_id"), F.lit("b").alias("brand"),
                                 F.lit(1).cast("long").alias("category_id"))
    assert tuple(Q.consistency(silver, dim).first()) == (1, 1, 3, 1)
    assert Q.consistency(silver, dim, checks=("brand",)).columns == ["mismatched_brands_silver", "mismatched_brands_dim"]
    b = Q.referential_integrity(silver, dim).collect()
    assert sum(r[0] is None for r in b) == silver.where("product_id IS NULL").count()
    assert {r[0] for r in b} - {None} == set(range(90, 100))
    assert join_dimension(silver, dim.select("product_id"), "product_id", "left_semi").count() == silver.where("product_id < 90").count()


def test_summary_reads_each_table_once_or_twice(spark, tmp_path):
    """Bronze once, silver at most twice; of the fact its keys and its product
    ids, each by itself and unshuffled, and the keys once more, which AQE drops
    where none is repeated."""
    from ingot.operators import transforms as T
    from ingot.sources import testbed as tb

    bronze = tb.bronze(spark, "/root/testdata/sf0.001")
    bronze.write.parquet(str(tmp_path / "bronze"))
    bronze = spark.read.parquet(str(tmp_path / "bronze"))
    tables = {"silver": T.to_silver(bronze), "dim": T.to_dim_products(T.to_silver(bronze)), "fact": T.to_fact_columns(T.to_silver(bronze)).withColumn("event_key", F.monotonically_increasing_id())}
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    out = Q.summary(bronze, **tables)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    scans = [str(x) for x in out._jdf.queryExecution().executedPlan().toString().split("FileScan parquet")[1:]]
    reads = {n: sum(f"/{n}]" in x.split("PartitionFilters")[0] for x in scans) for n in ("bronze", "silver", "fact")}
    assert reads["bronze"] == 1 and reads["fact"] <= 3 and reads["silver"] <= 2, reads
    columns = [x.split("ReadSchema: struct<")[1].split(">")[0] for x in scans if "/fact]" in x.split("PartitionFilters")[0]]
    assert sorted(columns) == ["event_key:bigint", "event_key:bigint", "product_id:bigint"]
    assert "Expand" not in plan.split("Union")[0]
    assert out.count() == 8


def test_csv_columns_are_bound_by_name(spark, tmp_path):
    (tmp_path / "a").mkdir(), (tmp_path / "b").mkdir()
    (tmp_path / "a" / "x.csv").write_text("category_id,product_id,event_time,brand\n999,1.0,2019-11-01,apple\n998,1e3,2019-11-01 05:00:00+02:00\n")
    (tmp_path / "b" / "x.csv").write_text("event_time,product_id\n2019-11-01 00:00:00 UTC,12345678901234567\n2019-11-01 00:00:00 UTC,1.5\n,7\n2019-11-02 00:00:00 UTC,3,4\n")
    (tmp_path / "b" / "y.csv").write_text("event_time,colour\n2019-11-01 00:00:00 UTC,red\n")
    text = CSV.read_events_text(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    ok, bad = CSV.to_bronze_rows(text)
    got = sorted((r.product_id, r.category_id, str(r.event_time), r.brand, r.price) for r in ok.collect())
    assert got == [(1, 999, "2019-11-01 00:00:00", "apple", None), (1000, 998, "2019-11-01 03:00:00", None, None), (12345678901234567, None, "2019-11-01 00:00:00", None, None)]
    assert sorted(r.reject_reason for r in bad.collect()) == ["event_time is null or unparsable", "more fields than the header", "product_id is not a valid number", "unknown column colour"]
    ok, bad = CSV.to_bronze_rows(text, on_error="skip_file")
    assert ok.count() == 2 and bad.count() == 5


def test_date_alone_is_the_same_in_any_zone(spark):
    from ingot.functions import columns as C

    old = spark.conf.get("spark.sql.session.timeZone")
    df = spark.createDataFrame([("2019-11-01",), ("2019-11-01 10:00:00 +0230",), ("2019-11-01 10:00:00.5Z",)], "t string")
    try:
        for zone in ("America/New_York", "UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [str(r[0]) for r in df.select(C.parse_event_time("t")).collect()]
            assert got == ["2019-11-01 00:00:00", "2019-11-01 07:30:00", "2019-11-01 10:00:00.500000"], zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_entry_survives_a_missing_library():
    """Any library that only the training-data operators need may be absent."""
    import subprocess
    import sys

    for name in ("tiktoken", "regex", "xxhash", "zstandard", "public_tokenizers", "tokenizers", "corpus_pipeline"):
        code = f"import sys; sys.modules[{name!r}] = None; import __spark_entry__ as e; assert 'dim_products' in e.queries() and len(e.oracle_sql()) >= 42"
        subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
