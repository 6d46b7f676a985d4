import os

from pyspark.sql import functions as F

from ingot.operators import partitions as P
from ingot.plans import medallion as M
from ingot.plans import sinks as S
from ingot.streaming.incremental import ingest_new_files

from tests.test_pipeline import _rows, _write


def test_incremental_ingest_loads_only_new_files(spark, tmp_path):
    src = tmp_path / "incoming"
    src.mkdir()
    _write(src / "day1.csv", _rows(20))
    _write(src / "day2.csv", _rows(6, start=50, bad_at=52))  # skipped as a whole
    lh = S.Lakehouse(spark, str(tmp_path / "lake"))
    lh.create(recreate=True)
    ingest_new_files(lh, str(src), on_error="skip_file")
    assert lh.table(S.BRONZE).count() == 20
    assert lh.table(S.BRONZE_REJECTS).count() == 6
    ingest_new_files(lh, str(src))  # nothing new: nothing added
    assert lh.table(S.BRONZE).count() == 20
    _write(src / "day3.csv", _rows(4, start=80))
    ingest_new_files(lh, str(src))
    b = lh.table(S.BRONZE)
    assert b.count() == 24
    files = {os.path.basename(r[0]) for r in b.select("source_file").distinct().collect()}
    assert files == {"day1.csv", "day3.csv"}


def test_partition_inventory_and_pruning(spark, tmp_path):
    src = tmp_path / "csv"
    src.mkdir()
    rows = _rows(30)
    # spread the rows over several storage groups
    for i, r in enumerate(rows):
        r[0] = ["2019-10-05", "2019-12-24", "2020-02-29", "2020-06-01"][i % 4] + " 10:00:00 UTC"
    _write(src / "a.csv", rows)
    root = str(tmp_path / "lake")
    from ingot import schemas

    bounds = schemas.MONTH_BOUNDS
    M.run_medallion(spark, str(src), root, recreate=True, bounds=bounds)
    lh = S.Lakehouse(spark, root, bounds)
    silver = lh.table(S.SILVER)
    inv = {r.event_month: (r.row_count, r.file_count) for r in P.stored_partition_inventory(silver).collect()}
    assert set(inv) == {"FG_201911", "FG_201912", "FG_202002", "FG_Extra"}
    assert sum(n for n, _ in inv.values()) == 30 and all(f >= 1 for _, f in inv.values())
    # a date range names its partitions: the scan prunes folders
    sel = P.where_dates(silver, "2019-12-01", "2019-12-31", bounds=bounds)
    plan = sel._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_month" in plan and "FG_201912" in plan
    assert sel.count() == 8
    # calendar months, whatever the dates
    M.run_medallion(spark, str(src), str(tmp_path / "lake_m"), recreate=True)
    silver = S.Lakehouse(spark, str(tmp_path / "lake_m")).table(S.SILVER)
    assert {r.event_month for r in P.stored_partition_inventory(silver).collect()} == {"2019-10", "2019-12", "2020-02", "2020-06"}
    sel = P.where_dates(silver, "2020-06-01", "2020-06-08")
    plan = sel._jdf.queryExecution().executedPlan().toString()
    assert "event_month" in plan.split("PartitionFilters: [")[1].split("]")[0] and "2020-06" in plan
    assert sel.count() == 7
    assert P.groups_for_dates("2019-12-01", "2020-02-15") == ["FG_201912", "FG_202001", "FG_202002"]
    assert P.groups_for_dates(None, "2019-01-01") == ["FG_201911"]


def test_data_inventory_matches_counts(spark):
    df = spark.createDataFrame([("2019-11-30",), ("2019-12-01",), (None,), ("2021-01-01",)], "s string") \
        .select(F.col("s").cast("date").alias("d"))
    inv = {r.month_bucket: (r.storage_group, r.row_count) for r in P.partition_inventory(df).collect()}
    assert inv == {1: ("FG_201911", 2), 2: ("FG_201912", 1), 7: ("FG_Extra", 1)}


def test_partitioned_writes_rebalance(spark, tmp_path):
    lh = S.Lakehouse(spark, str(tmp_path / "lake_rb"))
    lh.create(recreate=True)
    rows = spark.range(4000).select(
        F.expr("date_add(DATE'2019-11-01', CAST(id % 120 AS INT))").alias("event_date"),
        F.lit("12:00:00").alias("event_time_only"), F.lit("view").alias("event_type"),
        F.col("id").alias("product_id"), F.lit(1).cast("long").alias("category_id"),
        F.lit("a").alias("category"), F.lit("b").alias("subcategory"), F.lit("x").alias("brand"),
        F.lit(1).cast("decimal(10,2)").alias("price"), F.col("id").alias("user_id"),
        F.lit("s").alias("user_session"))
    many = lh.partitioned(rows.repartition(64))
    assert "RebalancePartitions" in lh._ordered(many, S.SILVER)._jdf.queryExecution().optimizedPlan().toString()
    lh.overwrite(many, S.SILVER)
    files = lh.table(S.SILVER).inputFiles()
    assert lh.table(S.SILVER).count() == 4000 and len(files) < 64


def test_streaming_increment_runs_downstream(spark, tmp_path):
    src = tmp_path / "incoming2"
    src.mkdir()
    _write(src / "day1.csv", _rows(20))
    lh = S.Lakehouse(spark, str(tmp_path / "lake_sd"))
    lh.create(recreate=True)
    ingest_new_files(lh, str(src), downstream=True)
    _write(src / "day2.csv", _rows(7, start=40))
    ingest_new_files(lh, str(src), downstream=True)
    ingest_new_files(lh, str(src), downstream=True)   # nothing new
    assert lh.table(S.BRONZE).count() == 27 and lh.table(S.SILVER).count() == 27
    stats = lh.table(S.FACT).agg(F.count("*"), F.max("event_key"), F.countDistinct("event_key")).first()
    assert tuple(stats) == (27, 27, 27)
    assert lh.table(S.DIM_PRODUCTS).count() == 7
