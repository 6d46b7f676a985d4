"""Plan-shape checks for the paths that must survive hot keys at scale."""

from pyspark.sql import functions as F

from ingot.operators import transforms as T
from ingot.operators.joins import anti_join
from ingot.sources import csv as CSV
from ingot.sources import testbed as tb


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_shuffled_anti_join_splits_off_null_keys(spark):
    # a third of the fact rows carry a NULL key
    fact = spark.range(3000).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 50)
                                    .alias("product_id"))
    dim = spark.range(40).withColumnRenamed("id", "product_id")
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:  # a large dimension: neither we nor the planner broadcast it
            spark.conf.set(k, "-1")
        out = anti_join(fact, dim, "product_id")
        plan = _plan(out)
        assert "Union" in plan and "BroadcastHashJoin" not in plan
        assert "LeftAnti" in plan and "isnull" in plan
        assert out.count() == 1000 + 2000 * 10 // 50
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_dimension_pre_aggregates_on_the_map_side(spark):
    silver = T.to_silver(tb.bronze(spark, "/root/testdata/sf0.001"))
    plan = _plan(T.to_dim_products(silver))
    first_exchange = plan.index("Exchange hashpartitioning(product_id")
    # a partial hash aggregate sits below the first shuffle: a hot product
    # is reduced to one row per map task before anything moves
    assert "HashAggregate(keys=[product_id" in plan[first_exchange:]


def test_parquet_head_n_is_a_narrow_filter(spark):
    ev = tb.table(spark, "/root/testdata/sf0.001", "events")
    plan = _plan(CSV.head_n_per_file(ev, 10, parquet=True))
    assert "Exchange" not in plan and "row_index" in plan


def test_scans_prune_columns_and_push_filters(spark):
    bronze = tb.bronze(spark, "/root/testdata/sf0.001")
    plan = _plan(bronze.where(F.col("product_id") <= 0).select("product_id"))
    assert "ReadSchema: struct<event_id:bigint,props:string>" in plan
