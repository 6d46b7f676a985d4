"""Checks that read little: profile states, dense keys by words, filtered orphans."""

import random

import pytest
from pyspark.sql import functions as F

from ingot.operators import joins as J
from ingot.operators import quality as Q
from ingot.plans import medallion as M
from ingot.plans import sinks as S

from tests.test_pipeline import _rows, _write


def test_states_add_up_to_the_profile(spark, tmp_path):
    """After each of three loads the metrics are those of the full profiles,
    and only the new load's parts have been read."""
    lh = S.Lakehouse(spark, str(tmp_path / "lake"))
    lh.create(recreate=True)
    for k in range(3):
        (tmp_path / f"in{k}").mkdir()
        _write(tmp_path / f"in{k}" / "a.csv", _rows(25, start=17 * k))
        M.load_bronze_increment(lh, str(tmp_path / f"in{k}"))
        assert M.update_profiles(lh) == 3 and M.update_profiles(lh) == 0
        key = lambda df: sorted(tuple(r) for r in df.select("layer", "check_name", "metric", "value", "status").collect())
        assert key(M.incremental_metrics(lh)) == key(M.dq_metrics(lh))
    M.load_silver(lh)  # a refresh: the states of the parts it replaced no longer count
    assert key(M.incremental_metrics(lh)) == key(M.dq_metrics(lh))


def test_sketched_columns_are_close_and_empty_tables_zero(spark):
    df = spark.range(20_000).select(F.col("id").alias("product_id"), F.lit("x").alias("brand"), F.lit(None).cast("string").alias("category_code"))
    args = {"nulls": [("brand", "nb"), ("category_code", "nc")], "distincts": [("product_id", "dp"), ("brand", "db"), ("category_code", "dc")]}
    parts = [df.where(F.col("product_id") % 3 == i) for i in range(3)]
    states = [Q.profile_state(p, **args, sketched=("product_id",)) for p in parts]
    row = Q.merged_profile(states[0].unionByName(states[1]).unionByName(states[2]).unionByName(states[0].where("kind <> 'counter'")), **args, sketched=("product_id",)).first()
    assert (row["total_rows"], row["nb"], row["nc"], row["db"], row["dc"]) == (20_000, 0, 20_000, 1, 0) and abs(row["dp"] / 20_000 - 1) < 0.05
    assert set(Q.merged_profile(Q.profile_state(df.limit(0), **args), **args).first()) == {0}


@pytest.mark.parametrize("seed", range(3))
def test_dense_keys_are_grouped_as_all_keys(spark, seed):
    r = random.Random(seed)
    keys = [r.choice([None, 0, -1, -64, 63, 64, 2**62]) for _ in range(20)] + list(range(-300, 700)) + [r.randrange(-300, 700) for _ in range(30)]
    df = spark.createDataFrame([(k,) for k in keys], "event_key long").repartition(3)
    same = lambda a: sorted(map(tuple, a.collect()), key=str)
    assert same(Q.event_key_duplicates(df)) == same(Q.repeated_keys(df, "event_key"))


def test_unique_dense_keys_shuffle_words_only(spark):
    """No row of the fact reaches the exchange of the exact grouping."""
    df = spark.range(1, 200_001, 1, 4).withColumnRenamed("id", "event_key")
    out = Q.event_key_duplicates(df)
    assert out.collect() == []
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "LocalTableScan" in final or "EmptyRelation" in final  # the second reading was dropped


@pytest.mark.parametrize("n_orphans", [0, 3, 5000])
def test_filtered_orphans_are_the_orphans(spark, n_orphans):
    dim = spark.range(0, 3000).withColumnRenamed("id", "product_id")
    rows = spark.range(0, 30_000).select(F.when(F.col("id") % 11 == 0, None).when(F.col("id") < n_orphans, F.col("id") + 10_000).otherwise(F.col("id") % 3000).alias("product_id"), F.col("id").alias("n"))
    same = lambda a: sorted(map(tuple, a.select("product_id", "n").collect()), key=str)
    assert same(J.anti_join_filtered(rows, dim, "product_id")) == same(J.anti_join(rows, dim, "product_id"))


def test_a_filter_holds_its_keys_and_few_others(spark, monkeypatch):
    keys = spark.range(0, 4000).withColumnRenamed("id", "k")
    bits, blocks = J.key_filter(keys, "k", 4000)
    assert J.might_hold(keys, "k", bits, blocks).count() == 4000 and bits.count() <= blocks == 2
    others = spark.range(10_000, 60_000).withColumnRenamed("id", "k")
    assert J.might_hold(others, "k", bits, blocks).count() < 50_000 * 0.02
    monkeypatch.setattr(J, "MAX_BLOCKS", 1)  # more keys than it is meant for: larger it does not get
    bits, blocks = J.key_filter(keys, "k", 4000)
    assert blocks == 1 and bits.count() == 1 and J.might_hold(keys, "k", bits, blocks).count() == 4000
