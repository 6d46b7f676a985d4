"""Exact top-k against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from ingot.llm import topk


def brute(rows, k, asked):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for qid, q in {(i, tuple(v)) for i, v in ok if asked(i)}:
        scored = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in ok if i != qid)
        out |= {(qid, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return out


def result(df):
    return {tuple(r[c] for c in ("query_id", "rank", "vec_id", "score")) for r in df.collect()}


@pytest.mark.parametrize("block", [4096, 7])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "QUERY_BLOCK", block)
    monkeypatch.setattr(topk, "SEEDS", 20)
    monkeypatch.setattr(topk, "CHUNK", 16)
    r = random.Random(5)
    rows = [(i, [r.gauss(0, 1) * (3 if j < 3 else 0.3) * (1 + i % 7) for j in range(12)]) for i in range(400)]
    rows += [(1000 + i, rows[i % 5][1]) for i in range(60)]  # ties
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit("clash"))
    assert result(topk.top_k(df, F.col("id") % 20 == 0)) == brute(rows, 5, lambda i: i % 20 == 0)


def test_nulls_short_vectors_and_few_rows(spark):
    rows = [(0, [1.0, 2.0]), (50, [0.5]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [float("inf")]), (None, [9.0, 9.0]), (7, []), (0, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert result(topk.top_k(df, F.col("id") % 50 == 0)) == brute(rows, 5, lambda i: i % 50 == 0)


def test_empty_table_and_no_query(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(empty, F.col("id") % 50 == 0).count() == 0
    assert topk.top_k(spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<float>"), F.col("id") % 50 == 0).count() == 0
    assert topk.top_k(spark.createDataFrame([(50, [1.0])], "vec_id long, embedding array<float>"), F.col("id") % 50 == 0).count() == 0


def test_large_components_and_scores(spark):
    r = random.Random(9)
    rows = [(i, [r.uniform(-3, 3) * (1 if i % 50 == 0 else 2.0 ** r.choice((0, 20, 40))) for _ in range(8)]) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert max(abs(c) for _, x in rows for c in x) > 2.0**40
    assert result(topk.top_k(df, F.col("id") % 50 == 0)) == brute(rows, 5, lambda i: i % 50 == 0)
    for rows in ([(0, [2.0**30] * 4), (1, [2.0**30] * 4), (2, [1.0] * 4)], [(0, [1.0]), (1, [2.0**56])]):
        with pytest.raises(Exception, match="beyond 64 bits"):
            topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 50 == 0).collect()
