"""Ranked search against scores of every document."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ingot.llm import lexical as L


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, k):
    found = [(i, Counter(words(t))) for i, t in docs]
    n, length = sum(bool(c) for _, c in found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in found:
            m = 100 - 25 + (25 * sum(c.values()) * n) // max(1, length)
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t in words(text) if c[t])
            scored.append((-s, i is not None, i or 0))
        top = sorted(x for x in scored if x[0] < 0)[:k]
        out += [(item, r, i if known else None, -s) for r, (s, known, i) in enumerate(top, 1)]
    return sorted(out, key=str)


def random_rows(seed, n, vocabulary=300):
    r = np.random.default_rng(seed)
    draw = lambda size: " ".join(f"w{x}" for x in r.zipf(1.3, size) % vocabulary)
    return [(int(i), draw(int(r.integers(0, 90)))) for i in r.permutation(n)]


@pytest.mark.parametrize("k", [1, 7, 20])
def test_equals_brute_force(spark, k):
    docs, items = random_rows(1, 700), random_rows(2, 25)
    docs += [(i + 1000, "w1 w2 w3") for i in range(60)]  # ties
    got = L.rank(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"), k=k)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items, k)


def test_shards_blocks_and_passes(spark, monkeypatch):
    """Small shards in one task (its threshold goes on), queries in passes."""
    monkeypatch.setattr(L, "BLOCK", 4)
    docs, items = random_rows(3, 400), random_rows(4, 12)
    data = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    got = L.rank(data, spark.createDataFrame(items, "item_id long, text string"), k=5, query_terms=60)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items, 5)


def shards_of(docs, terms, size):
    import pyarrow as pa

    code = {t: i for i, t in enumerate(terms)}
    for s in range(0, len(docs), size):
        part = [(i, L.terms_of(t.encode())) for i, t in docs[s : s + size]]
        hits = [np.array([code[w] for w in ws if w in code], np.int32) for _, ws in part]
        yield L.build_shard(pa.array([i for i, _ in part], pa.int64()), [len(ws) for _, ws in part], hits)


def test_one_heap_over_shards_with_tiny_blocks(monkeypatch):
    """The search itself, with blocks of three postings, and what it unpacks."""
    monkeypatch.setattr(L, "BLOCK", 3)
    docs = random_rows(5, 900)
    terms = sorted({w for _, t in docs for w in L.terms_of(t.encode())})
    rows = list(shards_of(docs, terms, 90))
    n, length = sum(r["n_docs"] for r in rows), sum(r["n_words"] for r in rows)
    df = Counter()
    for r in rows:
        df.update(dict(zip(r["codes"], r["df"])))
    unpacked = total = 0
    for item, text in random_rows(6, 15):
        heap = L.Heap(4)
        for r in rows:
            shard = L.Shard(r, n, length)
            query = [(c, q * L.weight(n, df[c])) for c, q in ((terms.index(t), q) for t, q in Counter(L.terms_of(text.encode())).items() if t in terms)]
            doc, score = shard.best(query, 4, heap.threshold)
            heap.add(L._load_ids(r["ids"]).take(doc).to_pylist(), score.tolist())
            unpacked += len(shard.known)
            total += sum(e - s for c, (s, e) in shard.blocks.items() if c in dict(query))
        assert [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(heap.rows)] == [x for x in sorted(brute(docs, [(item, text)], 4), key=lambda x: x[1])]
    assert unpacked < 0.8 * total  # blocks were rejected unread


def test_bounds_hold():
    r = np.random.default_rng(7)
    tf, m = r.integers(1, 300, 500), r.integers(75, 5000, 500)
    assert (L.saturation(np.full(500, tf.max()), np.full(500, m.min())) >= L.saturation(tf, m)).all()
    big = L.length_norms(np.array([10**9, 1], np.int64), 10**12, 10**13)  # beyond 64 bits on the way
    assert big.tolist() == [75 + 25 * 10**9 * 10**12 // 10**13, 75 + 25 * 10**12 // 10**13]


def test_hard_rows(spark):
    docs = [(None, "Alpha beta"), (3, None), (4, ""), (5, "alpha " * 30_000), (6, "ALPHA-beta"), (6, "ALPHA-beta"), (7, "éÉ漢 İ"), (8, "!!!")]
    items = [("a", "alpha beta beta"), ("a", "alpha beta beta"), (None, "éé漢"), ("n", None), ("e", ""), ("x", "absent"), ("u", "éÉ漢")]
    data = spark.createDataFrame(docs, "doc_id long, text string").withColumn("rank", F.lit(1)).withColumn("no", F.lit("x"))
    got = L.rank(data, spark.createDataFrame(items, "item_id string, text string").withColumn("score", F.lit(0)), k=3)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items, 3)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert L.rank(none, spark.createDataFrame(items, "item_id string, text string")).count() == 0
    assert L.rank(data, spark.createDataFrame([], "item_id string, text string")).count() == 0
