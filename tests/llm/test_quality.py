"""Quality classifier: held-out accuracy and the shrinkage by brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ingot.llm import quality as Q

D = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    labels = spark.read.parquet(f"{D}/labels.parquet")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    got = Q.judge(docs, labels.where(half)).join(labels.where(~half).select("doc_id", "quality"), "doc_id").select("keep", "quality").toPandas()
    good, bad = got[got.quality == 1], got[got.quality == 0]
    assert good.keep.mean() > 0.99 and (~bad.keep).mean() > 0.95
    kept = Q.filter_quality(docs, labels)
    assert kept.columns == docs.columns and 0.8 < kept.count() / docs.count() < 0.95


def strength(groups, center):
    """Prior strength of groups of probabilities around their centers."""
    n = np.array([len(g) for g in groups], float)
    m, c = np.array([np.mean(g) for g in groups]), np.array(center)
    within = sum(((np.array(g) - np.mean(g)) ** 2).sum() for g in groups) / max(1, n.sum() - len(n))
    var = ((n * (m - c) ** 2).sum() - len(n) * within) / max(1, n.sum() - (n**2).sum() / n.sum())
    mean = (n * c).sum() / n.sum()
    return min(1e6, max(1.0, mean * (1 - mean) / var - 1)) if var > 1e-9 else 1e6


def plain_posteriors(rows):
    """(prior, rates by host, rates by site) of (host, path, p) rows."""
    prior = sum(p for *_, p in rows) / len(rows)
    hosts, sites = sorted({h for h, *_ in rows}, key=str), sorted({(h, p) for h, p, _ in rows}, key=str)
    by_host = {h: [p for a, _, p in rows if a == h] for h in hosts}
    k = strength([by_host[h] for h in hosts], [prior] * len(hosts))
    rate = {h: (k * prior + sum(by_host[h])) / (k + len(by_host[h])) for h in hosts}
    by_site = {s: [p for a, b, p in rows if (a, b) == s] for s in sites}
    k = strength([by_site[s] for s in sites], [rate[s[0]] for s in sites])
    return prior, rate, {s: (k * rate[s[0]] + sum(by_site[s])) / (k + len(by_site[s])) for s in sites}


def test_every_score_by_hand(spark):
    """Regression by plain gradient descent, posteriors and scores of the whole
    table; repeated and contradictory labels are rows of the fit."""
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    labels = spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "quality")
    labels = labels.unionByName(labels.limit(9)).unionByName(labels.limit(4).withColumn("quality", 1 - F.col("quality")))
    rows, known = docs.collect(), labels.collect()
    x = {r["doc_id"]: Q.features(r["text"] or "") for r in rows}
    a, y = np.array([x[r["doc_id"]] for r in known if r["doc_id"] in x]), np.array([r["quality"] for r in known if r["doc_id"] in x], float)
    mean, scale = a.mean(0), np.maximum(a.std(0), 1e-6)
    z = np.c_[np.clip((a - mean) / scale, -8, 8), np.ones(len(a))]
    w, ridge = np.zeros(z.shape[1]), Q.RIDGE * len(a) / 10 * np.r_[np.ones(z.shape[1] - 1), 0]
    step = 1 / (np.linalg.norm(z, 2) ** 2 / 4 + ridge.max())
    for _ in range(200_000):
        g = z.T @ (y - 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))) - ridge * w
        w += step * g
        if np.abs(g).max() < 1e-8:
            break
    odds = {i: float(np.clip(np.r_[np.clip((np.array(f) - mean) / scale, -8, 8), 1] @ w, -20, 20)) for i, f in x.items()}
    prior, _, site = plain_posteriors([(r["source"], r["lang"], 1 / (1 + math.exp(-odds[r["doc_id"]]))) for r in rows])
    logit = lambda p: math.log(min(max(p, 1e-6), 1 - 1e-6) / (1 - min(max(p, 1e-6), 1 - 1e-6)))
    got = Q.judge(docs, labels).collect()
    assert len(got) == len(rows)
    for g in got:
        want = odds[g["doc_id"]] + logit(site[g["host"], g["path"]]) - logit(prior)
        assert g["log_odds"] == pytest.approx(odds[g["doc_id"]], abs=1e-3) and g["score"] == pytest.approx(want, abs=1e-2) and g["keep"] == (g["score"] >= Q.THRESHOLD)


def test_site_posteriors(spark):
    r = random.Random(4)
    rows = []
    for host, rate in (("a", 0.9), ("b", 0.5), ("c", 0.2), (None, 0.7)):
        for path in ("x", "y", None):
            rows += [(host, path, min(0.99, max(0.01, r.gauss(rate, 0.1)))) for _ in range(r.choice((1, 5, 60)))]
    got = {(g["host"], g["path"]): g for g in Q.site_posteriors(spark.createDataFrame(rows, "host string, path string, p double")).collect()}
    prior, rate, site = plain_posteriors(rows)
    for s, path_rate in site.items():
        assert got[s]["host_rate"] == pytest.approx(rate[s[0]])
        assert got[s]["path_rate"] == pytest.approx(path_rate)
        assert got[s]["prior"] == pytest.approx(prior)


def test_a_bad_site_tips_the_balance(spark):
    rows = [("bad", "p", -1.0)] * 50 + [("good", "p", 3.0)] * 50 + [("bad", "p", 0.3), ("good", "p", 0.3), ("new", "p", 0.3)]
    scored = spark.createDataFrame(rows, "host string, path string, log_odds double")
    sites = Q.site_posteriors(scored.select("host", "path", (1 / (1 + F.exp(-F.col("log_odds")))).alias("p")))
    got = {r["host"]: r["keep"] for r in Q.with_score(scored, sites).where("log_odds = 0.3").collect()}
    assert got == {"bad": False, "good": True, "new": True}


LABELS = "doc_id long, quality int"


def test_no_labels_keep_everything(spark):
    rows = [(1, "some text", "h", "en"), (1, "some text", "h", "en"), (2, None, None, None), (None, "", "h", None), (3, "x " * 60_000, "h", "en")]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, source string, lang string, log_odds double")
    for labels in (spark.createDataFrame([], LABELS), spark.createDataFrame([(1, 1), (None, 0), (9, None)], LABELS)):
        assert Q.judge(docs, labels).where("keep").count() == 5
        kept = Q.filter_quality(docs, labels)
        assert kept.columns == docs.columns and kept.count() == 5
    assert Q.filter_quality(docs.limit(0), spark.createDataFrame([], LABELS)).count() == 0


def test_features_are_bounded():
    for t in ("", " \n", "a", "!" * 100_000, "|" * 9, "\x00\x85", "A1 " * 50_000, "漢字 " * 7):
        f = Q.features(t)
        assert len(f) == len(Q.FEATURES) and all(math.isfinite(x) and 0 <= x <= 100_000 for x in f)
