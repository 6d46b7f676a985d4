"""Decontamination against brute force, with hard words, items and rows."""

import random
import re

import pytest

from ingot.llm import common
from ingot.llm import decontaminate as D


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, width=13):
    wins = []
    for i, t in items:
        w = words(t)
        wins += [(i, w[k : k + width]) for k in range(max(1, len(w) - width + 1))] if w else []
    out = []
    for d, t in docs:
        w = words(t)
        hit, found = set(), set()
        for i, v in wins:
            for k in range(len(w) - len(v) + 1):
                if w[k : k + len(v)] == v:
                    hit |= set(range(k, k + len(v)))
                    found |= {str(i)} if i is not None else set()
        out.append((d, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r["row"]["doc_id"], r["n_words"], r["n_hit"], list(r["items"]), r["contaminated"]) for r in df.collect()), key=str)


HARD = ["A1 É-é ÀB_c\x00d\x7fe {f}[g]`h`", "ẞ ss ß İ i̇ K k", "", None, " .,! ", "漢字, かな", "x" * 30_000, "the " * 9000, "a b c d e f g h i j k l m n o p"]


def tables(spark, seed=1):
    r = random.Random(seed)
    say = lambda n: " ".join(r.choice("the of and to in is was zq7 é3 blorf".split()) for _ in range(n))
    items = [(i, say(r.randrange(14, 40))) for i in range(12)] + [(20, "The"), (21, "no such words here"), (22, "blorf ZQ7 the"), (23, ""), (24, None), (25, HARD[0]), (26, items_twice := say(20)), (26, items_twice), (None, "of and")]
    docs = []
    for i in range(60):
        pick = r.choice(items)[1] or ""
        docs.append((i, say(60) + "\n" + pick.upper() + ", " + say(5) if i % 2 else say(80)))
    docs += [(100 + i, t) for i, t in enumerate(HARD)] + [(5, docs[5][1]), (5, "other the text"), (None, docs[1][1])]
    return docs, items, spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, n_hit string"), spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, window int")


@pytest.mark.parametrize("block_rows", [common.BLOCK_ROWS, 5])
def test_equals_brute_force(spark, monkeypatch, block_rows):
    monkeypatch.setattr(common, "BLOCK_ROWS", block_rows)
    docs, items, docs_df, items_df = tables(spark)
    assert result(D.judge(docs_df.repartition(5), items_df)) == brute(docs, items)


def brute_near(docs, items, width=13):
    """Items by document: a word among a window's rarest, around which four
    fifths of the window's distinct words stand."""
    from collections import Counter

    texts = [words(t) for _, t in docs]
    freq, out = Counter(w for t in texts for w in t), []
    wins = {(str(i), tuple(w[k : k + width])) for i, t in items if i is not None and (w := words(t)) for k in range(max(1, len(w) - width + 1))}
    for (d, _), t in zip(docs, texts):
        found = set()
        for i, v in wins:
            need = -(-4 * len(set(v)) // 5)
            rare = sorted(set(v), key=lambda w: (freq[w], w.encode()))[: 1 + len(set(v)) - need]
            if i not in found and any(w in rare and len(set(v) & set(t[max(0, p - 12) : p + 13])) >= need for p, w in enumerate(t)):
                found.add(i)
        out.append((d, sorted(found)))
    return sorted(out, key=str)


def test_items_near_equal_brute_force(spark):
    docs, items, docs_df, items_df = tables(spark, 3)
    docs, docs_df = [x for x in docs if len(x[1] or "") < 5000], docs_df.where("text IS NULL OR length(text) < 5000")
    got = D.judge(docs_df.repartition(5), items_df, near_share=D.NEAR_SHARE)
    assert result(got) == brute(docs, items)
    assert sorted(((r["row"]["doc_id"], list(r["near"])) for r in got.collect()), key=str) == brute_near(docs, items)


def test_filter_keeps_columns(spark):
    docs, items, docs_df, items_df = tables(spark, 2)
    kept = D.decontaminate(docs_df, items_df)
    assert kept.columns == docs_df.columns and kept.count() == sum(not b[-1] for b in brute(docs, items))


def test_empty_tables(spark):
    _, _, docs, items = tables(spark)
    assert D.judge(docs.limit(0), items).count() == 0
    assert D.judge(docs, items.limit(0)).where("contaminated OR n_hit > 0").count() == 0


def test_proximity_matches(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"
    texts = [item, " ".join(reversed(item.split())), item.replace("beta", "x").replace("mu", "y"), "alpha beta gamma only", None]
    docs = D.keyed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    index, rare, n, _ = D.build_index(docs, spark.createDataFrame([(1, item)], "item_id long, text string"), share=0.8)
    exact = {r["key"]["doc_id"] for r in D.phrase_matches(index, rare, n).collect()}
    near = {r["key"]["doc_id"] for r in D.proximity_matches(index, rare, n, share=0.8).collect()}
    assert exact == {0} and near == {0, 1, 2}


def test_main_path_has_no_python(spark):
    _, _, docs, items = tables(spark)
    plan = D.judge(docs, items, near_share=D.NEAR_SHARE)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
