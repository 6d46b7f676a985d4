"""SimHash near-duplicates against brute force over all pairs."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ingot.llm import simhash as S


def brute_fingerprint(text, k=3):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hs = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, budget):
    """Smallest index reachable, by breadth-first search over all pairs."""
    near = [[j for j in range(len(fps)) if (fps[i] ^ fps[j]).bit_count() <= budget] for i in range(len(fps))]
    comp = [None] * len(fps)
    for i in range(len(fps)):
        if comp[i] is None:
            todo = [i]
            while todo:
                x = todo.pop()
                if comp[x] is None:
                    comp[x] = i
                    todo += near[x]
    return comp


def clustered(n, seed):
    """Fingerprints in clusters whose members differ from a centre by 0-4 bits."""
    r = random.Random(seed)
    out = []
    while len(out) < n:
        centre = r.getrandbits(64)
        for _ in range(r.choice((1, 2, 5, 40))):
            f = centre
            for _ in range(r.randrange(5)):
                f ^= 1 << r.randrange(64)
            out.append(f)
    return out[:n]


@pytest.mark.parametrize("leaf,node_rows", [(16384, 10**6), (16, 10**6), (64, 60)])
def test_trie_join_equals_all_pairs(spark, leaf, node_rows):
    fps = sorted(set(clustered(700, 3)) | {0, 2**64 - 1, 2**64 - 2})
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    links = S.trie_links(df, len(fps), 2, leaf, node_rows)
    got = {r["node"] % 2**64: r["root"] % 2**64 for r in S.components(links).collect()}
    want = brute_components(fps, 2)
    groups_got, groups_want = {}, {}
    for i, f in enumerate(fps):
        groups_got.setdefault(got.get(f, f), set()).add(f)
        groups_want.setdefault(want[i], set()).add(f)
    assert sorted(map(sorted, groups_got.values())) == sorted(map(sorted, groups_want.values()))


TEXTS = ["a b c d e f g", "A b\tC d\n e f g", "a b c d e f h", "", None, " \n", "x", "one two", "ünï Çode ÀB c d", "\x1c y\x85z", "w " * 5000, ("long text of many words " * 3000) + "end"]


def test_fingerprints_match_the_definition(spark):
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(TEXTS)], "doc_id long, text string, fp int")
    got = {r["doc_id"]: r["fp"] % 2**64 for r in S.fingerprints(docs).collect()}
    assert got == {i: brute_fingerprint(t) for i, t in enumerate(TEXTS)}


def test_components_nulls_ties_and_clashing_columns(spark):
    rows = [(9, TEXTS[0], "a"), (4, TEXTS[1], "b"), (4, TEXTS[1], "b"), (None, TEXTS[0], "c"), (None, "quite another text of its own", "d"), (7, None, "e"), (8, "", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, root string")
    got = sorted(((str(r["doc_id"]), r["component_id"]) for r in S.near_duplicates(docs).collect()), key=str)
    assert got == sorted([("9", 4), ("4", 4), ("4", 4), ("None", 4), ("None", None), ("7", 7), ("8", 7)], key=str)
    kept = S.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) + r["root"] for r in kept.collect()) == ["4b", "7e", "Noned"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(docs).count() == 0
    assert S.deduplicate(docs).count() == 0


def test_long_chain_is_one_component(spark):
    edges = [(i + 1, i) for i in range(300)]
    random.Random(1).shuffle(edges)
    roots = S.components(spark.createDataFrame(edges, "u long, v long"))
    assert roots.where(F.col("root") != 0).count() == 0 and roots.count() == 300
