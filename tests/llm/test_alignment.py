"""Tokenizer alignment against a plain version over all links."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ingot.llm import alignment as A

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["Hello  world's\n\n end \t", "", None, "naïve Ünïcode 漢字かな 🙂🙂 ١٢٣ x²½", "<|endoftext|> it'll <s> </s>", "a ▁ b", "\x00\x1c\x85 　 a",
         "a" * 3000, " " * 5000 + "x", "word " * 2000, "Hello  world's\n\n end \t", " ", "퟿�", "the cat", "the the the cat", "\n", "é" * 300]


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def byte_of():
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, n = {chr(b): b for b in own}, 256
    for b in range(256):
        if b not in own:
            out[chr(n)] = b
            n += 1
    return out


def plain(tools, rows):
    """(rows of the result, documents by pair, links by pair), step by step."""
    a, b = tools
    letters, links, out = byte_of(), [], []
    for _, t in rows:
        groups = []
        want = b" " + (t or "").encode()
        if t:
            ta = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + t, add_special_tokens=False).ids]
            tb = [(i, bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(t)]
            if b"".join(x for _, x in ta) == want == b"".join(x for _, x in tb):
                i = j = end_a = end_b = 0
                xs, ys = [], []
                while i < len(ta) or j < len(tb):
                    if end_a <= end_b and i < len(ta):
                        xs.append(ta[i][0])
                        end_a += len(ta[i][1])
                        i += 1
                    else:
                        ys.append(tb[j][0])
                        end_b += len(tb[j][1])
                        j += 1
                    if end_a == end_b:
                        groups.append((xs, ys))
                        xs, ys = [], []
        own = Counter()
        for x, y in groups:
            for p, n in Counter(x).items():
                for q, m in Counter(y).items():
                    own[p, q] += n * m
        links.append(own)
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append([sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(own.values()), hashlib.sha256(text.encode()).hexdigest() if groups else ""])
    docs, total, top = Counter(), Counter(), defaultdict(int)
    for own in links:
        docs.update(own.keys())
        total.update(own)
    for (p, _), n in docs.items():
        top[p] = max(top[p], n)
    done = [(i, *o[:4], sum(n for (p, q), n in own.items() if docs[p, q] == top[p]), sum(n * docs[x] for x, n in own.items()), o[4]) for (i, _), o, own in zip(rows, out, links)]
    return done, docs, total


@pytest.mark.parametrize("limits", [None, (16, 3, 40)])
def test_equals_the_plain_version(spark, tools, monkeypatch, limits):
    """With small limits: parts to merge, dense bitmaps and many salts (the
    functions are sent with the module's names, so tasks see other values only
    where they run them here; see the bitmap test)."""
    rows = [(None if i == 3 else i, t) for i, t in enumerate(TEXTS)] * 2
    if limits:
        monkeypatch.setattr(A, "CONTAINERS_A_TASK", 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("container", F.lit("clash")).withColumn("id", F.lit(1)).repartition(5)
    al = A.Aligned(docs, *PATHS)
    want, by_doc, by_link = plain(tools, rows)
    assert sorted((tuple(r) for r in al.result().collect()), key=str) == sorted(want, key=str)
    assert {(r["a"], r["b"]): (r["docs"], r["links"]) for r in al.pairs().collect()} == {k: (n, by_link[k]) for k, n in by_doc.items()}


def test_bitmaps_merge_and_count(monkeypatch):
    """Sparse and dense bitmaps, in parts of disjoint documents, against sets."""
    monkeypatch.setattr(A, "SPARSE", 5)
    r = np.random.default_rng(3)
    held = {(int(p), int(d)): int(m) for p, d, m in zip(r.zipf(1.2, 4000) % 900, r.integers(0, 1 << 16, 4000) % 400, r.zipf(1.7, 4000) % 300 + 1)}
    parts = []
    for k in range(4):
        own = np.array(sorted((p, d, m) for (p, d), m in held.items() if d % 4 == k), np.int64)
        parts.append(A.Bitmaps.unpack(A.Bitmaps.of(*own.T).pack()))
    whole = A.Bitmaps.unpack(A.Bitmaps.merged(parts).pack())
    docs, links = whole.counts()
    assert whole.planes[0][2] and len(whole.planes[0][0])  # both kinds
    assert dict(zip(whole.pairs.tolist(), docs.tolist())) == Counter(p for p, _ in held)
    want = Counter()
    for (p, _), m in held.items():
        want[p] += m
    assert dict(zip(whole.pairs.tolist(), links.tolist())) == want
    score, best = r.integers(1, 99, len(whole.pairs)), r.random(len(whole.pairs)) < 0.5
    total, n_best = np.zeros(A.CONTAINER, np.int64), np.zeros(A.CONTAINER, np.int64)
    whole.add_scores(score, best, total, n_best)
    at = {p: i for i, p in enumerate(whole.pairs.tolist())}
    for d in range(400):
        mine = [(at[p], m) for (p, e), m in held.items() if e == d]
        assert total[d] == sum(int(score[i]) * m for i, m in mine) and n_best[d] == sum(m for i, m in mine if best[i])


def test_the_faster_library_gives_the_same_ids(tools):
    mine, r = A.aligner(*PATHS), np.random.default_rng(5)
    assert mine.fast is not None
    alphabet = list("aaeeiinnrstt'  \n\t.,!-0179AÉéßñçüøşŁ×÷ªºµ¡¿<|>_")
    for _ in range(3000):
        text = "".join(r.choice(alphabet, int(r.integers(1, 60))))
        assert mine.encode_a(text) == tools[0].encode(text, add_special_tokens=False).ids, text


def test_empty_table(spark):
    assert A.Aligned(spark.createDataFrame([], "doc_id string, text string"), *PATHS).result().count() == 0
    only = A.Aligned(spark.createDataFrame([("x", None), ("y", "")], "doc_id string, text string"), *PATHS).result().collect()
    assert sorted(tuple(r) for r in only) == [("x", 0, 0, 0, 0, 0, 0, ""), ("y", 0, 0, 0, 0, 0, 0, "")]


def test_query_on_the_table(spark, tools):
    from ingot.llm.queries import QUERIES

    d = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in QUERIES["op13_tokenizer_alignment"](spark, d).collect())
    assert got == sorted(plain(tools, rows)[0])
