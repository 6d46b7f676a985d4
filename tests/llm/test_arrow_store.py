"""Token-id files: exact round trip against the tokenizers library."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ingot.llm import arrow_store as A

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["Hello World's 123 ### !!", "", None, "naïve ÜNÏCODE İstanbul ΟΔΟΣ ς 漢字 🙂", "á é Å", "x\x1cy z\x85w v u\x0bq", "<|endoftext|> don't", "a <|endoftext|> b", "x<|startoftext|>y <|endoftext|>", "<|ENDOFTEXT|> <| end |>", "<|endoftext", "ß" * 3000, "word, " * 9000, "Hello World's 123 ### !!", "²½ ĳ ǅ"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)  # as it comes


def expected(library, rows):
    start, out = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_round_trip(spark, library):
    rows = [(i * 3, t) for i, t in enumerate(TEXTS)] + [(None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("tie", F.lit("clash")).repartition(4)
    manifest = A.write_sequences(docs, PATH, 2, length=16)
    got = [tuple(r) for r in A.read_digests(manifest, A.id_type_of(docs)).collect()]
    assert sorted(got, key=str) == sorted(expected(library, rows), key=str)


def test_random_access_and_masks(spark, library):
    docs = spark.createDataFrame([(1, "one two three"), (2, "four " * 50)], "doc_id long, text string")
    manifest = A.write_sequences(docs.coalesce(1), PATH, 2, length=8).collect()
    want = [*library.encode("one two three", add_special_tokens=False).ids, 2, *library.encode("four " * 50, add_special_tokens=False).ids, 2]
    got = []
    for shard in sorted(manifest, key=lambda r: r["shard"]):
        f = A.SequenceFile(shard["sequences"])
        assert len(f) == -(-shard["n_ids"] // 8)
        for i in reversed(range(len(f))):  # any order
            ids, mask = f[i]
            assert len(ids) == len(mask) == 8 and not ids.flags.owndata
        stream = [int(x) for i in range(len(f)) for x, ok in zip(f[i][0], f[i][1].to_pylist()) if ok]
        assert stream == f.span(0, shard["n_ids"]).tolist()
        got += stream
        with pytest.raises(IndexError):
            f[len(f)]
    assert got == want


def test_sequences_as_rows(spark):
    docs = spark.createDataFrame([(i, "some words here " * i) for i in range(40)], "doc_id long, text string")
    manifest = A.write_sequences(docs, PATH, 2, length=32)
    rows = A.read_sequences(manifest).select(F.size("ids").alias("n"), F.size("mask").alias("m"), F.size(F.filter("mask", lambda x: x)).alias("used"))
    r = rows.agg(F.min("n"), F.max("m"), F.sum("used")).first()
    assert (r[0], r[1]) == (32, 32) and r[2] == manifest.agg(F.sum("n_ids")).first()[0]


def test_equal_ids_and_empty_table(spark, library):
    rows = [(5, "same"), (5, "same"), (5, "other text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = A.read_digests(A.write_sequences(docs, PATH, 2), A.id_type_of(docs)).collect()
    assert len(got) == 3 and sorted(r["start"] for r in got)[0] == 0
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert A.read_digests(A.write_sequences(empty, PATH, 2), A.id_type_of(empty)).count() == 0


def test_query_on_the_table(spark, library):
    from ingot.llm.queries import QUERIES

    d = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r[c] for c in ("doc_id", "start", "n_tokens", "ids_crc32")) for r in QUERIES["op8_token_id_files"](spark, d).collect())
    assert got == expected(library, rows)


def test_a_worker_remembers_a_bounded_number_of_words(monkeypatch, library):
    """However many words one batch brings, and words met again stay known."""
    monkeypatch.setattr(A, "MEMORY_WORDS", 50)
    cache, most = A.WordCache(PATH), 0
    for i in range(300):
        text = f"the same words and {i}x{i} y{i * 7919}"
        assert np.frombuffer(cache.encode(text), cache.dtype).tolist() == library.encode(text, add_special_tokens=False).ids
        most = max(most, len(cache) + len(cache.older))
    assert most < 150 and "same" in cache.keys() | cache.older.keys()
