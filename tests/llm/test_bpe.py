"""Byte-level BPE against the tiktoken library."""

import public_tokenizers
import pytest
import tiktoken

from ingot.llm import bpe

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = ["Hello  world's\n\n end \t", "", None, "naïve Ünïcode 漢字かな 🙂🙂 ١٢٣ x²½", "<|endoftext|> it'll", "\x00\x1c\x85 　 a", "a" * 9000, "word " * 20000, "Hello  world's\n\n end \t", " ", "퟿�"]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks_of(RANKS), special_tokens={})


@pytest.mark.parametrize("block_chars", [bpe.BLOCK_CHARS, 40])
def test_equals_the_library_and_decodes(spark, library, block_chars):
    rows = [(i, t, "x" if i % 2 else None) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    got = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN, block_chars=block_chars), RANKS).collect()
    assert len(got) == len(rows)
    for r in got:
        text = TEXTS[r["row"]["doc_id"]] or ""
        assert r["ids"] == library.encode_ordinary(text)
        assert bytes(r["decoded"]) == text.encode()
        assert r["row"]["ids"] == ("x" if r["row"]["doc_id"] % 2 else None)


def test_empty_table_and_no_other_column(spark):
    assert bpe.encode(spark.createDataFrame([], "doc_id long, text string"), RANKS, public_tokenizers.PATTERN).count() == 0
    got = bpe.encode(spark.createDataFrame([("a b",), ("a b",)], "text string"), RANKS, public_tokenizers.PATTERN).collect()
    assert len(got) == 2 and got[0]["ids"] == got[1]["ids"]


def test_null_ids_decode_to_null(spark):
    rows = spark.createDataFrame([([0, 1],), (None,), ([],)], "ids array<int>")
    table = bpe.token_table(RANKS)
    assert [None if r["decoded"] is None else bytes(r["decoded"]) for r in bpe.decode(rows, RANKS).collect()] == [table[0] + table[1], None, b""]


def test_query_on_the_table(spark, library):
    import hashlib

    from ingot.llm.queries import QUERIES

    d = "/root/testdata/sf0.001"
    text = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    got = QUERIES["op6_byte_bpe"](spark, d).collect()
    assert len(got) == len(text)
    for r in got:
        ids = library.encode_ordinary(text[r["doc_id"]])
        sha = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha, hashlib.sha256(text[r["doc_id"]].encode()).hexdigest())
