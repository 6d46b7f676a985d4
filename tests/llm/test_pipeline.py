"""The pipeline against brute force, stage by stage."""

import re

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline as P
from ingot.llm import bpe
from tests.llm.test_pii import plain_spans
from tests.llm.test_simhash import brute_components, brute_fingerprint

D = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    """(stage, rows in, rows out) of every stage."""
    docs, found = spark.read.parquet(f"{D}/documents.parquet"), []
    folder = tmp_path_factory.mktemp("stages")
    for name, stage in P.STAGES:
        stage(spark, docs, D).write.parquet(f"{folder}/{name}")
        out = spark.read.parquet(f"{folder}/{name}")
        found.append((name, docs.collect(), out.collect(), out.columns))
        docs = out
    return {name: rest for name, *rest in found}


def test_stages_and_columns(outputs):
    assert list(outputs) == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "pii_sanitisation", "byte_bpe"]
    assert all(sorted(outputs[n][2]) == sorted(COLUMNS) for n in list(outputs)[:-1])


def test_quality_keeps_the_good(spark, outputs):
    rows, out, _ = outputs["quality_classifier"]
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{D}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in out}
    known = [r["doc_id"] for r in rows if r["doc_id"] in quality]
    right = sum((d in kept) == (quality[d] == 1) for d in known)
    assert len(out) < len(rows) and right / len(known) > 0.97


def test_one_document_of_each_group(outputs):
    rows, out, _ = outputs["simhash_near_dedup"]
    rows = sorted(rows, key=lambda r: r["doc_id"])
    comp = brute_components([brute_fingerprint(r["text"]) for r in rows], 2)
    want = {rows[c]["doc_id"] for c in comp}
    assert sorted(r["doc_id"] for r in out) == sorted(want) and len(out) < len(rows)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def test_contaminated_documents_go(spark, outputs):
    rows, out, _ = outputs["benchmark_decontamination"]
    windows = set()
    for r in spark.read.parquet(f"{D}/benchmark.parquet").collect():
        w = words(r["text"])
        windows |= {tuple(w[i : i + 13]) for i in range(max(1, len(w) - 12))} if w else set()
    sizes = {len(w) for w in windows}
    want = []
    for r in rows:
        w = words(r["text"])
        hit = {p for n in sizes for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in windows for p in range(i, i + n)}
        if not (hit and 20 * len(hit) >= len(w)):
            want.append(r["doc_id"])
    assert sorted(r["doc_id"] for r in out) == sorted(want) and len(want) < len(rows)


def test_no_personal_data_stays(outputs):
    rows, out, _ = outputs["pii_sanitisation"]
    before = {r["doc_id"]: r["text"] for r in rows}
    assert sorted(before) == sorted(r["doc_id"] for r in out)
    touched = 0
    for r in out:
        assert not plain_spans(r["text"] or "") and r["n_chars"] == len(r["text"] or "")
        if plain_spans(before[r["doc_id"]] or ""):
            touched += 1
        else:
            assert r["text"] == before[r["doc_id"]]
    assert touched


def test_ids_are_the_library_s(outputs):
    ranks = bpe.ranks_of(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows, out, _ = outputs["byte_bpe"]
    before = {r["doc_id"]: r for r in rows}
    assert len(out) == len(rows)
    for r in out:
        assert r["ids"] == library.encode_ordinary(before[r["doc_id"]]["text"]) and r["n_tokens"] == len(r["ids"])
        assert all(r[c] == before[r["doc_id"]][c] for c in COLUMNS)


def test_run_gives_the_last_stage(spark, outputs):
    assert sorted(r["doc_id"] for r in P.run(spark, D).select("doc_id").collect()) == sorted(r["doc_id"] for r in outputs["byte_bpe"][1])


def test_hard_rows_and_no_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "mail a@b.cc now", None, "s", 15), (2, "another text altogether here", "en", "s", 5), (3, "w " * 30_000, "en", "s", 60_000)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in P.STAGES:
            out = stage(spark, docs, D)
            if name != "byte_bpe":
                assert out.columns == docs.columns
            n = out.count()
            assert n == docs.count() if name in ("pii_sanitisation", "byte_bpe") else n <= docs.count()
