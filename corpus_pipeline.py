"""The document pipeline: five stages over `documents`.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which `run`
writes as Parquet under the shared checkpoint folder and reads again as the
next stage's documents.  All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingot.llm import bpe, decontaminate, pii, quality, simhash
from ingot.llm.common import read_table, shared_folder
from ingot.session import drop_folder


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps (site: source and language)."""
    return quality.filter_quality(docs, read_table(spark, sf_dir, "labels"), host_col="source", path_col="lang")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: 3-word shingles, 2 bits."""
    return simhash.deduplicate(docs, shingle=3, budget=2, seed=42)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover less than a twentieth."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def pii_sanitisation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts (and `n_chars`) without personal data."""
    return pii.sanitize(docs).withColumn("n_chars", F.length("text").cast("long"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with `ids`, `n_tokens` and the text decoded from the ids."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded=True)
    return coded.select("row.*", F.col("decoded").cast("string").alias("text"), F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii_sanitisation", pii_sanitisation),
    ("byte_bpe", byte_bpe),
]

#: Not expressible in SQL (trained classifier, SimHash, BPE): tests compare the
#: stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs, folder, before = read_table(spark, sf_dir, "documents"), shared_folder(spark, "pipeline"), None
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:  # the stage's input has been stored anew
            drop_folder(spark, before)
        before = path
    return docs
