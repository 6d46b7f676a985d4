"""Quality classifier: document evidence shrunk through host and path.

1. Every document gets a vector of style features over its whole text and a
   log-odds of being good from a logistic regression, fitted on at most
   `TRAIN_ROWS` labelled documents (those with the smallest id hashes).
2. The probabilities of all documents are summed by path within host, by host,
   and in total.  Empirical Bayes turns them into site posteriors: a host's
   rate is shrunk toward the global rate, a path's toward its host's, each
   with a prior strength estimated from the spread between the groups, so a
   site with few documents says little.
3. A document's score is its own log-odds plus the log-odds of its path's
   posterior minus those of the global rate.  Below `THRESHOLD` it is rejected.

Null texts count as empty; null hosts and paths are groups of their own;
labels that are null or for unknown documents are ignored; repeated labels of a
document, contradictory ones too, count once each in the fit.  Without labels of
both classes there is no evidence and every document is kept.  Repeated rows
each get their result; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot.llm.common import col, field, row_hash, small_side, stable, texts, whole_row

#: Labelled documents that the regression is fitted on, at most.
TRAIN_ROWS = 20_000
#: Score below which a document is rejected (log-odds).
THRESHOLD = 0.0
RIDGE = 1e-2

FEATURES = (
    "log_words", "word_length", "upper", "digit", "mark", "marks_per_word", "marked_words", "distinct_words", "top_word",
    "distinct_lines", "line_words", "repeated_triples", "exclaim", "bars", "capital_words", "long_words", "sentences", "odd",
)
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]+")
_DIGIT = re.compile(r"[0-9]+")
_MARK = re.compile(r"[^\w\s.,;:'\"()-]+")
_END = re.compile(r"[.!?](?:\s|$)")
_ODD = re.compile(r"[\x00-\x08\x0e-\x1f\x7f-\x9f�]")


def features(text: str) -> list[float]:
    """The style features of a whole text, each of bounded size."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, chars = len(words), max(1, len(text))
    lines = [x for x in text.split("\n") if x.strip()]
    counts = Counter(words)
    marks = _MARK.findall(text)
    n_marks = sum(map(len, marks))
    length = sum(map(len, words))
    triples = n - 2
    repeated = 1 - len(set(zip(words, words[1:], words[2:]))) / triples if triples > 0 else 0.0
    return [
        np.log1p(n), min(length / n, 40.0), sum(map(len, _UPPER.findall(text))) / chars, sum(map(len, _DIGIT.findall(text))) / chars,
        n_marks / chars, min(n_marks / n, 10.0), min(len(marks) / n, 2.0), len(counts) / n, max(counts.values()) / n,
        len(set(lines)) / max(1, len(lines)), min(n / max(1, len(lines)), 1000.0) / 100, repeated, text.count("!") / n if n else 0.0, text.count("|") / n,
        sum(w[0].isupper() for w in words) / n, sum(len(w) > 20 for w in words) / n, min(len(_END.findall(text)) / n, 1.0), min(len(_ODD.findall(text)) / chars, 1.0),
    ]


def featured(docs: DataFrame, id_col: str, text_col: str, host_col: str, path_col: str) -> DataFrame:
    """`doc_id`, `row_hash`, `host`, `path`, `f` (array of double) per row."""

    def run(batches):
        for b in batches:
            rows = [features(t or "") for t in texts(b.column(4))]
            values = pa.array(np.array(rows, np.float64).ravel())
            f = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * len(FEATURES)), values)
            yield pa.RecordBatch.from_arrays([*b.columns[:4], f], names=["doc_id", "row_hash", "host", "path", "f"])

    schema = T.StructType([field(docs, id_col, "doc_id"), T.StructField("row_hash", T.LongType()), T.StructField("host", T.StringType()), T.StructField("path", T.StringType()), T.StructField("f", T.ArrayType(T.DoubleType()))])
    cast = lambda c, name: col(c).cast("string").alias(name)
    return docs.select(col(id_col).alias("doc_id"), row_hash(docs).alias("row_hash"), cast(host_col, "host"), cast(path_col, "path"), cast(text_col, "text")).mapInArrow(run, schema)


# --- the document classifier --------------------------------------------------------------

class Model:
    """Logistic regression on standardised features."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.mean, self.scale, self.weight, self.bias = np.zeros(len(FEATURES)), np.ones(len(FEATURES)), np.zeros(len(FEATURES)), 0.0
        if len(y) and 0 < y.sum() < len(y):
            self._fit(x, y)

    def _fit(self, x: np.ndarray, y: np.ndarray) -> None:
        self.mean, self.scale = x.mean(0), np.maximum(x.std(0), 1e-6)
        z = np.c_[self._standard(x), np.ones(len(x))]
        w = np.zeros(z.shape[1])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            ridge = RIDGE * len(x) * np.r_[np.ones(len(w) - 1), 0] / 10
            gradient = z.T @ (y - p) - ridge * w
            curve = (z * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ z + np.diag(ridge + 1e-9)
            step = np.linalg.solve(curve, gradient)
            w += np.clip(step, -4, 4)
            if np.abs(step).max() < 1e-6:
                break
        self.weight, self.bias = w[:-1], float(w[-1])

    def _standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self._standard(x) @ self.weight + self.bias, -20, 20)


def fit(found: DataFrame, labels: DataFrame, label_id_col: str = "doc_id", label_col: str = "quality", train_rows: int = TRAIN_ROWS) -> Model:
    """The classifier, from a bounded sample of labelled documents: of the
    labels, by hash, about half as many again as wanted go into the join, so
    that no task sends its own `train_rows` rows to be cut down later."""
    known = labels.select(col(label_id_col).alias("doc_id"), col(label_col).cast("double").alias("y")).where("y IN (0, 1)")
    part = -(-1_500_000 * train_rows // max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < part)
    sample = found.join(known, "doc_id").select("y", "f").orderBy(F.xxhash64("doc_id"), "doc_id", "row_hash").limit(train_rows).toPandas()
    return Model(np.array(sample["f"].tolist(), np.float64).reshape(-1, len(FEATURES)), sample["y"].to_numpy(np.float64))


def log_odds(rows: DataFrame, model: Model) -> DataFrame:
    """`rows` with the classifier's `log_odds` of their features `f`."""
    schema = T.StructType([*[x for x in rows.schema.fields if x.name != "f"], T.StructField("log_odds", T.DoubleType())])

    def run(batches):
        for b in batches:
            at = b.schema.get_field_index("f")
            x = np.array(b.column(at).to_pylist(), np.float64).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([c for i, c in enumerate(b.columns) if i != at] + [pa.array(model.log_odds(x))], names=schema.names)

    return rows.mapInArrow(run, schema)


# --- site posteriors ------------------------------------------------------------------------

def _logit(p):
    p = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.log(p / (1 - p))


def _strength(groups: DataFrame, rate: str) -> DataFrame:
    """One row `strength`: the prior strength (in documents) of groups with
    `n`, `s` (sum), `q` (sum of squares) around the `rate` each is shrunk to,
    by the method of moments; large if the groups differ no more than chance."""
    total = groups.agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.count(F.lit(1)).alias("g"),
        F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.col(rate), 2)).alias("between"),
        F.sum(F.col("q") - F.col("s") * F.col("s") / F.col("n")).alias("within"), F.sum(F.col("n") * F.col(rate)).alias("mass"),
    )
    spread = F.col("within") / F.greatest(F.lit(1.0), F.col("n") - F.col("g"))
    variance = (F.col("between") - F.col("g") * spread) / F.greatest(F.lit(1.0), F.col("n") - F.col("nn") / F.col("n"))
    mean = F.col("mass") / F.col("n")
    strength = F.when(variance > 1e-9, mean * (1 - mean) / variance - 1).otherwise(F.lit(1e6))
    return total.select(F.least(F.lit(1e6), F.greatest(F.lit(1.0), strength)).alias("strength"))


def site_posteriors(scored: DataFrame) -> DataFrame:
    """`host`, `path`, `prior`, `host_rate`, `path_rate` from the
    probabilities `p` of all documents (host, path, p)."""
    paths = stable(scored.groupBy("host", "path").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("q")))
    prior = paths.agg(F.sum("s") / F.sum("n")).first()[0]
    prior = 0.5 if prior is None else float(prior)
    hosts = paths.groupBy("host").agg(*[F.sum(c).alias(c) for c in ("n", "s", "q")]).withColumn("prior", F.lit(prior))
    k = _strength(hosts, "prior").first()[0] or 1.0
    hosts = hosts.select(F.col("host").alias("_host"), "prior", ((F.lit(k) * F.col("prior") + F.col("s")) / (F.lit(k) + F.col("n"))).alias("host_rate"))
    nested = stable(paths.join(hosts, F.col("host").eqNullSafe(F.col("_host"))).drop("_host"))
    k = _strength(nested, "host_rate").first()[0] or 1.0
    return nested.select("host", "path", "prior", "host_rate", ((F.lit(k) * F.col("host_rate") + F.col("s")) / (F.lit(k) + F.col("n"))).alias("path_rate"))


def with_score(rows: DataFrame, sites: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`rows` (host, path, log_odds, ...) with `prior`, `host_rate`,
    `path_rate`, `score` and `keep`."""
    side = sites.withColumnsRenamed({"host": "_host", "path": "_path"})
    on = F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path"))
    out = rows.join(small_side(side, sites.count()), on, "left").drop("_host", "_path")
    return out.withColumn("score", F.col("log_odds") + _logit(F.col("path_rate")) - _logit(F.col("prior"))).withColumn("keep", F.col("score") >= threshold)


# --- the operator -----------------------------------------------------------------------------

def _learn(docs, labels, id_col, text_col, host_col, path_col, label_id_col, label_col, train_rows):
    found = stable(featured(docs, id_col, text_col, host_col, path_col))
    model = fit(found, labels, label_id_col, label_col, train_rows)
    scored = log_odds(found, model)
    p = 1 / (1 + F.exp(-F.col("log_odds")))
    return scored, model, stable(site_posteriors(scored.select("host", "path", p.alias("p"))))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang",
          label_id_col: str = "doc_id", label_col: str = "quality", train_rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: `doc_id`, `host`, `path`, `log_odds`, `prior`, `host_rate`,
    `path_rate`, `score`, `keep`."""
    scored, _, sites = _learn(docs, labels, id_col, text_col, host_col, path_col, label_id_col, label_col, train_rows)
    return with_score(scored.drop("row_hash"), sites, threshold)


def filter_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang",
                   label_id_col: str = "doc_id", label_col: str = "quality", train_rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` without the rejected documents.  The features are computed once
    more beside the text, which is cheaper than to shuffle the texts."""
    _, model, sites = _learn(docs, labels, id_col, text_col, host_col, path_col, label_id_col, label_col, train_rows)
    cast = lambda c, name: col(c).cast("string").alias(name)
    rows = docs.select(whole_row(docs).alias("row"), cast(host_col, "host"), cast(path_col, "path"))
    schema = T.StructType([*rows.schema.fields, T.StructField("log_odds", T.DoubleType())])

    def run(batches):
        for b in batches:
            x = np.array([features(t or "") for t in texts(b.column(0).field(text_col))], np.float64).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(model.log_odds(x))], names=schema.names)

    return with_score(rows.mapInArrow(run, schema), sites, threshold).where("keep").select("row.*")
