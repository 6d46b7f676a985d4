"""Registered queries of this package: one per operator and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from ingot.llm import alignment, arrow_store, bpe, decontaminate, html_extract, langid, lexical, pii, quality, simhash, token_counts, topk, url_rules
from ingot.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3-word shingles, XXH64 seed 42, links at 2 or fewer differing bits."""
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, budget=2, seed=42)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@register
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """13-word windows; contaminated from a twentieth of the words hit.  Beside
    that the items of which four fifths of a window's words stand together."""
    docs, items = read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "benchmark")
    return decontaminate.judge(docs, items, near_share=decontaminate.NEAR_SHARE).select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
        F.size("near").cast("long").alias("n_near"), F.sha2(F.array_join("near", ","), 256).alias("near_sha256"),
    )


SQL["op10_benchmark_decontamination"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, w[s : s + 12] AS v
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS s FROM b WHERE len(w) > 0)),
tok AS (SELECT rid, w, unnest(range(1, len(w) + 1)) AS p FROM d),
hit AS (
  SELECT t.rid, t.p, len(win.v) AS n, win.item_id
  FROM (SELECT rid, p, w[p] AS a, w[p : p + 12] AS c FROM tok) t
  JOIN win ON t.a = win.v[1] AND t.c[1 : len(win.v)] = win.v),
cover AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM hit) GROUP BY rid),
own AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT rid, item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY rid),
tk AS (SELECT rid, unnest(w) AS a, unnest(range(1, len(w) + 1)) AS p FROM d),
freq AS (SELECT a, count(*) AS n FROM tk GROUP BY 1),
words AS (SELECT v, list_distinct(v) AS u, len(list_distinct(v)) AS k FROM (SELECT DISTINCT v FROM win)),
ranked AS (
  SELECT v, u, k, a, coalesce(n, 0) AS n, row_number() OVER (PARTITION BY v ORDER BY coalesce(n, 0), a) AS place
  FROM (SELECT v, u, k, unnest(u) AS a FROM words) LEFT JOIN freq USING (a)),
near AS (
  SELECT DISTINCT t.rid, r.v
  FROM (SELECT * FROM ranked WHERE place <= 1 + k - (4 * k + 4) // 5) r JOIN tk t USING (a) JOIN d USING (rid)
  WHERE len(list_intersect(r.u, d.w[greatest(1, t.p - 12) : t.p + 12])) >= (4 * r.k + 4) // 5),
nearby AS (
  SELECT rid, count(*) AS n_near, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT rid, item_id FROM near JOIN win USING (v) WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(own.ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated,
       CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, sha256(coalesce(nearby.ids, '')) AS near_sha256
FROM d LEFT JOIN cover USING (rid) LEFT JOIN own USING (rid) LEFT JOIN nearby USING (rid)
"""


@register
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts by the 50k multilingual ranks, then back from the ids."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded=True)
    return coded.select(
        "row.doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@register
def op8_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the 49k word vocabulary, end id 2, written and read back."""
    docs = read_table(spark, sf_dir, "documents")
    manifest = arrow_store.write_sequences(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return arrow_store.read_digests(manifest, arrow_store.id_type_of(docs))


@register
def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best of all other vectors for every 50th id."""
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5, scale=256)


SQL["op9_exact_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def _span_list(spans: str):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@register
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans of every text and the disclosing terms around them."""
    found = pii.spans_of(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.expr(f"size(filter(base, s -> s.kind = '{k}'))").cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(_span_list("base"), 256).alias("base_sha256"), _span_list("spans").alias("spans"))


#: Site rules of the contract.
SITE_RULES = (
    url_rules.site_rule("allow", "org/"), url_rules.site_rule("block", "example.org/es/"), url_rules.site_rule("block", "example.org/en/1"),
    url_rules.site_rule("allow", "com/fr/"), url_rules.site_rule("block", "com/de/"),
)


@register
def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five site rules, then the word rules, on every url."""
    return url_rules.judge(read_table(spark, sf_dir, "pages").select("page_id", "url"), (*SITE_RULES, *url_rules.WORD_RULES))


SQL["op3_url_filters"] = r"""
WITH u AS (
  SELECT page_id, CASE WHEN position('://' IN coalesce(url, '')) = 0 THEN '' ELSE substr(url, position('://' IN url) + 3) END AS rest
  FROM pages),
h AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u),
r(verdict, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                                    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
w AS (
  SELECT page_id, host, path, r.verdict, rhost || rpath AS rule
  FROM h LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC NULLS LAST) = 1)
SELECT page_id, host, path, rule,
       CASE WHEN rule IS NOT NULL THEN verdict
            WHEN regexp_matches('/' || translate(host || path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || '/',
                 '[./_-](spam|cheap[./_-]+pills|casino|viagra|porn|xxx|malware|phishing)[./_-]') THEN 'block'
            ELSE 'allow' END AS verdict
FROM w
"""


@register
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy lengths in the 50k multilingual byte vocabulary."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@register
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


@register
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and verdict of every document (site: source and language)."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return quality.judge(docs, labels, host_col="source", path_col="lang")


@register
def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learnt on three of four folds of the ids, predicted for every text."""
    return langid.cross_identify(read_table(spark, sf_dir, "documents"))


@register
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of all documents for every benchmark item."""
    return lexical.rank(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=20)


SQL["op12_ranked_search"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT row_number() OVER () AS iid, item_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
q AS (SELECT iid, item_id, t, count(*) AS q FROM (SELECT iid, item_id, unnest(w) AS t FROM b) GROUP BY ALL),
c AS (SELECT CAST(count(*) FILTER (len(w) > 0) AS BIGINT) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d),
p AS (SELECT rid, t, count(*) AS tf FROM (SELECT rid, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
v AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * c.n + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM p, c GROUP BY t, c.n),
m AS (SELECT rid, doc_id, 100 - 25 + ((25 * CAST(len(d.w) AS BIGINT) * c.n) // c.l) AS m FROM d, c),
s AS (
  SELECT q.iid, q.item_id, m.rid, m.doc_id, CAST(sum(q.q * v.w * ((1000000000 * p.tf) // (1000 * p.tf + 12 * m.m))) AS BIGINT) AS score
  FROM q JOIN v USING (t) JOIN p USING (t) JOIN m USING (rid) GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id, rid) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""


@register
def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the 50k byte vocabulary and the 32k pieces."""
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.Aligned(read_table(spark, sf_dir, "documents"), *paths).result()


@register
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of `corpus_pipeline`."""
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
