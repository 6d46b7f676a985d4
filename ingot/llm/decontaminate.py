"""Benchmark decontamination over a distributed positional inverted index.

The index stores, for the terms the benchmark needs, one posting per
occurrence in the training corpus: term, document, position and the words
around it.  A query (a window of benchmark words) starts from the postings of
its rarest term, shifts each position by the term's offset in the window and
keeps the ones where every other offset holds the window's word as well.  For
proximity matches, which may lack a part of the window's words and have them in
any order, it starts from as many more of its rarest terms as may be lacking.

Only DataFrame functions run here.  The corpus is read three times (term
counts, postings, word counts), its tokens are never shuffled: they meet the
benchmark's terms by a broadcast join, in blocks of about `common.BLOCK_ROWS`
rows, so a benchmark of any size takes more passes, not more memory.

Null texts have no words.  Repeated rows (same id and text) each get a result
row.  Items with a null id mark words as hit but are not listed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ingot.llm.common import BROADCAST_ROWS, col, in_blocks, small_side, stable, whole_row

#: Words of a window, and the share of hit words that contaminates (1 / 20).
WINDOW = 13
HIT_SHARE = 20
#: Share of a window's distinct words that a proximity match holds.
NEAR_SHARE = 0.8

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text: A-Z lowered, runs of digits, a-z and non-ASCII."""
    text = F.coalesce(text, F.lit(""))
    # of an ASCII text, lower() changes A-Z only, and reads it faster
    lowered = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(lowered, _GAP), "")


def windows_of(items: DataFrame, id_col: str = "item_id", text_col: str = "text", width: int = WINDOW) -> DataFrame:
    """`window` (array of words) and `item_id` of every benchmark window; an
    item of fewer words, but not none, is one window."""
    words = items.select(col(id_col).cast("string").alias("item_id"), words_of(col(text_col).cast("string")).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (width - 1)))
    return words.select("item_id", "words", F.explode(starts).alias("s")).select(F.expr(f"slice(words, s, {width})").alias("window"), "item_id").distinct()


def term_counts(docs: DataFrame, terms: DataFrame, n_terms: int) -> DataFrame:
    """`term`, `count`: occurrences in the corpus of each of `terms`."""
    tokens = docs.select(F.explode("words").alias("term"))
    counted = [tokens.join(F.broadcast(part), "term").groupBy("term").agg(F.count(F.lit(1)).alias("count")) for part in in_blocks(terms, n_terms, "term")]
    return reduce(DataFrame.unionByName, counted)


def _needed(distinct: Column, share: float) -> Column:
    """How many of so many distinct words a match holds (not swayed by rounding)."""
    return F.ceil(F.lit(share) * distinct - F.lit(1e-9)).cast("int")


def rarest_terms(windows: DataFrame, counts: DataFrame, n_terms: int, share: float = 1.0) -> DataFrame:
    """`window`, `term` (its rarest, ties by the term), `at` (its first offset
    in the window), `place` (0 for the rarest).  A match may lack a part of the words if `share` is below
    one: then so many more of the rarest terms are given that each match holds
    one of them.  Terms that the corpus lacks occur nowhere and are left out."""
    terms = windows.select("window").distinct().select("window", F.posexplode("window").alias("at", "term"))
    known = terms.join(small_side(counts, n_terms, BROADCAST_ROWS), "term", "left")
    words = known.groupBy("window", "term").agg(F.coalesce(F.max("count"), F.lit(0)).alias("count"), F.min("at").alias("at"))
    ranked = words.groupBy("window").agg(F.array_sort(F.collect_list(F.struct("count", "term", "at"))).alias("r"))
    may_lack = F.size("r") - _needed(F.size("r"), share)
    rare = ranked.select("window", F.posexplode(F.slice("r", F.lit(1), 1 + may_lack)).alias("place", "r"))
    return rare.where("r.count > 0").select("window", F.col("r.term").alias("term"), F.col("r.at").alias("at"), "place")


def postings(docs: DataFrame, anchors: DataFrame, n_anchors: int, width: int = WINDOW) -> DataFrame:
    """Positional postings of the anchor terms: `term`, `key`, `pos` (from 0)
    and `around`, the words at most `width` - 1 before and after it, of which
    `before` come first."""
    tokens = docs.select("key", "words", F.posexplode("words").alias("pos", "term"))
    parts = [tokens.join(F.broadcast(part), "term") for part in in_blocks(anchors, n_anchors, "term")]
    before = F.least(F.col("pos"), F.lit(width - 1))
    return reduce(DataFrame.unionByName, parts).select("term", "key", "pos", before.alias("before"), F.expr(f"slice(words, pos - least(pos, {width - 1}) + 1, least(pos, {width - 1}) + {width})").alias("around"))


def phrase_matches(index: DataFrame, rare: DataFrame, n_rare: int) -> DataFrame:
    """Exact matches: `window`, `key`, `start` (word position), `length`."""
    hit = F.expr("place = 0 AND before >= at AND slice(around, before - at + 1, size(window)) = window")
    parts = [index.join(F.broadcast(part), "term").where(hit) for part in in_blocks(rare, n_rare, "term")]
    return reduce(DataFrame.unionByName, parts).select("window", "key", (F.col("pos") - F.col("at")).alias("start"), F.size("window").alias("length"))


def proximity_matches(index: DataFrame, rare: DataFrame, n_rare: int, share: float = 0.8, width: int = WINDOW) -> DataFrame:
    """Near matches: places where at least `share` of a window's distinct words
    stand within `width` - 1 words of one of its rarest terms, in any order:
    `window`, `key`, `pos` (of that term), `found` (distinct words).  The
    index must have been built with the same `share`."""
    found = F.size(F.array_intersect("window", "around"))
    parts = [index.join(F.broadcast(part), "term") for part in in_blocks(rare, n_rare, "term")]
    near = reduce(DataFrame.unionByName, parts).select("window", "key", "pos", found.alias("found"), F.size(F.array_distinct("window")).alias("need")).distinct()
    return near.where(F.col("found") >= _needed(F.col("need"), share)).drop("need")


def build_index(docs: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text", width: int = WINDOW, share: float = 1.0):
    """(postings, rarest terms, their number, item windows) for `docs(key, words)`."""
    windows = stable(windows_of(items, id_col, text_col, width))
    terms = stable(windows.select(F.explode("window").alias("term")).distinct())
    n_terms = terms.count()
    rare = stable(rarest_terms(windows, term_counts(docs, terms, n_terms), n_terms, share))
    anchors = rare.select("term").distinct()
    return stable(postings(docs, anchors, anchors.count(), width)), rare, rare.count(), windows


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`key` (id and text hash: rows alike in both share one result), `words`."""
    text = col(text_col).cast("string")
    return docs.select(F.struct(col(id_col).alias("doc_id"), F.xxhash64(text).alias("hash")).alias("key"), words_of(text).alias("words"))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", width: int = WINDOW, near_share: float = 1.0) -> DataFrame:
    """Per document: `key`, `n_hit` (words inside an occurring window), `items`
    (sorted item ids) for the documents that have any; with a `near_share`
    below one also `near`, the items with proximity matches."""
    corpus = keyed(docs, id_col, text_col)
    index, rare, n_rare, windows = build_index(corpus, items, item_id_col, item_text_col, width, near_share)
    hits = stable(phrase_matches(index, rare, n_rare).distinct())
    spans = hits.groupBy("key", "start").agg(F.max("length").alias("length"))
    order = Window.partitionBy("key").orderBy("start")
    end = F.col("start") + F.col("length")
    covered = spans.withColumn("done", F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    covered = covered.groupBy("key").agg(F.sum(F.greatest(F.lit(0), end - F.greatest(F.col("start"), F.coalesce("done", F.lit(0))))).alias("n_hit"))
    owners = windows.where("item_id IS NOT NULL").join(small_side(rare.select("window"), n_rare, BROADCAST_ROWS), "window", "left_semi")

    def listed(matches: DataFrame, name: str) -> DataFrame:
        per_item = matches.select("key", "window").distinct().join(owners, "window").select("key", "item_id").distinct()
        return per_item.groupBy("key").agg(F.array_sort(F.collect_list("item_id")).alias(name))

    parts = [covered, listed(hits, "items")]
    if near_share < 1:
        parts.append(listed(proximity_matches(index, rare, n_rare, near_share, width), "near"))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    found = [F.sum("n_hit").alias("n_hit"), *[F.first(c, ignorenulls=True).alias(c) for c in rows.columns if c not in ("key", "n_hit")]]
    return rows.groupBy("key").agg(*found)


def judge(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per input row: its columns in `row`, `n_words`, `n_hit`, `items`,
    `contaminated` (hit words are at least 1 / 20 of all); with a `near_share`
    below one also `near`, the items that it holds a proximity match of."""
    found = contamination(docs, items, id_col, text_col, **options)
    lists = [c for c in ("items", "near") if c in found.columns]
    flat = found.select(F.col("key.doc_id").alias("_id"), F.col("key.hash").alias("_hash"), "n_hit", *lists)
    text = col(text_col).cast("string")
    rows = docs.select(whole_row(docs).alias("row"), col(id_col).alias("_rid"), F.xxhash64(text).alias("_rhash"), F.size(words_of(text)).cast("long").alias("n_words"))
    flat, n = _counted(flat)
    out = rows.join(small_side(flat, n), (F.col("_rhash") == F.col("_hash")) & F.col("_rid").eqNullSafe(F.col("_id")), "left")
    out = out.select("row", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), *[F.coalesce(c, F.array().cast("array<string>")).alias(c) for c in lists])
    return out.withColumn("contaminated", F.expr(f"n_hit > 0 AND {HIT_SHARE} * n_hit >= n_words"))


def _counted(df: DataFrame) -> tuple[DataFrame, int]:
    df = stable(df)
    return df, df.count()


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """`docs` without the contaminated documents."""
    return judge(docs, items, **options).where("NOT contaminated").select("row.*")
