"""Ranked lexical search by Block-Max MaxScore over sharded inverted lists.

1. Index: every task cuts its documents into shards.  A shard holds, for the
   terms that are asked for, lists of (document, occurrences), ascending by
   document id, in blocks of `BLOCK` postings that are packed to the width
   their numbers need.  Beside the packed block stand its last document, its
   most occurrences and its shortest document: what bounds its scores, whatever
   the corpus-wide counts turn out to be.
2. The shards' counts add up to those of the corpus: documents, words, and
   documents by term.
3. Search: a task goes through its shards with one heap of the best documents
   for each query, whose smallest score is the threshold.  In a shard a query's
   lists are ordered by their bounds; those which even together stay below the
   threshold are not essential.  Candidates come from the essential lists only.
   In the others, from the highest bound down, a candidate is looked up by the
   bound of the block it would stand in; if that block and the bounds of the
   remaining lists cannot lift it to the threshold, it is dropped before the
   block is unpacked.
4. The heaps of all tasks are merged, first within parts of the documents.

Scores are 64-bit integers.  Bounds compare strictly, so ties are never lost.
Queries are taken in blocks of about `QUERY_TERMS` terms, of which each reads
the corpus once; everything the driver or a task holds for them is bounded by
that, or by the longest single query.

Null texts have no terms.  Repeated documents each take a rank; repeated items
each get their ranks; an item without terms, or whose terms occur nowhere, has
none.  Null document ids come first among equal scores.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot.llm.common import col, field, stable, text_bytes

#: Documents of a shard (their numbers fit 16 bits) and its words, at most
#: (a longer document is a shard alone).
SHARD_DOCS = 4096
SHARD_WORDS = 4_000_000
#: Postings of a block.
BLOCK = 64
#: Distinct terms of the queries that one pass over the corpus answers.
QUERY_TERMS = 200_000
#: Parts of the documents in which the heaps of all tasks are merged first.
MERGE_PARTS = 64

#: Separators become blanks, A-Z become a-z, all else is part of a term.
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


# --- scores ----------------------------------------------------------------------

def weight(n_docs: int, df: int) -> int:
    """Of a term that `df` of `n_docs` documents hold."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_norms(lengths: np.ndarray, n_docs: int, n_words: int) -> np.ndarray:
    """m of documents with so many words; Python's integers where 64 bits are too few."""
    if 25 * int(lengths.max(initial=0)) * n_docs < 1 << 62:
        return 75 + 25 * lengths.astype(np.int64) * n_docs // max(1, n_words)
    return np.array([75 + 25 * int(n) * n_docs // n_words for n in lengths], np.int64)


def saturation(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Of `tf` occurrences in a document of norm `m`; grows with tf, falls with m."""
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


# --- 1: index ----------------------------------------------------------------------

_INDEX = T.StructType([
    T.StructField("n_docs", T.LongType()), T.StructField("n_words", T.LongType()),
    T.StructField("codes", T.ArrayType(T.IntegerType())), T.StructField("df", T.ArrayType(T.LongType())),  # by list
    T.StructField("ids", T.BinaryType()), T.StructField("lengths", T.BinaryType()),  # by document
    T.StructField("first", T.BinaryType()), T.StructField("last", T.BinaryType()), T.StructField("most", T.BinaryType()),
    T.StructField("shortest", T.BinaryType()), T.StructField("packed", T.BinaryType()),  # by block
])


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _store_ids(ids: pa.Array) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([ids], names=["id"])
    with pa.ipc.new_stream(sink, batch.schema) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _load_ids(data: bytes) -> pa.Array:
    return pa.ipc.open_stream(data).read_next_batch().column(0)


def _widths(first: int, last: int, most: int) -> tuple[str, str]:
    return ("<u1" if last - first < 256 else "<u2"), ("<u1" if most < 256 else "<u4")


def build_shard(ids: pa.Array, lengths: list[int], hits: list[np.ndarray]) -> dict:
    """The index row of documents with these ids, numbers of words, and codes
    of the asked terms in them (with repeats)."""
    order = pc.sort_indices(ids, null_placement="at_start").to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    own = np.repeat(place, [len(h) for h in hits])
    keys, tf = np.unique(np.concatenate([np.empty(0, np.int64), *hits]).astype(np.int64) << 16 | own, return_counts=True)
    code, doc, n = keys >> 16, keys & 0xFFFF, np.array(lengths, np.int64)[order]
    heads = np.flatnonzero(np.diff(code, prepend=-1))
    df = np.diff(heads, append=len(code))
    starts = np.flatnonzero((np.arange(len(code)) - np.repeat(heads, df)) % BLOCK == 0)
    ends = np.append(starts[1:], len(code))[: len(starts)]
    most, shortest = (np.maximum.reduceat(tf, starts), np.minimum.reduceat(n[doc], starts)) if len(starts) else (tf, n[:0])
    first, last, packed = doc[starts], doc[ends - 1] if len(ends) else doc, []
    for a, z, lo, hi, top in zip(starts.tolist(), ends.tolist(), first.tolist(), last.tolist(), most.tolist()):
        wide_doc, wide_tf = _widths(lo, hi, top)
        packed += [(doc[a:z] - lo).astype(wide_doc).tobytes(), tf[a:z].astype(wide_tf).tobytes()]
    return {"n_docs": int((n > 0).sum()), "n_words": int(n.sum()), "codes": code[heads].tolist(), "df": df.tolist(), "ids": _store_ids(ids.take(pa.array(order))),
            "lengths": n.tobytes(), "first": first.tobytes(), "last": last.tobytes(), "most": most.astype(np.int64).tobytes(), "shortest": shortest.tobytes(), "packed": b"".join(packed)}


def build_index(docs: DataFrame, terms: list[bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a shard, with the lists of `terms` (code = place in that list)."""
    schema, code_of = _arrow(_INDEX), {t: i for i, t in enumerate(terms)}

    def run(batches):
        ids, lengths, hits, words = [], [], [], 0

        def shard():
            return pa.RecordBatch.from_pylist([build_shard(pa.concat_arrays(ids), lengths, hits)], schema)

        for b in batches:
            at = 0
            for i, text in enumerate(text_bytes(b.column(1))):
                found = terms_of(text or b"")
                if lengths and (len(lengths) >= SHARD_DOCS or words + len(found) > SHARD_WORDS):
                    ids.append(b.column(0).slice(at, i - at))
                    yield shard()
                    ids, lengths, hits, words, at = [], [], [], 0, i
                codes = [c for c in map(code_of.get, found) if c is not None]
                hits.append(np.array(codes, np.int32))
                lengths.append(len(found))
                words += len(found)
            ids.append(b.column(0).slice(at))
        if lengths:
            yield shard()

    return docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text")).mapInArrow(run, _INDEX)


# --- 3: search -----------------------------------------------------------------------

class Shard:
    """Lists of one index row; blocks are unpacked when they are asked for."""

    def __init__(self, row: dict, n_docs: int, n_words: int):
        number = lambda name: np.frombuffer(row[name], np.int64)
        self.data, self.first, self.last, self.most = row["packed"], number("first"), number("last"), number("most")
        self.norms, self.size = length_norms(number("lengths"), n_docs, n_words), len(row["lengths"]) // 8
        self.bound = saturation(self.most, length_norms(number("shortest"), n_docs, n_words))
        df = np.array(row["df"], np.int64)
        blocks = -(-df // BLOCK)
        ends = np.cumsum(blocks)
        self.blocks = {c: (e - n, e) for c, e, n in zip(row["codes"], ends.tolist(), blocks.tolist())}
        top = np.maximum.reduceat(self.bound, ends - blocks) if len(df) else df
        self.list_bound = dict(zip(row["codes"], top.tolist()))
        self.count = np.full(len(self.first), BLOCK, np.int64)
        self.count[ends - 1] = df - BLOCK * (blocks - 1)
        wide = np.where(self.last - self.first < 256, 1, 2) + np.where(self.most < 256, 1, 4)
        self.at = np.cumsum(wide * self.count) - wide * self.count
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and saturations of block `k`."""
        if k not in self.known:
            n, at = int(self.count[k]), int(self.at[k])
            wide_doc, wide_tf = _widths(self.first[k], self.last[k], self.most[k])
            doc = np.frombuffer(self.data, wide_doc, n, at).astype(np.int64) + self.first[k]
            tf = np.frombuffer(self.data, wide_tf, n, at + n * np.dtype(wide_doc).itemsize).astype(np.int64)
            self.known[k] = doc, saturation(tf, self.norms[doc])
        return self.known[k]

    def join(self, blocks) -> tuple[np.ndarray, np.ndarray]:
        parts = [self.block(k) for k in blocks]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def whole(self, code: int) -> tuple[np.ndarray, np.ndarray]:
        if code not in self.lists:
            self.lists[code] = self.join(range(*self.blocks[code]))
        return self.lists[code]

    def best(self, query: list[tuple[int, int]], k: int, threshold: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the `k` best for `query` (code, weight) among
        those that reach `threshold` (1 at least), best first."""
        lists = sorted((w * self.list_bound[c], c, w) for c, w in query if c in self.list_bound and w > 0)
        below = np.cumsum([0] + [b for b, _, _ in lists])  # of the lists before
        essential = int(np.searchsorted(below[1:], threshold, "left"))  # lists from here on reach it together
        score = np.zeros(self.size, np.int64)
        for _, c, w in lists[essential:]:
            doc, s = self.whole(c)
            score[doc] += w * s
        found = np.flatnonzero(score)
        for i in range(essential - 1, -1, -1):
            threshold = self._raised(score[found], k, threshold)
            found = found[score[found] + below[i + 1] >= threshold]
            if not len(found):
                break
            _, c, w = lists[i]
            start, end = self.blocks[c]
            at = start + np.searchsorted(self.last[start:end], found)
            inside = at < end
            block_bound = np.where(inside, w * self.bound[np.minimum(at, end - 1)], 0)
            keep = score[found] + block_bound + below[i] >= threshold
            found, at, inside = found[keep], at[keep], inside[keep]
            wanted = found[inside]
            if len(wanted):
                doc, s = self.join(np.unique(at[inside]).tolist())
                where = np.minimum(np.searchsorted(doc, wanted), len(doc) - 1)
                hit = doc[where] == wanted
                score[wanted[hit]] += w * s[where[hit]]
        threshold = self._raised(score[found], k, threshold)
        found = found[score[found] >= threshold]
        found = found[np.argsort(-score[found], kind="stable")[:k]]  # ties: ascending ids
        return found, score[found]

    @staticmethod
    def _raised(scores: np.ndarray, k: int, threshold: int) -> int:
        """The k-th best of scores that can only grow, if that is more."""
        return max(threshold, int(np.partition(scores, len(scores) - k)[len(scores) - k])) if len(scores) >= k else threshold


class Heap:
    """The best documents of a query so far."""

    def __init__(self, k: int):
        self.k, self.rows, self.threshold = k, [], 1

    def add(self, ids: list, scores: list[int]) -> None:
        self.rows += [(-s, i is not None, i) for i, s in zip(ids, scores)]
        self.rows.sort(key=lambda r: r if r[1] else r[:2])
        del self.rows[self.k :]
        if len(self.rows) == self.k:
            self.threshold = max(1, -self.rows[-1][0])


def _search(queries: dict[int, list[tuple[int, int]]], n_docs: int, n_words: int, k: int, out: pa.Schema):
    def run(batches):
        heaps = {q: Heap(k) for q in queries}
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                shard, ids = Shard(row, n_docs, n_words), _load_ids(row["ids"])
                for q, heap in heaps.items():
                    doc, score = shard.best(queries[q], k, heap.threshold)
                    if len(doc):
                        heap.add(ids.take(pa.array(doc)).to_pylist(), score.tolist())
        rows = [(q, i, -s) for q, h in heaps.items() for s, _, i in h.rows]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], out.field(j).type) for j in range(3)], schema=out)

    return run


# --- the operator ----------------------------------------------------------------------

def _asked(items: DataFrame, text_col: str) -> DataFrame:
    """`no`, `term`, `n` of the items (`no`, text)."""

    def run(batches):
        for b in batches:
            rows = [(no, t, n) for no, text in zip(b.column(0).to_pylist(), text_bytes(b.column(1))) for t, n in Counter(terms_of(text or b"")).items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.int64())], names=["no", "term", "n"])

    return items.select("no", col(text_col).cast("string").alias("text")).mapInArrow(run, "no long, term binary, n long")


def _answer(docs: DataFrame, wanted: list, k: int, id_col: str, text_col: str) -> DataFrame:
    """`no`, `doc_id`, `score`: the best of every task's documents for one block
    of queries, given as rows (no, term, n)."""
    terms = sorted({bytes(r["term"]) for r in wanted})
    index = stable(build_index(docs, terms, id_col, text_col))
    n_docs, n_words = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    lists = index.select(F.explode(F.arrays_zip("codes", "df")).alias("x"))
    df = {r["code"]: r["df"] for r in lists.groupBy(F.col("x.codes").alias("code")).agg(F.sum("x.df").alias("df")).collect()}
    code_of, queries = {t: i for i, t in enumerate(terms)}, {}
    for r in wanted:
        c = code_of[bytes(r["term"])]
        if c in df:
            queries.setdefault(r["no"], []).append((c, r["n"] * weight(n_docs, df[c])))
    schema = T.StructType([T.StructField("no", T.LongType()), field(docs, id_col, "doc_id"), T.StructField("score", T.LongType())])
    return index.mapInArrow(_search(queries, n_docs, n_words, k, _arrow(schema)), schema)


def _top(rows: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def rank(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
         item_id_col: str = "item_id", item_text_col: str = "text", query_terms: int = QUERY_TERMS) -> DataFrame:
    """`item_id`, `rank`, `doc_id`, `score`: for each of `items` the `k`
    documents with the highest scores above 0, ties by ascending id."""
    asked = stable(items.select(col(item_id_col).alias("item_id"), col(item_text_col).alias("text")).withColumn("no", F.monotonically_increasing_id()))
    wanted = stable(_asked(asked, "text"))
    n = max(1, -(-wanted.count() // query_terms))
    parts = (wanted.where(F.pmod(F.xxhash64("no"), F.lit(n)) == i).collect() for i in range(n))
    # the answers are written, so that each block's queries leave the driver with it
    found = reduce(DataFrame.unionByName, [stable(_answer(docs, p, k, id_col, text_col)) for p in parts])
    heaps = found.withColumn("part", F.pmod(F.xxhash64("doc_id", "score"), F.lit(MERGE_PARTS)))
    best = _top(_top(heaps, k, "no", "part").drop("rank"), k, "no")
    return best.join(asked.select("no", "item_id"), "no").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
