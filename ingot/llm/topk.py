"""Exact top-k inner products over norm-sorted vectors.

The components become integers floor(scale * x), so every score is an exact
integer.  The search itself is pruned with floating-point bounds:

1. The second-moment matrix of all vectors (dim x dim, summed in Spark) gives
   the SVD basis; turned into it, most of a vector's length lies in its first
   components.
2. The vectors are dealt to range partitions by descending length.  The
   longest `SEEDS` give each query a first lower bound for its k-th score.
3. A task walks its vectors in descending length, a chunk at a time.  A query
   drops out of the partition as soon as |q| |x| cannot reach its bound; for
   the others the partial sum over the leading rotated components plus the
   Cauchy-Schwarz bound of the rest, |q_rest| |x_rest|, decides which pairs
   get their exact score.  The bounds are raised chunk by chunk.
4. The best k of all partitions are merged per query.

Queries go out in blocks of `QUERY_BLOCK`, a pass over the vectors each.

Vectors that are null, or hold a null or a component that is not finite, take
no part.  A component or score that does not fit into 64 bits is an error, as
in SQL.  Shorter vectors count as padded with zeros.  Equal query rows are
answered once; as candidates, repeated rows count each.  A query's own row is
every row with its id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ingot.llm.common import col, stable

SEEDS = 2048
QUERY_BLOCK = 4096
CHUNK = 1024
#: Share of the squared length that the leading components must hold.
LEADING = 0.8
#: Slack of the floating-point bounds, relative to |q| |x|.
SLACK = 1e-9


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """`id`, `v` (array of bigint) and `sq` (squared length) of the usable rows."""
    x = col(vec_col).cast("array<double>")
    usable = x.isNotNull() & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    fits = lambda e: F.abs(e * F.lit(float(scale))) < 2.0**63
    v = F.transform(x, lambda e: F.when(fits(e), F.floor(e * F.lit(float(scale)))).otherwise(F.raise_error(F.lit("vector component beyond 64 bits"))).cast("long"))
    out = vectors.where(usable & col(id_col).isNotNull()).select(col(id_col).cast("long").alias("id"), v.alias("v"))
    return out.withColumn("sq", F.aggregate("v", F.lit(0.0), lambda s, e: s + e.cast("double") * e.cast("double")))


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    """Integer rows of a list column, padded with zeros to `dim`."""
    n, values = np.diff(column.offsets.to_numpy()), column.values.to_numpy(zero_copy_only=False)[column.offsets[0].as_py() : column.offsets[-1].as_py()]
    if len(n) and (n == dim).all():
        return values.reshape(-1, dim)
    out = np.zeros((len(n), dim), np.int64)
    out[np.repeat(np.arange(len(n)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] = values
    return out


def rotation(rows: DataFrame, dim: int) -> tuple[np.ndarray, int]:
    """SVD basis of the vectors (columns, strongest first) and the number of
    leading components that hold `LEADING` of all squared length."""

    def run(batches):
        total = np.zeros((dim, dim))
        for b in batches:
            m = _matrix(b.column(0), dim).astype(np.float64)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(dim), dim), pa.int32()), pa.array(np.tile(np.arange(dim), dim), pa.int32()), pa.array(total.ravel())], names=["i", "j", "s"])

    sums = rows.select("v").mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).toPandas()
    moment = np.zeros((dim, dim))
    moment[sums["i"], sums["j"]] = sums["s"]
    values, basis = np.linalg.eigh((moment + moment.T) / 2)
    values, basis = np.maximum(values[::-1], 0), basis[:, ::-1]
    share = np.cumsum(values) / max(values.sum(), 1e-300)
    return np.ascontiguousarray(basis), int(min(dim, np.searchsorted(share, LEADING) + 1))


class _Best:
    """The k best (score, id) of every query so far."""

    def __init__(self, n: int, k: int):
        self.k, self.n = k, n
        self.q, self.id, self.score = (np.empty(0, np.int64) for _ in range(3))
        self.bound = np.full(n, -np.inf)

    def add(self, q: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        q, ids, score = np.r_[self.q, q], np.r_[self.id, ids], np.r_[self.score, score]
        order = np.lexsort((ids, -score, q))
        q, ids, score = q[order], ids[order], score[order]
        first = np.searchsorted(q, np.arange(self.n))
        rank = np.arange(len(q)) - first[q]
        keep = rank < self.k
        self.q, self.id, self.score = q[keep], ids[keep], score[keep]
        last = rank == self.k - 1
        self.bound[q[last]] = np.maximum(self.bound[q[last]], score[last])


def _search(best: _Best, ids: np.ndarray, x: np.ndarray, qids: np.ndarray, q: np.ndarray, basis: np.ndarray, lead: int) -> None:
    """Feed the vectors `x`, of descending length, to `best`."""
    turned, qt = x @ basis, q @ basis
    length, qlength = np.sqrt((x.astype(np.float64) ** 2).sum(1)), np.sqrt((q.astype(np.float64) ** 2).sum(1))
    rest, qrest = np.sqrt((turned[:, lead:] ** 2).sum(1)), np.sqrt((qt[:, lead:] ** 2).sum(1))
    live = np.arange(len(q))
    for at in range(0, len(x), CHUNK):
        to = slice(at, at + CHUNK)
        live = live[qlength[live] * length[at] * (1 + SLACK) + 1e-6 >= best.bound[live]]
        if not len(live):
            return
        upper = turned[to, :lead] @ qt[live, :lead].T
        upper += np.outer(rest[to], qrest[live])
        upper += np.outer(length[to], qlength[live]) * SLACK + 1e-6
        i, j = np.nonzero(upper >= best.bound[live])
        j = live[j]
        other = ids[to][i] != qids[j]
        i, j = i[other], j[other]
        for part in range(0, len(i), 1 << 18):
            pi, pj = i[part : part + (1 << 18)], j[part : part + (1 << 18)]
            best.add(pj, ids[to][pi], _scores(x[to][pi], q[pj], length[at] * qlength.max()))


def _scores(x: np.ndarray, q: np.ndarray, most: float) -> np.ndarray:
    """Inner products of the rows, none longer than `most`."""
    if most >= 2.0**62:  # sums modulo 2**64 are right where the result fits
        rough = np.einsum("ij,ij->i", x.astype(np.float64), q.astype(np.float64))
        error = 1e-12 * np.sqrt((x.astype(np.float64) ** 2).sum(1) * (q.astype(np.float64) ** 2).sum(1))
        for i in np.flatnonzero(np.abs(rough) + error >= 2.0**63):
            if not -(2**63) < sum(a * b for a, b in zip(x[i].tolist(), q[i].tolist())) < 2**63:
                raise OverflowError("score beyond 64 bits")
    return np.einsum("ij,ij->i", x, q)


def _partition_best(sent, lead: int, k: int, dim: int):
    """mapInArrow function: the best of one partition for a block of queries."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        qids, q, basis, (seed_ids, seed_x) = sent.value
        start = _Best(len(q), k)  # only its bounds count: the seeds are met again in their partition
        _search(start, seed_ids, seed_x, qids, q, basis, lead)
        best = _Best(len(q), k)
        best.bound = start.bound
        for b in batches:
            if b.num_rows:
                _search(best, b.column(0).to_numpy(), _matrix(b.column(1), dim), qids, q, basis, lead)
        yield pa.RecordBatch.from_arrays([pa.array(qids[best.q]), pa.array(best.q, pa.int64()), pa.array(best.id, pa.int64()), pa.array(best.score, pa.int64())], names=["query_id", "q", "vec_id", "score"])

    return run


def _numpy(df: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and matrix of a bounded set of rows, at the driver."""
    pdf: pd.DataFrame = df.select("id", "v").toPandas()
    out = np.zeros((len(pdf), dim), np.int64)
    for i, v in enumerate(pdf["v"]):
        out[i, : len(v)] = v
    return pdf["id"].to_numpy(np.int64), out


def top_k(vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256) -> DataFrame:
    """`query_id`, `rank` (from 1), `vec_id`, `score`: for every row that
    satisfies `queries` (a condition on `id`) its `k` best other rows, ties to
    the smaller id."""
    spark = vectors.sparkSession
    rows = stable(integer_vectors(vectors, id_col, vec_col, scale))
    asked = stable(rows.where(queries).select("id", "v").distinct())
    n, dim = asked.count(), rows.agg(F.coalesce(F.max(F.size("v")), F.lit(0))).first()[0]
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not n:
        return empty
    dim = max(dim, 1)
    basis, lead = rotation(rows, dim)
    seeds = _numpy(rows.orderBy(F.desc("sq"), "id").limit(SEEDS), dim)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(partitions, F.desc("sq"), "id").sortWithinPartitions(F.desc("sq"), "id").select("id", "v")
    blocks = -(-n // QUERY_BLOCK)
    if blocks > 1:  # deal and sort once for all passes
        ordered = stable(ordered)
    found = []
    for b in range(blocks):
        part = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("id", "v"), F.lit(blocks)) == b)
        qids, q = _numpy(part, dim)
        if len(q):
            sent = spark.sparkContext.broadcast((qids, q, basis, seeds))
            best = ordered.mapInArrow(_partition_best(sent, lead, k, dim), "query_id long, q long, vec_id long, score long")
            # the answers are written, so that a block's queries leave the driver and the executors with it
            found.append(stable(_merged(best, k)))
            sent.destroy()
    return reduce(DataFrame.unionByName, found)


def _merged(best: DataFrame, k: int) -> DataFrame:
    """The k best of each query, of which at most k rows of each partition meet."""
    order = F.struct((-F.col("score")).alias("s"), F.col("vec_id").alias("vec_id"))
    merged = best.groupBy("query_id", "q").agg(F.slice(F.array_sort(F.collect_list(order)), 1, k).alias("top"))
    return merged.select("query_id", F.posexplode("top").alias("p", "t")).select("query_id", (F.col("p") + 1).cast("int").alias("rank"), "t.vec_id", (-F.col("t.s")).alias("score"))
