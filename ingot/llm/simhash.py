"""SimHash near-duplicates by a binary-trie self-join.

1. `fingerprints`: one 64-bit SimHash per document, over the whole text.
2. `trie_links`: the distinct fingerprints form a binary trie.  The join walks
   pairs of trie nodes together, adds up the bits in which their paths differ
   and drops a pair as soon as the sum exceeds the error budget.  Spark walks
   the upper levels: a frontier row says "this fingerprint lies below one node
   of the pair, and the paths so far differ in `diff` bits"; nodes that hold
   too many rows are taken further down until each fits a task.  A task then
   walks the rest of its node pairs in numpy and returns a spanning forest of
   the links, never all pairs.
3. `components`: alternating large-star / small-star steps over those links.

A null text or one without words has fingerprint zero and is linked like any
other.  Equal fingerprints are one trie leaf, so copies cost nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot.llm.common import col, field, row_hash, stable, text_bytes

BITS = 64
#: Fingerprints below one trie node, on average, when the walk starts.
LEAF_FINGERPRINTS = 16_384
#: Frontier rows of one node that a task may take; larger nodes are split.
NODE_ROWS = 1_000_000
#: Bits by which an oversized node is split at a time.
STRIDE = 4
#: Node pairs a task expands at a time.
CHUNK_PAIRS = 200_000


# --- fingerprints -------------------------------------------------------------

def simhash(text: bytes | None, shingle: int, seed: int) -> int:
    """SimHash of a UTF-8 text: words between ASCII white space, A-Z lowered,
    `shingle` words a shingle (repeats count), XXH64 of each."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    h = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return h(b" ".join(words), seed)
    joined = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
    n = len(words) - shingle + 1
    hashes = np.fromiter((h(s, seed) for s in joined), dtype="<u8", count=n)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, 65_536):
        part = hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """`doc_id`, `row_hash` (of the whole row) and `fp` (signed 64 bits) per row."""

    def run(batches):
        for b in batches:
            fps = np.fromiter((simhash(t, shingle, seed) for t in text_bytes(b.column(2))), dtype=np.uint64, count=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], names=["doc_id", "row_hash", "fp"])

    schema = T.StructType([field(docs, id_col, "doc_id"), T.StructField("row_hash", T.LongType()), T.StructField("fp", T.LongType())])
    return docs.select(col(id_col).alias("doc_id"), row_hash(docs).alias("row_hash"), col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


# --- trie join -----------------------------------------------------------------

def _forest(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of `n` nodes under links (u, v)."""
    label = np.arange(n)
    while True:
        a, b = label[u], label[v]
        open_ = a != b
        if not open_.any():
            return label
        u, v, a, b = u[open_], v[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := label[label], label):
            label = up


def _middle(x: np.ndarray, lo: np.ndarray, depth: int) -> np.ndarray:
    """First index of `x` below the node's one-child, for nodes starting at `lo`."""
    high = ((1 << depth) - 1) << (BITS - depth)
    return np.searchsorted(x, (x[lo] & np.uint64(high)) | np.uint64(1 << (BITS - 1 - depth)))


def _walk(x, y, pairs, depth: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links (index in x, index in y) below the given node pairs.

    `pairs`: arrays (x_lo, x_hi, y_lo, y_hi, diff, same); a node is a range of
    the sorted fingerprints that share their first `depth` bits.
    """
    stack = [(depth, pairs)]
    while stack:
        depth, pairs = stack.pop()
        if len(pairs[0]) > CHUNK_PAIRS:
            half = len(pairs[0]) // 2
            stack += [(depth, [p[:half] for p in pairs]), (depth, [p[half:] for p in pairs])]
            continue
        xlo, xhi, ylo, yhi, diff, same = pairs
        few = ((xhi - xlo) * (yhi - ylo) <= 16) | (depth == BITS)
        if few.any():
            nx, ny = (xhi - xlo)[few], (yhi - ylo)[few]
            each = nx * ny
            at = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            wide = np.repeat(ny, each)
            i, j = np.repeat(xlo[few], each) + at // wide, np.repeat(ylo[few], each) + at % wide
            near = np.bitwise_count(x[i] ^ y[j]) <= budget
            near &= ~np.repeat(same[few], each) | (i < j)
            if near.any():
                yield i[near], j[near]
        rest = ~few
        if not rest.any():
            continue
        xlo, xhi, ylo, yhi, diff, same = (p[rest] for p in pairs)
        xm = np.clip(_middle(x, xlo, depth), xlo, xhi)
        ym = np.clip(_middle(y, ylo, depth), ylo, yhi)
        children = []
        for a0, a1, b0, b1, cost, keep in (
            (xlo, xm, ylo, ym, 0, None), (xm, xhi, ym, yhi, 0, None), (xlo, xm, ym, yhi, 1, None), (xm, xhi, ylo, ym, 1, ~same),
        ):
            ok = (a0 < a1) & (b0 < b1) & (diff + cost <= budget)
            if keep is not None:  # the mirror image of the third pair
                ok &= keep
            children.append((a0[ok], a1[ok], b0[ok], b1[ok], diff[ok] + cost, same[ok] if not cost else np.zeros(int(ok.sum()), bool)))
        nxt = [np.concatenate(c) for c in zip(*children)]
        if len(nxt[0]):
            stack.append((depth + 1, nxt))


def _links_below(home: np.ndarray, visitor: np.ndarray, vdiff: np.ndarray, depth: int, budget: int) -> np.ndarray:
    """Spanning-forest links among `home` and from it to `visitor` fingerprints."""
    home = np.sort(home)
    order = np.argsort(visitor)
    visitor, vdiff = visitor[order], vdiff[order]
    n, everything = len(home), np.concatenate([home, visitor])
    if not n:
        return np.empty((0, 2), np.uint64)
    one = lambda v, t=np.int64: np.array([v], t)
    runs = [_walk(home, home, [one(0), one(n), one(0), one(n), one(0), one(True, bool)], depth, budget)]
    if len(visitor):
        prefix = visitor >> np.uint64(BITS - depth)
        first = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]])
        last, m = np.r_[first[1:], len(visitor)], len(first)
        runs.append(((i, j + n) for i, j in _walk(home, visitor, [np.zeros(m, np.int64), np.full(m, n), first, last, vdiff[first].astype(np.int64), np.zeros(m, bool)], depth, budget)))
    label, us, vs, waiting = np.arange(len(everything)), [], [], 0
    for run in runs:
        for u, v in run:
            us.append(u)
            vs.append(v)
            waiting += len(u)
            if waiting > 1_000_000:  # keep the forest only
                label = _forest(len(label), np.concatenate([np.arange(len(label)), *us]), np.concatenate([label, *vs]))
                us, vs, waiting = [], [], 0
    label = _forest(len(label), np.concatenate([np.arange(len(label)), *us]), np.concatenate([label, *vs]))
    linked = np.flatnonzero(label != np.arange(len(label)))
    return np.stack([everything[linked], everything[label[linked]]], axis=1)


def _solve(budget: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        fp, home = pdf["fp"].to_numpy().view(np.uint64), pdf["home"].to_numpy()
        links = _links_below(fp[home], fp[~home], pdf["diff"].to_numpy()[~home], int(key[1]), budget).view(np.int64)
        return pd.DataFrame({"u": links[:, 0], "v": links[:, 1]})

    return run


def trie_links(fps: DataFrame, n: int, budget: int = 2, leaf: int = LEAF_FINGERPRINTS, node_rows: int = NODE_ROWS) -> DataFrame:
    """Links `u`, `v` that connect the distinct fingerprints `fp` whose
    Hamming distance is at most `budget`; `n` is their number."""
    depth = min(48, STRIDE * max(0, math.ceil(math.log2(max(n, 1) / leaf) / STRIDE)))
    masks = [0] + [1 << i for i in range(depth)] * (budget > 0) + [(1 << i) | (1 << j) for i in range(depth) for j in range(i)] * (budget > 1)
    if budget > 2:
        depth, masks = 0, [0]  # larger budgets start at the root and split on the way
    prefix = F.shiftrightunsigned("fp", BITS - depth) if depth else F.lit(0).cast("long")
    start = fps.select("fp", prefix.alias("own"), F.explode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("mask"))
    frontier = start.select(
        "fp", F.lit(depth).alias("depth"), F.col("own").bitwiseXOR(F.col("mask")).alias("node"), "own",
        F.bit_count("mask").cast("int").alias("diff"), (F.col("mask") == 0).alias("home"),
    ).where("home OR node < own").drop("own")
    links = None
    while True:
        sizes = frontier.groupBy("depth", "node").agg(F.count(F.lit(1)).alias("rows")).where((F.col("rows") > node_rows) & (F.col("depth") < BITS))
        large = stable(sizes.select("depth", "node"))
        any_large = not large.isEmpty()
        fits = frontier.join(large, ["depth", "node"], "left_anti") if any_large else frontier
        found = fits.groupBy("node", "depth").applyInPandas(_solve(budget), "u long, v long")
        links = found if links is None else links.unionByName(found)
        if not any_large:
            return links.distinct()
        frontier = stable(_split(frontier.join(large, ["depth", "node"], "left_semi"), budget))


def _split(rows: DataFrame, budget: int) -> DataFrame:
    """Frontier rows taken `STRIDE` bits further down, as pairs of children."""
    bits = F.expr(f"int(shiftrightunsigned(shiftleft(fp, depth), {BITS - STRIDE}))").alias("bits")
    children = F.explode(F.array(*[F.lit(c) for c in range(1 << STRIDE)])).alias("child")
    rows = rows.select("*", bits).select("*", children)
    extra = F.bit_count(F.col("bits").bitwiseXOR(F.col("child"))).cast("int")
    rows = rows.withColumn("total", F.col("diff") + extra).where(f"total <= {budget}").where("NOT home OR child <= bits")
    return rows.select(
        "fp", (F.col("depth") + STRIDE).alias("depth"), (F.shiftleft("node", STRIDE) + F.col("child")).alias("node"),
        F.col("total").alias("diff"), (F.col("home") & (F.col("child") == F.col("bits"))).alias("home"),
    )


# --- components -------------------------------------------------------------------

def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """`node`, `root` for every node of the links (u, v): the smallest node
    reachable.  Large-star and small-star steps until nothing changes; each
    round is written to the shared folder."""
    edges = stable(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    for _ in range(max_rounds):
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = stable(small.where("u <> v").distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


# --- the operator -------------------------------------------------------------------

def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, budget: int = 2, seed: int = 42,
                    leaf: int = LEAF_FINGERPRINTS, node_rows: int = NODE_ROWS) -> DataFrame:
    """Per input row: `doc_id`, `row_hash`, `fp`, `root` (the group's key) and
    `component_id`, the smallest doc_id reachable over links of at most
    `budget` differing bits (null only if the whole group has null ids).

    Repeated rows stay repeated; other columns are ignored; an empty table
    gives an empty result.
    """
    marked = stable(fingerprints(docs, id_col, text_col, shingle, seed))
    fps = stable(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(trie_links(fps.select("fp"), fps.count(), budget, leaf, node_rows))
    rooted = fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    groups = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    rooted = stable(rooted.join(groups, "root").select("fp", "root", "component_id"))
    return marked.join(rooted, "fp").select("doc_id", "row_hash", "fp", "root", "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """`docs` with one row of each near-duplicate group: the smallest id's
    (null ids last; equal ids by row hash; wholly equal rows count once)."""
    found = near_duplicates(docs, id_col, text_col, **options)
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("doc_id"), F.col("row_hash").alias("row_hash"))
    keep = found.groupBy("root").agg(F.min(order).alias("k")).select(F.concat_ws(":", "k.row_hash", "k.doc_id").alias("_kept"))
    # one key for the join and for wholly equal rows: the texts are shuffled once
    key = F.concat_ws(":", row_hash(docs), col(id_col))
    rows = docs.select(F.struct(*[col(c).alias(c) for c in docs.columns]).alias("_row"), key.alias("_key"))
    return rows.join(keep, rows["_key"] == keep["_kept"], "left_semi").dropDuplicates(["_key"]).select("_row.*")
