"""Alignment of two tokenizers by inverted pair bitmaps.

Both tokenizers encode every whole text.  Byte offsets where tokens of both end
cut the text into groups, and each token of one that shares a group with a
token of the other is linked to it.

1. Documents are numbered within containers of at most `CONTAINER` documents of
   one input partition.  For every pair of ids that is linked in a container
   there is a bitmap of the documents that hold it, and planes of its
   multiplicity (plane j: bit j of the number of links less one).  A bitmap is
   a sorted array of 16-bit numbers, or 65,536 bits if more than `SPARSE` are
   set.  A task writes its bitmaps out in parts of about `PART_ENTRIES` bits,
   packed by bucket of the first id.
2. The parts of a bucket and container meet in one task, which merges the
   bitmaps of a pair by OR and counts their bits: the documents that hold the
   pair, and, by planes, its links.  The counts add up over all containers, and
   give each first id its highest.
3. The counts of a bucket go to its bitmaps, which return them as scores to the
   documents they hold, plane by plane.  A document's scores are summed over
   the buckets.

What meets in one task is bounded by the size of a container or by the two
vocabularies, not by the corpus: a pair that every document holds has a bitmap
in every container.  Buckets are spread over tasks by container, too.

Texts that are null or empty, or which one of the tokenizers does not give back
byte by byte, have no tokens: zeros and an empty digest.  Repeated rows are
documents of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot.llm.common import col, field, spread, stable, texts

#: Documents of a container (numbers of 16 bits), and bits beyond which a
#: bitmap is stored as bits.
CONTAINER = 1 << 16
SPARSE = 4096
#: Entries (pair and document) after which a task writes its bitmaps.
PART_ENTRIES = 1_000_000
#: Characters encoded at a time (a longer text alone).
BATCH_CHARS = 500_000
#: Links of a group beyond which equal ids are counted before they are paired.
LARGE_GROUP = 4096
#: Containers of a bucket that one task scores.
CONTAINERS_A_TASK = 64
#: Characters on whose classes every Unicode version agrees.
_PLAIN = re.compile("[^\t\n\r -~¡-ɏ]")


# --- tokens -----------------------------------------------------------------------

def _byte_letters() -> dict[str, int]:
    """The byte that each printable letter of byte-level vocabularies stands for."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return {(chr(b) if b in set(own) else chr(next(rest))): b for b in range(256)}


class TokenBytes:
    """Bytes of every id, one after the other."""

    def __init__(self, table: list[bytes]):
        self.n = np.fromiter(map(len, table), np.int64, len(table))
        self.first = np.cumsum(self.n) - self.n
        self.data = np.frombuffer(b"".join(table), np.uint8)

    def join(self, ids: np.ndarray) -> bytes:
        return self.data[spread(self.first[ids], self.n[ids])].tobytes()


def _ranked(path: str, table: list[bytes]):
    """The vocabulary of a byte-level tokenizer file as ranks, for a faster
    library that merges by rank; None unless its merges make the ids in
    ascending order, which is when both encode alike."""
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        described = json.load(f)
    model, pre = described["model"], described.get("pre_tokenizer") or {}
    own = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [model["vocab"].get(a + b, -1) for a, b in own]
    alike = made == list(range(256, 256 + len(made))) and described.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    ranks = {t: i for i, t in enumerate(table[: 256 + len(made)])}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}) if alike else None


class Aligner:
    """Both tokenizers of a worker: A byte-level, B with pieces and byte fallback."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a, self.b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True  # their strings in a text are then ordinary text
        letters, size = _byte_letters(), self.a.get_vocab_size()
        a_table = [b""] * size
        for token, i in self.a.get_vocab().items():
            a_table[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        b_table = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.fast = _ranked(a_path, a_table)
        self.size_a, self.size_b = len(a_table), len(b_table)
        self.a_bytes, self.b_bytes = TokenBytes(a_table), TokenBytes(b_table)
        # decimal ids with what follows them: (a "," or "|" behind) then (b "," or ";" behind)
        self.names = [f"{i}{s}".encode() for i in range(self.size_a) for s in ",|"] + [f"{i}{s}".encode() for i in range(self.size_b) for s in ",;"]

    def encode_a(self, text: str) -> list[int]:
        """Ids of A of a text as it is."""
        if self.fast is not None and not _PLAIN.search(text):
            return self.fast.encode_ordinary(text)
        return self.a.encode(text, add_special_tokens=False).ids

    def encode(self, text: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of A and B of each text; None if it has no tokens."""
        full = [i for i, t in enumerate(text) if t]
        a = [self.encode_a(" " + text[i]) for i in full]
        b = self.b.encode([text[i] for i in full], num_threads=1)
        out: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(text)
        for i, x, y in zip(full, a, b):
            x, y, want = np.array(x, np.int64), np.array(y, np.int64), b" " + text[i].encode()
            if self.a_bytes.n[x].sum() == self.b_bytes.n[y].sum() == len(want) and self.a_bytes.join(x) == want == self.b_bytes.join(y):
                out[i] = x, y
        return out

    def align(self, coded: list[tuple[np.ndarray, np.ndarray]]) -> Alignment:
        return Alignment(self, coded)


class Alignment:
    """Groups and links of texts with tokens, all texts in one go."""

    def __init__(self, of: Aligner, coded: list[tuple[np.ndarray, np.ndarray]]):
        none = np.empty(0, np.int64)
        self.of, self.n = of, len(coded)
        self.a, self.b = np.concatenate([none, *[x for x, _ in coded]]), np.concatenate([none, *[y for _, y in coded]])
        self.n_a, self.n_b = np.array([len(x) for x, _ in coded], np.int64), np.array([len(y) for _, y in coded], np.int64)
        a_end, b_end = np.cumsum(of.a_bytes.n[self.a]), np.cumsum(of.b_bytes.n[self.b])
        common = np.intersect1d(a_end, b_end, assume_unique=True)
        self.a_group, self.b_group = np.searchsorted(common, a_end), np.searchsorted(common, b_end)
        self.group_a, self.group_b = np.bincount(self.a_group, minlength=len(common)), np.bincount(self.b_group, minlength=len(common))
        last = np.cumsum(self.n_a)[self.n_a > 0] - 1  # the last token of a text ends its last group
        ends = np.zeros(self.n, np.int64)
        ends[self.n_a > 0] = self.a_group[last] + 1
        self.groups_to = np.maximum.accumulate(ends) if self.n else ends
        self.n_groups = np.diff(self.groups_to, prepend=0)
        self.text = np.repeat(np.arange(self.n), self.n_groups)  # of each group
        links = self.group_a * self.group_b
        self.n_links = np.array([x.sum() for x in np.split(links, self.groups_to[:-1])], np.int64) if self.n else none

    def digests(self) -> list[str]:
        """SHA-256 of the groups of each text."""
        a_before, b_before = np.cumsum(self.group_a) - self.group_a, np.cumsum(self.group_b) - self.group_b
        i, j = np.arange(len(self.a)), np.arange(len(self.b))
        code = np.empty(len(i) + len(j), np.int64)
        code[i + b_before[self.a_group]] = 2 * self.a + (np.diff(self.a_group, append=-1) != 0)
        code[j + (a_before + self.group_a)[self.b_group]] = 2 * (self.of.size_a + self.b) + (np.diff(self.b_group, append=-1) != 0)
        ends, names = np.cumsum(self.n_a + self.n_b).tolist(), self.of.names
        return [hashlib.sha256(b"".join([names[c] for c in code[s:e].tolist()])[:-1]).hexdigest() for s, e in zip([0, *ends], ends)]

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pair, text, links) of every pair in every text, in this order;
        a pair is a * size of B + b."""
        size, first = self.of.size_b, np.cumsum(self.group_b) - self.group_b
        large = self.group_a * self.group_b > LARGE_GROUP
        take = np.flatnonzero(~large[self.a_group])
        g = self.a_group[take]
        pair = np.repeat(self.a[take], self.group_b[g]) * size + self.b[spread(first[g], self.group_b[g])]
        text, weight = np.repeat(self.text[g], self.group_b[g]), None
        if large.any():
            more, start = [], np.cumsum(self.group_a) - self.group_a
            for g in np.flatnonzero(large):
                x, n_x = np.unique(self.a[start[g] : start[g] + self.group_a[g]], return_counts=True)
                y, n_y = np.unique(self.b[first[g] : first[g] + self.group_b[g]], return_counts=True)
                more.append(((x[:, None] * size + y).ravel(), np.full(len(x) * len(y), self.text[g]), (n_x[:, None] * n_y).ravel()))
            weight = np.concatenate([np.ones(len(pair), np.int64), *[m[2] for m in more]])
            pair, text = np.concatenate([pair, *[m[0] for m in more]]), np.concatenate([text, *[m[1] for m in more]])
        return _summed(pair, text, weight)


def _summed(pair: np.ndarray, place: np.ndarray, weight: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries sorted by pair and place, the weights (or repeats) of equal ones added."""
    key = pair << 16 | place
    if weight is None:
        key, weight = np.unique(key, return_counts=True)
    else:
        order = np.argsort(key, kind="stable")
        key, weight = key[order], weight[order]
        heads = np.flatnonzero(np.diff(key, prepend=-1))
        key, weight = key[heads], np.add.reduceat(weight, heads) if len(heads) else weight
    return key >> 16, key & 0xFFFF, weight


# --- bitmaps -------------------------------------------------------------------------

class Bitmaps:
    """For sorted pairs the bitmap of their documents and planes of their
    multiplicity: `planes[0]` the documents, `planes[1 + j]` those with bit j of
    links - 1.  A plane is (places of the pairs, 16-bit numbers) of the sparse
    bitmaps and {place: bits} of the dense ones."""

    def __init__(self, pairs: np.ndarray, planes: list[tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]]):
        self.pairs, self.planes = pairs, planes

    @staticmethod
    def _plane(at: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]:
        dense = {}
        for k in np.flatnonzero(np.bincount(at, minlength=n) > SPARSE).tolist():
            bits = np.zeros(CONTAINER, bool)
            bits[doc[np.searchsorted(at, k) : np.searchsorted(at, k, "right")]] = True
            dense[k] = np.packbits(bits)
        keep = ~np.isin(at, list(dense)) if dense else slice(None)
        return at[keep], doc[keep].astype(np.uint16), dense

    @classmethod
    def of(cls, pair: np.ndarray, doc: np.ndarray, links: np.ndarray) -> Bitmaps:
        """From sorted entries."""
        heads = np.diff(pair, prepend=-1) != 0
        pairs, at, planes = pair[heads], np.cumsum(heads) - 1, []
        planes.append(cls._plane(at, doc, len(pairs)))
        for j in range(int(links.max(initial=1) - 1).bit_length()):
            has = (links - 1) >> j & 1 == 1
            planes.append(cls._plane(at[has], doc[has], len(pairs)))
        return cls(pairs, planes)

    @classmethod
    def merged(cls, parts: list[Bitmaps]) -> Bitmaps:
        """OR of the bitmaps of equal pairs, plane by plane.  Each document is
        in one part, so OR is right for the multiplicities, too."""
        if len(parts) == 1:
            return parts[0]
        pairs, planes = np.unique(np.concatenate([p.pairs for p in parts])), []
        places = [np.searchsorted(pairs, p.pairs) for p in parts]
        for j in range(max(len(p.planes) for p in parts)):
            own = [(place, p.planes[j]) for place, p in zip(places, parts) if j < len(p.planes)]
            keys = np.unique(np.concatenate([place[at].astype(np.int64) << 16 | doc for place, (at, doc, _) in own]))
            at, doc, dense = cls._plane(keys >> 16, keys & 0xFFFF, len(pairs))
            for place, (_, _, more) in own:
                for k, bits in more.items():
                    k = int(place[k])
                    if k not in dense:
                        here = slice(np.searchsorted(at, k), np.searchsorted(at, k, "right"))
                        new = np.zeros(CONTAINER, bool)
                        new[doc[here]] = True
                        dense[k], at, doc = np.packbits(new), np.delete(at, here), np.delete(doc, here)
                    dense[k] = dense[k] | bits
            planes.append((at, doc, dense))
        return cls(pairs, planes)

    def popcounts(self, j: int) -> np.ndarray:
        """Set bits of each pair in plane `j`."""
        at, _, dense = self.planes[j]
        n = np.bincount(at, minlength=len(self.pairs))
        for k, bits in dense.items():
            n[k] = int(np.bitwise_count(bits).sum())
        return n

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Documents and links of each pair."""
        docs = self.popcounts(0)
        return docs, docs + sum((self.popcounts(j) << (j - 1) for j in range(1, len(self.planes))), np.zeros(len(docs), np.int64))

    def add_scores(self, score: np.ndarray, best: np.ndarray, total: np.ndarray, n_best: np.ndarray) -> None:
        """Adds to each document `score` of its links (`total`) and the links
        of the pairs marked `best` (`n_best`)."""
        for j, (at, doc, dense) in enumerate(self.planes):
            shift = max(0, j - 1)
            np.add.at(total, doc, score[at] << shift)
            np.add.at(n_best, doc[best[at]], 1 << shift)
            for k, bits in dense.items():
                where = np.flatnonzero(np.unpackbits(bits))
                total[where] += score[k] << shift
                n_best[where] += int(best[k]) << shift

    # --- packed ---

    def pack(self) -> bytes:
        head = [len(self.pairs), len(self.planes)]
        body = [np.diff(self.pairs, prepend=0).astype("<i8")]
        for at, doc, dense in self.planes:
            head += [len(at), len(dense)]
            body += [np.bincount(at, minlength=len(self.pairs)).astype("<u2"), doc.astype("<u2"), np.array(sorted(dense), "<u4"), *[dense[k] for k in sorted(dense)]]
        return zstandard.compress(np.array(head, "<u4").tobytes() + b"".join(x.tobytes() for x in body), 1)

    @classmethod
    def unpack(cls, data: bytes) -> Bitmaps:
        data, at = zstandard.decompress(data), 0

        def read(kind: str, n: int) -> np.ndarray:
            nonlocal at
            at += n * np.dtype(kind).itemsize
            return np.frombuffer(data, kind, n, at - n * np.dtype(kind).itemsize)

        n, n_planes = read("<u4", 2).tolist()
        sizes = read("<u4", 2 * n_planes).reshape(-1, 2).tolist()
        pairs, planes = np.cumsum(read("<i8", n)), []
        for n_sparse, n_dense in sizes:
            places, doc, keys = np.repeat(np.arange(n), read("<u2", n)), read("<u2", n_sparse), read("<u4", n_dense).tolist()
            planes.append((places, doc, {k: read("u1", CONTAINER // 8) for k in keys}))
        return cls(pairs, planes)


# --- 1: containers ---------------------------------------------------------------------

def _stored(id_type: T.DataType) -> T.StructType:
    longs = [T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")]
    return T.StructType([T.StructField("container", T.LongType()), T.StructField("place", T.IntegerType()), T.StructField("id", id_type), *longs,
                         T.StructField("digest", T.StringType()), T.StructField("bucket", T.IntegerType()), T.StructField("data", T.BinaryType())])


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """This worker's tokenizers."""
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


def _stretches(batches) -> Iterator[tuple[pa.Array, list[str]]]:
    """Ids and texts, about `BATCH_CHARS` characters at a time."""
    for b in batches:
        start, waiting, size = 0, [], 0
        for i, t in enumerate(texts(b.column(1))):
            if waiting and size + len(t or "") > BATCH_CHARS:
                yield b.column(0).slice(start, i - start), waiting
                start, waiting, size = i, [], 0
            waiting.append(t or "")
            size += len(waiting[-1])
        if waiting:
            yield b.column(0).slice(start), waiting


def _containers(a_path: str, b_path: str, buckets: int, schema: pa.Schema):
    """A row for each document, and one for each part of a bucket's bitmaps."""

    def run(batches):
        from pyspark import TaskContext

        tools = aligner(a_path, b_path)
        container, used, waiting, size = TaskContext.get().partitionId() << 20, 0, [], 0

        def rows(**columns):
            n = len(next(iter(columns.values())))
            return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

        def part():
            pair, place, links = (np.concatenate([w[k] for w in waiting]) for k in range(3))
            bucket = pair // tools.size_b % buckets
            order = np.lexsort((place, pair, bucket))
            pair, place, links, bucket = pair[order], place[order], links[order], bucket[order]
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=buckets)).tolist()
            for s, e in zip(cuts, cuts[1:]):
                yield rows(container=[container], bucket=[int(bucket[s])], data=[Bitmaps.of(pair[s:e], place[s:e], links[s:e]).pack()])

        for ids, found in _stretches(batches):
            for at in range(0, len(found), CONTAINER):  # a stretch of empty texts may be long
                text = found[at : at + CONTAINER]
                if used + len(text) > CONTAINER:
                    if waiting:
                        yield from part()
                    container, used, waiting, size = container + 1, 0, [], 0
                coded = tools.encode(text)
                whole = [i for i, c in enumerate(coded) if c is not None]
                numbers, digest = np.zeros((4, len(text)), np.int64), [""] * len(text)
                if whole:
                    got = tools.align([coded[i] for i in whole])
                    numbers[:, whole] = got.n_a, got.n_b, got.n_groups, got.n_links
                    for i, d in zip(whole, got.digests()):
                        digest[i] = d
                    pair, where, links = got.entries()
                    waiting.append((pair, used + np.array(whole, np.int64)[where], links))
                    size += len(pair)
                yield rows(container=[container] * len(text), place=range(used, used + len(text)), id=ids.slice(at, len(text)), n_a=numbers[0], n_b=numbers[1], n_groups=numbers[2], n_links=numbers[3], digest=digest)
                used += len(text)
                if size > PART_ENTRIES:
                    yield from part()
                    waiting, size = [], 0
        if waiting:
            yield from part()

    return run


# --- 2: merged bitmaps and counts ----------------------------------------------------------

_MERGED = T.StructType([
    T.StructField("bucket", T.IntegerType()), T.StructField("container", T.LongType()), T.StructField("data", T.BinaryType()),
    *[T.StructField(c, T.ArrayType(T.LongType())) for c in ("pairs", "docs", "links")],
])


def _merge(batches):
    """Input sorted by bucket and container."""
    schema, now, parts = _arrow(_MERGED), None, []

    def row():
        whole = Bitmaps.merged(parts)
        docs, links = whole.counts()
        return pa.RecordBatch.from_pylist([{"bucket": now[0], "container": now[1], "data": whole.pack(), "pairs": whole.pairs, "docs": docs, "links": links}], schema)

    for b in batches:
        for bucket, container, data in zip(*(b.column(i).to_pylist() for i in range(2)), b.column(2)):
            if (bucket, container) != now:
                if parts:
                    yield row()
                now, parts = (bucket, container), []
            parts.append(Bitmaps.unpack(data.as_py()))
    if parts:
        yield row()


def _pair_counts(merged: DataFrame, size_b: int) -> DataFrame:
    """`bucket`, `pair`, `a`, `docs`, `links`, `best` of every pair of the corpus."""
    each = merged.select("bucket", F.explode(F.arrays_zip("pairs", "docs", "links")).alias("x"))
    counts = each.groupBy("bucket", F.col("x.pairs").alias("pair")).agg(F.sum("x.docs").alias("docs"), F.sum("x.links").alias("links"))
    counts = counts.withColumn("a", F.expr(f"pair div {size_b}"))
    # the partners of an id are at most the other vocabulary
    return counts.withColumn("best", F.col("docs") == F.max("docs").over(Window.partitionBy("bucket", "a")))


# --- 3: scores ------------------------------------------------------------------------------

def _scores(batches):
    """Input by bucket and salt, the counts of the bucket first; per bitmap
    row the packed scores of its documents."""
    schema = pa.schema([("container", pa.int64()), ("data", pa.binary())])
    pairs = docs = best = None
    for b in batches:
        for i in range(b.num_rows):
            r = b.slice(i, 1)
            values = {n: r.column(n)[0] for n in ("container", "data", "pairs", "docs", "best")}
            if not values["data"].is_valid:
                pairs, docs, best = (values[n].values.to_numpy(zero_copy_only=False) for n in ("pairs", "docs", "best"))
                continue
            maps = Bitmaps.unpack(values["data"].as_py())
            at = np.searchsorted(pairs, maps.pairs)
            total, n_best = np.zeros(CONTAINER, np.int64), np.zeros(CONTAINER, np.int64)
            maps.add_scores(docs[at], best[at], total, n_best)
            where = np.flatnonzero(total)
            data = zstandard.compress(where.astype("<u2").tobytes() + total[where].tobytes() + n_best[where].tobytes(), 1)
            yield pa.RecordBatch.from_arrays([pa.array([values["container"].as_py()], pa.int64()), pa.array([data], pa.binary())], schema=schema)


def _sum_scores(batches):
    """Input sorted by container; a row for each document with links."""
    schema = pa.schema([("container", pa.int64()), ("place", pa.int32()), ("n_best", pa.int64()), ("count_sum", pa.int64())])
    now, total, n_best = None, None, None

    def done():
        where = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(where), now)), pa.array(where.astype(np.int32)), pa.array(n_best[where]), pa.array(total[where])], schema=schema)

    for b in batches:
        for container, data in zip(b.column(0).to_pylist(), b.column(1)):
            if container != now:
                if now is not None:
                    yield done()
                now, total, n_best = container, np.zeros(CONTAINER, np.int64), np.zeros(CONTAINER, np.int64)
            raw = zstandard.decompress(data.as_py())
            n = len(raw) // 18
            where = np.frombuffer(raw, "<u2", n)
            total[where] += np.frombuffer(raw, np.int64, n, 2 * n) if n % 4 == 0 else np.frombuffer(raw[2 * n : 10 * n], np.int64)
            n_best[where] += np.frombuffer(raw[10 * n :], np.int64)
    if now is not None:
        yield done()


# --- the operator -------------------------------------------------------------------------------

class Aligned:
    """Stored links of all documents of a table under two tokenizers."""

    def __init__(self, docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"):
        self.spark = docs.sparkSession
        self.n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.size_b = aligner(a_path, b_path).size_b
        schema = _stored(field(docs, id_col).dataType)
        rows = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
        stored = stable(rows.mapInArrow(_containers(a_path, b_path, self.n, _arrow(schema)), schema))
        self.documents = stored.where("place IS NOT NULL").drop("bucket", "data")
        parts = stored.where("bucket IS NOT NULL").select("bucket", "container", "data")
        self.bitmaps = stable(parts.repartition(self.n, "bucket", "container").sortWithinPartitions("bucket", "container").mapInArrow(_merge, _MERGED))
        self._counts = _pair_counts(self.bitmaps, self.size_b)

    def pairs(self) -> DataFrame:
        """`a`, `b`, `docs`, `links`, `best` (no partner of `a` has more
        documents) of every pair of ids."""
        return self._counts.select("a", F.expr(f"pair % {self.size_b}").alias("b"), "docs", "links", "best")

    def scores(self) -> DataFrame:
        """`container`, `place`, `n_best`, `count_sum` of the documents with links."""
        salts = -(-self.bitmaps.select("container").distinct().count() // CONTAINERS_A_TASK) or 1
        none = lambda kind: F.lit(None).cast(kind)
        maps = self.bitmaps.select("bucket", F.pmod(F.xxhash64("container"), F.lit(salts)).cast("int").alias("salt"), "container", "data",
                                   none("array<long>").alias("pairs"), none("array<long>").alias("docs"), none("array<boolean>").alias("best"))
        listed = self._counts.groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("pair", "docs", "best"))).alias("x"))
        counts = listed.select("bucket", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), none("long").alias("container"), none("binary").alias("data"),
                               F.col("x.pair").alias("pairs"), F.col("x.docs").alias("docs"), F.col("x.best").alias("best"))
        both = maps.unionByName(counts).repartition(self.n, "bucket", "salt").sortWithinPartitions("bucket", "salt", F.col("data").isNotNull())
        parts = both.mapInArrow(_scores, "container long, data binary")
        return parts.repartition(self.n, "container").sortWithinPartitions("container").mapInArrow(_sum_scores, "container long, place int, n_best long, count_sum long")

    def result(self) -> DataFrame:
        """Per document `doc_id`, `n_a`, `n_b`, `n_groups`, `n_links`, `n_best`,
        `count_sum` and `groups_sha256`."""
        found = self.documents.join(self.scores(), ["container", "place"], "left")
        zero: list[Column] = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
        return found.select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", *zero, F.col("digest").alias("groups_sha256"))
