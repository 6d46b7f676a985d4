"""Byte-level BPE encoding and decoding by a shuffle of distinct words.

Encoding explodes every text into pre-tokens with their positions, encodes
each distinct pre-token once, joins the ids back and reassembles the texts by
position:

1. A block of whole documents (about `BLOCK_CHARS` characters of one input
   partition) becomes a dictionary of its distinct words and, per document,
   the word codes in text order: position n of the sequence is pre-token n.
2. The dictionary goes out in buckets by a hash of the word, so that equal
   words of all blocks meet in one task; the sequences travel by block, once.
   In a bucket each distinct word is encoded once and its ids go to the block.
3. Sequences and ids of a block are joined on the block: the ids of its words
   take the places of the codes.

Words are exchanged as one packed row per block and bucket, not as one row
per occurrence: the shuffles carry a fraction of the input, and a word that is
in every document is one entry per block.  Blocks are read in the order of the
input's partitions; if a lost executor makes a partition run again on an input
whose order is not fixed, a checksum tells the old and the new block apart and
the job fails instead of mixing them.  Stored tables have a fixed order.

Decoding joins each id with its bytes in the token table: the table is one
byte string with the place of every token, and an array of ids becomes the
array of the bytes that stand at their places.

A null text counts as empty: no ids, empty bytes.  Other columns are passed
through; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import io
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot.llm.common import col, spread, whole_row

#: Characters of text that one block gathers (a longer text is a block alone).
BLOCK_CHARS = 4_000_000
#: Most buckets that the words are dealt to.
MAX_BUCKETS = 4096
#: Distinct words whose ids a task remembers at a time.
MEMORY_WORDS = 1_000_000
#: Ids that are looked up in the token table at a time.
CHUNK_IDS = 250_000


# --- vocabulary -----------------------------------------------------------------

_LOADED: dict = {}


def ranks_of(path: str) -> dict[bytes, int]:
    """Token bytes and their ids, from a tiktoken rank file on this machine."""
    if path not in _LOADED:
        with open(path, "rb") as f:
            _LOADED[path] = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return _LOADED[path]


def word_encoder(path: str, pattern: str) -> Callable[[bytes], list[int]]:
    """Merges of one pre-token."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks_of(path), special_tokens={})
    return _LOADED[path, pattern]._encode_single_piece


def token_table(path: str) -> list[bytes]:
    """Bytes by id."""
    if (path, "table") not in _LOADED:
        ranks = ranks_of(path)
        table = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            table[i] = token
        _LOADED[path, "table"] = table
    return _LOADED[path, "table"]


# --- packed columns -----------------------------------------------------------------

def _pack_numbers(x: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(x, "<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(planes.tobytes(), 3)


def _unpack_numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _pack_words(words: list[bytes]) -> bytes:
    sizes = _pack_numbers(np.fromiter(map(len, words), np.uint32, len(words)))
    return len(sizes).to_bytes(4, "little") + sizes + zstandard.compress(b"".join(words), 3)


def _unpack_words(data: bytes) -> list[bytes]:
    at = 4 + int.from_bytes(data[:4], "little")
    ends = np.cumsum(_unpack_numbers(data[4:at]), dtype=np.int64).tolist()
    raw = zstandard.decompress(data[at:])
    return [raw[i:j] for i, j in zip([0, *ends], ends)]


def _pack_rows(rows: pa.Array) -> bytes:
    out = io.BytesIO()
    batch = pa.RecordBatch.from_arrays([rows], names=["row"])
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return out.getvalue()


def _unpack_rows(data: bytes) -> pa.Array:
    return pa.ipc.open_stream(data).read_next_batch().column(0)


_ROW = T.StructType([
    T.StructField("key", T.LongType()),  # where the row goes: a bucket, or the block (negative)
    T.StructField("block", T.LongType()), T.StructField("bucket", T.IntegerType()), T.StructField("crc", T.LongType()),
    T.StructField("words", T.BinaryType()),  # of a bucket, until they are encoded
    T.StructField("numbers", T.BinaryType()),  # the ids of its words, or the codes of the texts
    T.StructField("sizes", T.BinaryType()),  # ids a word, or words a text
    T.StructField("docs", T.BinaryType()),
])


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


# --- 1: blocks ------------------------------------------------------------------

class _Block:
    """Dictionary and sequences of the texts of one block."""

    def __init__(self, split):
        self.split, self.code = split, defaultdict()
        self.code.default_factory = self.code.__len__  # a new word gets the next number
        self.codes: list[np.ndarray] = []
        self.rows: list[pa.Array] = []
        self.chars = 0

    def add(self, text: str) -> None:
        words = self.split(text)
        self.codes.append(np.fromiter(map(self.code.__getitem__, words), np.uint32, len(words)))
        self.chars += len(text)

    def emit(self, block: int, buckets: int) -> Iterator[dict]:
        """The bucket rows, then the row of the documents."""
        words = [w.encode() for w in self.code]
        self.code.clear()
        sizes = np.fromiter(map(len, self.codes), np.uint32, len(self.codes))
        codes = np.concatenate([np.empty(0, np.uint32), *self.codes])
        self.codes.clear()
        # frequent words get small numbers, which pack best
        often = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
        place = np.empty(len(words), np.uint32)
        place[often] = np.arange(len(words), dtype=np.uint32)
        codes = place[codes]
        # the words leave by bucket, the frequent ones first: the bucket of each
        # word by frequency is all it takes to put their ids in order again
        bucket = np.fromiter((zlib.crc32(words[i]) % buckets for i in often), np.uint32, len(words))
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order].astype(np.int64), prepend=-1, append=buckets))
        parts = [order[i:j] for i, j in zip(cuts[:-1], cuts[1:])]
        crc = zlib.crc32(codes.tobytes())
        for part in parts:
            yield {"key": int(bucket[part[0]]), "block": block, "bucket": int(bucket[part[0]]), "crc": crc, "words": _pack_words([words[i] for i in often[part]])}
        del words
        yield {"key": -1 - block, "block": block, "bucket": len(parts), "crc": crc, "words": _pack_numbers(bucket),
               "numbers": _pack_numbers(codes), "sizes": _pack_numbers(sizes), "docs": _pack_rows(pa.concat_arrays(self.rows))}


def _blocks(pattern: str, buckets: int, block_chars: int):
    """Rows of `_ROW` for the blocks of one partition (input: text, row)."""
    schema = _arrow(_ROW)

    def run(batches):
        from pyspark import TaskContext

        split, number = regex.compile(pattern).findall, TaskContext.get().partitionId() << 32
        block = _Block(split)
        for b in batches:
            start = 0
            for i, t in enumerate(b.column(0)):
                t = t.as_py() or ""
                if block.codes and block.chars + len(t) > block_chars:
                    block.rows.append(b.column(1).slice(start, i - start))
                    for row in block.emit(number, buckets):
                        yield pa.RecordBatch.from_pylist([row], schema)
                    block, number, start = _Block(split), number + 1, i
                    pa.default_memory_pool().release_unused()
                block.add(t)
            block.rows.append(b.column(1).slice(start))
        if block.codes:
            for row in block.emit(number, buckets):
                yield pa.RecordBatch.from_pylist([row], schema)

    return run


# --- 2: each distinct word once ------------------------------------------------------

def _rows(batches) -> Iterator[dict]:
    """The rows of all batches, one at a time."""
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


def _encode_buckets(path: str, pattern: str):
    """Puts the ids of its words into each bucket row, which then goes to its
    block: `key` becomes that of the block's documents."""
    schema = _arrow(_ROW)

    def run(batches):
        encode, known, now = word_encoder(path, pattern), {}, None
        for r in _rows(batches):
            if r["bucket"] != now or len(known) > MEMORY_WORDS:
                now, known = r["bucket"], {}
            words = _unpack_words(r["words"])
            known.update((w, np.array(encode(w), np.uint32)) for w in words if w not in known)
            ids = [known[w] for w in words]
            r |= {"key": -1 - r["block"], "words": None, "numbers": _pack_numbers(np.concatenate(ids)), "sizes": _pack_numbers(np.fromiter(map(len, ids), np.uint32, len(ids)))}
            yield pa.RecordBatch.from_pylist([r], schema)

    return run


# --- 3: reassembly by position -----------------------------------------------------

def _ids_by_code(parts: list[dict], bucket_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all words of a block, and where those of each code begin and how
    many they are."""
    none = np.empty(0, np.uint32)
    ids = np.concatenate([none] + [_unpack_numbers(p["numbers"]) for p in parts])
    n = np.concatenate([none] + [_unpack_numbers(p["sizes"]) for p in parts]).astype(np.int64)
    back = np.empty(len(bucket_of), np.int64)
    back[np.argsort(bucket_of, kind="stable")] = np.arange(len(bucket_of))
    return ids, (np.cumsum(n) - n)[back], n[back]


def _reassemble(out: pa.Schema, table: str | None):
    """Joins the documents row of a block (left) with its bucket rows (right)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if len(left) != 1:
            raise RuntimeError("a block was read again in another order; write the input to a table first")
        r, parts = left.to_pylist()[0], sorted(right.to_pylist(), key=lambda p: p["bucket"])
        if len(parts) != r["bucket"] or any(p["crc"] != r["crc"] for p in parts):
            raise RuntimeError("a block was read again in another order; write the input to a table first")
        codes, docs = _unpack_numbers(r["numbers"]), _unpack_rows(r["docs"])
        if zlib.crc32(codes.tobytes()) != r["crc"]:
            raise RuntimeError("the codes of a block were damaged")
        ids, first, n = _ids_by_code(parts, _unpack_numbers(r["words"]))
        ends = np.cumsum(_unpack_numbers(r["sizes"]), dtype=np.int64)
        del parts, r
        each = n[codes]
        values = ids[spread(first[codes], each)].astype(np.int32)
        offsets = np.concatenate([[0], np.cumsum(each)])[np.concatenate([[0], ends])].astype(np.int32)
        del codes, each
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
        columns = [docs.cast(out.field(0).type), lists]
        return pa.Table.from_arrays(columns + ([_bytes_of(lists, table)] if table else []), schema=out)

    return run


# --- the operator -------------------------------------------------------------------

def _here(condition: str) -> Column:
    """`condition`, in a form that Spark does not move below the exchange, so
    that two filters over one exchange read the same shuffle."""
    return F.expr(f"if(spark_partition_id() >= 0, {condition}, false)")


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", keep: list[str] | None = None, block_chars: int = BLOCK_CHARS, decoded: bool = False) -> DataFrame:
    """`row` (a struct of the columns `keep`, all but the text by default) and
    `ids` (array of int) of every row of `docs`; with `decoded` also what
    `decode` makes of the ids, in the same task."""
    spark = docs.sparkSession
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    row = whole_row(docs.select(*[col(c) for c in keep])) if keep else F.struct(F.lit(None).cast("int").alias("none"))
    source = docs.select(col(text_col).cast("string").alias("text"), row.alias("row"))
    out = T.StructType([T.StructField("row", source.schema["row"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))] + [T.StructField("decoded", T.BinaryType())] * decoded)
    blocks = source.mapInArrow(_blocks(pattern, max(1, min(MAX_BUCKETS, partitions)), block_chars), _ROW)
    dealt = blocks.repartition(partitions, "key")  # one exchange, read by both sides
    encoded = dealt.where(_here("key >= 0")).sortWithinPartitions("key").mapInArrow(_encode_buckets(path, pattern), _ROW)
    texts, ids = dealt.where(_here("key < 0")), encoded.repartition(partitions, "key")
    return texts.groupBy("key").cogroup(ids.groupBy("key")).applyInArrow(_reassemble(_arrow(out), path if decoded else None), out)


# --- decoding -----------------------------------------------------------------------

def _places(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All token bytes one after the other, where each begins and its length."""
    if (path, "places") not in _LOADED:
        table = token_table(path)
        n = np.fromiter(map(len, table), np.int64, len(table))
        _LOADED[path, "places"] = np.frombuffer(b"".join(table), np.uint8), np.cumsum(n) - n, n
    return _LOADED[path, "places"]


def _bytes_of(column: pa.ListArray, path: str) -> pa.Array:
    """The bytes that the ids of each list stand for; null for null."""
    data, first, n = _places(path)
    values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    done = []
    for i, ok in enumerate(column.is_valid().to_pylist()):
        parts = [values[k : min(k + CHUNK_IDS, offsets[i + 1])] for k in range(offsets[i], offsets[i + 1], CHUNK_IDS)]
        done.append(b"".join(data[spread(first[x], n[x])].tobytes() for x in parts) if ok else None)
    return pa.array(done, pa.binary())


def decode(rows: DataFrame, path: str, ids_col: str = "ids", as_col: str = "decoded") -> DataFrame:
    """`rows` with the bytes of their ids as a binary column `as_col`; null
    ids give null."""

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, _bytes_of(b.column(b.schema.get_field_index(ids_col)), path)], names=[*b.schema.names, as_col])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(as_col, T.BinaryType())]))
