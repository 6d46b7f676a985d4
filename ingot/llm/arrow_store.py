"""Token ids in Arrow files of equal-length sequences.

Documents are sorted by id over range partitions (ties by text), encoded, ended
with `end_id` and packed one after the other into sequences of `length` ids.
Every partition writes a shard of two Arrow IPC files into one folder:

- `seq-*.arrow`: record batches with `ids` (fixed-size list of unsigned ints)
  and `mask` (fixed-size list of bool, false on the padding behind a shard's
  last document).  Uncompressed, so a memory map gives any sequence without a
  copy: `SequenceFile(path)[i]`.
- `doc-*.arrow`: `doc_id`, `start` (in the shard) and `n_tokens`.

A shard counts only if its row is in the manifest that the write returns: a
task that runs again writes files of another name, and readers never see the
abandoned ones.  The manifest also gives each shard's place in the whole
stream of ids.

A null text counts as empty: its sequence is the end id alone.  Rows with
equal ids stay in; null ids come first; an empty table gives no shard.
"""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot.llm.common import col, field, shared_folder, stable, text_bytes

#: Ids of a sequence, and sequences of a record batch.
LENGTH = 2048
BATCH_SEQUENCES = 256
#: Encoded words of each of the two generations that a worker remembers (about 35
#: MB); an executor keeps a worker for each core, and more for a while when short
#: tasks follow each other.
MEMORY_WORDS = 200_000
#: Python characters of which every word of a text can be encoded alone: none
#: that composes, changes case by its neighbours or counts as white space in
#: one of the two libraries only.
_PLAIN = re.compile("[^\t\n\r -~¡-įı-ɏ]")
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


# --- encoding ---------------------------------------------------------------------

def _byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in set(own) else chr(next(rest)) for b in range(256)]


class WordCache(dict):
    """Ids (as bytes of `dtype`) of white-space separated words, filled on demand."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.older: dict[str, bytes] = {}
        self.library = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        #: Beginnings that the added tokens share, such as "<|" (the library
        #: also finds them in other letter case).
        self.marks = {t.content[:2] for t in self.library.get_added_tokens_decoder().values()}
        self.letters = _byte_letters()
        self.code = "H" if self.dtype.itemsize == 2 else "I"

    def _tokenize(self, piece: str) -> bytes:
        word = piece if piece.isascii() else "".join(map(self.letters.__getitem__, piece.encode()))
        return array(self.code, [t.id for t in self.library.model.tokenize(word)]).tobytes()

    def __missing__(self, word: str) -> bytes:
        if (ids := self.older.get(word)) is not None:
            self[word] = ids
            return ids
        low = word.lower()
        pieces = [low] if low.isalpha() else _WORD.findall(low)
        self[word] = ids = self._tokenize(word) if pieces == [word] else b"".join(map(self.__getitem__, pieces))
        return ids

    def trim(self) -> None:
        """Once there are too many words, forget those not met since the last
        time (before each text)."""
        if len(self) > MEMORY_WORDS:
            self.older = dict(self)
            self.clear()

    def encode(self, text: str) -> bytes:
        """The ids that the library gives for the whole text, adding none.  A
        text in which the vocabulary's added tokens may stand goes through it whole."""
        self.trim()
        if any(m in text for m in self.marks) or _PLAIN.search(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()
        return b"".join(map(self.__getitem__, text.split()))


_CACHES: dict[str, WordCache] = {}


def word_cache(path: str) -> WordCache:
    """This worker's cache for a tokenizer file."""
    if path not in _CACHES:
        _CACHES[path] = WordCache(path)
    return _CACHES[path]


# --- files ------------------------------------------------------------------------

def _open_fs(uri: str) -> tuple[pa.fs.FileSystem, str]:
    if uri.startswith("file:") or "://" not in uri:
        return pa.fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pa.fs.FileSystem.from_uri(uri)


def _open(uri: str) -> pa.ipc.RecordBatchFileReader:
    fs, path = _open_fs(uri)
    return pa.ipc.open_file(pa.memory_map(path) if isinstance(fs, pa.fs.LocalFileSystem) else fs.open_input_file(path))


class SequenceFile:
    """Random access to the sequences of one shard."""

    def __init__(self, uri: str):
        self.reader = _open(uri)
        meta = self.reader.schema.metadata
        self.length, self.per_batch = int(meta[b"length"]), int(meta[b"per_batch"])
        batches = self.reader.num_record_batches
        self._at, self._batch = -1, None
        self.n = (batches - 1) * self.per_batch + self.reader.get_batch(batches - 1).num_rows if batches else 0

    def __len__(self) -> int:
        return self.n

    def _values(self, k: int) -> np.ndarray:
        """All ids of batch `k`, a view of the file."""
        if k != self._at:
            self._at, self._batch = k, self.reader.get_batch(k)
        return self._batch.column(0).values.to_numpy()

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """Ids (a view of the file) and mask of sequence `i`."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        k, j = divmod(i, self.per_batch)
        ids = self._values(k)[j * self.length : (j + 1) * self.length]
        return ids, self._batch.column(1)[j].values

    def span(self, start: int, n: int) -> np.ndarray:
        """`n` ids of the shard's stream from `start` on, across sequences."""
        size, parts = self.length * self.per_batch, []
        while n > 0:
            k, j = divmod(start, size)
            parts.append(self._values(k)[j : j + n])
            start, n = start + len(parts[-1]), n - len(parts[-1])
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


class _Shard:
    """Writer of one shard: packs ids into sequences, batch by batch."""

    def __init__(self, folder: str, name: str, dtype: np.dtype, id_type: pa.DataType, length: int):
        self.fs, path = _open_fs(folder)
        self.fs.create_dir(path)
        self.seq_uri, self.doc_uri = f"{folder}/seq-{name}.arrow", f"{folder}/doc-{name}.arrow"
        self.length, self.dtype, self.waiting, self.size, self.total = length, dtype, [], 0, 0
        item = pa.uint16() if dtype.itemsize == 2 else pa.uint32()
        self.schema = pa.schema([("ids", pa.list_(item, length)), ("mask", pa.list_(pa.bool_(), length))], metadata={"length": str(length), "per_batch": str(BATCH_SEQUENCES)})
        self.item, self.writer, self.out = item, None, None
        self.docs: list[pa.RecordBatch] = []
        self.doc_schema = pa.schema([("doc_id", id_type), ("start", pa.int64()), ("n_tokens", pa.int64())])

    def add(self, ids: pa.Array, coded: list[bytes]) -> None:
        n = np.array([len(c) // self.dtype.itemsize for c in coded], np.int64)
        starts = self.total + np.cumsum(n) - n
        self.docs.append(pa.RecordBatch.from_arrays([ids.cast(self.doc_schema.field(0).type), pa.array(starts), pa.array(n)], schema=self.doc_schema))
        self.total += int(n.sum())
        for c in coded:
            self.waiting.append(c)
            self.size += len(c)
            if self.size >= 4 * self.length * BATCH_SEQUENCES * self.dtype.itemsize:
                self._flush(False)

    def _flush(self, last: bool) -> None:
        if self.writer is None:
            fs, path = _open_fs(self.seq_uri)
            self.out = fs.open_output_stream(path)
            self.writer = pa.ipc.new_file(self.out, self.schema)
        ids = np.frombuffer(b"".join(self.waiting), self.dtype)
        step, at = self.length * BATCH_SEQUENCES, 0
        while len(ids) - at >= step or last and at < len(ids):
            part = ids[at : at + step]
            rows = -(-len(part) // self.length)
            pad = rows * self.length - len(part)
            values = np.concatenate([part, np.zeros(pad, self.dtype)]) if pad else part
            mask = np.ones(rows * self.length, bool)
            mask[len(part) :] = False
            self.writer.write_batch(pa.RecordBatch.from_arrays(
                [pa.FixedSizeListArray.from_arrays(pa.array(values, self.item), self.length), pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)],
                schema=self.schema))
            at += step
        self.waiting = [ids[at:].tobytes()]
        self.size = len(self.waiting[0])

    def close(self) -> None:
        self._flush(True)
        self.writer.close()
        self.out.close()
        fs, path = _open_fs(self.doc_uri)
        with fs.open_output_stream(path) as out, pa.ipc.new_file(out, self.doc_schema) as w:
            for b in self.docs:
                w.write_batch(b)


_MANIFEST = T.StructType([
    T.StructField("shard", T.IntegerType()), T.StructField("sequences", T.StringType()), T.StructField("documents", T.StringType()),
    T.StructField("n_documents", T.LongType()), T.StructField("n_ids", T.LongType()),
])


def _write_shard(path: str, folder: str, end_id: int, length: int):
    def run(batches):
        from pyspark import TaskContext

        shard, n = None, 0
        part = TaskContext.get().partitionId()
        for b in batches:
            if not b.num_rows:
                continue
            cache = word_cache(path)
            if shard is None:
                shard = _Shard(folder, f"{part:06d}-{uuid.uuid4().hex}", cache.dtype, b.column(0).type, length)
                end = np.array([end_id], cache.dtype).tobytes()
            shard.add(b.column(0), [cache.encode((t or b"").decode()) + end for t in text_bytes(b.column(1))])
            n += b.num_rows
        if shard is not None:
            shard.close()
            yield pa.RecordBatch.from_pylist([{"shard": part, "sequences": shard.seq_uri, "documents": shard.doc_uri, "n_documents": n, "n_ids": shard.total}],
                                             pa.schema([("shard", pa.int32()), ("sequences", pa.string()), ("documents", pa.string()), ("n_documents", pa.int64()), ("n_ids", pa.int64())]))

    return run


def write_sequences(docs: DataFrame, path: str, end_id: int, folder: str | None = None, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files; returns the manifest: `shard` (ascending in doc_id),
    file names, `n_documents`, `n_ids` and `start`, the ids of all shards
    before.  `folder` must be one that driver and executors share (default: a
    new one under the checkpoint folder)."""
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "token-ids")
    text = col(text_col).cast("string")
    rows = docs.select(col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    ordered = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    manifest = stable(ordered.select("doc_id", "text").mapInArrow(_write_shard(path, folder, end_id, length), _MANIFEST))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _spans(sequences: str, documents: str) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Index batches of a shard with the ids of their documents."""
    stored, index = SequenceFile(sequences), _open(documents)
    for k in range(index.num_record_batches):
        b = index.get_batch(k)
        yield b, [stored.span(s, n) for s, n in zip(b.column(1).to_numpy(), b.column(2).to_numpy())]


def read_digests(manifest: DataFrame, id_type: T.DataType) -> DataFrame:
    """From the files, per document: `doc_id`, `start`, `n_tokens`, `ids_crc32`
    (of the ids as little-endian unsigned 32-bit integers)."""
    schema = T.StructType([T.StructField("doc_id", id_type)] + [T.StructField(c, T.LongType()) for c in ("start", "n_tokens", "ids_crc32")])

    def run(batches):
        for rows in batches:
            for r in rows.to_pylist():
                for b, ids in _spans(r["sequences"], r["documents"]):
                    crc = np.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], np.int64)
                    yield pa.RecordBatch.from_arrays([b.column(0), pa.array(b.column(1).to_numpy() + r["start"]), b.column(2), pa.array(crc)], names=schema.names)

    return _one_shard_a_task(manifest).mapInArrow(run, schema)


def read_sequences(manifest: DataFrame) -> DataFrame:
    """`shard`, `sequence` (number in the shard), `ids` and `mask` of all sequences."""
    schema = "shard int, sequence long, ids array<int>, mask array<boolean>"

    def run(batches):
        for rows in batches:
            for r in rows.to_pylist():
                reader, k = _open(r["sequences"]), 0
                for i in range(reader.num_record_batches):
                    b = reader.get_batch(i)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([r["shard"]] * b.num_rows, pa.int32()), pa.array(range(k, k + b.num_rows), pa.int64()),
                        b.column(0).cast(pa.list_(pa.int32())), b.column(1).cast(pa.list_(pa.bool_()))], names=["shard", "sequence", "ids", "mask"])
                    k += b.num_rows

    return _one_shard_a_task(manifest).mapInArrow(run, schema)


def _one_shard_a_task(manifest: DataFrame) -> DataFrame:
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(n, "shard")


def id_type_of(docs: DataFrame, id_col: str = "doc_id") -> T.DataType:
    return field(docs, id_col).dataType
