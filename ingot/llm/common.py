"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot.session import ensure_checkpoint_dir, reliable_checkpoint

#: Rows a side may have before a join ships it to every executor.
BROADCAST_ROWS = 200_000
#: Rows that one pass over a large table broadcasts, where the table's tokens
#: must not be shuffled; a larger side takes more passes.
BLOCK_ROWS = 50_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stable(df: DataFrame) -> DataFrame:
    """`df` written once to the shared checkpoint folder (cuts lineage)."""
    return reliable_checkpoint(df)


def shared_folder(spark: SparkSession, kind: str) -> str:
    """A new folder name under the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def small_side(df: DataFrame, rows: int, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast of `df` if its counted `rows` are within `max_rows`;
    beyond it the join is a shuffle, whose skewed keys AQE splits."""
    return F.broadcast(df) if rows <= max_rows else df


def in_blocks(df: DataFrame, rows: int, key: str, block_rows: int | None = None) -> list[DataFrame]:
    """`df` in parts of about `block_rows` rows by a hash of `key`."""
    n = -(-rows // (block_rows or BLOCK_ROWS))
    return [df] if n <= 1 else [df.where(F.pmod(F.xxhash64(key), F.lit(n)) == i) for i in range(n)]


def col(name: str):
    """Column by its exact name (dots and blanks allowed)."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(df: DataFrame):
    """All columns as one struct, so that helper columns cannot clash."""
    return F.struct(*[col(c).alias(c) for c in df.columns])


def row_hash(df: DataFrame):
    """64-bit hash of the whole row (every column)."""
    return F.xxhash64(*[col(c) for c in df.columns])


def field(df: DataFrame, name: str, as_name: str | None = None) -> T.StructField:
    return T.StructField(as_name or name, df.schema[name].dataType, True)


def text_bytes(column: pa.Array) -> Iterator[bytes | None]:
    """UTF-8 bytes of a string column, one value at a time."""
    raw = column.cast(pa.binary()) if not pa.types.is_large_string(column.type) else column.cast(pa.large_binary())
    for v in raw:
        yield v.as_py()


def texts(column: pa.Array) -> Iterator[str | None]:
    for v in column:
        yield v.as_py()


def spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places first[i], ..., first[i] + n[i] - 1 of every i, one after the other."""
    return np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)
