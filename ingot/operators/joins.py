"""Join helpers.

Joins are plain: the planner broadcasts a table scan below
`spark.sql.autoBroadcastJoinThreshold`, and AQE turns a shuffled join into a
broadcast once it has measured that a side is small.  Beyond that the join is
a shuffle whose hot keys AQE's skew handling splits.  The one hinted broadcast
is that of a key filter, whose size has a fixed bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ingot.session import reliable_checkpoint

# Blocks of a key filter: bits of one (what `bitmap_construct_agg` makes), most
# blocks (4 KB each, so a filter is at most 64 MB), keys that a block is meant
# for, and bits set for each key.
BLOCK_BITS = 32_768
MAX_BLOCKS = 16_384
KEYS_A_BLOCK = 2_048
KEY_BITS = 4


def join_dimension(facts: DataFrame, dim: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Join a large relation to a dimension on equal keys."""
    return facts.join(dim, on=on, how=how)


def anti_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of `left` whose `key` has no match in `right` (NOT EXISTS).

    Rows with a NULL key never match and are kept, duplicates are kept.  NULL
    keys are split off before the join: shuffled, they would all hash to one
    reducer.
    """
    nulls = left.where(F.col(key).isNull())
    keys = right.select(key).where(F.col(key).isNotNull()).distinct()
    rest = left.where(F.col(key).isNotNull()).join(keys, key, "left_anti")
    return rest.unionByName(nulls)


# --- membership filters -----------------------------------------------------------

def _block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _bits_of(key: Column) -> list[Column]:
    """The positions of a key within its block."""
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(BLOCK_BITS)) for i in range(KEY_BITS)]


def key_filter(keys: DataFrame, key: str, n_keys: int) -> tuple[DataFrame, int]:
    """A blocked Bloom filter of `keys`, built in one aggregation: (`_block`,
    `_bits`) rows, and the number of blocks.  More keys than it is meant for
    make it less selective, not larger."""
    blocks = max(1, min(MAX_BLOCKS, -(-n_keys // KEYS_A_BLOCK)))
    bits = keys.select(_block_of(F.col(key), blocks).alias("_block"), F.explode(F.array(*_bits_of(F.col(key)))).alias("_bit"))
    return bits.groupBy("_block").agg(F.expr("bitmap_construct_agg(_bit)").alias("_bits")), blocks


def might_hold(df: DataFrame, key: str, filter_: DataFrame, blocks: int) -> DataFrame:
    """Rows of `df` whose `key` the filter may hold: all that it does hold, and
    few others.  The filter is broadcast; its size is bounded by `MAX_BLOCKS`."""
    def has(bit: Column) -> Column:
        byte = F.ascii(F.decode(F.substring(F.col("_bits"), (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1)), "ISO-8859-1"))
        return F.getbit(byte.cast("long"), bit.bitwiseAND(7).cast("int")) == 1

    found = df.withColumn("_at", _block_of(F.col(key), blocks)).join(F.broadcast(filter_), F.col("_at") == F.col("_block"))
    for bit in _bits_of(F.col(key)):
        found = found.where(has(bit))
    return found.select(*df.columns)


def anti_join_filtered(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The rows of `anti_join`, for a `left` of many rows a key of which few
    have no match: the keys are reduced to their distinct values where they are
    read, those without a match found among them, and a filter of these lets
    only suspects through to the exact join.  The rows of `left` are read twice
    and not shuffled."""
    known = right.select(key).where(F.col(key).isNotNull()).distinct()
    orphans = reliable_checkpoint(left.select(key).where(F.col(key).isNotNull()).distinct().join(known, key, "left_anti"))
    filter_, blocks = key_filter(orphans, key, orphans.count())
    suspects = might_hold(left.where(F.col(key).isNotNull()), key, filter_, blocks)
    return suspects.join(orphans, key, "left_semi").unionByName(left.where(F.col(key).isNull()))
