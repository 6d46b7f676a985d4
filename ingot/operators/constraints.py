"""Table constraints the Parquet tables do not enforce (V1-V3).

Each check splits a relation into accepted rows and rejected rows (with a
reason) in one pass over the same plan; `strict=True` raises instead when
any row would be rejected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ingot.functions.columns import over_width


class ConstraintViolation(ValueError):
    pass


def _reason(parts: Sequence[Column]) -> Column:
    return F.concat_ws(";", *parts)


def not_null_reasons(cols: Sequence[str]) -> Column:
    """Text naming every NOT NULL column that is NULL ('' when none)."""
    return _reason([F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in cols])


def length_reasons(widths: Mapping[str, int]) -> Column:
    """Text naming every column longer than its VARCHAR(n) width."""
    return _reason(
        [F.when(over_width(c, n), F.lit(f"{c}>{n}")) for c, n in widths.items()]
    )


def split_rejects(
    df: DataFrame, reason: Column, strict: bool = False, reason_col: str = "reject_reason"
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejects): rows with an empty reason pass, others are
    returned with the reason in `reason_col`."""
    tagged = df.withColumn(reason_col, reason)
    rejects = tagged.where(F.col(reason_col) != "")
    accepted = tagged.where(F.col(reason_col) == "").drop(reason_col)
    if strict and not rejects.isEmpty():
        sample = rejects.limit(5).collect()
        raise ConstraintViolation(f"rows violate table constraints, e.g. {sample}")
    return accepted, rejects


def not_null_split(df: DataFrame, cols: Sequence[str], strict: bool = False):
    """V1: enforce NOT NULL on `cols`."""
    return split_rejects(df, not_null_reasons(cols), strict)


def length_split(df: DataFrame, widths: Mapping[str, int], strict: bool = False):
    """V2: enforce VARCHAR(n) widths."""
    return split_rejects(df, length_reasons(widths), strict)


def assert_unique(df: DataFrame, key: str) -> None:
    """V3: raise when `key` holds a value twice (primary key check)."""
    dup = df.groupBy(key).count().where(F.col("count") > 1).limit(5).collect()
    if dup:
        raise ConstraintViolation(f"duplicate {key} values, e.g. {dup}")
