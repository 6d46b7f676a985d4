"""Monthly range partitioning (M1-M3).

The source defines a RANGE LEFT partition function over six month-end
dates and maps its seven buckets to named storage groups.  Both are functions
here (`with_month_partition`).  The stored tables are partitioned by calendar
month unless a lakehouse is given such bounds, so that dates beyond the last
bound do not all fall into one partition; reads with a predicate on it prune
whole folders.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingot import schemas
from ingot.functions.columns import range_left_bucket, storage_group

PARTITION_COLUMN = "event_month"


def with_month_partition(
    df: DataFrame,
    date_col: str = "event_date",
    bounds=schemas.MONTH_BOUNDS,
    bucket_col: str | None = None,
    group_col: str = PARTITION_COLUMN,
) -> DataFrame:
    """Add the storage-group column (and optionally the bucket number)."""
    b = range_left_bucket(date_col, bounds)
    out = df
    if bucket_col:
        out = out.withColumn(bucket_col, b)
    return out.withColumn(group_col, storage_group(b, bounds))


def groups_for_dates(
    lo: str | _dt.date | None, hi: str | _dt.date | None, bounds=schemas.MONTH_BOUNDS
) -> list[str]:
    """Storage groups that can hold dates in [lo, hi] (for partition pruning)."""
    names = schemas.group_names(bounds)
    ends = schemas.month_bounds(bounds)

    def bucket(d):
        d = _dt.date.fromisoformat(d) if isinstance(d, str) else d
        return 1 + sum(1 for e in ends if d > e)

    first = 1 if lo is None else bucket(lo)
    last = len(names) if hi is None else bucket(hi)
    return names[first - 1:last]


def with_partition(df: DataFrame, date_col: str = "event_date", bounds=None, group_col: str = PARTITION_COLUMN) -> DataFrame:
    """Add the partition column of the stored tables: the calendar month
    (`yyyy-MM`) by default, or the storage group for the given bounds."""
    if bounds is not None:
        return with_month_partition(df, date_col, bounds, group_col=group_col)
    return df.withColumn(group_col, F.date_format(F.col(date_col), "yyyy-MM"))


def where_dates(
    df: DataFrame,
    lo: str | None,
    hi: str | None,
    date_col: str = "event_date",
    group_col: str = PARTITION_COLUMN,
    bounds=None,
) -> DataFrame:
    """Date-range filter that also names the partitions to read.

    A predicate on `event_date` alone does not prune folders partitioned by
    `event_month`; the added predicate on the month (or storage group) does.
    """
    month = F.col(group_col)
    cond = F.lit(True)
    if bounds is not None:
        cond = month.isin(groups_for_dates(lo, hi, bounds))
    if lo is not None:
        cond = cond & (F.col(date_col) >= F.lit(lo).cast("date"))
        cond = cond & (month >= F.lit(str(lo)[:7])) if bounds is None else cond
    if hi is not None:
        cond = cond & (F.col(date_col) <= F.lit(hi).cast("date"))
        cond = cond & (month <= F.lit(str(hi)[:7])) if bounds is None else cond
    return df.where(cond)


def partition_inventory(
    df: DataFrame, date_col: str = "d", bounds=schemas.MONTH_BOUNDS
) -> DataFrame:
    """M3 from data: rows and date range per bucket / storage group."""
    b = range_left_bucket(date_col, bounds)
    return (
        df.select(b.alias("month_bucket"), F.col(date_col).alias("_d"))
        .groupBy("month_bucket")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min("_d").alias("min_date"),
            F.max("_d").alias("max_date"),
        )
        .withColumn("storage_group", storage_group("month_bucket", bounds))
        .select("month_bucket", "storage_group", "row_count", "min_date", "max_date")
    )


def stored_partition_inventory(df: DataFrame, group_col: str = PARTITION_COLUMN) -> DataFrame:
    """M3 for a stored, partitioned table: rows, files and MB per partition.

    Uses the scan's `_metadata` (file path and size), so file counts and
    sizes come from the same pass as the row counts.
    """
    files = df.select(
        F.col(group_col),
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_size").alias("_size"),
    )
    per_file = files.groupBy(group_col, "_path").agg(
        F.count(F.lit(1)).alias("_rows"), F.first("_size").alias("_size")
    )
    return per_file.groupBy(group_col).agg(
        F.sum("_rows").alias("row_count"),
        F.count(F.lit(1)).alias("file_count"),
        F.floor(F.sum("_size") / F.lit(1024 * 1024)).cast("long").alias("size_mb"),
    )
