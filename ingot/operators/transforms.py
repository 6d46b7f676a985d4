"""Layer transforms: bronze -> silver -> product dimension / event fact.

Pure `DataFrame -> DataFrame` functions; writing is done by `ingot.plans`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingot import schemas
from ingot.functions import columns as C


def split_category(df: DataFrame, code: str = "category_code") -> DataFrame:
    """Add `category` / `subcategory` split at the first dot."""
    return df.withColumns(
        {"category": C.category_head(code), "subcategory": C.category_tail(code)}
    )


def to_silver(bronze: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Bronze -> silver (T7): one narrow projection, every row kept.

    date and rounded time of day from `event_time`, category path split,
    UNKNOWN for missing brand and session, five columns (and those named in
    `keep`) passed through.
    """
    return bronze.select(
        C.event_date("event_time").alias("event_date"),
        C.time_of_day("event_time").alias("event_time_only"),
        F.col("event_type"),
        F.col("product_id"),
        F.col("category_id"),
        C.category_head("category_code").alias("category"),
        C.category_tail("category_code").alias("subcategory"),
        C.fill_unknown("brand").alias("brand"),
        F.col("price"),
        F.col("user_id"),
        C.fill_unknown("user_session").alias("user_session"),
        *keep,
    )


def to_fact_columns(silver: DataFrame) -> DataFrame:
    """Silver -> fact projection (T8) without the surrogate key."""
    return silver.select(*schemas.FACT_COLUMNS)


def to_dim_products(
    silver: DataFrame,
    collation: str | None = None,
    dedupe_first: bool = True,
) -> DataFrame:
    """One row per non-NULL product_id with MAX(category_id), MAX(brand) (G1).

    The two maxima are taken independently, as in the source procedure.
    Rows with a NULL product_id cannot enter the dimension (its key is NOT
    NULL); they are reported by `constraints.not_null_split`, not dropped
    silently by the caller.

    `dedupe_first` first reduces the rows to distinct (product_id, brand)
    pairs with a hash aggregate (max(category_id) rides along): MAX over a
    string cannot use the hash aggregate, so the sort-based final step then
    runs over a handful of rows per product instead of every event.  The
    partial aggregates also absorb hot products before the shuffle.

    `collation='UTF8_LCASE'` compares brands case-insensitively (the
    source database's usual default) instead of binary.
    """
    rows = silver.where(F.col("product_id").isNotNull())
    brand = F.col("brand")
    if collation:
        brand = F.collate(brand, collation)
    if dedupe_first:
        pairs = rows.groupBy("product_id", brand.alias("brand")).agg(
            F.max("category_id").alias("category_id")
        )
        dim = pairs.groupBy("product_id").agg(
            F.max("category_id").alias("category_id"), F.max("brand").alias("brand")
        )
    else:
        dim = rows.groupBy("product_id").agg(
            F.max("category_id").alias("category_id"), F.max(brand).alias("brand")
        )
    if collation:
        dim = dim.withColumn("brand", F.col("brand").cast("string"))
    return dim.select("product_id", "category_id", "brand")
