"""Table schemas and the fixed values the pipeline must agree on.

All layouts follow the four tables of the medallion model: bronze events
(raw, typed), silver events (split and filled), the product dimension and
the event fact.  Types are declared up front; nothing is inferred from CSV.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values (must match the source system's behaviour exactly)
# --------------------------------------------------------------------------

# Filler written for a missing brand / session and for an unsplittable
# category code.
UNKNOWN = "UNKNOWN"

# Separator between category and subcategory in `category_code`.
CATEGORY_SEPARATOR = "."

# Text tokens that a pandas CSV read treats as missing (its default NA set).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Monthly partition function: RANGE LEFT upper bounds (inclusive), six
# bounds giving seven buckets; dates at or before the first bound and NULL
# dates land in bucket 1, dates after the last bound in bucket 7.
MONTH_BOUNDS = (
    "2019-11-30",
    "2019-12-31",
    "2020-01-31",
    "2020-02-29",
    "2020-03-31",
    "2020-04-30",
)

# Storage group name of the last (open-ended) bucket; the others are named
# "FG_" + yyyyMM of their bound.
EXTRA_GROUP = "FG_Extra"

# Inactivity gap that starts a new user session.
SESSION_GAP_SECONDS = 2 * 60 * 60

# Column widths of the target tables (VARCHAR(n)).  event_type is widened
# from 10 to 50 in bronze and fact: the source's own `remove_from_cart`
# event does not fit in 10 characters.  category and subcategory are widened
# from 50 to 100: they are parts of a category_code of up to 100 characters,
# and no row may be cut for its width.
BRONZE_WIDTHS = {
    "event_type": 50,
    "category_code": 100,
    "brand": 50,
    "user_session": 36,
}
SILVER_WIDTHS = {
    "event_type": 50,
    "category": 100,
    "subcategory": 100,
    "brand": 50,
    "user_session": 36,
}

PRICE_TYPE = T.DecimalType(10, 2)

# --------------------------------------------------------------------------
# Schemas
# --------------------------------------------------------------------------

# The nine CSV columns, all read as text first so that NA tokens, bad
# numbers and bad times are handled by the pipeline, not by the parser.
CSV_COLUMNS = (
    "event_time",
    "event_type",
    "product_id",
    "category_id",
    "category_code",
    "brand",
    "price",
    "user_id",
    "user_session",
)
CSV_TEXT_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in CSV_COLUMNS]
)

BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("event_time", T.TimestampNTZType(), False),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("product_id", T.LongType(), True),
        T.StructField("category_id", T.LongType(), True),
        T.StructField("category_code", T.StringType(), True),
        T.StructField("brand", T.StringType(), True),
        T.StructField("price", PRICE_TYPE, True),
        T.StructField("user_id", T.LongType(), True),
        T.StructField("user_session", T.StringType(), True),
        T.StructField("loaded_at", T.TimestampType(), False),
    ]
)
BRONZE_COLUMNS = tuple(f.name for f in BRONZE_SCHEMA.fields)

SILVER_SCHEMA = T.StructType(
    [
        T.StructField("event_date", T.DateType(), False),
        T.StructField("event_time_only", T.StringType(), False),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("product_id", T.LongType(), True),
        T.StructField("category_id", T.LongType(), True),
        T.StructField("category", T.StringType(), True),
        T.StructField("subcategory", T.StringType(), True),
        T.StructField("brand", T.StringType(), True),
        T.StructField("price", PRICE_TYPE, True),
        T.StructField("user_id", T.LongType(), True),
        T.StructField("user_session", T.StringType(), True),
    ]
)
SILVER_COLUMNS = tuple(f.name for f in SILVER_SCHEMA.fields)

DIM_PRODUCTS_SCHEMA = T.StructType(
    [
        T.StructField("product_id", T.LongType(), False),
        T.StructField("category_id", T.LongType(), True),
        T.StructField("brand", T.StringType(), True),
    ]
)

FACT_COLUMNS = (
    "event_date",
    "event_time_only",
    "event_type",
    "product_id",
    "category",
    "subcategory",
    "price",
    "user_id",
    "user_session",
)
FACT_SCHEMA = T.StructType(
    [T.StructField("event_key", T.LongType(), False)]
    + [SILVER_SCHEMA[c] for c in FACT_COLUMNS]
)


def month_bounds(bounds=MONTH_BOUNDS) -> list[_dt.date]:
    return [_dt.date.fromisoformat(b) for b in bounds]


def group_names(bounds=MONTH_BOUNDS, extra: str = EXTRA_GROUP) -> list[str]:
    """Storage-group name per bucket: FG_yyyyMM of each bound, then extra."""
    return [f"FG_{d.year:04d}{d.month:02d}" for d in month_bounds(bounds)] + [extra]
