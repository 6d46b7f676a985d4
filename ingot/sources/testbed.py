"""Bronze-shaped input derived from the driver's parquet tables.

The source system loads a clickstream CSV; the test data has an `events`
table and a `part` table instead.  These functions derive, with Spark, a
bronze relation of the same shape from them (deterministic, whole tables,
with NULLs, invalid ids, long category paths and case variants injected by
rules on `event_id`), plus the raw-text and dated variants used by the
ingest and partition operators.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingot import schemas
from ingot.operators.transforms import to_dim_products, to_silver
from ingot.session import ensure_checkpoint_dir

# Fixed values of the stand-in (id rules and base category id).
CATEGORY_ID_BASE = 2053013555631882655


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _events_with_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events joined to the part row named by `props` ("k": n)."""
    events = table(spark, sf_dir, "events").withColumn(
        "_k", F.regexp_extract("props", "([0-9]+)", 1).try_cast("long")
    )
    part = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size"
    )
    # `part` grows with the data.  As a plain table scan its size is known
    # from its files, so the planner broadcasts it only while it is under
    # spark.sql.autoBroadcastJoinThreshold; beyond that the join shuffles and
    # AQE's skew-join handling splits the few hot part keys (`k` takes only
    # 100 values).
    # An event without a part stays, with empty product columns.
    return events.join(part, events["_k"] == part["p_partkey"], "left")


def bronze_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze columns plus the source `event_id` (for ordering / variants)."""
    e = _events_with_part(spark, sf_dir)
    eid = F.col("event_id")
    dotted_name = F.translate("p_name", " ", ".")
    return e.select(
        eid,
        F.col("ts").alias("event_time"),
        F.col("event_type"),
        F.when(eid % 211 == 0, F.lit(0).cast("long"))
        .when(eid % 307 == 0, F.lit(None).cast("long"))
        .otherwise(F.col("p_partkey"))
        .alias("product_id"),
        F.when(eid % 401 == 0, F.lit(-1).cast("long"))
        .when(eid % 53 == 0, F.lit(CATEGORY_ID_BASE + 1) + F.col("p_size"))
        .otherwise(F.lit(CATEGORY_ID_BASE) + F.col("p_size"))
        .alias("category_id"),
        F.when(eid % 11 == 0, F.lit(None).cast("string"))
        .when(eid % 13 == 0, F.lower("p_type"))
        .when(eid % 17 == 0, F.concat(dotted_name, F.lit("."), F.lower("p_type")))
        .otherwise(dotted_name)
        .alias("category_code"),
        F.when(eid % 7 == 0, F.lit(None).cast("string"))
        .when(eid % 19 == 0, F.lower("p_brand"))
        .otherwise(F.col("p_brand"))
        .alias("brand"),
        F.when(eid % 31 == 0, F.lit(None).cast(schemas.PRICE_TYPE))
        .otherwise(F.col("value").cast(schemas.PRICE_TYPE))
        .alias("price"),
        F.when(eid % 29 == 0, F.lit(None).cast("long")).otherwise(F.col("user_id")).alias("user_id"),
        F.when(eid % 23 == 0, F.lit(None).cast("string"))
        .otherwise(
            F.concat(
                F.lit("s-"),
                F.col("user_id").cast("string"),
                F.lit("-"),
                F.to_date("ts").cast("string"),
            )
        )
        .alias("user_session"),
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine bronze data columns (no load stamp)."""
    return bronze_src(spark, sf_dir).select(*schemas.CSV_COLUMNS)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(bronze(spark, sf_dir))


def dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_dim_products(silver(spark, sf_dir))


def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV-like text rows: zoned times (some unparsable), NA-token brands."""
    e = _events_with_part(spark, sf_dir)
    eid = F.col("event_id")
    return e.select(
        eid,
        F.when(eid % 37 == 0, F.lit("bad-time"))
        .otherwise(F.concat(F.substr(F.col("ts").cast("string"), F.lit(1), F.lit(19)), F.lit(" UTC")))
        .alias("event_time"),
        F.when(eid % 5 == 0, F.lit("NA"))
        .when(eid % 7 == 0, F.lit("null"))
        .when(eid % 11 == 0, F.lit(""))
        .when(eid % 13 == 0, F.lit("N/A"))
        .otherwise(F.col("p_brand"))
        .alias("brand"),
    )


def session_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events for sessions: some without a user, some with tied times."""
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return e.select(
        eid,
        F.when(eid % 29 != 0, F.col("user_id")).alias("user_id"),
        F.when(eid % 3 == 0, F.date_trunc("hour", "ts").cast(e.schema["ts"].dataType)).otherwise(F.col("ts")).alias("ts"),
        "event_type",
        F.regexp_extract("props", "([0-9]+)", 1).try_cast("long").alias("product_id"),
    )


def csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-in as CSV text: times with a zone, dates alone, bad ids,
    brands with quotes, line feeds and commas in them."""
    b = bronze_src(spark, sf_dir)
    eid = F.col("event_id")
    text = F.substr(F.col("event_time").cast("string"), F.lit(1), F.lit(19))
    time = F.when(eid % 41 == 0, F.substr(text, F.lit(1), F.lit(10))).otherwise(F.concat(text, F.lit(" UTC")))
    product = F.when(eid % 43 == 0, F.concat(F.col("product_id").cast("string"), F.lit(".0"))).when(eid % 47 == 0, F.lit("n1")).otherwise(F.col("product_id").cast("string"))
    brand = F.when(eid % 53 == 0, F.concat(F.lit('a "'), F.coalesce("brand", F.lit("")), F.lit('"\n\nb, c'))).otherwise(F.col("brand"))
    rest = [F.col(c).cast("string").alias(c) for c in schemas.CSV_COLUMNS if c not in ("event_time", "product_id", "brand")]
    return b.select("event_id", time.alias("event_time"), product.alias("product_id"), brand.alias("brand"), *rest)


#: Layouts of the CSV files, by event_id % 3: the usual columns; ids swapped and
#: no session column; prices and everything behind them absent.
CSV_LAYOUTS = (
    schemas.CSV_COLUMNS,
    ("category_id", "product_id", "event_time", "event_type", "category_code", "brand", "price", "user_id"),
    ("event_time", "event_type", "product_id", "category_id", "category_code", "brand"),
)


def write_csv_files(spark: SparkSession, sf_dir: str, root: str | None = None, layouts: tuple[int, ...] = (0, 1, 2)) -> list[str]:
    """The rows as CSV under the shared checkpoint folder; a folder a layout."""
    root = root or f"{ensure_checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    rows, out = csv_rows(spark, sf_dir), []
    for i in layouts:
        columns = CSV_LAYOUTS[i]
        out.append(f"{root}/layout{i}")
        rows.where(F.col("event_id") % len(CSV_LAYOUTS) == i).select(*columns).write.option("header", "true").option("escape", '"').csv(out[-1])
    return out


#: Files of the head-N fixture, by event_id.
HEAD_FILES = 5


def write_csv_heads(spark: SparkSession, sf_dir: str) -> str:
    """The rows as CSV, a file for each event_id % 5, in the order of event_id."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    rows = csv_rows(spark, sf_dir).withColumn("part", F.col("event_id") % HEAD_FILES)
    ordered = rows.repartition(HEAD_FILES, "part").sortWithinPartitions("part", "event_id").select("part", *schemas.CSV_COLUMNS)
    ordered.write.partitionBy("part").option("header", "true").option("escape", '"').csv(root)
    return f"{root}/part=*"


def orders_dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates spanning several years (some NULL) for range buckets."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 97 == 0, F.lit(None).cast("date"))
        .otherwise(F.col("o_orderdate").cast("date"))
        .alias("d"),
    )


# Yearly RANGE LEFT bounds covering the order dates (1992-1998 and beyond).
ORDER_YEAR_BOUNDS = (
    "1995-12-31",
    "1996-12-31",
    "1997-12-31",
    "1998-12-31",
    "1999-12-31",
    "2000-12-31",
)
