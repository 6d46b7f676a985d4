"""Registered queries: one callable `(spark, sf_dir) -> DataFrame` per key.

Each reads the driver's tables (whole, no row caps) through the stand-in
of `ingot.sources.testbed` and runs one operator of the pipeline.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingot import schemas
from ingot.functions import columns as C
from ingot.operators import constraints as V
from ingot.operators import keys as K
from ingot.operators import partitions as P
from ingot.operators import quality as Q
from ingot.operators import sessions as X
from ingot.operators import transforms as T
from ingot.plans import medallion as M
from ingot.plans import sinks as S
from ingot.session import ensure_checkpoint_dir, reliable_checkpoint
from ingot.sources import csv as CSV
from ingot.sources import testbed as tb
from ingot.streaming.incremental import ingest_new_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


@register("silver_events")
def q_silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.silver(spark, sf_dir)


@register("dim_products")
def q_dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.dim_products(spark, sf_dir)


# --- T-operators and the fact -------------------------------------------------

@register("split_category")
def q_split_category(spark, sf_dir):
    b = tb.bronze(spark, sf_dir).select("category_code")
    return T.split_category(b)


@register("fill_unknown")
def q_fill_unknown(spark, sf_dir):
    b = tb.bronze(spark, sf_dir)
    return b.select(
        F.col("brand").alias("brand_source"),
        C.fill_unknown("brand").alias("brand"),
        F.col("user_session").alias("user_session_source"),
        C.fill_unknown("user_session").alias("user_session"),
    )


@register("fact_ecommerce")
def q_fact_ecommerce(spark, sf_dir):
    return T.to_fact_columns(tb.silver(spark, sf_dir))


def _keyed_fact(spark, sf_dir):
    return K.with_surrogate_key(T.to_fact_columns(tb.silver(spark, sf_dir)))


@register("fact_key_stats")
def q_fact_key_stats(spark, sf_dir):
    f = _keyed_fact(spark, sf_dir)
    return f.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("event_key").alias("min_key"),
        F.max("event_key").alias("max_key"),
        F.countDistinct("event_key").alias("distinct_keys"),
    )


# --- data-quality checks --------------------------------------------------------

@register("dq_invalid_ids")
def q_dq_invalid_ids(spark, sf_dir):
    return Q.invalid_ids(tb.bronze(spark, sf_dir))


@register("dq_nulls_bronze")
def q_dq_nulls_bronze(spark, sf_dir):
    return Q.bronze_profile(tb.bronze(spark, sf_dir))


@register("dq_duplicate_products_bronze")
def q_dq_duplicate_products_bronze(spark, sf_dir):
    return Q.duplicate_products(tb.bronze(spark, sf_dir))


@register("dq_nulls_silver")
def q_dq_nulls_silver(spark, sf_dir):
    return Q.silver_profile(tb.silver(spark, sf_dir))


@register("dq_unknowns_silver")
def q_dq_unknowns_silver(spark, sf_dir):
    return Q.silver_unknowns(tb.silver(spark, sf_dir))


@register("dq_duplicate_products_silver")
def q_dq_duplicate_products_silver(spark, sf_dir):
    return Q.duplicate_products(tb.silver(spark, sf_dir))


# The type reloaded by mistake in the duplicate-key check.
RELOADED_TYPE = "purchase"
# The dimension of the integrity check was last built, from purchases alone,
# before this date.
STALE_DIM_DATE = "2024-01-02"


@register("dq_event_key_duplicates")
def q_dq_event_key_duplicates(spark, sf_dir):
    """The fact loaded, then one event type reloaded with the key counter
    restarted: with m such rows the keys 1..m must be reported, no others."""
    rows = T.to_fact_columns(tb.silver(spark, sf_dir))
    again = K.with_surrogate_key(rows.where(F.col("event_type") == RELOADED_TYPE))
    return Q.event_key_duplicates(K.with_surrogate_key(rows).select("event_key").unionByName(again.select("event_key")))


@register("dq_nulls_fact")
def q_dq_nulls_fact(spark, sf_dir):
    return Q.fact_profile(_keyed_fact(spark, sf_dir))


@register("dq_report_fact")
def q_dq_report_fact(spark, sf_dir):
    return Q.report(Q.fact_profile(_keyed_fact(spark, sf_dir)), "gold", "fact_nulls_unknowns")


@register("dq_referential_integrity")
def q_dq_referential_integrity(spark, sf_dir):
    """Fact against a stale dimension: products first seen since then, and
    NULL ids, are orphans."""
    silver = tb.silver(spark, sf_dir)
    old = (F.col("event_date") < F.lit(STALE_DIM_DATE).cast("date")) & (F.col("event_type") == "purchase")
    stale = T.to_dim_products(silver.where(old))
    return Q.referential_integrity(T.to_fact_columns(silver), stale)


def _consistency(spark, sf_dir, *checks):
    silver = tb.silver(spark, sf_dir)
    return Q.consistency(silver, T.to_dim_products(silver), checks=checks or ("brand", "category"))


@register("dq_brand_mismatch_silver")
def q_dq_brand_mismatch_silver(spark, sf_dir):
    return _consistency(spark, sf_dir, "brand").select(F.col("mismatched_brands_silver").alias("mismatched_brands"))


@register("dq_brand_mismatch_dim")
def q_dq_brand_mismatch_dim(spark, sf_dir):
    return _consistency(spark, sf_dir, "brand").select(F.col("mismatched_brands_dim").alias("mismatched_brands"))


@register("dq_category_mismatch_silver")
def q_dq_category_mismatch_silver(spark, sf_dir):
    return _consistency(spark, sf_dir, "category").select(
        F.col("mismatched_categories_silver").alias("mismatched_categories"))


@register("dq_category_mismatch_dim")
def q_dq_category_mismatch_dim(spark, sf_dir):
    return _consistency(spark, sf_dir, "category").select(
        F.col("mismatched_categories_dim").alias("mismatched_categories"))


@register("dq_consistency")
def q_dq_consistency(spark, sf_dir):
    return _consistency(spark, sf_dir)


@register("dq_summary")
def q_dq_summary(spark, sf_dir):
    # bronze is materialised once in the checkpoint folder; silver, the
    # dimension and the keyed fact are derived from that stable copy
    bronze = reliable_checkpoint(tb.bronze(spark, sf_dir))
    silver = T.to_silver(bronze)
    dim = T.to_dim_products(silver)
    fact = K.with_surrogate_key(T.to_fact_columns(silver), stable_input=True)
    return Q.summary(bronze, silver, dim, fact)


@register("dq_preview")
def q_dq_preview(spark, sf_dir):
    return Q.preview(Q.invalid_ids(tb.bronze_src(spark, sf_dir)), ["event_id"], 20)


# --- ingest-side operators (text normalisation, parsing, constraints) ----------

@register("null_tokens")
def q_null_tokens(spark, sf_dir):
    r = tb.raw_text(spark, sf_dir)
    return r.select("event_id", C.null_tokens("brand").alias("brand"))


@register("parse_event_time")
def q_parse_event_time(spark, sf_dir):
    r = tb.raw_text(spark, sf_dir)
    return r.select("event_id", C.parse_event_time("event_time").alias("event_time"))


@register("not_null_rejects")
def q_not_null_rejects(spark, sf_dir):
    r = tb.raw_text(spark, sf_dir).select(
        "event_id",
        F.col("event_time").alias("event_time_text"),
        C.parse_event_time("event_time").alias("event_time"),
    )
    _, rejects = V.not_null_split(r, ["event_time"])
    return rejects.select("event_id", "event_time_text", "reject_reason")


# Target widths of the length check: the bronze table's, with category_code
# narrowed to 12 characters (a target too narrow for the longer paths).
LENGTH_CHECK_WIDTHS = dict(schemas.BRONZE_WIDTHS, category_code=12)


@register("length_rejects")
def q_length_rejects(spark, sf_dir):
    _, rejects = V.length_split(tb.bronze(spark, sf_dir), LENGTH_CHECK_WIDTHS)
    return rejects


# --- partitions -------------------------------------------------------------------

@register("month_bucket")
def q_month_bucket(spark, sf_dir):
    o = tb.orders_dated(spark, sf_dir)
    return P.with_month_partition(
        o, "d", bounds=tb.ORDER_YEAR_BOUNDS, bucket_col="month_bucket", group_col="storage_group"
    )


@register("partition_inventory")
def q_partition_inventory(spark, sf_dir):
    return P.partition_inventory(tb.orders_dated(spark, sf_dir), "d", tb.ORDER_YEAR_BOUNDS)


# --- source-side operators over the driver's files ---------------------------------

@register("head_n_per_file")
def q_head_n_per_file(spark, sf_dir):
    """First 500 rows of each events file, in file order."""
    ev = tb.table(spark, sf_dir, "events")
    return CSV.head_n_per_file(ev, 500, parquet=True).drop(CSV.ROW_INDEX)


@register("load_counts")
def q_load_counts(spark, sf_dir):
    return CSV.load_counts(tb.table(spark, sf_dir, "events"))


# --- sessions (README-described behaviour) --------------------------------------------

def _sessions(spark, sf_dir):
    return X.sessionize(tb.session_events(spark, sf_dir))


@register("sessionize")
def q_sessionize(spark, sf_dir):
    return _sessions(spark, sf_dir).select("event_id", "user_id", "ts", "session_seq")


@register("user_journey")
def q_user_journey(spark, sf_dir):
    return X.journeys(_sessions(spark, sf_dir), tie="event_id")


@register("journey_steps")
def q_journey_steps(spark, sf_dir):
    return X.journey_steps(_sessions(spark, sf_dir))


@register("event_type_counts")
def q_event_type_counts(spark, sf_dir):
    return X.event_type_counts(tb.silver(spark, sf_dir))


@register("dq_report_bronze")
def q_dq_report_bronze(spark, sf_dir):
    return Q.report(Q.bronze_profile(tb.bronze(spark, sf_dir)), "bronze", "nulls_and_distincts")


@register("dq_report_silver")
def q_dq_report_silver(spark, sf_dir):
    # profile and UNKNOWN counts in one aggregation pass over silver
    both = Q.silver_profile(tb.silver(spark, sf_dir), with_unknowns=True)
    unknowns = {c: "unknown_values" for c in both.columns if c.endswith("_unknowns")}
    return Q.report(both, "silver", "nulls_and_distincts", checks=unknowns)


# --- long codes, stored tables and CSV files -----------------------------------------------

@register("silver_long_codes")
def q_silver_long_codes(spark, sf_dir):
    """Codes of up to 100 characters pass through silver whole."""
    b = tb.bronze_src(spark, sf_dir)
    code = F.rpad(F.coalesce("category_code", F.lit("none")), 100, ".x")
    long_ = b.withColumn("category_code", F.when(F.col("event_id") % 3 == 0, code).otherwise(F.col("category_code")))
    return T.to_silver(long_, keep=("event_id",)).select("event_id", "category", "subcategory")


@register("stored_inventory")
def q_stored_inventory(spark, sf_dir):
    """M3 over silver written by month to the shared folder."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stored-inventory-{uuid.uuid4().hex}"
    P.with_partition(tb.silver(spark, sf_dir)).hint("rebalance", P.PARTITION_COLUMN).write.partitionBy(P.PARTITION_COLUMN).parquet(path)
    found = P.stored_partition_inventory(spark.read.parquet(path))
    # files and their size vary with the cluster; that there are some does not
    return found.select(F.col(P.PARTITION_COLUMN).cast("string").alias(P.PARTITION_COLUMN), "row_count", (F.col("file_count") >= 1).alias("has_files"))


def _csv_text(spark, sf_dir):
    return CSV.read_events_text(spark, tb.write_csv_files(spark, sf_dir))


@register("csv_ingest")
def q_csv_ingest(spark, sf_dir):
    """Rows accepted from CSV files of several layouts."""
    accepted, _ = CSV.to_bronze_rows(_csv_text(spark, sf_dir))
    return accepted.drop(CSV.SOURCE_FILE)


@register("csv_head_n")
def q_csv_head_n(spark, sf_dir):
    """The accepted ones of the first 100 rows of each of five CSV files; no
    file is read beyond them."""
    text = CSV.read_events_text(spark, tb.write_csv_heads(spark, sf_dir), first=100)
    accepted, _ = CSV.to_bronze_rows(CSV.head_n_per_file(text, 100))
    return accepted.drop(CSV.SOURCE_FILE, CSV.ROW_INDEX)


@register("csv_rejects")
def q_csv_rejects(spark, sf_dir):
    """Rows rejected from the same files, by reason."""
    _, rejects = CSV.to_bronze_rows(_csv_text(spark, sf_dir))
    return rejects.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rows"))


@register("medallion_layers")
def q_medallion_layers(spark, sf_dir):
    """The whole run (W1-W8) on those files, then one more file as an increment
    (run twice under one load id): rows and key checks of every table."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lake-{uuid.uuid4().hex}"
    files = tb.write_csv_files(spark, sf_dir)
    lh = S.Lakehouse(spark, root)
    M.run_medallion(spark, files[:-1], root, recreate=True)
    for _ in range(2):
        M.load_bronze_increment(lh, files[-1:], load_id="again")
    return _table_counts(lh)


def _table_counts(lh):
    counts = []
    for name in (S.BRONZE, S.BRONZE_REJECTS, S.SILVER, S.DIM_PRODUCTS, S.FACT):
        t = lh.frozen(name)  # the files: more may be published later
        ids = F.sum("product_id").cast("long") if name != S.BRONZE_REJECTS else F.lit(None).cast("long")
        key = F.max("event_key") if name == S.FACT else F.lit(None).cast("long")
        keys = F.countDistinct("event_key") if name == S.FACT else F.lit(None).cast("long")
        counts.append(t.agg(F.count(F.lit(1)).alias("rows"), ids.alias("sum_product_id"), key.alias("max_key"), keys.alias("distinct_keys")).withColumn("table_name", F.lit(name)))
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@register("medallion_stream")
def q_medallion_stream(spark, sf_dir):
    """The same tables by a file stream: two drops of files, a run after each,
    and one run more that finds nothing new."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lake-{uuid.uuid4().hex}"
    lh = S.Lakehouse(spark, root)
    lh.create(recreate=True)
    for drop in ((0,), (1, 2), ()):
        if drop:
            tb.write_csv_files(spark, sf_dir, f"{root}/incoming", drop)
        ingest_new_files(lh, f"{root}/incoming", downstream=True)
    return _table_counts(lh)


@register("medallion_checks")
def q_medallion_checks(spark, sf_dir):
    """The verdicts that a whole run records."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lake-{uuid.uuid4().hex}"
    M.run_medallion(spark, tb.write_csv_files(spark, sf_dir), root, recreate=True)
    return S.Lakehouse(spark, root).frozen(S.DQ_RESULTS).drop("run_at")


@register("dq_incremental_profiles")
def q_dq_incremental_profiles(spark, sf_dir):
    """The metrics of all layers after three loads, from their states."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lake-{uuid.uuid4().hex}"
    lh = S.Lakehouse(spark, root)
    lh.create(recreate=True)
    for files in tb.write_csv_files(spark, sf_dir):
        M.load_bronze_increment(lh, files)
        M.update_profiles(lh)
    return M.incremental_metrics(lh)


@register("dq_orphans_filtered")
def q_dq_orphans_filtered(spark, sf_dir):
    """The check of `dq_referential_integrity` with a filter of the orphans'
    keys in front of the exact join."""
    silver = tb.silver(spark, sf_dir)
    old = (F.col("event_date") < F.lit(STALE_DIM_DATE).cast("date")) & (F.col("event_type") == "purchase")
    stale = T.to_dim_products(silver.where(old))
    return Q.referential_integrity(T.to_fact_columns(silver), stale, filtered=True)


@register("load_stamps")
def q_load_stamps(spark, sf_dir):
    """L2: rows of each of three loads, each under one stamp of its own."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lake-{uuid.uuid4().hex}"
    lh = S.Lakehouse(spark, root)
    lh.create(recreate=True)
    for files in tb.write_csv_files(spark, sf_dir):
        M.load_bronze(lh, files)
    layout = F.regexp_extract("source_file", "layout([0-9])", 1).cast("int")
    stamps = lh.frozen(S.BRONZE).groupBy(layout.alias("layout")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("loaded_at").alias("first"), F.max("loaded_at").alias("last"))
    other = stamps.select(F.col("layout").alias("other"), F.col("last").alias("other_last"))
    earlier = stamps.join(other, F.col("other") < F.col("layout"), "left").groupBy("layout", "rows", "first", "last").agg(F.max("other_last").alias("before"))
    once = (F.col("first") == F.col("last")) & (F.col("before").isNull() | (F.col("before") < F.col("first")))
    return earlier.select("layout", "rows", once.alias("one_later_stamp"))
