"""The bronze -> silver -> gold jobs and their checks.

Each layer is one lazy DataFrame plan ended by one write; checks return
DataFrames, and `run_medallion` records their verdicts in a results
table.  Nothing gates on a check unless `fail_on` asks for it.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ingot.operators import quality as Q
from ingot.operators.keys import next_key_start, with_surrogate_key
from ingot.operators.transforms import to_dim_products, to_fact_columns, to_silver
from ingot.plans import sinks as S
from ingot.sources import csv as CSV


@dataclass
class LoadReport:
    rows_loaded: int = 0
    rows_rejected: int = 0


# --- W1 / W2: bronze ------------------------------------------------------------

def load_bronze(
    lh: S.Lakehouse,
    source: str | list[str],
    limit_per_file: int | None = None,
    on_error: str = "quarantine",
) -> LoadReport:
    """Append every CSV matching `source` to bronze.

    `limit_per_file=10_000` reproduces the source loader's test mode (first
    chunk of each file); the default loads whole files.  Rejected rows go to
    the rejects table with their reason; `on_error='skip_file'` rejects the
    whole file with them, as the source does.  The text is parsed once; row
    counts are observed during the writes, without another scan.
    """
    text = CSV.head_n_per_file(CSV.read_events_text(lh.spark, source, first=limit_per_file), limit_per_file)
    parts = _write_bronze(lh, text, on_error, uuid.uuid4().hex)
    lh.publish(*parts)
    CSV.drop_staging(text)
    return LoadReport(parts[0].rows, sum(p.rows for p in parts[1:]))


def _write_bronze(lh: S.Lakehouse, text: DataFrame, on_error: str, load_id: str) -> list[S.Part]:
    """The load's part of bronze, and that of the rejects if there are any
    (their pass only runs when something was rejected)."""
    counter = Observation(f"bronze_rejected_{uuid.uuid4().hex}")
    accepted, rejects = CSV.to_bronze_rows(text, on_error=on_error, reject_counter=counter)
    parts = [lh.write(CSV.with_load_stamp(accepted), S.BRONZE, load_id)]
    if int(S.observed(counter).get("rejected") or 0):
        parts.append(lh.write(CSV.with_load_stamp(rejects), S.BRONZE_REJECTS, load_id))
    return parts


def bronze_file_counts(lh: S.Lakehouse) -> DataFrame:
    """Rows per source file stored in bronze (L6 report)."""
    return lh.table(S.BRONZE).groupBy("source_file").agg(F.count(F.lit(1)).alias("rows_loaded"))


def bronze_checks(lh: S.Lakehouse) -> dict[str, DataFrame]:
    b = lh.table(S.BRONZE)
    return {
        "invalid_ids": Q.invalid_ids(b),
        "nulls_and_distincts": Q.bronze_profile(b),
        "duplicate_products": Q.duplicate_products(b),
    }


# --- W3 / W4: silver --------------------------------------------------------------

def load_silver(lh: S.Lakehouse) -> None:
    """Full refresh of silver from bronze (T7 + L3), partitioned by month.
    Every bronze row is kept: the split columns are as wide as the code."""
    lh.overwrite(lh.partitioned(to_silver(lh.table(S.BRONZE))), S.SILVER)


def silver_checks(lh: S.Lakehouse) -> dict[str, DataFrame]:
    s = lh.table(S.SILVER)
    return {
        "nulls_and_distincts": Q.silver_profile(s),
        "unknown_values": Q.silver_unknowns(s),
        "duplicate_products": Q.duplicate_products(s),
    }


# --- W5 / W6 / W7: gold -------------------------------------------------------------

def load_dim_products(lh: S.Lakehouse, collation: str | None = None, strict: bool = False) -> int:
    """Full refresh of the product dimension (G1 + L3).

    Events without a product id cannot form a dimension row (NOT NULL key):
    they are summarised in the dim rejects table (or raise with strict).
    Returns the number of such events.
    """
    parts, events = _write_dim(lh, lh.table(S.SILVER), uuid.uuid4().hex, collation)
    if events and strict:
        raise ValueError(f"{events} silver events have no product_id")
    lh.publish(*parts)
    return events


def _write_dim(lh: S.Lakehouse, silver: DataFrame, load_id: str, collation: str | None = None, merge: bool = False) -> tuple[list[S.Part], int]:
    """A new version of the dimension, and a rejects part that sums up the
    events without a product id (and their number); these are profiled while
    the dimension is written, in the same pass over `silver`.

    `merge` takes MAX over the stored dimension and the new rows: a repeat
    changes nothing, and the new version may be made from the old one.
    """
    missing, obs = F.col("product_id").isNull(), Observation(f"dim_missing_{uuid.uuid4().hex}")
    seen = silver.observe(obs, F.sum(F.when(missing, 1).otherwise(0)).alias("events"),
                          F.max(F.when(missing, F.col("category_id"))).alias("category_id"), F.max(F.when(missing, F.col("brand"))).alias("brand"))
    dim = to_dim_products(seen, collation=collation)
    if merge:
        dim = to_dim_products(lh.table(S.DIM_PRODUCTS).select(*dim.columns).unionByName(dim))
    parts, m = [lh.write(dim, S.DIM_PRODUCTS, load_id, "overwrite")], S.observed(obs)
    events = int(m.get("events") or 0)
    if events:
        row = lh.spark.createDataFrame([(m.get("category_id"), m.get("brand"), events, "product_id is null")], "category_id bigint, brand string, events bigint, reject_reason string")
        parts.append(lh.write(S.stamp(row), S.DIM_REJECTS, load_id))
    return parts, events


def logged_key(lh: S.Lakehouse, verify: bool = False) -> int:
    """Last key of the stored fact according to the journal.

    `verify=True` compares the journal with the stored rows and takes the
    largest stored key instead if rows came without their keys being noted;
    that opens every fact file, so it is done on demand only.
    """
    noted = [p for p in lh.parts(S.FACT)[S.FACT] if p.last_key is not None]
    if verify and sum(p.rows for p in noted) != lh.table(S.FACT).count():
        return next_key_start(lh.table(S.FACT))
    return max((p.last_key for p in noted), default=0)


def _write_fact(lh: S.Lakehouse, silver: DataFrame, load_id: str, mode: str = "append", verify: bool = False) -> S.Part:
    start = logged_key(lh, verify) if mode == "append" else 0
    fact = with_surrogate_key(to_fact_columns(silver), start=start, stable_input=True)
    # silver's files hold a month each, and keys follow them: the rows are
    # written where they are read, and a file's keys are nearly consecutive
    return lh.write(lh.partitioned(fact), S.FACT, load_id, mode, key="event_key", by_month=True)


def load_fact(lh: S.Lakehouse, mode: str = "append", verify: bool = False) -> int:
    """Load the fact from silver with dense surrogate keys (T8 + K1 + L4).

    mode='append' (the source's behaviour): every run adds all of silver
    again under new keys continuing after the largest noted key.
    mode='overwrite': idempotent reruns, keys restart at 1.
    Silver is read straight from its files, a deterministic scan, so the
    key assignment needs no extra checkpoint.
    """
    part = _write_fact(lh, lh.frozen(S.SILVER), uuid.uuid4().hex, mode, verify)
    lh.publish(part)
    return part.rows


# --- increments -------------------------------------------------------------------------

def load_bronze_increment(
    lh: S.Lakehouse,
    source: str | list[str],
    limit_per_file: int | None = None,
    on_error: str = "quarantine",
    load_id: str | None = None,
) -> dict:
    """Batch flavour of the incremental path: load the files into bronze and
    carry exactly those rows on to silver, the dimension and the fact."""
    if load_id and (done := lh.load_parts(load_id)):
        return _load_report(load_id, done)
    text = CSV.head_n_per_file(CSV.read_events_text(lh.spark, source, first=limit_per_file), limit_per_file)
    return increment_from_text(lh, text, on_error, load_id)


def bronze_from_text(lh: S.Lakehouse, text: DataFrame, on_error: str = "quarantine", load_id: str | None = None) -> str:
    """Append a text scan to bronze and its rejects, once per `load_id`."""
    load_id = load_id or uuid.uuid4().hex
    if not lh.load_parts(load_id):
        lh.publish(*_write_bronze(lh, text, on_error, load_id))
    CSV.drop_staging(text)
    return load_id


def increment_from_text(lh: S.Lakehouse, text: DataFrame, on_error: str = "quarantine", load_id: str | None = None) -> dict:
    """Carry a text scan (or a stream's micro-batch) through all layers.

    Equivalent to the full refresh when bronze is append-only, at the cost of
    the new rows plus the dimension: the load's part of bronze becomes its part
    of silver, which is merged into the dimension (MAX over old dimension and
    new rows is the MAX over all rows) and becomes its part of the fact, under
    keys that continue the noted ones.  Each step reads the part before it, no
    other file.  All parts are published together, at the end and once per
    `load_id`: a load that broke off has published nothing and is run again.
    """
    load_id = load_id or uuid.uuid4().hex
    if done := lh.load_parts(load_id):
        CSV.drop_staging(text)
        return _load_report(load_id, done)
    parts = _write_bronze(lh, text, on_error, load_id)
    silver = lh.write(lh.partitioned(to_silver(lh.read(parts[0]))), S.SILVER, load_id)
    mine = lh.read(silver)
    dim, missing = _write_dim(lh, mine, load_id, merge=True)
    parts += [silver, *dim, _write_fact(lh, mine, load_id)]
    lh.publish(*parts)
    CSV.drop_staging(text)
    return _load_report(load_id, {p.table: p for p in parts}, missing)


def _load_report(load_id: str, parts: dict[str, S.Part], missing: int | None = None) -> dict:
    rows = {t: p.rows for t, p in parts.items()}
    return {"load_id": load_id, "silver_rows": rows.get(S.SILVER, 0), "dim_events_without_product": missing, "bronze_rejects": rows.get(S.BRONZE_REJECTS, 0)}


def gold_checks(lh: S.Lakehouse) -> dict[str, DataFrame]:
    f, d, s = lh.table(S.FACT), lh.table(S.DIM_PRODUCTS), lh.table(S.SILVER)
    return {
        "event_key_duplicates": Q.event_key_duplicates(f),
        "fact_nulls_unknowns": Q.fact_profile(f),
        "referential_integrity": Q.referential_integrity(f, d),
        "brand_category_consistency": Q.consistency(s, d),
    }


def dq_metrics(lh: S.Lakehouse, exact: bool = True) -> DataFrame:
    """R1 over all layers: every profile value as (layer, check, metric, value, status).

    The printed profiles of the source's DQ flows, as one relation: one
    aggregation pass each over bronze, silver (profile and UNKNOWN counts
    fused) and the fact.
    """
    b, s, f = lh.table(S.BRONZE), lh.table(S.SILVER), lh.table(S.FACT)
    silver_both = Q.silver_profile(s, exact=exact, with_unknowns=True)
    unknown_metrics = [c for c in silver_both.columns if c.endswith("_unknowns")]
    parts = [
        Q.report(Q.bronze_profile(b, exact=exact), "bronze", "nulls_and_distincts"),
        Q.report(silver_both, "silver", "nulls_and_distincts",
                 checks={m: "unknown_values" for m in unknown_metrics}),
        Q.report(Q.fact_profile(f, exact=exact), "gold", "fact_nulls_unknowns"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- profiles after an increment --------------------------------------------------------

PROFILED = {S.BRONZE: ("bronze", "nulls_and_distincts", Q.BRONZE_PROFILE), S.SILVER: ("silver", "nulls_and_distincts", Q.SILVER_PROFILE), S.FACT: ("gold", "fact_nulls_unknowns", Q.FACT_PROFILE)}


def update_profiles(lh: S.Lakehouse, sketched: tuple[str, ...] = ()) -> int:
    """Store the profile states of the parts that have none yet, which are the
    loads since the last time; returns how many were read."""
    known = {r["folder"] for r in lh.table(S.PROFILES).select("folder").distinct().collect()}
    parts, new = lh.parts(*PROFILED), []
    for table, (_, _, counted) in PROFILED.items():
        for p in parts[table]:
            if p.rows and p.folder not in known:
                state = Q.profile_state(lh.read(p), **counted, sketched=sketched)
                new.append(state.withColumn("table_name", F.lit(table)).withColumn("folder", F.lit(p.folder)))
    if new:
        lh.append(reduce(DataFrame.unionByName, new), S.PROFILES)
    return len(new)


def incremental_metrics(lh: S.Lakehouse, sketched: tuple[str, ...] = ()) -> DataFrame:
    """`dq_metrics` from the stored states of the parts in use: after an
    increment only the new load has been read."""
    update_profiles(lh, sketched)
    states, out = lh.frozen(S.PROFILES), []
    for table, (layer, check, counted) in PROFILED.items():
        folders = [p.folder for p in lh.parts(table)[table] if p.rows]
        used = lh.spark.createDataFrame([(f,) for f in folders], "folder string")
        row = Q.merged_profile(states.where(F.col("table_name") == table).join(used, "folder", "left_semi"), **counted, sketched=sketched)
        named = {n: "unknown_values" for _, n in counted.get("unknowns", ())} if table == S.SILVER else None
        out.append(Q.report(row, layer, check, checks=named))
    return reduce(DataFrame.unionByName, out)


def dq_summary(lh: S.Lakehouse) -> DataFrame:
    return Q.summary(
        lh.table(S.BRONZE), lh.table(S.SILVER), lh.table(S.DIM_PRODUCTS), lh.table(S.FACT)
    )


# --- W8: the whole run ------------------------------------------------------------------

class QualityGateFailed(RuntimeError):
    pass


def run_medallion(
    spark: SparkSession,
    source: str | list[str],
    root: str,
    limit_per_file: int | None = None,
    on_error: str = "quarantine",
    fact_mode: str = "append",
    fail_on: tuple[str, ...] | None = None,
    recreate: bool = False,
    exact_distinct: bool = True,
    parallel_gold: bool = False,
    bounds: tuple[str, ...] | None = None,
) -> dict:
    """Bronze load, silver, dimension and fact, then record all checks.

    `fail_on` lists check names whose WARN verdict should stop the run
    (after recording it); by default nothing gates, as in the source.
    `parallel_gold=True` submits the dimension and fact loads (independent:
    both only read silver) as concurrent jobs.
    `exact_distinct=False` computes the profiles' distinct counts with HLL
    sketches when exact counts are not needed.  `bounds` partitions silver and
    the fact by those month ends instead of calendar months.
    """
    lh = S.Lakehouse(spark, root, bounds)
    lh.create(recreate=recreate)
    bronze = load_bronze(lh, source, limit_per_file, on_error)
    load_silver(lh)
    if parallel_gold:
        # the dimension and the fact only read silver: submit both jobs at
        # once so the tail of one overlaps the other on the cluster
        with ThreadPoolExecutor(max_workers=2, thread_name_prefix="gold") as pool:
            dim_job = pool.submit(load_dim_products, lh)
            fact_job = pool.submit(load_fact, lh, fact_mode)
            dim_missing, fact_rows = dim_job.result(), fact_job.result()
    else:
        dim_missing = load_dim_products(lh)
        fact_rows = load_fact(lh, fact_mode)
    verdicts = dq_summary(lh).withColumn("run_at", F.current_timestamp())
    verdicts = verdicts.select("run_at", "layer", "check_name", "violations", "status")
    rows = verdicts.collect()  # one row per check
    lh.append(spark.createDataFrame(rows, verdicts.schema), S.DQ_RESULTS)
    metrics = dq_metrics(lh, exact=exact_distinct).withColumn("run_at", F.lit(rows[0]["run_at"]) if rows
                                        else F.current_timestamp())
    lh.append(metrics, S.DQ_METRICS)
    result = {
        "bronze_rows": bronze.rows_loaded,
        "bronze_rejects": bronze.rows_rejected,
        "dim_events_without_product": dim_missing,
        "fact_rows": fact_rows,
        "checks": {(r["layer"], r["check_name"]): (r["violations"], r["status"]) for r in rows},
    }
    if fail_on:
        failed = [r for r in rows if r["check_name"] in fail_on and r["status"] == Q.WARN]
        if failed:
            raise QualityGateFailed(f"quality gate failed: {failed}")
    return result
