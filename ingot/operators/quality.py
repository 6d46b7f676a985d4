"""Data-quality checks of the three layers, as DataFrames.

Every check returns a DataFrame (violation rows, or a one-row profile)
instead of printing.  Profiles read their table once: rows are first reduced
to the distinct combinations of the columns to be counted (partial aggregation
on the map side), distinct counts run over that.  `report` and `summary` turn
results into (metric, value, status) rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ingot import schemas
from ingot.operators.joins import anti_join, anti_join_filtered, join_dimension

# Status words of the report tables.
WARN, PASS, OK = "WARN", "PASS", "OK"


# --- generic building blocks (A1-A4, A6-A8) ---------------------------------

def count_nulls(c: str) -> Column:
    """`SUM(CASE WHEN c IS NULL THEN 1 ELSE 0 END)` (NULL on no rows)."""
    return F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("long")


def count_equal(c: str, value: str) -> Column:
    """`SUM(CASE WHEN c = value THEN 1 ELSE 0 END)`."""
    return F.sum(F.when(F.col(c) == F.lit(value), 1).otherwise(0)).cast("long")


def _collated(c: str, collation: str | None) -> Column:
    col = F.col(c)
    if collation and isinstance(collation, str):
        return F.collate(col, collation)
    return col


def count_distinct(c: str, exact: bool = True, collation: str | None = None) -> Column:
    """`COUNT(DISTINCT c)` (NULL not counted); HLL sketch if not exact.

    `collation='UTF8_LCASE'` counts text case-insensitively (the usual
    default collation of the source database); numbers are unaffected.
    """
    if exact:
        return F.countDistinct(_collated(c, collation))
    return F.approx_count_distinct(_collated(c, collation))


def profile(
    df: DataFrame,
    nulls: Sequence[tuple[str, str]] = (),
    unknowns: Sequence[tuple[str, str]] = (),
    distincts: Sequence[tuple[str, str]] = (),
    total: str | None = "total_rows",
    exact: bool = True,
    collation: str | None = None,
) -> DataFrame:
    """One-row profile in one pass over the table.

    `nulls`, `unknowns`, `distincts` are (column, output name) pairs;
    `collation` applies to the distinct counts of text columns.

    Exact distinct counts are taken in two levels: the counters are summed per
    combination of the counted columns, then the combinations are counted, so
    the copies that several distinct counts need are of the reduced rows.
    """
    text = {f.name for f in df.schema if f.dataType.typeName() == "string"}
    counters = [F.count(F.lit(1)).alias(total)] if total else []
    counters += [count_nulls(c).alias(n) for c, n in nulls]
    counters += [count_equal(c, schemas.UNKNOWN).alias(n) for c, n in unknowns]
    distinct = [count_distinct(c, exact, collation if c in text else None).alias(n) for c, n in distincts]
    if not exact or not distincts:
        return df.agg(*counters, *distinct)
    names = ([total] if total else []) + [n for _, n in (*nulls, *unknowns)]
    combinations = df.groupBy(*[c for c, _ in distincts]).agg(*counters)
    sums = [F.sum(n).cast("long").alias(n) for n in names]
    if total:  # a table without rows has none, not NULL
        sums[0] = F.coalesce(F.sum(total), F.lit(0)).cast("long").alias(total)
    return combinations.agg(*sums, *distinct)


def repeated_keys(df: DataFrame, key: str, count_name: str = "duplicate_count") -> DataFrame:
    """`GROUP BY key HAVING COUNT(*) > 1` -> (key, count); NULL is a group."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias(count_name))
        .where(F.col(count_name) > 1)
    )


def count_repeated_keys(df: DataFrame, key: str, name: str = "total_duplicates") -> DataFrame:
    """Number of key values seen more than once (aggregate of aggregate)."""
    return repeated_keys(df, key).agg(F.count(F.lit(1)).alias(name))


# --- mergeable profiles ------------------------------------------------------------

#: Rows of a profile's state: counters (`n`), distinct values (`value`), sketches.
STATE = "kind STRING, name STRING, n BIGINT, value STRING, sketch BINARY"


def profile_state(
    df: DataFrame,
    nulls: Sequence[tuple[str, str]] = (),
    unknowns: Sequence[tuple[str, str]] = (),
    distincts: Sequence[tuple[str, str]] = (),
    total: str | None = "total_rows",
    sketched: Sequence[str] = (),
) -> DataFrame:
    """What `profile` needs to know of `df`, as rows that add up with those of
    other parts of the table: a counter each, and for each distinct count its
    values (or, for the columns in `sketched`, an HLL sketch of them)."""
    counters = [F.count(F.lit(1)).alias(total)] if total else []
    counters += [F.coalesce(count_nulls(c), F.lit(0)).alias(n) for c, n in nulls]
    counters += [F.coalesce(count_equal(c, schemas.UNKNOWN), F.lit(0)).alias(n) for c, n in unknowns]
    names = ([total] if total else []) + [n for _, n in (*nulls, *unknowns)]
    row = lambda kind, name, n="CAST(NULL AS BIGINT)", value="CAST(NULL AS STRING)", sketch="CAST(NULL AS BINARY)": [
        F.lit(kind).alias("kind"), F.expr(name).alias("name"), F.expr(n).alias("n"), F.expr(value).alias("value"), F.expr(sketch).alias("sketch")]
    exact, rough = [d for d in distincts if d[0] not in sketched], [d for d in distincts if d[0] in sketched]
    sketches = [F.hll_sketch_agg(F.col(c).cast("string"), 14).alias(n) for c, n in rough]
    one = df.agg(*counters, *sketches)
    out = one.select(*names).unpivot([], names, "name", "n").select(*row("counter", "name", "n"))
    for _, n in rough:
        out = out.unionByName(one.select(*row("sketch", f"'{n}'", sketch=n)))
    if exact:
        values = F.array(*[F.struct(F.lit(n).alias("name"), F.col(c).cast("string").alias("value")) for c, n in exact])
        seen = df.select(*[c for c, _ in exact]).distinct().select(F.explode(values).alias("x")).select("x.*").where("value IS NOT NULL").distinct()
        out = out.unionByName(seen.select(*row("value", "name", value="value")))
    return out


def merged_profile(states: DataFrame, nulls: Sequence[tuple[str, str]] = (), unknowns: Sequence[tuple[str, str]] = (), distincts: Sequence[tuple[str, str]] = (),
                   total: str | None = "total_rows", sketched: Sequence[str] = ()) -> DataFrame:
    """The row of `profile` from the states of all parts."""
    names = ([total] if total else []) + [n for _, n in (*nulls, *unknowns)]
    kind = lambda k, n: (F.col("kind") == k) & (F.col("name") == n)
    values = states.where("kind = 'value'").select("kind", "name", F.lit(1).cast("long").alias("n"), "value", F.lit(None).cast("binary").alias("sketch")).distinct()
    rest = states.where("kind <> 'value'").select("kind", "name", "n", "value", "sketch").unionByName(values)
    out = [F.coalesce(F.sum(F.when(kind("counter", n), F.col("n"))), F.lit(0)).alias(n) for n in names]
    for c, n in distincts:
        if c in sketched:
            out.append(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(F.when(kind("sketch", n), F.col("sketch")))), F.lit(0)).alias(n))
        else:
            out.append(F.coalesce(F.sum(F.when(kind("value", n), F.col("n"))), F.lit(0)).alias(n))
    return rest.agg(*out)


# --- bronze checks -----------------------------------------------------------

def invalid_ids(bronze: DataFrame) -> DataFrame:
    """Q1: rows with `product_id <= 0 OR category_id <= 0` (NULL never matches)."""
    return bronze.where((F.col("product_id") <= 0) | (F.col("category_id") <= 0))


BRONZE_NULL_COLS = (
    "event_time", "event_type", "product_id", "category_id", "category_code",
    "brand", "price", "user_id", "user_session",
)


#: What the profiles count, for `profile`, `profile_state` and `merged_profile`.
BRONZE_PROFILE = {
    "nulls": [(c, f"null_{c}") for c in BRONZE_NULL_COLS],
    "distincts": [(c, f"total_distinct_{c}") for c in ("category_code", "brand", "product_id")],
}


def bronze_profile(bronze: DataFrame, exact: bool = True) -> DataFrame:
    """Q2: total, nine NULL counts, three distinct counts."""
    return profile(bronze, **BRONZE_PROFILE, exact=exact)


def duplicate_products(df: DataFrame) -> DataFrame:
    """Q3 / Q6: how many product ids occur on more than one row."""
    return count_repeated_keys(df, "product_id")


# --- silver checks -----------------------------------------------------------

SILVER_UNKNOWN_COLS = ("category", "subcategory", "brand", "user_session")


SILVER_PROFILE = {
    "nulls": [("event_time_only", "null_event_time"), ("event_date", "null_event_date")]
    + [(c, f"null_{c}") for c in ("event_type", "product_id", "category_id", "brand", "price", "user_id", "user_session")],
    "unknowns": [(c, f"{c}_unknowns") for c in SILVER_UNKNOWN_COLS],
    "distincts": [(c, f"total_distinct_{c}") for c in ("category", "subcategory", "brand", "product_id")],
}


def silver_profile(silver: DataFrame, exact: bool = True, with_unknowns: bool = False) -> DataFrame:
    """Q4: total, nine NULL counts (event time means the time-of-day column),
    four distinct counts; with `with_unknowns` also Q5's four UNKNOWN
    counts in the same pass."""
    return profile(silver, **SILVER_PROFILE | ({} if with_unknowns else {"unknowns": ()}), exact=exact)


def silver_unknowns(silver: DataFrame) -> DataFrame:
    """Q5: UNKNOWN filler counts of four columns."""
    return profile(
        silver,
        unknowns=[(c, f"{c}_unknowns") for c in SILVER_UNKNOWN_COLS],
        total=None,
    )


# --- gold checks ---------------------------------------------------------------

def event_key_duplicates(fact: DataFrame) -> DataFrame:
    """Q7: (event_key, duplicate_count) for keys stored more than once."""
    return repeated_dense_keys(fact, "event_key")


def repeated_dense_keys(df: DataFrame, key: str, count_name: str = "duplicate_count") -> DataFrame:
    """`repeated_keys` of integers that are mostly dense and unique.

    64 neighbouring keys make one word: their bits and their number, reduced
    where they are read, so a file of consecutive keys sends a 64th of its
    rows.  A word with fewer bits than keys holds a repeated one, and only the
    rows of such words (or a NULL key) are grouped by key; where there are
    none, AQE drops that second reading."""
    k = F.col(key)
    words = df.groupBy(F.shiftright(k, 6).alias("_word")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(`{key}` & 63 AS INT))")).alias("_bits"), F.count(F.lit(1)).alias("_n"))
    full = words.where(F.coalesce(F.bit_count("_bits"), F.lit(1)) < F.col("_n")).select("_word")
    rows = df.select(key, F.shiftright(k, 6).alias("_row_word")).join(full, F.col("_row_word").eqNullSafe(F.col("_word")), "left_semi")
    return repeated_keys(rows, key, count_name)


FACT_NULL_COLS = (
    "event_key", "event_date", "event_time_only", "event_type", "product_id",
    "category", "subcategory", "price", "user_id", "user_session",
)


FACT_PROFILE = {
    "nulls": [(c, f"{c}_null_count") for c in FACT_NULL_COLS],
    "unknowns": [(c, f"{c}_unknown_count") for c in ("category", "subcategory")],
    "distincts": [(c, f"total_distinct_{c}") for c in ("category", "subcategory", "product_id")],
}


def fact_profile(fact: DataFrame, exact: bool = True) -> DataFrame:
    """Q8: total, ten NULL counts, two UNKNOWN counts, three distinct counts."""
    return profile(fact, **FACT_PROFILE, exact=exact)


def referential_integrity(fact: DataFrame, dim: DataFrame, filtered: bool = False) -> DataFrame:
    """Q9: fact product ids with no dimension row (NULL ids included,
    duplicates kept), i.e. `LEFT JOIN ... WHERE p.product_id IS NULL`.
    `filtered` shuffles suspects only, for a fact and a dimension too large to
    shuffle or broadcast."""
    return (anti_join_filtered if filtered else anti_join)(fact.select("product_id"), dim, "product_id")


def consistency(
    silver: DataFrame,
    dim: DataFrame,
    collation: str | None = None,
    checks: Sequence[str] = ("brand", "category"),
) -> DataFrame:
    """Q10, both copies fused into one join and one aggregation.

    Counts distinct brands / category ids on rows whose value differs from
    the dimension's, taken from the silver side (pipeline copy) and from the
    dimension side (standalone copy).  NULLs never count as mismatches.
    `collation='UTF8_LCASE'` compares brands case-insensitively; `checks`
    names the differences asked for, and only rows with one of them go on.
    """
    d = dim.select(
        "product_id",
        F.col("brand").alias("_dim_brand"),
        F.col("category_id").alias("_dim_category_id"),
    )
    j = join_dimension(silver.select("product_id", "brand", "category_id"), d, "product_id")
    brand_diff = _collated("brand", collation) != _collated("_dim_brand", collation)
    cat_diff = F.col("category_id") != F.col("_dim_category_id")
    differs, counts = F.lit(False), []
    if "brand" in checks:
        differs = differs | brand_diff
        counts += [
            F.countDistinct(F.when(brand_diff, _collated("brand", collation))).alias("mismatched_brands_silver"),
            F.countDistinct(F.when(brand_diff, _collated("_dim_brand", collation))).alias("mismatched_brands_dim"),
        ]
    if "category" in checks:
        differs = differs | cat_diff
        counts += [
            F.countDistinct(F.when(cat_diff, F.col("category_id"))).alias("mismatched_categories_silver"),
            F.countDistinct(F.when(cat_diff, F.col("_dim_category_id"))).alias("mismatched_categories_dim"),
        ]
    # only differing rows can count, and each pair of values once: what the
    # distinct counts copy is the reduced relation
    pairs = j.where(differs).select("brand", "category_id", "_dim_brand", "_dim_category_id").distinct()
    return pairs.agg(*counts)


# --- previews and reports (B1, R1, R2) -----------------------------------------

def preview(violations: DataFrame, order_by: Sequence[str], n: int = 20) -> DataFrame:
    """First `n` violation rows in a stable order (top-k, no full collect)."""
    return violations.orderBy(*order_by).limit(n)


def report(
    one_row: DataFrame,
    layer: str,
    check: str,
    warn_words: Sequence[str] = ("null", "unknown"),
    checks: dict[str, str] | None = None,
) -> DataFrame:
    """Wide one-row profile -> (layer, check_name, metric, value, status).

    status is WARN when the value is above 0 and the metric name mentions a
    NULL or UNKNOWN count; NULL sums (empty table) are reported as 0.
    `checks` names a different check for some metrics (a fused profile).
    """
    metrics = one_row.columns
    longs = one_row.select(*[F.col(c).cast("long").alias(c) for c in metrics])
    tall = longs.unpivot([], metrics, "metric", "value")
    value = F.coalesce(F.col("value"), F.lit(0).cast("long"))
    name = F.lower(F.col("metric"))
    flagged = F.lit(False)
    for w in warn_words:
        flagged = flagged | name.contains(w)
    check_name = F.lit(check)
    for metric, other in (checks or {}).items():
        check_name = F.when(F.col("metric") == metric, F.lit(other)).otherwise(check_name)
    return tall.select(
        F.lit(layer).alias("layer"),
        check_name.alias("check_name"),
        F.col("metric"),
        value.alias("value"),
        F.when((value > 0) & flagged, F.lit(WARN)).otherwise(F.lit(OK)).alias("status"),
    )


def verdicts(counts: DataFrame) -> DataFrame:
    """R2: (layer, check_name, n) rows -> (layer, check_name, violations, status)."""
    v = F.coalesce(F.col("n").cast("long"), F.lit(0).cast("long"))
    return counts.select(
        "layer",
        "check_name",
        v.alias("violations"),
        F.when(v > 0, F.lit(WARN)).otherwise(F.lit(PASS)).alias("status"),
    )


def _stack(one_row: DataFrame, checks: Sequence[tuple[str, str, str]]) -> DataFrame:
    """One row of counts -> (layer, check_name, n) rows."""
    rows = ", ".join(f"'{layer}', '{check}', CAST({column} AS BIGINT)" for layer, check, column in checks)
    return one_row.select(F.expr(f"stack({len(checks)}, {rows}) AS (layer, check_name, n)"))


def summary(bronze: DataFrame, silver: DataFrame, dim: DataFrame, fact: DataFrame) -> DataFrame:
    """R2 over all layers: one verdict row per check.

    Bronze is read once, silver twice (its own checks, and the consistency
    join), of the fact its keys and its product ids, which are reduced where
    they are read.
    """
    repeated = F.sum(F.when(F.col("_rows") > 1, 1).otherwise(0))
    invalid = (F.col("product_id") <= 0) | (F.col("category_id") <= 0)
    b = bronze.groupBy("product_id").agg(F.count(F.lit(1)).alias("_rows"), F.sum(F.when(invalid, 1).otherwise(0)).alias("_bad"))
    b = b.agg(F.sum("_bad").alias("invalid"), repeated.alias("repeated"))
    unknown = sum((F.when(F.col(c) == schemas.UNKNOWN, 1).otherwise(0) for c in SILVER_UNKNOWN_COLS), F.lit(0))
    s = silver.groupBy("product_id").agg(F.count(F.lit(1)).alias("_rows"), F.sum(unknown).alias("_unknown"))
    s = s.agg(F.sum("_unknown").alias("unknown"), repeated.alias("repeated"))
    keys = dim.select(F.col("product_id").alias("_known")).distinct()
    f = repeated_dense_keys(fact.select("event_key"), "event_key").agg(F.count(F.lit(1)).alias("repeated"))
    # one row a product: a third of the fact without an id is one of them
    o = fact.groupBy("product_id").agg(F.count(F.lit(1)).alias("_rows"))
    o = join_dimension(o, keys, F.col("product_id") == F.col("_known"), "left").agg(F.sum(F.when(F.col("_known").isNull(), F.col("_rows"))).alias("orphans"))
    counts = [
        _stack(b, [("bronze", "invalid_ids", "invalid"), ("bronze", "duplicate_product_ids", "repeated")]),
        _stack(s, [("silver", "duplicate_product_ids", "repeated"), ("silver", "unknown_values", "unknown")]),
        _stack(f, [("gold", "event_key_duplicates", "repeated")]), _stack(o, [("gold", "referential_integrity", "orphans")]),
        _stack(consistency(silver, dim), [("gold", "brand_mismatches", "mismatched_brands_silver"), ("gold", "category_mismatches", "mismatched_categories_silver")]),
    ]
    out = counts[0]
    for part in counts[1:]:
        out = out.unionByName(part)
    return verdicts(out)
