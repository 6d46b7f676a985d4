"""User sessions, journeys and event counts (README-described behaviour).

A new session starts when a user has been inactive for more than two hours.
`sessionize` numbers sessions per user without ordering events: a user's
timeline is cut into chunks no longer than that gap, and the sessions are
stitched from the chunks' first and last times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ingot import schemas

# Length of a chunk (at most; never longer than the gap).
CHUNK_SECONDS = 900

# Event types of the clickstream (fixed values).
EVENT_TYPES = ("view", "cart", "remove_from_cart", "purchase")


def _gap(seconds: int) -> Column:
    return F.expr(f"INTERVAL {int(seconds)} SECONDS")


def _chunk(events: DataFrame, ts: str, chunk_us: int) -> Column:
    """Number of the stretch of `chunk_us` microseconds that an event falls in."""
    micros = F.unix_micros(F.col(ts).cast("timestamp")) if dict(events.dtypes)[ts] == "timestamp" else F.timestamp_diff(
        "MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col(ts).cast("timestamp_ntz"))
    return F.floor(micros / F.lit(chunk_us)).cast("long")


def session_chunks(events: DataFrame, user: str, ts: str, gap_seconds: int, chunk_us: int) -> DataFrame:
    """`_ss_user`, `_ss_chunk`, `_ss_seq`: the session of every chunk of a
    user's timeline that holds events, from the chunks' first and last times.

    A chunk is no longer than the gap, so no session starts inside one; it
    starts one where its first event is more than the gap behind the last
    event of the chunk before."""
    spans = events.groupBy(F.col(user).alias("_ss_user"), _chunk(events, ts, chunk_us).alias("_ss_chunk")).agg(F.min(ts).alias("_ss_first"), F.max(ts).alias("_ss_last"))
    order = Window.partitionBy("_ss_user").orderBy(F.col("_ss_chunk").asc_nulls_first())
    starts = F.coalesce((F.col("_ss_first") - F.lag("_ss_last").over(order)) > _gap(gap_seconds), F.lit(False))
    flagged = spans.withColumn("_ss_new", starts.cast("long"))
    seq = 1 + F.sum("_ss_new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return flagged.select("_ss_user", "_ss_chunk", seq.alias("_ss_seq"))


def sessionize(
    events: DataFrame,
    user: str = "user_id",
    ts: str = "ts",
    gap_seconds: int = schemas.SESSION_GAP_SECONDS,
    out: str = "session_seq",
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """Add `out` = 1, 2, ... per user; a gap above `gap_seconds` starts a new one.

    A gap of exactly `gap_seconds` stays in the same session.  Events without
    a user are one user of their own; events without a time come first in
    their user's first session.

    Only the chunk summaries, partially aggregated where the events are read,
    are ordered by user.  The events themselves are joined with their chunk's
    session, never sorted: a user with a third of all events is spread over
    the chunks of their timeline.
    """
    chunk_us = max(1, 1_000_000 * min(chunk_seconds, gap_seconds))
    found = session_chunks(events, user, ts, gap_seconds, chunk_us).withColumnRenamed("_ss_chunk", "_ss_key")
    e = events.withColumn("_ss_chunk", _chunk(events, ts, chunk_us))
    same = F.col(user).eqNullSafe(F.col("_ss_user")) & F.col("_ss_chunk").eqNullSafe(F.col("_ss_key"))
    return e.join(found, same, "inner").withColumn(out, F.col("_ss_seq")).drop("_ss_chunk", "_ss_seq", "_ss_user", "_ss_key")


def journeys(
    sessions: DataFrame,
    user: str = "user_id",
    session: str = "session_seq",
    ts: str = "ts",
    event_type: str = "event_type",
    tie: str | None = None,
) -> DataFrame:
    """One row per session: span, event counts by type, first/last event type
    (ties of `ts` by the column `tie`).

    Plain aggregates (partial on the map side), so a long session is
    reduced before the shuffle rather than gathered as a list.
    """
    et = F.col(event_type)
    counts = [
        F.sum(F.when(et == F.lit(t), 1).otherwise(0)).cast("long").alias(f"n_{t}")
        for t in EVENT_TYPES
    ]
    order = F.struct(ts, tie) if tie else F.col(ts)
    return sessions.groupBy(user, session).agg(
        F.min(ts).alias("session_start"),
        F.max(ts).alias("session_end"),
        F.count(F.lit(1)).alias("n_events"),
        *counts,
        F.min_by(event_type, order).alias("first_event_type"),
        F.max_by(event_type, order).alias("last_event_type"),
    ).withColumn("converted", F.col("n_purchase") > 0)


def journey_steps(
    sessions: DataFrame,
    user: str = "user_id",
    session: str = "session_seq",
    ts: str = "ts",
    tie: str = "event_id",
    columns: tuple[str, ...] = ("event_type", "product_id"),
) -> DataFrame:
    """The journey step by step: `step` = 1, 2, ... within each session, with
    the named columns.  A row stays a row: no session is gathered as a list."""
    w = Window.partitionBy(user, session).orderBy(F.col(ts), F.col(tie))
    return sessions.select(user, session, F.row_number().over(w).alias("step"), ts, tie, *columns)


def event_type_counts(silver: DataFrame) -> DataFrame:
    """Events per day and type."""
    return silver.groupBy("event_date", "event_type").agg(F.count(F.lit(1)).alias("events"))
