"""Column expressions for the medallion transforms.

Every function returns a `Column` built from built-in Spark functions, so
all of them run inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ingot import schemas


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- T1 / T2: timestamp -> date and rounded time of day -------------------

def event_date(ts) -> Column:
    """`CAST(ts AS DATE)`: the calendar day of a timestamp."""
    return F.to_date(_col(ts))


def time_of_day(ts) -> Column:
    """`CAST(ts AS TIME(0))` as an ``HH:mm:ss`` string.

    The cast rounds half up to the second and wraps 23:59:59.5 and later to
    00:00:00 without touching the date (the date is a separate cast).
    Adding 500 ms and keeping only hours, minutes and seconds of the text
    form does both; the text form of a TIMESTAMP_NTZ involves no time zone,
    so the result does not depend on the session's zone.
    """
    shifted = (_col(ts) + F.expr("INTERVAL 500 MILLISECONDS")).cast("string")
    return F.substr(shifted, F.lit(12), F.lit(8))


# --- T3 / T4: category path split at the first separator ------------------

def _sep_pos(code) -> Column:
    return F.instr(_col(code), schemas.CATEGORY_SEPARATOR)


def category_head(code) -> Column:
    """Text before the first dot; no dot (or NULL) gives UNKNOWN."""
    c = _col(code)
    pos = _sep_pos(c)
    return F.when(pos > 0, F.substr(c, F.lit(1), pos - 1)).otherwise(
        F.lit(schemas.UNKNOWN)
    )


def category_tail(code) -> Column:
    """Everything after the first dot (``a.b.c`` -> ``b.c``); else UNKNOWN."""
    c = _col(code)
    pos = _sep_pos(c)
    return F.when(pos > 0, F.substr(c, pos + 1)).otherwise(
        F.lit(schemas.UNKNOWN)
    )


# --- T5 / T6 ---------------------------------------------------------------

def fill_unknown(c) -> Column:
    """`ISNULL(c, 'UNKNOWN')`; an empty string stays empty."""
    return F.coalesce(_col(c), F.lit(schemas.UNKNOWN))


# --- S5 / S6: text normalisation on ingest ---------------------------------

def null_tokens(c, tokens: Iterable[str] = schemas.NA_TOKENS) -> Column:
    """NULL for any text equal to a missing-value token, else the text."""
    c = _col(c)
    return F.when(~c.isin(*tokens), c)


# A zone behind the time of day: Z, UTC/GMT, +hh:mm / +hhmm / +hh, or a region
# id such as Europe/Paris.  Without a time of day there is no zone: the end of
# a plain date such as 2019-11-01 is not an offset.
_ZONE_SUFFIX = r"(?i)\d:\d{2}(:\d{2}(\.\d+)?)?\s*(z|utc|gmt|[+-]\d{2}(:?\d{2})?|[a-z]+/[a-z_]+)$"
# +hhmm, which the cast does not read, beside +hh:mm, which it does
_SHORT_OFFSET = r"(:\d{2}(?:\.\d+)?\s*[+-]\d{2})(\d{2})$"
_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def parse_event_time(c) -> Column:
    """Parse time text to its UTC wall clock as TIMESTAMP_NTZ (NULL if bad).

    Text with a zone (``2019-11-01 00:00:00 UTC``, ``...+02:00``) is read as
    an instant and moved to UTC exactly (epoch microseconds added to the
    epoch); text without a zone is taken as UTC already, as a UTC-localising
    CSV reader does.  Neither path depends on the session's time zone.
    Unparsable text gives NULL (rejected later by the NOT NULL check).
    """
    text = F.regexp_replace(F.trim(_col(c)), _SHORT_OFFSET, "$1:$2")
    instant = text.try_cast("timestamp")
    utc_wall = F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.expr(_EPOCH_NTZ))
    naive = text.try_cast("timestamp_ntz")
    return F.when(text.rlike(_ZONE_SUFFIX), utc_wall).otherwise(naive)


# --- M1 / M2: RANGE LEFT buckets and their storage groups --------------------

def range_left_bucket(d, bounds=schemas.MONTH_BOUNDS) -> Column:
    """1-based bucket of a date for inclusive upper bounds (RANGE LEFT).

    bucket = 1 + number of bounds strictly below the date; a NULL date
    falls in bucket 1, as in a RANGE LEFT partition function.
    """
    d = _col(d)
    terms = [F.when(d > F.lit(b).cast("date"), 1).otherwise(0) for b in schemas.month_bounds(bounds)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return (F.lit(1) + total).cast("int")


def storage_group(bucket, bounds=schemas.MONTH_BOUNDS, extra: str = schemas.EXTRA_GROUP) -> Column:
    names = schemas.group_names(bounds, extra)
    return F.element_at(F.array(*[F.lit(n) for n in names]), _col(bucket))


def over_width(c, width: int) -> Column:
    """True when text is longer than a VARCHAR(width) column allows."""
    return F.coalesce(F.length(_col(c)) > width, F.lit(False))
