"""Clickstream CSV ingest (S1-S6): text scan, per-file head-N, typing, rejects.

One `spark.read.text` covers a single file or a glob (S1/S2): the files are
split and read in parallel, and each line keeps its source file through the
scan's `_metadata` column, so nothing loops over files on the driver.  The
lines are written once, into a staging table in the shared checkpoint folder;
headers, counts, accepted and rejected rows all come from there.

A quoted field may hold separators, doubled quotes and line feeds, as in any
CSV reader, yet files stay splittable.  Each line is a map of two states, "not
in quotes" and "in quotes", to the state behind it: lines without a quote keep
the state, some turn it over, some end in one state whatever came before.  Such
maps compose, so the task that reads a split tells where every line begins, for
either state in front of the split, and a running count over the splits of a
file tells these states; the lines of a record that spans several are then
joined, across splits too.  All other lines stay where they are read.

Columns are bound by the header of each file, as a CSV reader with named
columns does: order does not matter, a column that a file lacks is NULL, short
rows are padded with NULL.  Missing-value tokens, numbers, decimals and zoned
times are typed by Spark expressions, and any value that fails becomes a reject
reason instead of an exception.
"""

from __future__ import annotations

import itertools
import re
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot import schemas
from ingot.functions import columns as C
from ingot.operators.constraints import ConstraintViolation
from ingot.session import drop_folder, ensure_checkpoint_dir, reliable_checkpoint

SOURCE_FILE = "source_file"
ROW_INDEX = "_row_in_file"
BLOCK = "_rf_block"
#: Reason of a file-level problem, beside the rows' own ones.
HEADER_REASON = "_header_reason"

_LONG_COLS = ("product_id", "category_id", "user_id")
_TEXT_COLS = ("event_type", "category_code", "brand", "user_session")


# --- quotes -------------------------------------------------------------------

class Quotes:
    """Patterns for fields between separators; valid in Java and in Python.

    A quote opens a field only at its beginning, two of them inside stand for
    one, and what follows the closing one belongs to the field as it is."""

    def __init__(self, sep: str = ","):
        s, end, text = re.escape(sep), r"(?![\s\S])", r'[^"]*+(?:""[^"]*+)*+'
        self.sep = sep
        whole, open_ = rf'(?:"{text}"[^{s}]*+|(?!")[^{s}]*+)', rf'"{text}{end}'
        behind = rf"(?:{whole}{s})*+{open_}"
        #: Of lines that begin outside and inside quotes: those which end inside.
        self.opens, self.stays = f"^{behind}", rf'^{text}(?:{end}|"[^{s}]*+{s}{behind})'
        #: A field with the separator before it, and its parts.
        self.field, self.parts = rf'{s}(?:"{text}(?:"[^{s}]*+|{end})|[^{s}]*+)', rf'^"({text})"?([\s\S]*)'

    def ends_inside(self, line: str, inside: bool) -> bool:
        return inside if '"' not in line else re.search(self.stays if inside else self.opens, line) is not None

    def fields(self, record: Column) -> Column:
        """Record -> array of text."""
        text = F.regexp_replace(record, r"\r\z", "")
        cut = F.regexp_extract_all(F.concat(F.lit(self.sep), text), F.lit(self.field), F.lit(0))

        def plain(x: Column) -> Column:
            x = F.substring(x, 2, 1 << 30)
            quoted = F.concat(F.replace(F.regexp_extract(x, self.parts, 1), F.lit('""'), F.lit('"')), F.regexp_extract(x, self.parts, 2))
            return F.when(F.startswith(x, F.lit('"')), quoted).otherwise(x)

        return F.when(F.contains(text, F.lit('"')), F.transform(cut, plain)).otherwise(F.split(text, re.escape(self.sep), -1))


# --- scan and staging ---------------------------------------------------------

def text_lines(reader) -> DataFrame:
    """Options of the text scan: lines end with a line feed alone."""
    return reader.option("lineSep", "\n")


def with_source(df: DataFrame) -> DataFrame:
    """`value`, source file and block start of each line."""
    return df.select("value", F.col("_metadata.file_path").alias(SOURCE_FILE), F.col("_metadata.file_block_start").alias(BLOCK))


def _through(out: np.ndarray, in_: np.ndarray, state: bool, begun: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of lines one after the other, the first in `state` with `begun` records
    before it: begins outside quotes? ends inside? records begun up to it."""
    turns = np.cumsum(out & ~in_)
    known = np.maximum.accumulate(np.where(out == in_, np.arange(len(out)), -1))  # the last constant line
    after = np.where(known >= 0, out[known] ^ ((turns - turns[known]) % 2 == 1), state ^ (turns % 2 == 1))
    begins = ~np.concatenate([[state], after[:-1]])
    return begins, after, begun + np.cumsum(begins)


#: Columns that `_scan_blocks` yields.
_SCANNED = (f"value string, {SOURCE_FILE} string, {BLOCK} long, _blank boolean, "
            "_begins0 boolean, _after0 boolean, _rec0 long, _begins1 boolean, _after1 boolean, _rec1 long")


def _scan_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with their maps -> lines as `_through` sees them in a block that
    begins outside quotes (columns ending in 0) and in one that begins inside
    (1).  A task reads a block in its order, from its beginning to its end."""
    block, at = None, [(False, 0), (True, 0)]
    for b in batches:
        if not b.num_rows:
            continue
        files, starts = b.column(1).dictionary_encode(), b.column(2).to_numpy()
        codes = files.indices.to_numpy()
        cuts = 1 + np.flatnonzero((codes[1:] != codes[:-1]) | (starts[1:] != starts[:-1]))
        out, in_, parts = *(b.column(i).to_numpy(zero_copy_only=False) for i in (3, 4)), []
        for i, j in itertools.pairwise([0, *cuts.tolist(), b.num_rows]):
            here = (files.dictionary[int(codes[i])].as_py(), int(starts[i]))
            if here != block:
                block, at = here, [(False, 0), (True, 0)]
            seen = [_through(out[i:j], in_[i:j], *x) for x in at]
            at = [(bool(after[-1]), int(rec[-1])) for _, after, rec in seen]
            parts.append([*seen[0], *seen[1]])
        states = [pa.array(np.concatenate(c)) for c in zip(*parts)]
        yield pa.RecordBatch.from_arrays([*(b.column(i) for i in (0, 1, 2, 5)), *states], names=[c.split()[0] for c in _SCANNED.split(", ")])


def stage(lines: DataFrame, sep: str = ",") -> DataFrame:
    """The lines, written once to the shared checkpoint folder, with a number
    `_line` that follows the file order within a block, whether they are blank,
    and what `_scan_blocks` tells of them: `_begins`, `_after` and `_rec`, for
    both states in which their block may begin."""
    spark, q = lines.sparkSession, Quotes(sep)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/csv-staging-{uuid.uuid4().hex}"
    quoted = F.contains("value", F.lit('"'))
    out, in_ = quoted & F.rlike("value", F.lit(q.opens)), ~quoted | F.rlike("value", F.lit(q.stays))
    blank = F.trim(F.translate("value", "\r\t", "  ")) == ""
    maps = lines.select("value", SOURCE_FILE, BLOCK, out.alias("_out"), in_.alias("_in"), blank.alias("_blank"))
    maps.mapInArrow(_scan_blocks, _SCANNED).withColumn("_line", F.monotonically_increasing_id()).write.parquet(path)
    return spark.read.parquet(path)


def drop_staging(text: DataFrame) -> int:
    """Delete the staged lines behind `text`, once its rows are stored; returns
    how many folders went."""
    folders = {m[1] for f in text.inputFiles() if (m := re.match(r"(.*/csv-staging-[0-9a-f]{32})/", f))}
    return sum(drop_folder(text.sparkSession, f) for f in folders)


def _open_text(uri: str):
    """A file's lines, decompressed by its name's ending, as they are read."""
    import io

    import pyarrow.fs as pafs

    local = uri.startswith("file:") or "://" not in uri
    fs, path = (pafs.LocalFileSystem(), "/" + unquote(uri.removeprefix("file:")).lstrip("/")) if local else pafs.FileSystem.from_uri(uri)
    return io.TextIOWrapper(fs.open_input_stream(path, compression="detect", buffer_size=1 << 16), encoding="utf-8", errors="replace", newline="\n")


def _first_records(spark: SparkSession, files: list[str], n: int, sep: str) -> DataFrame | None:
    """The lines of the header and the first `n` records of every file, read by
    tasks that open their files and stop there; None if the files are in a
    store that only Spark opens."""
    try:
        with _open_text(files[0]):
            pass
    except (OSError, ValueError, ImportError):
        return None
    q, schema = Quotes(sep), f"value string, {SOURCE_FILE} string, {BLOCK} long"

    def head(batches):
        for b in batches:
            for file in b.column(0).to_pylist():
                kept, left, inside = [], n + 1, False
                with _open_text(file) as lines:
                    for line in lines:
                        line, begun = line.removesuffix("\n"), not inside
                        kept.append(line)
                        inside = q.ends_inside(line, inside)
                        left -= not inside and not (begun and not line.strip())
                        if left == 0:
                            break
                yield pa.RecordBatch.from_arrays([pa.array(kept, pa.string()), pa.array([file] * len(kept), pa.string()), pa.array([0] * len(kept), pa.int64())], names=["value", SOURCE_FILE, BLOCK])

    tasks = min(len(files), 4 * spark.sparkContext.defaultParallelism)
    return spark.createDataFrame([(f,) for f in files], "file string").repartition(tasks).mapInArrow(head, schema)


def read_events_text(
    spark: SparkSession,
    path: str | list[str],
    on_missing: str = "empty",
    first: int | None = None,
    sep: str = ",",
) -> DataFrame:
    """Scan CSV file(s) with a header as nine text columns.

    Besides them: the source file, its block and line, and `_header_reason`
    for files whose columns cannot be bound.  A path that matches nothing
    gives an empty frame (`on_missing='empty'`, as the source loader reports
    and carries on) or raises (`'raise'`).  With `first`, no file is read much
    beyond its first `first` rows (S3); `head_n_per_file` cuts them exactly.
    """
    try:
        lines = with_source(text_lines(spark.read.option("ignoreMissingFiles", "true")).text(path))
    except AnalysisException as e:
        if on_missing == "empty" and "PATH_NOT_FOUND" in str(e):
            lines = spark.createDataFrame([], f"value string, {SOURCE_FILE} string, {BLOCK} long")
        else:
            raise
    if first is not None and (files := lines.inputFiles()):
        heads = _first_records(spark, sorted(files), first, sep)
        lines = lines if heads is None else heads
    return bind_columns(stage(lines, sep), sep)


# --- records --------------------------------------------------------------------

def _turned(state: Column, times: Column) -> Column:
    return state != (times % 2 == 1)


def _blocks(staged: DataFrame) -> DataFrame:
    """A row a block: `_start` (does it begin in quotes?), `_owner` (the record
    that its lines before the first beginning go on with, by block and number),
    `_unclosed` (the record, if any, in which its file ends), `_more` (lines
    that are no record by themselves).

    The last line tells a block's map, which is constant, turns the state over
    or keeps it; the maps of a file's blocks compose; a file begins outside."""
    file = Window.partitionBy(SOURCE_FILE).orderBy(BLOCK)
    upto, before = (file.rowsBetween(Window.unboundedPreceding, end) for end in (Window.currentRow, -1))
    cols = [c for i in "01" for c in (F.max_by(f"_after{i}", "_line").alias(f"_end{i}"), F.max(f"_rec{i}").alias(f"_n{i}"),
                                      F.sum((~F.col(f"_begins{i}") | F.col(f"_after{i}")).cast("long")).alias(f"_more{i}"))]
    maps = staged.groupBy(SOURCE_FILE, BLOCK).agg(*cols).withColumn("_s", F.sum((F.col("_end0") & ~F.col("_end1")).cast("long")).over(upto))
    constant = F.when(F.col("_end0") == F.col("_end1"), F.struct(F.col("_end0").alias("v"), F.col("_s").alias("s")))
    known = maps.withColumn("_c", F.last(constant, ignorenulls=True).over(upto))
    ends = known.withColumn("_end", F.when(F.col("_c").isNotNull(), _turned(F.col("_c.v"), F.col("_s") - F.col("_c.s"))).otherwise(_turned(F.lit(False), F.col("_s"))))
    ends = ends.withColumn("_start", F.coalesce(F.lag("_end").over(file), F.lit(False)))
    n = _in_state("_n")
    last = F.when(n > 0, F.struct(F.col(BLOCK).alias("b"), n.alias("r")))
    owners = ends.withColumn("_owner", F.last(last, ignorenulls=True).over(before)).withColumn("_own", F.coalesce(last, "_owner"))
    whole = Window.partitionBy(SOURCE_FILE)
    tail = F.max_by(F.struct("_end", "_own"), BLOCK).over(whole)
    return owners.select(SOURCE_FILE, BLOCK, "_start", "_owner", F.when(tail["_end"], tail["_own"]).alias("_unclosed"), _in_state("_more").alias("_more"))


def _in_state(name: str) -> Column:
    """The one of a pair of columns that holds for the block's beginning."""
    return F.when(F.col("_start"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))


def records(staged: DataFrame, sep: str = ",") -> DataFrame:
    """Staged lines -> `fields` of every record, with file, block, the number
    of its first line, and `_open` if its file ends before its last quote.
    Blank lines are no records.

    The blocks' states (a row for each split of the scan) are broadcast to the
    lines, so a line that is a record by itself stays where it is; only the
    lines of longer records are brought together, and written once more."""
    blocks = reliable_checkpoint(_blocks(staged))
    lines = staged.join(F.broadcast(blocks), [SOURCE_FILE, BLOCK])
    key = F.when(_in_state("_rec") > 0, F.struct(F.col(BLOCK).alias("b"), _in_state("_rec").alias("r"))).otherwise(F.col("_owner"))
    lines = lines.withColumn("_open", F.coalesce(key == F.col("_unclosed"), F.lit(False)))
    # what is not closed at the end of its file stays line by line: it may be all the rest
    alone = F.col("_open") | (_in_state("_begins") & ~_in_state("_after"))
    rows = lines.where(alone & (F.col("_open") | ~F.col("_blank"))).select("value", SOURCE_FILE, BLOCK, "_line", "_open")
    if not blocks.where("_more > 0").isEmpty():
        parts = lines.where(~alone).withColumn("_key", key).groupBy(SOURCE_FILE, "_key").agg(F.array_sort(F.collect_list(F.struct(BLOCK, "_line", "value"))).alias("p"))
        joined = parts.select(F.array_join("p.value", "\n").alias("value"), SOURCE_FILE, F.col("_key.b").alias(BLOCK), F.col("p")[0]["_line"].alias("_line"), F.lit(False).alias("_open"))
        rows = rows.unionByName(reliable_checkpoint(joined))
    return rows.select(Quotes(sep).fields(F.col("value")).alias("fields"), SOURCE_FILE, BLOCK, "_line", "_open")


def bind_columns(staged: DataFrame, sep: str = ",") -> DataFrame:
    """Staged lines -> the nine columns by the name in their file's header.

    The header is the first record of a file.  An unknown or
    repeated column is a problem of the whole file, more fields than the
    header names one of the row; both become reject reasons.
    """
    staged = records(staged, sep)
    # the block of a blank beginning has none: the first record is looked up over the first record of each block;
    # lines are told by their numbers, so that no fields but the headers' are cut here
    tops = staged.groupBy(SOURCE_FILE, BLOCK).agg(F.min("_line").alias("_header_line"))
    tops = tops.groupBy(SOURCE_FILE).agg(F.min_by("_header_line", BLOCK).alias("_header_line"))
    first = staged.join(F.broadcast(tops.select(F.col(SOURCE_FILE).alias("_hfile"), "_header_line")), (F.col(SOURCE_FILE) == F.col("_hfile")) & (F.col("_line") == F.col("_header_line")))
    names = F.transform("fields", lambda x: F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), "^\ufeff", "")))
    known = F.array(*[F.lit(c) for c in schemas.CSV_COLUMNS])
    unknown = F.array_except(names, known)
    reason = F.when(F.size(unknown) > 0, F.concat(F.lit("unknown column "), F.array_join(unknown, ", "))).when(
        F.size(F.array_distinct(names)) < F.size(names), F.lit("repeated column"))
    header = first.select("_hfile", "_header_line", F.size("fields").alias("_width"), reason.alias(HEADER_REASON),
                          *[F.array_position(names, c).cast("int").alias(f"_at_{c}") for c in schemas.CSV_COLUMNS])
    header = reliable_checkpoint(header)  # a row a file
    rows = staged.join(F.broadcast(header), F.col(SOURCE_FILE) == F.col("_hfile"), "left").where("_line <> _header_line OR _header_line IS NULL")
    cols = [F.when(F.col(f"_at_{c}") > 0, F.get("fields", F.col(f"_at_{c}") - 1)).alias(c) for c in schemas.CSV_COLUMNS]
    used = F.expr("filter(transform(fields, (x, i) -> if(x = '', -1, i)), i -> i >= 0)")
    wide = F.when(F.coalesce(F.array_max(used), F.lit(-1)) >= F.col("_width"), F.lit("more fields than the header"))
    problem = F.coalesce(F.col(HEADER_REASON), F.when(F.col("_open"), F.lit("quote not closed")), wide)
    return rows.select(*cols, SOURCE_FILE, BLOCK, "_line", problem.alias(HEADER_REASON))


# --- head-N ---------------------------------------------------------------------

def with_row_in_file(df: DataFrame, parquet: bool = False) -> DataFrame:
    """Add the 0-based position of each data row inside its source file.

    Parquet has it in `_metadata.row_index`.  For staged text it is built
    from the line numbers: a table with one row per block gives each block's
    first line and row count, running counts per file its first row number.
    The blocks' rows are counted, not their lines, so a window over one
    block's rows numbers them; a block is one split, so a huge file is never
    gathered in one task.
    """
    if parquet:
        return df.withColumn(ROW_INDEX, F.col("_metadata.row_index"))
    in_block = F.row_number().over(Window.partitionBy(SOURCE_FILE, BLOCK).orderBy("_line"))
    blocks = df.groupBy(SOURCE_FILE, BLOCK).agg(F.count(F.lit(1)).alias("_rf_n"))
    before = Window.partitionBy(SOURCE_FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(SOURCE_FILE, BLOCK, F.coalesce(F.sum("_rf_n").over(before), F.lit(0)).alias("_rf_off"))
    out = df.withColumn("_rf_in", in_block).join(offsets, [SOURCE_FILE, BLOCK], "inner")
    return out.withColumn(ROW_INDEX, F.col("_rf_off") + F.col("_rf_in") - 1).drop("_rf_in", "_rf_off")


def head_n_per_file(df: DataFrame, n: int | None, parquet: bool = False) -> DataFrame:
    """First `n` rows of every source file in file order (S3); all if None."""
    if n is None:
        return df
    indexed = df if ROW_INDEX in df.columns else with_row_in_file(df, parquet)
    return indexed.where(F.col(ROW_INDEX) < n)


# --- typing and rejects ------------------------------------------------------------

def _whole_number(text):
    """Text -> BIGINT: an integer, or a number without a fraction (`1.0`,
    `1e3`), exactly to 19 digits; else NULL."""
    number = text.try_cast("decimal(38,6)")
    return F.when(number == F.floor(number), number).try_cast("long")


def type_events(text: DataFrame) -> DataFrame:
    """Text columns -> bronze types plus a `reject_reason` ('' when clean).

    NA tokens become NULL first (S5); `event_time` is parsed as a zoned
    time and kept as its UTC wall clock (S6); numbers are cast to BIGINT and
    prices to DECIMAL(10,2) (half-up).  A non-missing value that does not
    parse, a missing event time, a malformed line or a text longer than the
    column allows is named in the reason (V1, V2).
    """
    clean = {c: C.null_tokens(c) for c in schemas.CSV_COLUMNS}
    typed = {
        "event_time": C.parse_event_time(clean["event_time"]),
        "price": clean["price"].try_cast(schemas.PRICE_TYPE),
    }
    for c in _LONG_COLS:
        typed[c] = _whole_number(clean[c])
    for c in _TEXT_COLS:
        typed[c] = clean[c]

    reasons = [F.col(HEADER_REASON)] if HEADER_REASON in text.columns else []
    reasons.append(F.when(typed["event_time"].isNull(), F.lit("event_time is null or unparsable")))
    for c in _LONG_COLS + ("price",):
        reasons.append(
            F.when(clean[c].isNotNull() & typed[c].isNull(), F.lit(f"{c} is not a valid number"))
        )
    for c, w in schemas.BRONZE_WIDTHS.items():
        reasons.append(F.when(C.over_width(typed[c], w), F.lit(f"{c}>{w}")))

    cols = [typed[c].alias(c) for c in schemas.CSV_COLUMNS]
    extra = [c for c in text.columns if c in (SOURCE_FILE, ROW_INDEX)]
    return text.select(*cols, *extra, F.concat_ws("; ", *reasons).alias("reject_reason"))


def to_bronze_rows(
    text: DataFrame,
    on_error: str = "quarantine",
    reject_counter: Observation | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(accepted bronze rows, rejected rows) from the text scan.

    on_error='quarantine': only the bad rows are held back.
    on_error='skip_file' (the source's policy, where a file is at most one
    chunk): a file with any bad row is not loaded at all; its rows are all
    returned as rejects.
    on_error='fail': raise if any row is bad.

    With `reject_counter`, the number of rejected rows (metric `rejected`)
    is observed while the accepted rows are written, so a caller can skip
    writing an empty rejects table without another pass.
    """
    typed = type_events(text)
    reason = F.col("reject_reason")
    bad_row = reason != ""
    if on_error == "fail":
        sample = typed.where(bad_row).limit(5).collect()
        if sample:
            raise ConstraintViolation(f"rows violate the bronze schema, e.g. {sample}")
    reason_out = reason
    if on_error == "skip_file":
        bad = typed.where(bad_row).select(F.col(SOURCE_FILE).alias("_bad_file")).distinct()
        typed = typed.join(bad, typed[SOURCE_FILE] == bad["_bad_file"], "left")
        in_bad = F.col("_bad_file").isNotNull()
        reason_out = F.when(bad_row, reason).otherwise(F.lit("file has rejected rows"))
        bad_row = bad_row | in_bad
    if reject_counter is not None:
        typed = typed.observe(
            reject_counter, F.sum(F.when(bad_row, 1).otherwise(0)).alias("rejected")
        )
    accepted = typed.where(~bad_row).drop("reject_reason", "_bad_file")
    rejects = typed.where(bad_row).withColumn("reject_reason", reason_out).drop("_bad_file")
    return accepted, rejects


def with_load_stamp(df: DataFrame) -> DataFrame:
    """`loaded_at DEFAULT GETDATE()` (L2); the load's id is a property of the
    part that the rows are written to."""
    return df.withColumn("loaded_at", F.current_timestamp())


def load_counts(df: DataFrame) -> DataFrame:
    """Rows per source file (L6); files of one name in two folders stay apart."""
    counts = df.groupBy(F.col("_metadata.file_path").alias("_path")).agg(F.count(F.lit(1)).alias("rows_loaded"))
    return counts.select(F.element_at(F.split("_path", "/"), -1).alias("file_name"), "rows_loaded")
