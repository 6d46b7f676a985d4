"""Incremental bronze ingest with Structured Streaming.

The source loader appends every CSV it finds on each run, so a rerun loads
old files again.  Here the CSV folder is a file stream: its checkpoint
records which files were consumed, and `trigger(availableNow=True)` loads
everything new and stops, so a rerun adds only files that arrived since.
Each micro-batch goes through the same typing and reject split as the
batch loader and is appended to the bronze and rejects tables.

A micro-batch is a load with an id of its own (stream and batch number), whose
parts are published together: after a crash before that it runs again from the
start, after a crash between that and its commit it finds itself published, so
its rows are stored once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ingot.plans import medallion as M
from ingot.plans import sinks as S
from ingot.sources import csv as CSV

#: Files of a micro-batch: bounds its work, whatever has piled up.
MAX_FILES_PER_TRIGGER = 1000


def events_text_stream(spark: SparkSession, folder: str, max_files_per_trigger: int = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """Lines of the CSV files arriving in `folder` or below, as a stream."""
    reader = CSV.text_lines(spark.readStream).option("maxFilesPerTrigger", str(max_files_per_trigger)).option("recursiveFileLookup", "true")
    return CSV.with_source(reader.text(folder))


def ingest_new_files(
    lh: S.Lakehouse,
    folder: str,
    checkpoint: str | None = None,
    on_error: str = "quarantine",
    max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
    wait: bool = True,
    downstream: bool = False,
) -> StreamingQuery:
    """Append the CSV files not loaded before to bronze (and its rejects).

    `checkpoint` must be on shared storage; by default it lives under the
    lakehouse root.  A whole file always falls into one micro-batch, so the
    skip-file policy works per batch as in the batch loader.

    `downstream=True` also carries each micro-batch on to silver, the
    product dimension and the fact (`medallion.increment_from_text`), so a
    run costs the new files plus the dimension, not the whole history.
    """
    checkpoint = checkpoint or f"{lh.root.rstrip('/')}/_checkpoints/bronze_ingest"

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        load = M.increment_from_text if downstream else M.bronze_from_text
        load(lh, CSV.bind_columns(CSV.stage(batch)), on_error, load_id=f"{checkpoint}#{batch_id}")

    query = (
        events_text_stream(lh.spark, folder, max_files_per_trigger)
        .writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .queryName("bronze_ingest")
        .start()
    )
    if wait:
        query.awaitTermination()
    return query
