"""Incremental snapshot ingestion with Structured Streaming.

The reference re-reads every snapshot file on each daily run. Here a file
stream over the snapshot folder tracks, in its checkpoint, which files were
already taken; each run (``trigger(availableNow=True)``: take what is new,
then stop) hands only the new files to ``foreachBatch``. The batch function
reuses the drift-safe loader (header of each file from its first block, columns by name), so a renamed
column in a new file is handled exactly as in batch.

Exactly once: a micro-batch is merged into the bronze table under its own
number (``streaming/bronze.py``), so a batch replayed after a failure replaces
its own output and never appends twice. A row re-sent in a later file is removed
by the same rule as in batch, in the slices that the new files touch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from starmart.sources.csv import load_snapshots
from starmart.streaming.bronze import merge_drop, read_bronze

__all__ = ["ingest", "new_files_stream", "read_bronze"]


# the binaryFile source's fixed schema (a stream needs it up front)
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def new_files_stream(spark: SparkSession, directory: str, pattern: str,
                     recursive: bool = False, max_files_per_trigger: int = 1000) -> DataFrame:
    """Stream of paths of files that appear under ``directory`` (content not read)."""
    # recursiveFileLookup: no partition discovery, so sub-folders that are
    # named like partitions do no harm
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
              .option("maxFilesPerTrigger", max_files_per_trigger))
    return reader.load(directory if recursive else f"{directory.rstrip('/')}/{pattern}").select("path")


def ingest(spark: SparkSession, directory: str, bronze: str, checkpoint: str,
           pattern: str = "*payroll_*.csv", recursive: bool = False,
           max_files_per_trigger: int = 1000, buckets: int = 64) -> StreamingQuery:
    """Merge the rows of files not seen before into the bronze table (of
    ``buckets`` hash buckets a year, if it is new); returns the (finished) query.
    The list of new paths per batch is bounded by ``max_files_per_trigger``; the
    rows themselves never pass the driver."""

    def write_batch(paths: DataFrame, batch_id: int) -> None:
        new = sorted(r.path for r in paths.collect())
        if not new:
            return
        merge_drop(spark, bronze, load_snapshots(spark, new, provenance=True), batch_id, buckets)

    q = (new_files_stream(spark, directory, pattern, recursive, max_files_per_trigger)
         .writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return q
