"""Incremental intake of the monthly roster folder (S2 as a file stream).

The reference re-reads its folder of monthly workbooks in a batch loop; here new
workbooks are picked up exactly once by Structured Streaming's file source (the
checkpoint remembers processed files) and each micro-batch runs the same
extraction as the batch path (:mod:`rosterflow.sources.workbooks`). Each batch is
written to its own ``batch_id`` folder with overwrite, so a retried batch
replaces its own output instead of duplicating it. ``availableNow`` processes
what has arrived and stops — the natural trigger for a monthly drop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.workbooks import ROSTER_SECTIONS, extract_workbooks, is_workbook, roster_frames

BINARY_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def roster_stream(spark: SparkSession, folder: str, pattern: str | None = None,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of new workbook files (S2: all but ``.keep`` and lock files ``~...``)."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_SCHEMA)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    files = reader.load(folder)
    return files.where(is_workbook())


def _write_batch(out_dir: str, sections):
    def write(batch: DataFrame, batch_id: int) -> None:
        frames = roster_frames(extract_workbooks(batch, sections))
        for name, df in frames.items():
            (df.withColumn("batch_id", F.lit(batch_id))
               .write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/{name}/batch_id={batch_id}"))
    return write


def ingest_rosters(spark: SparkSession, folder: str, out_dir: str, checkpoint: str,
                   sections=ROSTER_SECTIONS, available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start (and, with ``available_now``, finish) one incremental ingest run.

    ``checkpoint`` must be on shared storage (e.g. under ``spark.checkpoint.dir``).
    Returns the finished or running ``StreamingQuery``.
    """
    writer = (roster_stream(spark, folder, max_files_per_trigger=max_files_per_trigger).writeStream
              .foreachBatch(_write_batch(out_dir, sections))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q


def read_ingested(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """The ingested header, roster and totals frames (all batches)."""
    return {name: spark.read.parquet(f"{out_dir.rstrip('/')}/{name}") for name in ("header", "roster", "totals")}
