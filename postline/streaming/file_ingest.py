"""Continuous ingest of posting files dropped into a folder.

The reference loads one file per scheduled run; the same job as a
Structured Streaming query watches a folder with the ``binaryFile`` source
(only the path column is selected, so file contents are not read by the
stream itself) and, for every micro-batch, hands the new paths to the batch
ingest job.  Exactly-once holds because the ingest job is idempotent: a
file whose fingerprint is completed in the ledger is skipped, and what a run
that ended early has written is visible to no reader, so a retried micro-batch
changes nothing.  A micro-batch takes at most ``files_per_batch`` files, so the paths
that go through the driver are bounded, the first time too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from postline.plans.ingest import Paths, ingest_files

# the binaryFile source's fixed schema (a stream needs it given)
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def start_file_ingest(spark: SparkSession, folder: str, paths: Paths, checkpoint: str,
                      source_name: str = "stream", glob: str = "*.csv",
                      available_now: bool = False, files_per_batch: int = 1000) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is there and stops."""
    files = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("pathGlobFilter", glob)
             .option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true").load(folder).select("path"))

    def load(batch: DataFrame, epoch_id: int) -> None:
        # one row per new file in this micro-batch (bounded by files, not data)
        new_paths = [r.path for r in batch.distinct().collect()]
        if new_paths:
            ingest_files(batch.sparkSession, sorted(new_paths), paths, source_name=source_name)

    writer = files.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
