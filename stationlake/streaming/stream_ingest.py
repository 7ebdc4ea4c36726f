"""Incremental import with Structured Streaming.

The stream finds files, ``foreachBatch`` imports them: each micro-batch is a list of new
paths that goes through the same readers and ``ingest_lines`` as the batch import, so codecs,
zip archives and broken files are treated alike. The checkpoint records which files were
taken, so a file is imported once even if moving it fails. Table writes are upserts or merges,
and log and rejects are replaced by batch, so a replayed batch leaves the same tables. A batch that
was committed before the driver was lost is not read again, since some of its files may
have been moved; only the moves go on. Spark's file source counts files without bytes but hands on
no row for them, so a batch takes them from the listing: stream and batch import log the same files.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stationlake.plans.ingest import archive_files, committed_log, empty_files, import_files, record_moves, table_paths
from stationlake.schemas import DEFAULT_DIALECT, Dialect
from stationlake.session import checkpoint_root, staging
from stationlake.sources.files import file_path, literal_path

#: Files of a micro-batch: their paths are listed on the driver.
FILES_PER_TRIGGER = 10_000
_FOUND = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
                       T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])


def stream_files(spark: SparkSession, inbox: str, max_files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Streaming listing of the inbox: the paths of new files; no file is opened."""
    return (spark.readStream.format("binaryFile").schema(_FOUND)
            .option("maxFilesPerTrigger", str(max_files_per_trigger)).load(inbox)
            .select(file_path().alias("file_path")))


def import_batch(spark: SparkSession, paths: list[str], out_root: str, batch_id: str, inbox: str, *,
                 archive_to: str | None = None, dialect: Dialect = DEFAULT_DIALECT, on_error: str = "quarantine") -> DataFrame:
    """Imports the files of one micro-batch; returns its stored log rows. A batch that is run again after its tables
    were written is only archived."""
    log = committed_log(spark, out_root, batch_id)
    if log is None:
        with staging(spark):
            log = import_files(spark, [literal_path(p) for p in paths], out_root, batch_id, dialect=dialect, on_error=on_error)
    if archive_to:
        moves = archive_files(log, inbox, archive_to, archive_to.rstrip("/") + "_FAILED")
        record_moves(spark, moves, f"{out_root.rstrip('/')}/archived", batch_id)
    return log


def start_stream_ingest(spark: SparkSession, inbox: str, out_root: str, *,
                        checkpoint: str | None = None, archive_to: str | None = None,
                        available_now: bool = True, max_files_per_trigger: int = FILES_PER_TRIGGER,
                        dialect: Dialect = DEFAULT_DIALECT, on_error: str = "quarantine") -> StreamingQuery:
    """Start the import stream; ``available_now`` processes what is there and stops.

    Without ``checkpoint`` the stream of this inbox and output always uses the same folder below
    the shared one, so a restart knows which files were taken."""
    name = hashlib.sha256(f"{inbox}\n{out_root}".encode()).hexdigest()[:16]
    ckpt = checkpoint or f"{checkpoint_root(spark).rstrip('/')}/stream-ingest/{name}"

    def batch(df: DataFrame, epoch_id: int) -> None:
        spark, batch_id = df.sparkSession, f"stream-{name}-{epoch_id}"
        paths = [r["file_path"] for r in df.select("file_path").collect()]  # at most max_files_per_trigger
        paths += empty_files(spark, inbox, out_root, batch_id, max_files_per_trigger)
        if paths:
            import_batch(spark, paths, out_root, batch_id, inbox, archive_to=archive_to, dialect=dialect, on_error=on_error)

    writer = (stream_files(spark, inbox, max_files_per_trigger).writeStream
              .foreachBatch(batch).option("checkpointLocation", ckpt))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def run_stream_ingest(spark: SparkSession, inbox: str, out_root: str, **kw) -> dict[str, str]:
    """Run the stream until the inbox is drained; returns the table paths."""
    q = start_stream_ingest(spark, inbox, out_root, available_now=True, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return table_paths(out_root)
