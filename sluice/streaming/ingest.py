"""File-arrival ingestion with Structured Streaming.

The reference runs a task every 5 minutes when its stream over the landing
area has data, then calls create -> load -> merge.  Here a file stream
(``binaryFile`` source; only path and length are read) is the trigger and
its checkpoint is the offset: a micro-batch exists only when new files
arrived (with ``availableNow`` a run without new files runs no batch).
``foreachBatch`` runs the chain on the driver as ordinary batch jobs.

``foreachBatch`` is at-least-once: a batch replayed after a failure runs the
chain again.  That is safe because the load step keeps a ledger and skips
files already loaded (the reference also re-lists the whole stage each run).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.operators.ledger import current_loads, read_ledger
from sluice.operators.load import (RunResult, create_entity_tables, landed, landed_files,
                                   load_files)
from sluice.operators.snapshot import stage
from sluice.session import conf_for, listing_conf

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"

AfterLoad = Callable[[SparkSession, str, RunResult], None]


def has_new_files(spark: SparkSession, landing: str, warehouse: str) -> bool:
    """Batch form of the stream-has-data check (I1): landed files not in the ledger."""
    files = landed_files(spark, landing)
    loaded = current_loads(read_ledger(spark, warehouse, files.select("file_name")))
    same = ["file_name", "length", "modified"]
    return bool(files.join(loaded.select(*same), same, "left_anti").take(1))


def run_chain(spark: SparkSession, landing: str, warehouse: str, loaded_at: _dt.datetime,
              after_load: AfterLoad | None = None, files: DataFrame | None = None) -> RunResult:
    """create -> load (-> after_load, e.g. a master-lookup merge).

    ``files`` (path, file_name, length, modified, entity) limits the run to
    these files; the landing folder is not listed then.
    """
    create_entity_tables(spark, landing, warehouse, files=files)
    result = load_files(spark, landing, warehouse, loaded_at, files=files)
    if after_load is not None:
        after_load(spark, warehouse, result)
    return result


def ingest_stream(spark: SparkSession, landing: str, warehouse: str, checkpoint: str, *,
                  trigger: str = "availableNow", loaded_at: _dt.datetime | None = None,
                  after_load: AfterLoad | None = None, glob: str = "*.csv.gz",
                  max_files_per_trigger: int | None = None, clean_source: str = "off",
                  archive_dir: str | None = None,
                  on_done: Callable[[int], None] | None = None) -> StreamingQuery:
    """Start the ingest stream.  ``trigger``: ``'availableNow'`` (run what is
    there, then stop; for an outside scheduler) or an interval such as
    ``'5 minutes'`` (the reference's cadence, I4).

    ``clean_source='archive'`` (with ``archive_dir``) or ``'delete'`` moves
    landed files away once their micro-batch is committed (A21), done by the
    file source itself.  Files that failed to load are moved too, so keep the
    default ``'off'`` when failed files should be retried in place.
    """
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("pathGlobFilter", glob).option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if clean_source != "off":
        reader = reader.option("cleanSource", clean_source)
        if clean_source == "archive":
            if not archive_dir:
                raise ValueError("archive_dir is required for clean_source='archive'")
            reader = reader.option("sourceArchiveDir", archive_dir)
    arrivals = reader.load(landing).select("path", "length", "modificationTime")

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        # the batch's own files only: max_files_per_trigger bounds each load
        files = stage(batch.sparkSession, landed(batch.select(
            "path", "length", F.col("modificationTime").alias("modified"))), "arrivals")
        if files.isEmpty():
            return
        ts = loaded_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        run_chain(batch.sparkSession, landing, warehouse, ts, after_load, files)
        if on_done is not None:
            on_done(batch_id)

    writer = (arrivals.writeStream.foreachBatch(on_batch)
              .option("checkpointLocation", checkpoint))
    if trigger == "availableNow":
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def run_available(spark: SparkSession, landing: str, warehouse: str, checkpoint: str,
                  **kw) -> int:
    """One scheduled run: process everything that arrived, return the number
    of micro-batches that had data."""
    done: list[int] = []
    # the file source lists a batch's files again by path, under the session's settings
    with conf_for(spark, listing_conf(spark)):
        q = ingest_stream(spark, landing, warehouse, checkpoint, trigger="availableNow",
                          on_done=done.append, **kw)
        q.awaitTermination()
    return len(done)


def stream_landed_csv(spark: SparkSession, landing: str, columns: list[str],
                      glob: str = "*.csv.gz", options: dict[str, str] | None = None
                      ) -> DataFrame:
    """Streaming analogue of ``read_landed_csv`` (I6): all-string columns by
    position plus the file name, one micro-batch per group of new files."""
    from pyspark.sql import types as T

    from sluice.sources.files import profile
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    df = (spark.readStream.options(**(options or profile("ingest_csv"))).schema(schema)
          .option("pathGlobFilter", glob).option("recursiveFileLookup", "true").csv(landing))
    return df.select("*", F.col("_metadata.file_name").alias("source_file_name"))
