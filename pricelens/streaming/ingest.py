"""Incremental formatting of landed raw files with Structured Streaming.

The reference's daily run re-reads every ``ingestion_date=`` folder and so counts a
sale once per run that has seen it. Here the landing folder is a file stream: each
file is formatted exactly once, progress is kept in a checkpoint under the shared
``spark.checkpoint.dir``, and an ``availableNow`` trigger processes whatever has
landed since the last run and stops -- the batch schedule, without re-reading the
past. An executor lost mid-run is recovered from the checkpoint and the file sink's
commit log (the sink is exactly-once).
"""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from pricelens import contracts as C
from pricelens.operators.formatting import format_sales

LANDED_SALES = T.StructType(C.RAW_SALES.fields + [T.StructField("ingestion_date", T.DateType(), True)])


class _Rows(StreamingQueryListener):
    """Input rows over every progress record of a query (the query itself keeps only the last 100)."""

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.ended: dict[str, threading.Event] = {}

    def _event(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        run = str(event.progress.runId)
        self.rows[run] = self.rows.get(run, 0) + int(event.progress.numInputRows)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):  # comes after the last progress record
        self._event(str(event.runId)).set()


def _run(spark: SparkSession, writer) -> int:
    """Start an ``availableNow`` query, wait for its end and return the rows it read."""
    listener = _Rows()
    spark.streams.addListener(listener)
    try:
        query = writer.start()
        query.awaitTermination()
        if not listener._event(str(query.runId)).wait(120):
            raise TimeoutError("the query's end was not reported")
        return listener.rows.get(str(query.runId), 0)
    finally:
        spark.streams.removeListener(listener)


def format_landed_sales(spark: SparkSession, landed_path: str, formatted_path: str,
                        checkpoint_path: str, max_files_per_trigger: int | None = None) -> int:
    """Format every raw-sales CSV landed under ``landed_path`` since the last call and
    append it to the Parquet table at ``formatted_path`` (partitioned by ``year``).
    Returns the number of landed rows read by this call (from its progress records)."""
    reader = (spark.readStream.schema(LANDED_SALES).option("header", True)
              .option("inferSchema", False).option("encoding", "UTF-8")
              .option("enforceSchema", False))  # every file's header is checked
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(landed_path)
    return _run(spark, format_sales(raw).writeStream.format("parquet")
                .option("path", formatted_path)
                .option("checkpointLocation", checkpoint_path)
                .partitionBy("year")
                .outputMode("append")
                .trigger(availableNow=True))


def _batch_name(batch_id: int) -> str:
    return f"{batch_id:012d}"


def update_segment_state(spark: SparkSession, landed_path: str, state_root: str,
                         checkpoint_path: str, max_files_per_trigger: int | None = None) -> int:
    """Fold every sales file landed since the last call into the segment state.

    A file stream over the landing folder; each micro-batch is formatted and its counts are
    appended to the log (``operators/segment_log.py``) as a run named by the batch, so a batch
    writes in proportion to its own sales. A retried batch replaces its run: the sink is
    idempotent, and the stream's checkpoint makes every file count once. ``segment_log.compact`` folds
    the log. Returns the number of landed rows read by this call (from its progress records).
    """
    from pyspark.sql import functions as F

    from pricelens.operators import market as MKT
    from pricelens.operators import segment_log as LOG

    none = spark.createDataFrame([], "file long, sign int")  # the checkpoint knows the files

    def append_batch(batch, batch_id: int) -> None:
        rows = MKT.histogram_rows(batch).withColumn("_file", F.lit(0).cast("long"))
        LOG.append(spark, state_root, _batch_name(batch_id), rows, none)

    reader = (spark.readStream.schema(LANDED_SALES).option("header", True)
              .option("inferSchema", False).option("encoding", "UTF-8").option("enforceSchema", False))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _run(spark, format_sales(reader.csv(landed_path)).writeStream.foreachBatch(append_batch)
                .option("checkpointLocation", checkpoint_path)
                .trigger(availableNow=True))


def segment_stats_from_state(spark: SparkSession, state_root: str):
    """Segment statistics from the stored state (same columns as ``market.segment_stats``)."""
    from pricelens.operators import segment_log as LOG
    return LOG.state(spark, state_root).stats()
