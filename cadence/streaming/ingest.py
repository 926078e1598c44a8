"""Structured Streaming: message stream -> Bronze, a tail reader, and an event-time trend.

The source is the message folder (``text``), or Kafka where the connector is on
the classpath (same decode step). Runs are bounded by data with
``trigger(availableNow=True)``; the checkpoint makes a rerun pick up only new
files, so a restart after a lost driver or executor neither loses nor
duplicates rows in the append-only Bronze table.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from cadence.sources import messages


INGEST_DATE = "ingest_date"


def ingest_bronze(spark: SparkSession, source: str, bronze_path: str, checkpoint: str,
                  schema: T.StructType, source_format: str = "text", sink_format: str = "parquet",
                  source_options: dict | None = None, processing_time: str | None = None,
                  max_files_per_trigger: int | None = None, partition_by_ingest_date: bool = True):
    """Start (and, for availableNow, finish) the Bronze ingest query; returns the query.

    Bronze is partitioned by ingest date (the micro-batch's processing date), so
    later readers that build Silver incrementally prune to the new partitions.
    ``processing_time`` (e.g. "30 seconds") gives a continuously running query
    instead; the caller stops it."""
    raw = messages.read_message_stream(spark, source, source_format, source_options, max_files_per_trigger)
    decoded = messages.decode(raw, schema)
    if partition_by_ingest_date:
        decoded = decoded.withColumn(INGEST_DATE, F.current_date())
    writer = (decoded.writeStream.format(sink_format).outputMode("append")
              .option("checkpointLocation", checkpoint))
    if partition_by_ingest_date:
        writer = writer.partitionBy(INGEST_DATE)
    writer = writer.trigger(processingTime=processing_time) if processing_time else \
        writer.trigger(availableNow=True)
    q = writer.start(bronze_path)
    if not processing_time:
        q.awaitTermination()
    return q


class RunLog(StreamingQueryListener):
    """Batches (number, rows read) of the streaming queries that run while the listener is registered."""

    def __init__(self):
        self.batches: list[tuple[str, int, int]] = []
        self.ended: dict[str, str | None] = {}
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self._change:
            self.batches.append((str(event.progress.runId), event.progress.batchId, event.progress.numInputRows))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self.ended[str(event.runId)] = event.exception
            self._change.notify_all()

    def wait(self, run_id: str, seconds: float = 30.0) -> None:
        """Until the end of a run has been reported (events arrive after the fact)."""
        with self._change:
            self._change.wait_for(lambda: run_id in self.ended, seconds)

    def of(self, run_id: str) -> list[tuple[int, int]]:
        """(batch, rows) of one run in order; a batch reported twice (idle progress) counts by its last report."""
        with self._change:
            return sorted({b: n for r, b, n in self.batches if r == run_id and n > 0}.items())


def ingest_bounded(spark: SparkSession, source: str, bronze_path: str, checkpoint: str, schema: T.StructType, seconds: float,
                   every: str = "30 seconds", drain: bool = True, **options) -> list[tuple[int, int]]:
    """A continuous ingest run of a bounded time: a micro-batch ``every`` so often for ``seconds``, then, with
    ``drain``, whatever has arrived by that time, then a stop. Returns (batch, rows) of the run, as a listener
    recorded them. A failure of the stream is raised; the next run goes on from the checkpoint."""
    log = RunLog()
    spark.streams.addListener(log)
    try:
        query = ingest_bronze(spark, source, bronze_path, checkpoint, schema, processing_time=every, **options)
        try:
            if not query.awaitTermination(seconds) and drain:
                query.processAllAvailable()
        finally:
            query.stop()
        log.wait(str(query.runId))
        return log.of(str(query.runId))
    finally:
        spark.streams.removeListener(log)


def ingest_with_quarantine(spark: SparkSession, source: str, good_path: str, bad_path: str, checkpoint: str,
                           schema: T.StructType, source_format: str = "text", source_options: dict | None = None):
    """Good messages to one table, the raw text of unparsable ones to another; none is lost.

    Each micro-batch writes to a folder of its own number, so a repeated batch replaces itself."""
    raw = messages.read_message_stream(spark, source, source_format, source_options)
    parsed = messages.decode_with_quarantine(raw, schema)
    bad = F.col(messages.CORRUPT_COLUMN).isNotNull()

    def write(batch: DataFrame, number: int):
        # one pass over the source: both sides come from what this batch stored
        stored = f"{checkpoint}-staged/batch={number}"
        batch.write.mode("overwrite").parquet(stored)
        rows = spark.read.schema(batch.schema).parquet(stored)
        rows.where(~bad).drop(messages.CORRUPT_COLUMN).write.mode("overwrite").parquet(f"{good_path}/batch={number}")
        rows.where(bad).select(messages.CORRUPT_COLUMN).write.mode("overwrite").parquet(f"{bad_path}/batch={number}")

    q = parsed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def tail(spark: SparkSession, source: str, out_path: str, checkpoint: str, schema: T.StructType,
         skip_existing: bool = True, source_format: str = "text", source_options: dict | None = None):
    """Messages that arrive after the tail starts (``startingOffsets=latest`` for a topic).

    The checkpoint is first advanced over what is already present, all rows
    filtered out, so a later run writes only newer messages."""
    if source_format == "kafka":
        source_options = {"startingOffsets": "latest"} | (source_options or {})

    def start(decoded: DataFrame):
        q = (decoded.writeStream.format("parquet").option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start(out_path))
        q.awaitTermination()

    def stream() -> DataFrame:
        return messages.decode(messages.read_message_stream(spark, source, source_format, source_options), schema)

    if skip_existing:
        start(stream().where(F.lit(False)))
    return lambda: start(stream())


def hourly_trend(spark: SparkSession, source: str, out_root: str, checkpoint: str,
                 schema: T.StructType, ts_col: str = "ts", watermark: str = "2 hours"):
    """Messages per event-time hour as a tumbling window with a watermark.

    Update mode: a micro-batch writes only the hours it changed, to a folder of its own number
    (a repeated batch replaces itself), and state of hours behind the watermark is dropped together
    with messages that are later than that. ``read_trend`` gives the latest count of each hour."""
    ev = messages.decode(messages.read_message_stream(spark, source), schema)
    # watermarks need a zoned timestamp; wall-clock time is read in the session zone
    ev = ev.withColumn("_event_time", F.col(ts_col).cast("timestamp"))
    counts = (ev.withWatermark("_event_time", watermark)
              .groupBy(F.window("_event_time", "1 hour").alias("w"))
              .agg(F.count(F.lit(1)).alias("message_count")))

    def write(batch: DataFrame, number: int):
        (batch.select(F.col("w.start").cast("timestamp_ntz").alias("hour"), "message_count")
         .write.mode("overwrite").parquet(f"{out_root}/batch={number}"))

    q = (counts.writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def read_trend(spark: SparkSession, out_root: str) -> DataFrame:
    """(hour, message_count): the count of the last micro-batch that changed the hour."""
    return spark.read.parquet(out_root).groupBy("hour").agg(F.max_by("message_count", "batch").alias("message_count"))
