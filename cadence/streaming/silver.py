"""Bronze to Silver as a stream: the cleaning chain with a de-duplication whose state expires.

``keep="smallest"``: the row that the batch form keeps (the smallest by message time, then genre, then
every other column). Rows of one key belong together while less than ``gap`` of message time lies between
them (a session window per key); the smallest is kept as state and written when the watermark has passed
the session's end, whatever the order of arrival. Result and batch Silver agree on all keys whose rows lie
within ``gap`` of each other and arrive within ``delay``.

``keep="first"``: the row that arrives first is written at once, later ones within ``delay`` are dropped
(``dropDuplicatesWithinWatermark``); which of two rows of one micro-batch comes first is not defined.

In both forms a row older than the watermark (the latest message time so far less ``delay``) is dropped, and state older
than that is forgotten, so the state is bounded by the keys of one ``delay`` and ``gap``, not by the table. The watermark
moves with the messages: rows in a source's last ``delay`` and ``gap`` stay in state until later ones arrive; a
message that carries nothing but a time (a heartbeat) is enough. Rows with a NULL field or an unreadable time go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.operators import clean
from cadence.session import SHUFFLES_GO_AT_ONCE, settings

TIME = "_event_time"
#: State of many keys lies in RocksDB, compressed and outside the heap, which would hold it twice at a restart.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}


def silver_stream(bronze: DataFrame, columns: list[str], keep: str = "smallest", key: str = clean.DEDUPE_KEY, time_col: str = "kafka_timestamp",
                  delay: str = "1 hour", gap: str = "1 day") -> DataFrame:
    """The Silver rows of a streaming ``bronze`` with the message ``columns``."""
    timed = bronze.select(*columns).withColumn(TIME, F.try_to_timestamp(F.col(time_col))).withWatermark(TIME, delay)
    # one predicate that needs the event time: Catalyst would move the others ahead of the watermark, which then
    # would not see the time of a heartbeat or of any other row that is dropped here
    whole = timed.where(~F.greatest(*[F.col(c).isNull() for c in [TIME, *columns]]))
    if keep == "first":
        one = whole.dropDuplicatesWithinWatermark([key]).drop(TIME)
    elif keep == "smallest":
        rest = [c for c in columns if c != key and c not in clean.DEDUPE_ORDER]
        row = F.struct(*[F.col(c) for c in [*clean.DEDUPE_ORDER, *rest]])
        one = whole.groupBy(key, F.session_window(TIME, gap).alias("_session")).agg(F.min(row).alias("_row")).select(key, "_row.*")
    else:
        raise ValueError(f"keep: {keep}")
    return clean.with_flag(clean.in_range(one.select(*columns), "popularity", 0, 100))


def stream_silver(spark: SparkSession, bronze_path: str, silver_path: str, checkpoint: str, schema: T.StructType, fmt: str = "parquet",
                  processing_time: str | None = None, partitions: int | None = None, **options):
    """Append the Silver rows of a growing Bronze table; a rerun goes on from the checkpoint with its state.
    Without ``processing_time`` it ends with what is there, else the caller stops the query that is returned.
    ``partitions``: into how many the first run deals rows and state (the checkpoint keeps the number; the session's own
    where none is named). A task sorts the rows of one, so many rows need many."""
    bronze = spark.readStream.schema(schema).format(fmt).load(bronze_path)
    rows = silver_stream(bronze, schema.names, **options)
    writer = rows.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    with settings(spark, STATE_SETTINGS | SHUFFLES_GO_AT_ONCE | ({"spark.sql.shuffle.partitions": str(partitions)} if partitions else {})):
        query = writer.start(silver_path)
    if not processing_time:
        query.awaitTermination()
    return query
