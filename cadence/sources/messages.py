"""Message encoding/decoding and the message-file source/sink.

A message is one JSON object per row in a ``value`` column, as a Kafka record
value would be. Where the Kafka connector is on the classpath the same frames
read from / write to ``format("kafka")``; here files carry the messages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.sources.schemas import MESSAGE_SCHEMA

CORRUPT_COLUMN = "_corrupt_record"
#: Of message files (about a sixth of the bytes at no more CPU time; gzip is smaller and slower). One task reads a file.
FILE_COMPRESSION = "lz4"


# Message time formats (microseconds kept).
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
TS_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
JSON_OPTIONS = {"timestampFormat": TS_FORMAT, "timestampNTZFormat": TS_NTZ_FORMAT}


def encode(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Rows -> one JSON text per row; NULL fields are kept as ``null``."""
    opts = dict(JSON_OPTIONS, ignoreNullFields="false")
    return df.select(F.to_json(F.struct(*df.columns), opts).alias(value_col))


def stamp(df: DataFrame) -> DataFrame:
    """What a producer adds to each raw row: send time, a user id, the event type."""
    return df.select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("kafka_timestamp"),
        F.expr("uuid()").alias("user_id"),
        F.lit("track_played").alias("event_type"),
        *[c for c in df.columns if c not in ("kafka_timestamp", "user_id", "event_type")],
    )


def decode(df: DataFrame, schema: T.StructType = MESSAGE_SCHEMA,
           value_col: str = "value") -> DataFrame:
    """JSON text (or bytes) -> typed columns. Permissive: unparsable text gives an
    all-NULL row, a field of the wrong JSON kind gives NULL in that field alone."""
    text = F.col(value_col).cast("string")
    opts = dict(JSON_OPTIONS, mode="PERMISSIVE")
    # inline(array(struct)) expands the parsed struct in one step; selecting
    # "data.*" lets the optimizer split the parse into one pruned parse per field
    return df.select(F.inline(F.array(F.from_json(text, schema, opts))))


def decode_with_quarantine(df: DataFrame, schema: T.StructType = MESSAGE_SCHEMA,
                           value_col: str = "value") -> DataFrame:
    """Like ``decode`` but keeps the raw text of messages that failed to parse in
    ``_corrupt_record`` (NULL for good messages), so they can be routed apart."""
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COLUMN, T.StringType())])
    text = F.col(value_col).cast("string")
    parsed = F.from_json(text, with_corrupt,
                         dict(JSON_OPTIONS, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT_COLUMN))
    return df.select(parsed.alias("data")).select("data.*")


def write_messages(df: DataFrame, path: str | None, mode: str = "append", fmt: str = "text",
                   options: dict | None = None) -> None:
    """Publish encoded messages: text files (one JSON per line, compressed: JSON repeats every
    field name in every row) here, or a topic with ``fmt="kafka"`` and ``options`` naming servers and topic where the
    connector is on the classpath (not available in this environment)."""
    writer = df.select("value").write.mode(mode)
    if fmt == "text":
        writer.text(path, compression=FILE_COMPRESSION)
        return
    writer = writer.format(fmt)
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    writer.save()


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_message_stream(spark: SparkSession, path: str, fmt: str = "text",
                        options: dict | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming source of messages: ``text`` files here, ``kafka`` on a cluster
    with the connector (then ``options`` carry bootstrap servers and topic)."""
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":  # from the first message, unless the caller says otherwise
        options = {"startingOffsets": "earliest"} | (options or {})
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if fmt == "text":
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return reader.load(path)
    return reader.load()
