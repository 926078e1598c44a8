"""Binding of the driver tables to the shapes this engine works on.

The music-track data is not available, so the TPC-H-like tables are projected
into the 23-field message shape (``tracks``), the ``events`` table serves as a
second message stream (``events``), and a deterministic classifier output is
derived from ``lineitem`` (``predictions``). Each binding has a DataFrame
definition and an identical SQL definition that the DuckDB oracle uses.

At scale ``lineitem`` is the fact table and ``part`` grows with it (1/30 of
its rows), so the join is left to Catalyst/AQE: it broadcasts ``part`` only
when its measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and
otherwise shuffles both sides on the part key, into more partitions the larger
``lineitem`` is (``partitions``), so that a task sorts about as many rows at any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.sources.tables import read_table, table_bytes

LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate"]
PART_COLS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


#: Bytes of the ``lineitem`` files for a partition of the shuffles of all track rows (about 600,000 rows), and how many
#: such partitions the session's own setting is left to deal with.
PARTITION_BYTES = 8 << 20
FEW_PARTITIONS = 8


def partitions(spark: SparkSession, sf_dir: str) -> int | None:
    """Partitions that a shuffle of all track rows needs for sorts that stay in memory; None: the session's own will do."""
    n = -(-table_bytes(spark, sf_dir, "lineitem") // PARTITION_BYTES)
    return max(n, int(spark.conf.get("spark.sql.shuffle.partitions"))) if n > FEW_PARTITIONS else None


def _f32(c: Column) -> Column:
    return c.cast("float")


def tracks(spark: SparkSession, sf_dir: str, by_track: int | None = None) -> DataFrame:
    """Raw track messages as rows: lineitem joined to part, 23 message fields. ``by_track``: rows are dealt by ``track_id``
    to so many partitions, as the tables' own columns, which are half as wide as the fields made of them."""
    li = read_table(spark, sf_dir, "lineitem", LINEITEM_COLS)
    part = read_table(spark, sf_dir, "part", PART_COLS)
    if n := partitions(spark, sf_dir):  # the smaller side gives the number; where it is broadcast, that shuffle is small
        part = part.repartition(n, "p_partkey")
    j = li.join(part, li.l_partkey == part.p_partkey, "inner").withColumn("track_id", F.col("l_orderkey").cast("string"))
    if by_track:
        j = j.drop("l_orderkey", "p_partkey").repartition(by_track, "track_id")
    return j.select(
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("kafka_timestamp"),
        F.concat(F.lit("user-"), F.col("l_suppkey").cast("string")).alias("user_id"),
        F.lit("track_played").alias("event_type"),
        F.col("track_id"),
        F.col("p_name").alias("track_name"),
        F.col("p_type").alias("artists"),
        F.concat(F.lit("album-"), F.col("l_partkey").cast("string")).alias("album_name"),
        F.col("p_brand").alias("track_genre"),
        F.floor(F.col("l_quantity") * 2.5).cast("int").alias("popularity"),
        F.floor(F.col("l_extendedprice") * 6).cast("int").alias("duration_ms"),
        F.when(F.col("l_returnflag") == "A", "True")
         .when(F.col("l_returnflag") == "N", "False")
         .when(F.col("l_returnflag") == "R", "yes").alias("explicit"),
        _f32(F.col("l_discount") * 10).alias("danceability"),
        _f32(F.col("l_quantity") / 50).alias("energy"),
        (F.col("l_partkey") % 12).cast("int").alias("key"),
        _f32(F.col("p_retailprice") - 950).alias("loudness"),
        (F.col("l_linenumber") % 2).cast("int").alias("mode"),
        _f32(F.col("l_tax") * 10).alias("speechiness"),
        _f32(F.col("p_size") / F.lit(50.0)).alias("acousticness"),
        _f32((F.col("l_suppkey") % 100) / F.lit(100.0)).alias("instrumentalness"),
        _f32(F.col("l_linenumber") / F.lit(7.0)).alias("liveness"),
        _f32(F.nullif(F.col("l_tax"), F.lit(0.0)) * 12.5).alias("valence"),
        _f32(F.col("p_size") * 2 + 60).alias("tempo"),
        ((F.col("l_linenumber") % 4) + 2).cast("int").alias("time_signature"),
    )


TRACKS_SQL = """
SELECT
  strftime(l.l_shipdate, '%Y-%m-%dT%H:%M:%S.%f') AS kafka_timestamp,
  'user-' || CAST(l.l_suppkey AS VARCHAR) AS user_id,
  'track_played' AS event_type,
  CAST(l.l_orderkey AS VARCHAR) AS track_id,
  p.p_name AS track_name,
  p.p_type AS artists,
  'album-' || CAST(p.p_partkey AS VARCHAR) AS album_name,
  p.p_brand AS track_genre,
  CAST(floor(l.l_quantity * 2.5e0) AS INTEGER) AS popularity,
  CAST(floor(l.l_extendedprice * 6) AS INTEGER) AS duration_ms,
  CASE l.l_returnflag WHEN 'A' THEN 'True' WHEN 'N' THEN 'False' WHEN 'R' THEN 'yes' END AS explicit,
  CAST(l.l_discount * 10 AS FLOAT) AS danceability,
  CAST(l.l_quantity / 50 AS FLOAT) AS energy,
  CAST(l.l_partkey % 12 AS INTEGER) AS key,
  CAST(p.p_retailprice - 950 AS FLOAT) AS loudness,
  CAST(l.l_linenumber % 2 AS INTEGER) AS mode,
  CAST(l.l_tax * 10 AS FLOAT) AS speechiness,
  CAST(p.p_size / 50e0 AS FLOAT) AS acousticness,
  CAST((l.l_suppkey % 100) / 100e0 AS FLOAT) AS instrumentalness,
  CAST(l.l_linenumber / 7e0 AS FLOAT) AS liveness,
  CAST(nullif(l.l_tax, 0e0) * 12.5e0 AS FLOAT) AS valence,
  CAST(p.p_size * 2 + 60 AS FLOAT) AS tempo,
  CAST((l.l_linenumber % 4) + 2 AS INTEGER) AS time_signature
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
"""


def events(spark: SparkSession, sf_dir: str, columns=None) -> DataFrame:
    return read_table(spark, sf_dir, "events", columns)


# Classifier output bound to lineitem: label from the return flag, prediction from
# the quantity, raw scores as four linear forms (ties occur: quantity is integral). Class 3
# never occurs in the truth, and the largest quantity is predicted as a class that does not exist.
PRED_CLASSES = ["A", "N", "R", "X"]
OUT_OF_RANGE = 7


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                     "l_discount", "l_tax", "l_returnflag"])
    q, d, t = F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1)
         .otherwise(2).cast("int").alias("label"),
        F.when(q < 18, 0).when(q < 35, 1).when(q < 47, 2).when(q < 50, 3).otherwise(OUT_OF_RANGE)
         .cast("int").alias("prediction"),
        F.array(
            (F.lit(50.0) - q) / 10 + d * 10,
            F.lit(2.5) - F.abs(q - 26) / 10 + t * 10,
            q / 10 - t * 10,
            q / 10 - 4.5,
        ).alias("raw_scores"),
    )


PREDICTIONS_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS INTEGER) AS label,
  CAST(CASE WHEN l_quantity < 18 THEN 0 WHEN l_quantity < 35 THEN 1 WHEN l_quantity < 47 THEN 2
       WHEN l_quantity < 50 THEN 3 ELSE 7 END AS INTEGER) AS prediction,
  (50e0 - l_quantity) / 10 + l_discount * 10 AS s0,
  2.5e0 - abs(l_quantity - 26) / 10 + l_tax * 10 AS s1,
  l_quantity / 10 - l_tax * 10 AS s2,
  l_quantity / 10 - 4.5e0 AS s3
FROM lineitem
"""
