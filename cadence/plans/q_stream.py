"""Queries: message publishing and streaming ingest, layer and result-file round
trips, and the message-time reports over the event stream."""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import functions as F

from cadence.functions.expressions import safe_name
from cadence.operators import aggregate, evaluate, features, guards
from cadence.plans import binding, frames
from cadence.plans.oracle_sql import with_ctes
from cadence.plans.q_eval import _rules_q, best_model
from cadence.plans.registry import register
from cadence.session import SHUFFLES_GO_AT_ONCE, cut_lineage, scratch_path, settings
from cadence.sources import messages, results
from cadence.sources.schemas import EVENT_SCHEMA, MESSAGE_COLUMNS, MESSAGE_SCHEMA
from cadence.sources.tables import prune_catalog_layer, read_layer, resolve_layer, write_catalog_layer, write_layer
from cadence.streaming import ingest, silver

_EVENTS_SQL = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


def _publish(spark, df, name):
    path = scratch_path(spark, name)
    messages.write_messages(messages.encode(df), path)
    return path


@register("publish_messages", _EVENTS_SQL)
def publish_messages(spark, sf):
    """Events -> JSON messages in the message folder -> read back and decoded."""
    path = _publish(spark, binding.events(spark, sf), "events-msgs")
    return messages.decode(messages.read_messages(spark, path), EVENT_SCHEMA)


@register("stream_bronze", with_ctes("SELECT * FROM trk", "trk"))
def stream_bronze(spark, sf):
    """Track messages streamed into an append-only Bronze table with a checkpoint;
    a second run over the same folder adds nothing."""
    src = _publish(spark, binding.tracks(spark, sf), "track-msgs")
    bronze, ckpt = scratch_path(spark, "bronze"), scratch_path(spark, "bronze-ckpt")
    ingest.ingest_bronze(spark, src, bronze, ckpt, MESSAGE_SCHEMA)
    ingest.ingest_bronze(spark, src, bronze, ckpt, MESSAGE_SCHEMA)  # restart: no new files, no new rows
    return spark.read.parquet(bronze).drop(ingest.INGEST_DATE)


@register("stream_bounded", _EVENTS_SQL)
def stream_bounded(spark, sf):
    """A continuous run of a few seconds: half of the messages are there when it starts, the other half arrives while it
    runs; each lands once, and the rows that the listener recorded are the rows of the table."""
    ev = binding.events(spark, sf)
    src, bronze, ckpt = (scratch_path(spark, n) for n in ("bounded-src", "bounded", "bounded-ckpt"))
    messages.write_messages(messages.encode(ev.where("event_id % 2 = 0")), src)
    rest = threading.Timer(1.0, lambda: messages.write_messages(messages.encode(ev.where("event_id % 2 = 1")), src))
    rest.start()
    first = ingest.ingest_bounded(spark, src, bronze, ckpt, EVENT_SCHEMA, seconds=4, every="1 second")
    rest.join()
    first += ingest.ingest_bounded(spark, src, bronze, ckpt, EVENT_SCHEMA, seconds=0.1, every="1 second")  # what came after a slow start
    out = spark.read.parquet(bronze).drop(ingest.INGEST_DATE)
    seen, there = sum(n for _, n in first), out.count()
    if seen != there:
        raise ValueError(f"the listener saw {seen} rows, the table has {there}")
    return out


@register("stream_silver", with_ctes("SELECT * FROM silver", "silver"))
def stream_silver(spark, sf):
    """Bronze -> Silver as a stream in two runs over one checkpoint. The first run keeps every row as state; a heartbeat
    far ahead then moves the watermark past all sessions, and the second run writes the smallest row of each key."""
    bronze, out, ckpt = (scratch_path(spark, n) for n in ("silver-src", "stream-silver", "stream-silver-ckpt"))
    with settings(spark, SHUFFLES_GO_AT_ONCE):
        frames.bronze(spark, sf).write.parquet(bronze, compression="zstd")
    span = {"delay": "1 hour", "gap": "36500 days", "partitions": binding.partitions(spark, sf)}
    silver.stream_silver(spark, bronze, out, ckpt, MESSAGE_SCHEMA, **span)
    beat = spark.range(1).select(*[F.lit("2999-01-01T00:00:00.000000" if c == "kafka_timestamp" else None).cast(MESSAGE_SCHEMA[c].dataType).alias(c) for c in MESSAGE_COLUMNS])
    beat.write.mode("append").parquet(bronze)
    silver.stream_silver(spark, bronze, out, ckpt, MESSAGE_SCHEMA, **span)
    return spark.read.parquet(out)


@register("stream_silver_first", with_ctes("SELECT track_id, count(*) AS kept FROM (SELECT DISTINCT track_id FROM deduped) GROUP BY 1", "deduped"))
def stream_silver_first(spark, sf):
    """The form that writes at once: one row of each key, whichever came first (its popularity may be out of range, so
    the range is widened here)."""
    bronze, out, ckpt = (scratch_path(spark, n) for n in ("first-src", "stream-first", "stream-first-ckpt"))
    frames.bronze(spark, sf).withColumn("popularity", F.least("popularity", F.lit(100))).write.parquet(bronze)
    silver.stream_silver(spark, bronze, out, ckpt, MESSAGE_SCHEMA, keep="first", delay="36500 days")
    return spark.read.parquet(out).groupBy("track_id").agg(F.count(F.lit(1)).alias("kept"))


@register("stream_tail", _EVENTS_SQL + " WHERE event_id % 2 = 0")
def stream_tail(spark, sf):
    """Tail from the latest position: half of the messages are there before the tail starts, the
    other half arrives afterwards; the tail sees exactly those."""
    ev = binding.events(spark, sf)
    src = scratch_path(spark, "tail-src")
    messages.write_messages(messages.encode(ev.where("event_id % 2 = 1")), src)
    out, ckpt = scratch_path(spark, "tail-out"), scratch_path(spark, "tail-ckpt")
    run = ingest.tail(spark, src, out, ckpt, EVENT_SCHEMA, skip_existing=True)
    messages.write_messages(messages.encode(ev.where("event_id % 2 = 0")), src)
    run()
    return spark.read.parquet(out)


@register("stream_quarantine", """
SELECT event_id % 10 = 0 AS bad, count(*) AS "rows" FROM events GROUP BY 1""")
def stream_quarantine(spark, sf):
    """Every tenth message is cut off before it is published: it lands in the quarantine table,
    the others in the good one, and together they are all messages."""
    ev = binding.events(spark, sf)
    whole = messages.encode(ev.where("event_id % 10 <> 0"))
    broken = messages.encode(ev.where("event_id % 10 = 0")).select(F.expr("left(value, length(value) - 9)").alias("value"))
    src = scratch_path(spark, "mixed-msgs")
    messages.write_messages(whole.unionByName(broken), src)
    good, bad = scratch_path(spark, "good"), scratch_path(spark, "bad")
    ingest.ingest_with_quarantine(spark, src, good, bad, scratch_path(spark, "mixed-ckpt"), EVENT_SCHEMA)
    side = lambda path, flag: spark.read.parquet(path).agg(F.lit(flag).alias("bad"), F.count(F.lit(1)).alias("rows"))
    return side(good, False).unionByName(side(bad, True))


@register("message_stamp", """
SELECT count(*) AS messages, count(*) AS stamped, 1 AS event_types FROM lineitem JOIN part ON l_partkey = p_partkey""")
def message_stamp(spark, sf):
    """What a producer adds: send time, user id and event type on every message."""
    m = messages.stamp(binding.tracks(spark, sf).drop("kafka_timestamp", "user_id", "event_type"))
    return m.agg(F.count(F.lit(1)).alias("messages"),
                 F.count_if(F.col("user_id").isNotNull() & F.try_to_timestamp("kafka_timestamp").isNotNull()).alias("stamped"),
                 F.count_distinct("event_type").cast("int").alias("event_types"))


@register("stream_hourly_trend", """
SELECT date_trunc('hour', ts) AS hour, count(*) AS message_count FROM events GROUP BY 1""")
def stream_hourly_trend(spark, sf):
    src = _publish(spark, binding.events(spark, sf), "trend-msgs")
    out, ckpt = scratch_path(spark, "trend"), scratch_path(spark, "trend-ckpt")
    ingest.hourly_trend(spark, src, out, ckpt, EVENT_SCHEMA)
    return ingest.read_trend(spark, out)


# ------------------------------------------------------------------ layer round trips

@register("silver_roundtrip", with_ctes("SELECT * FROM silver", "silver"))
def silver_roundtrip(spark, sf):
    """Silver overwritten as a new version, read back through the pointer, and its
    row count checked against the rows the write reported."""
    root = scratch_path(spark, "silver")
    write_layer(frames.compute_silver(spark, sf), root)
    write_layer(frames.compute_silver(spark, sf), root)  # overwrite: readers see one version
    return read_layer(spark, root)


@register("features_roundtrip", with_ctes("SELECT * FROM feat", "feat"))
def features_roundtrip(spark, sf):
    root = scratch_path(spark, "features")
    write_layer(frames.silver(spark, sf), root)           # an older, narrower schema
    write_layer(frames.compute_features(spark, sf), root)  # replaced with the 28-column one
    return read_layer(spark, root)


@register("resolve_layer", with_ctes("SELECT * FROM silver", "silver"))
def resolve_layer_q(spark, sf):
    """First existing of (features, silver, bronze): features was never written."""
    base = scratch_path(spark, "lake")
    write_layer(frames.silver(spark, sf), f"{base}/silver")
    write_layer(frames.bronze(spark, sf), f"{base}/bronze")
    _, df = resolve_layer(spark, [f"{base}/features", f"{base}/silver", f"{base}/bronze"])
    return df


@register("csv_scan", with_ctes("SELECT * FROM trk", "trk"))
def csv_scan(spark, sf):
    """Raw rows as a CSV file with header and quoted text, scanned with a fixed schema."""
    path = scratch_path(spark, "raw-csv")
    results.write_csv(binding.tracks(spark, sf), path)
    return results.read_csv(spark, path, MESSAGE_SCHEMA)


_MARKS = "event_id, event_type || chr(10) || 'a\\b' || chr(13) || chr(10) || '\"q\", \\n ' || props AS note"


@register("csv_line_ends", f"SELECT {_MARKS} FROM events")
def csv_line_ends(spark, sf):
    """Values with line ends, backslashes, quotes and commas: escaped in a splittable file and read back."""
    note = F.concat("event_type", F.lit("\na\\b\r\n\"q\", \\n "), "props")
    df = binding.events(spark, sf).select("event_id", note.alias("note"))
    path = scratch_path(spark, "line-ends")
    results.write_csv(df, path, line_ends="escape")
    return results.read_csv(spark, path, df.schema, line_ends="escaped")


def _raw_export(spark, sf):
    """A raw file as other tools write it: byte-order mark, an unnamed index column, text in number fields."""
    t = binding.tracks(spark, sf)
    broken = {"popularity": (F.col("key") == 3, F.concat(F.col("popularity").cast("string"), F.lit(" pts"))), "tempo": (F.col("key") == 5, F.lit("fast"))}
    path = scratch_path(spark, "raw-export")
    columns = [F.when(broken[c][0], broken[c][1]).otherwise(F.col(c).cast("string")).alias(c) if c in broken else F.col(c) for c in t.columns]
    results.write_csv(t.select(F.concat("track_id", F.lit("-"), "user_id").alias(" "), *columns), path, bom=True)
    return results.raw_csv(spark, path)


@register("csv_typed", with_ctes("SELECT * EXCLUDE (popularity, tempo), CASE WHEN key <> 3 THEN popularity END AS popularity, CASE WHEN key <> 5 THEN tempo END AS tempo FROM trk", "trk"))
def csv_typed(spark, sf):
    """A raw file by its header names: malformed fields are NULL one by one, the index column goes."""
    return results.typed(_raw_export(spark, sf), MESSAGE_SCHEMA)


@register("csv_rejects", with_ctes(" UNION ALL ".join(
    f"SELECT {i + 1} AS position, '{f.name}' AS field, '{f.dataType.simpleString()}' AS data_type, count({f.name}) AS present, "
    + {"popularity": "count(*) FILTER (WHERE key = 3) AS rejected, min(popularity || ' pts') FILTER (WHERE key = 3) AS example",
       "tempo": "count(*) FILTER (WHERE key = 5) AS rejected, min(CASE WHEN key = 5 THEN 'fast' END) AS example"}.get(f.name, "0 AS rejected, NULL AS example")
    + " FROM trk" for i, f in enumerate(MESSAGE_SCHEMA.fields)), "trk"))
def csv_rejects(spark, sf):
    """The report beside it: values there, values that don't fit and one of them, for each field."""
    return results.rejects(_raw_export(spark, sf), MESSAGE_SCHEMA)


@register("catalog_layer", with_ctes("SELECT * FROM feat", "feat"))
def catalog_layer(spark, sf):
    """A layer by its name in the catalog: Silver first, then overwritten by the feature table that is computed from it
    (read while it is replaced, another schema); the old version goes once the new one is shown."""
    name, place = f"layer_{uuid.uuid4().hex[:12]}", scratch_path(spark, "catalog")
    write_catalog_layer(frames.silver(spark, sf), name, place)
    _, rows = write_catalog_layer(features.feature_table(spark.table(name)), name, place)
    out = spark.table(name)
    if rows != out.count() or len(prune_catalog_layer(spark, name, keep=1)) != 1:
        raise ValueError(f"{name}: {rows} rows were written, {out.count()} are there")
    return out


_GOLD = """
SELECT track_genre, count(track_id) AS track_count,
  round(avg(popularity), 2) AS avg_popularity, round(avg(danceability), 4) AS avg_danceability,
  round(avg(energy), 4) AS avg_energy, round(avg(tempo), 2) AS avg_tempo,
  round(avg(loudness), 2) AS avg_loudness, round(avg(valence), 4) AS avg_valence
FROM silver GROUP BY track_genre"""


@register("result_csv_roundtrip", with_ctes(_GOLD, "silver"))
def result_csv_roundtrip(spark, sf):
    gold = aggregate.gold_genre_summary(frames.silver(spark, sf))
    path = scratch_path(spark, "gold-csv")
    results.write_csv(gold, path)
    return results.read_csv(spark, path, gold.schema)


@register("result_json_roundtrip", _rules_q("""
SELECT model AS best_model_name, 'f1_weighted' AS selection_metric, f1_weighted AS best_f1_weighted
FROM metrics ORDER BY f1_weighted DESC, model_order LIMIT 1"""))
def result_json_roundtrip(spark, sf):
    best = best_model(spark, sf)
    path = scratch_path(spark, "best-json")
    results.write_json(best, path)
    return results.read_json(spark, path, best.schema)


_CLASSES = "(SELECT count(DISTINCT p_brand) FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem))"


@register("results_load", f"""
SELECT name, CAST(n AS BIGINT) AS "rows" FROM (VALUES ('model_metrics', 5), ('best_confusion_matrix', {_CLASSES}),
  ('forest_importance', 18), ('boosted_importance', 18), ('label_mapping', {_CLASSES}), ('best_model', 1)) t(name, n)""")
def results_load(spark, sf):
    """Write the six result files of the trained models, then load them all, failing if any is missing: five tables
    as CSV with a byte-order mark, the best model as a JSON document."""
    out = None
    for name, df in load_results(spark, write_results(spark, sf)).items():
        c = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows")
        out = c if out is None else out.unionByName(c)
    return out


def write_results(spark, sf):
    """(root, schemas): the result files of the trained models, and each model's metrics as a document of its own."""
    from cadence.plans import q_ml

    root = scratch_path(spark, "results")
    metrics = cut_lineage(q_ml.model_metrics(spark, sf))  # one row a model: every file that tells of them is made from the same ones
    best = evaluate.best_model(metrics)
    tables = {"model_metrics": metrics, "best_confusion_matrix": q_ml.confusion(spark, sf, best.first().best_model_name),
              "forest_importance": q_ml.importance(spark, sf, "Random Forest"),
              "boosted_importance": q_ml.importance(spark, sf, "GBT One-vs-Rest"),
              "label_mapping": q_ml.label_mapping(spark, sf), "best_model": best}
    for name, df in tables.items():
        if name in _DOCUMENTS:
            results.write_json(df, f"{root}/{name}")
        else:
            results.write_csv(df, f"{root}/{name}", single_file=True, bom=True)
    documents = metrics.select(safe_name("model").alias("document"), F.to_json(F.struct(*metrics.columns)).alias("value"))
    documents.write.partitionBy("document").text(f"{root}/metrics")  # one folder a model
    return root, {name: df.schema for name, df in tables.items()}


_DOCUMENTS = {"best_model": "json"}


def load_results(spark, written):
    root, schemas = written
    return results.load_required(spark, root, schemas, _DOCUMENTS)


@register("model_metrics_documents")
def model_metrics_documents(spark, sf):
    """Each model's metrics read back from its JSON document."""
    root, schemas = write_results(spark, sf)
    value = F.from_json("value", schemas["model_metrics"])
    return spark.read.text(f"{root}/metrics").select("document", F.inline(F.array(value)))


# ------------------------------------------------------------------ message-time reports

def event_messages(spark, sf):
    """Event rows as decoded messages: the send time is ISO-8601 text."""
    ev = binding.events(spark, sf, ["event_id", "ts", "event_type"])
    return ev.select("event_id", "event_type",
                     F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("kafka_timestamp"))


def _msg_time(df, candidates=("kafka_timestamp", "timestamp")):
    """Parse the first present time column; bad text gives NULL (and is dropped)."""
    present = [c for c in candidates if c in df.columns]
    if not present:
        raise ValueError(f"none of the time columns {list(candidates)} is present")
    return F.try_to_timestamp(F.col(present[0]))


@register("messages_by_hour", """
SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS message_count FROM events GROUP BY 1""")
def messages_by_hour(spark, sf):
    m = event_messages(spark, sf).withColumn("t", _msg_time(event_messages(spark, sf)))
    return m.groupBy(F.hour("t").alias("hour")).agg(F.count(F.lit(1)).alias("message_count")).orderBy("hour")


@register("messages_by_minute", """
SELECT CAST(minute(ts) AS INTEGER) AS minute, count(*) AS message_count FROM events GROUP BY 1""")
def messages_by_minute(spark, sf):
    m = event_messages(spark, sf).withColumn("t", _msg_time(event_messages(spark, sf)))
    return m.groupBy(F.minute("t").alias("minute")).agg(F.count(F.lit(1)).alias("message_count")).orderBy("minute")


@register("hourly_trend", """
SELECT date_trunc('hour', ts) AS hour, count(*) AS message_count FROM events GROUP BY 1""")
def hourly_trend(spark, sf):
    def report(m):
        t = m.select(_msg_time(m).alias("t")).where(F.col("t").isNotNull())
        return (t.groupBy(F.date_trunc("hour", "t").cast("timestamp_ntz").alias("hour"))
                .agg(F.count(F.lit(1)).alias("message_count")).orderBy("hour"))

    return guards.guarded(event_messages(spark, sf), ["event_id"], "hourly_trend", report)


@register("event_type_counts", """
SELECT CASE WHEN grouping(event_type) = 1 THEN 'ALL' ELSE event_type END AS event_type,
  count(*) AS event_count FROM events GROUP BY ROLLUP (event_type)""")
def event_type_counts(spark, sf):
    counts = binding.events(spark, sf, ["event_type"]).groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"))
    # the total from the counts, not from the rows again: one aggregate over the table
    pair = lambda name: F.struct(name.alias("event_type"), F.col("event_count"))
    both = F.array(pair(F.col("event_type")), pair(F.lit("ALL")))
    return (counts.select(F.posexplode(both).alias("side", "x")).groupBy("side", F.col("x.event_type").alias("event_type"))
            .agg(F.sum("x.event_count").alias("event_count")).select("event_type", "event_count"))

