"""Queries: messages, cleaning, Silver, Gold and the layer report."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.functions.expressions import flag_to_int
from cadence.operators import aggregate, clean
from cadence.plans import binding, frames
from cadence.plans.oracle_sql import _NOT_NULL, with_ctes
from cadence.plans.registry import register
from cadence.sources import messages
from cadence.sources.schemas import MESSAGE_COLUMNS


@register("json_encode", with_ctes("SELECT * FROM trk", "trk"))
def json_encode(spark, sf):
    """Rows -> JSON messages -> rows: the round trip must be lossless."""
    return messages.decode(messages.encode(binding.tracks(spark, sf)))


@register("json_decode", """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def json_decode(spark, sf):
    ev = binding.events(spark, sf, ["event_id", "event_type", "props"])
    parsed = F.from_json("props", "k INT", {"mode": "PERMISSIVE"})
    return ev.select("event_id", "event_type", parsed.getField("k").alias("k"))


@register("null_counts", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count FROM trk"
    for c in MESSAGE_COLUMNS), "trk"))
def null_counts(spark, sf):
    return clean.null_counts(frames.bronze(spark, sf))


@register("clean_drop_nulls", with_ctes(f"SELECT * FROM trk WHERE {_NOT_NULL}", "trk"))
def clean_drop_nulls(spark, sf):
    return clean.drop_nulls(frames.bronze(spark, sf))


@register("clean_dedupe", with_ctes("SELECT * FROM deduped", "deduped"))
def clean_dedupe(spark, sf):
    return clean.dedupe(clean.drop_nulls(frames.bronze_by_track(spark, sf)))


@register("clean_range", with_ctes("SELECT * FROM trk WHERE popularity BETWEEN 0 AND 100", "trk"))
def clean_range(spark, sf):
    return clean.in_range(frames.bronze(spark, sf), "popularity", 0, 100)


@register("flag_to_int", with_ctes("""
SELECT explicit AS explicit_text,
  CAST(CASE WHEN explicit = 'True' THEN 1 WHEN explicit = 'False' THEN 0 ELSE 0 END AS INTEGER) AS explicit_flag,
  count(*) AS track_count
FROM trk GROUP BY 1, 2""", "trk"))
def flag_to_int_q(spark, sf):
    b = frames.bronze(spark, sf)
    return (b.groupBy(F.col("explicit").alias("explicit_text"),
                      flag_to_int("explicit").alias("explicit_flag"))
            .agg(F.count(F.lit(1)).alias("track_count")))


@register("silver", with_ctes("SELECT * FROM silver", "silver"))
def silver(spark, sf):
    return frames.compute_silver(spark, sf)


@register("clean_stages", with_ctes("""
SELECT CAST(stage_no AS INTEGER) AS stage_no, stage, CAST(n AS BIGINT) AS "rows" FROM (VALUES
  (1, 'bronze', (SELECT count(*) FROM trk)),
  (2, 'drop_nulls', (SELECT count(*) FROM trk WHERE """ + _NOT_NULL + """)),
  (3, 'dedupe', (SELECT count(*) FROM deduped)),
  (4, 'range_filter', (SELECT count(*) FROM deduped WHERE popularity BETWEEN 0 AND 100))
) t(stage_no, stage, n)""", "deduped"))
def clean_stages(spark, sf):
    return clean.clean_stages(frames.bronze(spark, sf), frames.dedupe_partitions(spark, sf))


_GOLD_SQL = """
SELECT track_genre, count(track_id) AS track_count,
  round(avg(popularity), 2) AS avg_popularity, round(avg(danceability), 4) AS avg_danceability,
  round(avg(energy), 4) AS avg_energy, round(avg(tempo), 2) AS avg_tempo,
  round(avg(loudness), 2) AS avg_loudness, round(avg(valence), 4) AS avg_valence
FROM silver GROUP BY track_genre"""


@register("gold_genre_summary", with_ctes(_GOLD_SQL, "silver"))
def gold_genre_summary(spark, sf):
    return aggregate.gold_genre_summary(frames.silver(spark, sf))


def flagship(spark, sf):
    """Per-genre summary of cleaned messages: rows -> JSON messages -> decoded
    Bronze -> Silver -> Gold."""
    bronze = frames.bronze_via_messages(spark, sf)
    return aggregate.gold_genre_summary(clean.silver(bronze, frames.dedupe_partitions(spark, sf)))


@register("flagship_gold", with_ctes(_GOLD_SQL, "silver"))
def flagship_gold(spark, sf):
    return flagship(spark, sf)


@register("layer_report", with_ctes("""
SELECT metric, CAST(value AS BIGINT) AS value FROM (VALUES
  ('bronze', (SELECT count(*) FROM trk)),
  ('silver', (SELECT count(*) FROM silver)),
  ('gold', (SELECT count(DISTINCT track_genre) FROM silver)),
  ('removed', (SELECT count(*) FROM trk) - (SELECT count(*) FROM silver)),
  ('genres', (SELECT count(DISTINCT track_genre) FROM silver))
) t(metric, value)""", "silver"))
def layer_report(spark, sf):
    b = frames.bronze(spark, sf)
    s = frames.silver(spark, sf)
    g = aggregate.gold_genre_summary(s)
    return clean.layer_report(b, s, g)
