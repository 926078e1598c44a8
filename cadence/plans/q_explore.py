"""Queries: features, profiling, grouped reports, distributions and correlation.

Aggregated doubles (means, correlations, quantiles) are rounded to 6 digits on
both sides of the oracle, since the two engines sum in different orders.
Row-level arithmetic is compared exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.functions.expressions import (TEMPO_CUTS_MODEL, duration_minutes, popularity_class)
from cadence.operators import aggregate, features, guards, profile, stats
from cadence.operators.ordered import approx_quantiles, long_values
from cadence.plans import binding, frames
from cadence.plans.oracle_sql import with_ctes
from cadence.plans.registry import register
from cadence.sources.schemas import AUDIO_FEATURES, MESSAGE_COLUMNS

D = 6  # digits kept for aggregated doubles


def rounded(df: DataFrame, digits: int = D) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


def r(expr: str, name: str, digits: int = D) -> str:
    return f"round({expr}, {digits}) AS {name}"


def _with_long(ctes_sql: str, *names: str) -> str:
    """Prepend shared CTEs to a body that starts with more CTE definitions."""
    base = with_ctes("SELECT 1", *names)
    head = base[: base.rindex("\nSELECT 1")]
    return head + ",\n" + ctes_sql


# ------------------------------------------------------------------ features

NEW_NUMERIC = ["energy_danceability_ratio", "loudness_normalized", "energy_acoustic_contrast",
               "dancefloor_score"]


@register("features", with_ctes("SELECT * FROM feat", "feat"))
def features_q(spark, sf):
    return frames.compute_features(spark, sf)


@register("feature_projection", with_ctes("SELECT * FROM feat", "feat"))
def feature_projection(spark, sf):
    enriched = features.add_features(frames.silver(spark, sf)).withColumn("row_note", F.lit("x"))
    wanted = list(features.FEATURE_TABLE_COLUMNS) + ["not_present_column"]
    return features.feature_projection(enriched, wanted)


@register("feature_projection_missing", "SELECT * FROM (VALUES " + ", ".join(
    f"({i + 1}, '{c}', {str(c not in ('valence', 'tempo_category', 'not_present_column')).lower()})"
    for i, c in enumerate([*features.FEATURE_TABLE_COLUMNS, "not_present_column"])) + ") t(position, column_name, present)")
def feature_projection_missing(spark, sf):
    """Which wanted columns a feature table lacks (here one written without two of its columns)."""
    partial = frames.feature_table(spark, sf).drop("valence", "tempo_category")
    return guards.missing_report(partial, [*features.FEATURE_TABLE_COLUMNS, "not_present_column"])


@register("feat_energy_dance_ratio", with_ctes(
    "SELECT track_id, energy, danceability, energy_danceability_ratio FROM feat", "feat"))
def feat_ratio(spark, sf):
    s = frames.silver(spark, sf)
    return s.select("track_id", "energy", "danceability", features.energy_dance_ratio())


@register("feat_loudness_norm", with_ctes("SELECT track_id, loudness, loudness_normalized FROM feat", "feat"))
def feat_loudness(spark, sf):
    s = frames.silver(spark, sf).select("track_id", "loudness")
    return features.with_minmax(s, "loudness", "loudness_normalized")


@register("feat_tempo_category", with_ctes("SELECT track_id, tempo, tempo_category FROM feat", "feat"))
def feat_tempo(spark, sf):
    s = frames.silver(spark, sf).select("track_id", "tempo")
    return features.with_tempo_category(s)


@register("feat_tempo_category_alt", with_ctes("""
SELECT track_id, tempo, CASE WHEN CAST(tempo AS DOUBLE) < 90 THEN 'slow'
  WHEN CAST(tempo AS DOUBLE) <= 130 THEN 'medium' WHEN CAST(tempo AS DOUBLE) > 130 THEN 'fast' END
  AS tempo_category FROM silver""", "silver"))
def feat_tempo_alt(spark, sf):
    s = frames.silver(spark, sf).select("track_id", "tempo")
    return features.with_tempo_category(s, TEMPO_CUTS_MODEL)


@register("feat_contrast", with_ctes(
    "SELECT track_id, energy, acousticness, energy_acoustic_contrast FROM feat", "feat"))
def feat_contrast(spark, sf):
    return frames.silver(spark, sf).select("track_id", "energy", "acousticness", features.contrast())


@register("feat_dancefloor", with_ctes(
    "SELECT track_id, danceability, valence, dancefloor_score FROM feat", "feat"))
def feat_dancefloor(spark, sf):
    return frames.silver(spark, sf).select("track_id", "danceability", "valence", features.dancefloor())


@register("feature_ranges", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, {r(f'min({c})', 'min_value')}, {r(f'max({c})', 'max_value')}, "
    f"{r(f'avg({c})', 'mean_value')} FROM feat" for c in NEW_NUMERIC), "feat"))
def feature_ranges(spark, sf):
    return rounded(features.feature_ranges(frames.feature_table(spark, sf), NEW_NUMERIC))


def _summary_sql(cols, src, digits):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count({c}) AS count, {r(f'avg({c})', 'mean', digits)}, "
        f"{r(f'stddev_samp({c})', 'stddev', digits)}, {r(f'min(CAST({c} AS DOUBLE))', 'min', digits)}, "
        f"{r(f'max(CAST({c} AS DOUBLE))', 'max', digits)} FROM {src}" for c in cols)


@register("describe_features", with_ctes(_summary_sql(NEW_NUMERIC, "feat", D), "feat"))
def describe_features(spark, sf):
    return profile.summary_table(frames.feature_table(spark, sf), NEW_NUMERIC, D)


SUMMARY_COLS = ["popularity", "danceability", "energy", "tempo", "loudness", "acousticness",
                "valence", "duration_ms"]


@register("summary_table", with_ctes(_summary_sql(SUMMARY_COLS, "silver", 3), "silver"))
def summary_table(spark, sf):
    return profile.summary_table(frames.silver(spark, sf), SUMMARY_COLS, 3)


# ------------------------------------------------------------------ profiling

@register("schema_listing", """
SELECT CAST(row_number() OVER () AS INTEGER) AS position, column_name,
  CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
    WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' ELSE lower(column_type) END AS data_type,
  true AS nullable, present
FROM (DESCRIBE events) JOIN (UNPIVOT (SELECT COUNT(COLUMNS(*)) FROM events) ON COLUMNS(*) INTO NAME column_name VALUE present) USING (column_name)""")
def schema_listing(spark, sf):
    """The columns in order, with the rows that hold a value."""
    ev = binding.events(spark, sf)
    present = ev.agg(*[F.count(c).alias(c) for c in ev.columns]).unpivot([], ev.columns, "column_name", "present")
    return profile.schema_listing(ev).join(present, "column_name")


@register("duplicate_report", with_ctes("""
SELECT count(*) AS total_rows, count(DISTINCT track_id) AS distinct_keys,
  count(*) - count(DISTINCT track_id) AS duplicate_rows FROM trk""", "trk"))
def duplicate_report(spark, sf):
    return profile.duplicate_report(frames.bronze(spark, sf))


@register("distinct_counts", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) "
    f"AS BIGINT) AS distinct_count FROM trk" for c in MESSAGE_COLUMNS), "trk"))
def distinct_counts(spark, sf):
    return profile.distinct_counts(frames.bronze(spark, sf))


def _profile_sql():
    from cadence.sources.schemas import MESSAGE_FIELDS
    parts = []
    for i, (c, t) in enumerate(MESSAGE_FIELDS):
        num = not isinstance(t, T.StringType)
        lo = f"min(CAST({c} AS DOUBLE))" if num else "CAST(NULL AS DOUBLE)"
        hi = f"max(CAST({c} AS DOUBLE))" if num else "CAST(NULL AS DOUBLE)"
        parts.append(
            f"SELECT {i + 1} AS position, '{c}' AS column_name, '{t.simpleString()}' AS data_type, "
            f"CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS distinct_count, "
            f"count(*) FILTER (WHERE {c} IS NULL) AS null_count, {lo} AS min_value, {hi} AS max_value FROM trk")
    return " UNION ALL ".join(parts)


@register("column_profile", with_ctes(_profile_sql(), "trk"))
def column_profile(spark, sf):
    return profile.column_profile(frames.bronze(spark, sf))


# ------------------------------------------------------------------ grouped reports

@register("genre_counts", with_ctes(
    "SELECT track_genre, count(*) AS track_count FROM silver GROUP BY 1", "silver"))
def genre_counts(spark, sf):
    return aggregate.genre_counts(frames.silver(spark, sf))


@register("genre_counts_top20", with_ctes(
    "SELECT track_genre, count(*) AS track_count FROM silver GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20",
    "silver"))
def genre_counts_top20(spark, sf):
    return aggregate.genre_counts_top(frames.silver(spark, sf), 20)


@register("genre_counts_rarest", with_ctes(
    "SELECT track_genre, count(*) AS track_count FROM silver GROUP BY 1 ORDER BY 2, 1 LIMIT 20", "silver"))
def genre_counts_rarest(spark, sf):
    return aggregate.genre_counts_rarest(frames.silver(spark, sf), 20)


@register("genre_count_total", with_ctes(
    "SELECT count(DISTINCT track_genre) AS genre_total FROM silver", "silver"))
def genre_count_total(spark, sf):
    return aggregate.group_total(frames.silver(spark, sf))


@register("top_genres_by_popularity", with_ctes(f"""
SELECT track_genre, {r('avg_popularity', 'avg_popularity')}, {r('avg_popularity * 100.0 / sum(avg_popularity) OVER ()', 'share_pct')}
FROM (SELECT track_genre, avg(popularity) AS avg_popularity FROM silver GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)""",
    "silver"))
def top_genres_by_popularity(spark, sf):
    return rounded(aggregate.top_genres_by_popularity(frames.silver(spark, sf), 10))


@register("top_genres_by_count", with_ctes(f"""
SELECT track_genre, track_count, {r('track_count * 100.0 / sum(track_count) OVER ()', 'share_pct')}
FROM (SELECT track_genre, count(*) AS track_count FROM silver GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)""",
    "silver"))
def top_genres_by_count(spark, sf):
    return guards.guarded(frames.feature_table(spark, sf), ["track_genre"], "top_genres_by_count",
                          lambda f: rounded(aggregate.top_genres_by_count(f, 10)))


@register("genre_dance_energy_top15", with_ctes(f"""
SELECT track_genre, {r('avg(danceability)', 'avg_danceability')}, {r('avg(energy)', 'avg_energy')}
FROM silver GROUP BY 1 ORDER BY avg(danceability) DESC, 1 LIMIT 15""", "silver"))
def genre_dance_energy_top15(spark, sf):
    return rounded(aggregate.mean_by_genre_top(frames.silver(spark, sf), ["danceability", "energy"],
                                               "danceability", 15))


@register("genre_energy_top20", with_ctes(f"""
SELECT track_genre, {r('avg(CAST(energy AS DOUBLE))', 'avg_energy')}
FROM feat WHERE energy IS NOT NULL GROUP BY 1 ORDER BY avg(CAST(energy AS DOUBLE)) DESC, 1 LIMIT 20""", "feat"))
def genre_energy_top20(spark, sf):
    def report(f):
        f = f.select("track_genre", F.col("energy").cast("double").alias("energy"))
        return rounded(aggregate.mean_by_genre_top(f, ["energy"], "energy", 20, drop_null=True))

    return guards.guarded(frames.feature_table(spark, sf), ["track_genre", "energy"], "genre_energy_top20", report)


@register("duration_by_genre", with_ctes(f"""
SELECT track_genre, {r('avg(duration_ms / 60000e0)', 'avg_duration_min')}
FROM silver GROUP BY 1 ORDER BY avg(duration_ms / 60000e0) DESC, 1 LIMIT 20""", "silver"))
def duration_by_genre(spark, sf):
    s = frames.silver(spark, sf).select("track_genre", duration_minutes().alias("duration_min"))
    return rounded(aggregate.mean_by_genre_top(s, ["duration_min"], "duration_min", 20))


@register("explicit_effect", with_ctes(f"""
SELECT explicit, count(*) AS track_count, {r('avg(popularity)', 'avg_popularity')},
  CASE explicit WHEN 1 THEN 'explicit' WHEN 0 THEN 'clean' END AS content
FROM silver GROUP BY explicit""", "silver"))
def explicit_effect(spark, sf):
    return rounded(aggregate.explicit_effect(frames.silver(spark, sf)))


# The six genres compared by the fingerprint chart, bound to six brands.
FINGERPRINT_GENRES = ["Brand#11", "Brand#15", "Brand#22", "Brand#3", "Brand#4", "Brand#5"]
FINGERPRINT_FEATURES = ["danceability", "energy", "acousticness", "valence", "speechiness"]


@register("genre_fingerprint", with_ctes(
    "SELECT track_genre, " + ", ".join(r(f"avg({c})", f"avg_{c}") for c in FINGERPRINT_FEATURES)
    + " FROM silver WHERE track_genre IN (" + ", ".join(f"'{g}'" for g in FINGERPRINT_GENRES)
    + ") GROUP BY 1", "silver"))
def genre_fingerprint(spark, sf):
    return rounded(aggregate.genre_fingerprint(frames.silver(spark, sf), FINGERPRINT_GENRES,
                                               FINGERPRINT_FEATURES))


_BAND_SQL = """
bands(band_order, duration_band) AS (VALUES (1, '< 2 min'), (2, '2-3 min'), (3, '3-4 min'),
  (4, '4-5 min'), (5, '> 5 min')),
agg AS (SELECT CASE WHEN m < 2 THEN '< 2 min' WHEN m < 3 THEN '2-3 min' WHEN m < 4 THEN '3-4 min'
    WHEN m < 5 THEN '4-5 min' ELSE '> 5 min' END AS duration_band, count(*) AS track_count,
    avg(popularity) AS avg_popularity
  FROM (SELECT duration_ms / 60000e0 AS m, popularity FROM silver) WHERE m > 0 AND m < 10 GROUP BY 1)
SELECT CAST(b.band_order AS INTEGER) AS band_order, b.duration_band,
  coalesce(a.track_count, 0) AS track_count, round(a.avg_popularity, 6) AS avg_popularity
FROM bands b LEFT JOIN agg a USING (duration_band)"""

_TEMPO_GROUP_SQL = """
grp(band_order, tempo_group) AS (VALUES (1, 'slow (< 100 BPM)'), (2, 'medium (100-140 BPM)'),
  (3, 'fast (> 140 BPM)')),
agg AS (SELECT CASE WHEN tempo < 100 THEN 'slow (< 100 BPM)' WHEN tempo <= 140 THEN 'medium (100-140 BPM)'
    ELSE 'fast (> 140 BPM)' END AS tempo_group, count(*) AS track_count, avg(popularity) AS avg_popularity
  FROM silver WHERE tempo IS NOT NULL GROUP BY 1)
SELECT CAST(b.band_order AS INTEGER) AS band_order, b.tempo_group,
  coalesce(a.track_count, 0) AS track_count, round(a.avg_popularity, 6) AS avg_popularity
FROM grp b LEFT JOIN agg a USING (tempo_group)"""


@register("duration_band_popularity", _with_long(_BAND_SQL, "silver"))
def duration_band_popularity(spark, sf):
    return rounded(aggregate.duration_band_popularity(frames.silver(spark, sf)))


@register("tempo_group_popularity", _with_long(_TEMPO_GROUP_SQL, "silver"))
def tempo_group_popularity(spark, sf):
    return rounded(aggregate.tempo_group_popularity(frames.silver(spark, sf)))


@register("tempo_category_stats", with_ctes(f"""
SELECT tempo_category, count(*) AS track_count, {r('avg(tempo)', 'avg_tempo')},
  {r('avg(popularity)', 'avg_popularity')} FROM feat GROUP BY 1""", "feat"))
def tempo_category_stats(spark, sf):
    return rounded(aggregate.category_stats(frames.feature_table(spark, sf)))


@register("tempo_category_counts", with_ctes(
    "SELECT tempo_category, count(*) AS track_count FROM feat GROUP BY 1", "feat"))
def tempo_category_counts(spark, sf):
    return aggregate.category_counts(frames.feature_table(spark, sf))


_TOPK_COLS = ["track_id", "track_name", "track_genre", "energy", "danceability", "energy_danceability_ratio"]


@register("topk_feature_rows", with_ctes(
    f"SELECT {', '.join(_TOPK_COLS)} FROM feat ORDER BY energy_danceability_ratio DESC, "
    f"{', '.join(c for c in _TOPK_COLS if c != 'energy_danceability_ratio')} LIMIT 10", "feat"))
def topk_feature_rows(spark, sf):
    return aggregate.rows_by_feature(frames.feature_table(spark, sf), "energy_danceability_ratio",
                                     _TOPK_COLS, 10, descending=True)


@register("bottomk_feature_rows", with_ctes(
    f"SELECT {', '.join(_TOPK_COLS)} FROM feat ORDER BY energy_danceability_ratio, "
    f"{', '.join(c for c in _TOPK_COLS if c != 'energy_danceability_ratio')} LIMIT 10", "feat"))
def bottomk_feature_rows(spark, sf):
    return aggregate.rows_by_feature(frames.feature_table(spark, sf), "energy_danceability_ratio",
                                     _TOPK_COLS, 10, descending=False)


def _md5_order_sql(seed: int, cols) -> str:
    parts = " || '|' || ".join([f"'{seed}'"] + [f"CAST({c} AS VARCHAR)" for c in cols])
    return f"CAST('0x' || substr(md5({parts}), 1, 8) AS BIGINT)"


_SCATTER_SQL = """SELECT track_id, CAST(popularity AS DOUBLE) AS popularity, CAST(danceability AS DOUBLE) AS danceability
FROM silver WHERE popularity IS NOT NULL AND danceability IS NOT NULL"""


def _scatter(spark, sf):
    s = frames.silver(spark, sf).select("track_id", F.col("popularity").cast("double").alias("popularity"),
                                         F.col("danceability").cast("double").alias("danceability"))
    return s.where(F.col("popularity").isNotNull() & F.col("danceability").isNotNull())


@register("scatter_points", with_ctes(_SCATTER_SQL, "silver"))
def scatter_points(spark, sf):
    """All points of the scatter."""
    return guards.guarded(frames.silver(spark, sf), ["track_id", "popularity", "danceability"], "scatter_points", lambda _: _scatter(spark, sf))


@register("scatter_bins", with_ctes(f"""
SELECT CAST(floor(danceability / 0.5e0) AS BIGINT) AS x_bin, CAST(floor(popularity / 5e0) AS BIGINT) AS y_bin, count(*) AS count
FROM ({_SCATTER_SQL}) GROUP BY 1, 2""", "silver"))
def scatter_bins(spark, sf):
    return stats.bins_2d(_scatter(spark, sf), "danceability", "popularity", 0.5, 5.0)


@register("scatter_sample", with_ctes(f"""{_SCATTER_SQL}
ORDER BY {_md5_order_sql(42, ['track_id'])}, track_id LIMIT 1000""", "silver"))
def scatter_sample(spark, sf):
    """The sampler: 1,000 points in a fixed pseudo-random order (the limit is what is asked for)."""
    return stats.capped_rows(_scatter(spark, sf), 1000, 42, ["track_id"])


@register("hash_sample", with_ctes(f"""
SELECT track_id, track_genre, popularity FROM silver
WHERE {_md5_order_sql(42, ['track_id'])} < {int(0.3 * 4294967296)}""", "silver"))
def hash_sample(spark, sf):
    s = frames.silver(spark, sf).select("track_id", "track_genre", "popularity")
    return stats.hash_sample(s, 0.3, 42, ["track_id"])


# ------------------------------------------------------------------ distributions

def _hist_fixed_sql(expr: str, src: str, lo: float, hi: float, n: int, where: str = "TRUE") -> str:
    w = (hi - lo) / n
    return f"""
SELECT CAST(g.bin AS INTEGER) AS bin, {lo}e0 + g.bin * {w!r}e0 AS bin_lo, {lo}e0 + (g.bin + 1) * {w!r}e0 AS bin_hi,
  coalesce(c.cnt, 0) AS count
FROM (SELECT range AS bin FROM range({n})) g LEFT JOIN (
  SELECT CAST(least(floor((x - {lo}e0) / {w!r}e0), {n - 1}) AS INTEGER) AS bin, count(*) AS cnt
  FROM (SELECT CAST({expr} AS DOUBLE) AS x FROM {src} WHERE {where})
  WHERE x >= {lo}e0 AND x <= {lo}e0 + {w!r}e0 * {n} GROUP BY 1) c ON c.bin = g.bin"""


@register("hist_popularity_10", with_ctes(_hist_fixed_sql("popularity", "silver", 0.0, 100.0, 10), "silver"))
def hist_popularity_10(spark, sf):
    return stats.histogram_fixed(frames.silver(spark, sf), "popularity", 0.0, 100.0, 10)


@register("hist_popularity_20", with_ctes(
    _hist_fixed_sql("popularity", "feat", 0.0, 100.0, 20, "popularity IS NOT NULL"), "feat"))
def hist_popularity_20(spark, sf):
    def report(f):
        f = f.select(F.col("popularity").cast("double").alias("popularity"))
        return stats.histogram_fixed(f.where(F.col("popularity").isNotNull()), "popularity", 0.0, 100.0, 20)

    return guards.guarded(frames.feature_table(spark, sf), ["popularity"], "hist_popularity_20", report)


def _hist_auto_sql(long_sql: str, groups: list[str], n: int, density: bool = False) -> str:
    g = ", ".join(groups)
    jn = " AND ".join(f"c.{x} = b.{x}" for x in groups + ["bin"])
    dens = ", round(coalesce(c.cnt, 0) / (b._n * b._w), 6) AS density" if density else ""
    return f"""
long AS ({long_sql}),
b0 AS (SELECT {g}, min(value) AS _mn, max(value) AS _mx, count(value) AS _n FROM long
       WHERE value IS NOT NULL GROUP BY {g}),
b AS (SELECT {g}, _n, CASE WHEN _mn = _mx THEN _mn - 0.5 ELSE _mn END AS _lo,
        CASE WHEN _mn = _mx THEN _mx + 0.5 ELSE _mx END AS _hi FROM b0),
bw AS (SELECT *, (_hi - _lo) / {float(n)!r}e0 AS _w, r.range AS bin FROM b, range({n}) r),
c AS (SELECT {', '.join('l.' + x for x in groups)},
        CAST(least(CASE WHEN b._w > 0 THEN floor((l.value - b._lo) / b._w) ELSE 0 END, {n - 1}) AS INTEGER) AS bin,
        count(*) AS cnt
      FROM long l JOIN (SELECT *, (_hi - _lo) / {float(n)!r}e0 AS _w FROM b) b USING ({g})
      WHERE l.value IS NOT NULL GROUP BY ALL)
SELECT {', '.join('b.' + x for x in groups)}, CAST(b.bin AS INTEGER) AS bin,
  round(b._lo + b.bin * b._w, 6) AS bin_lo, round(b._lo + (b.bin + 1) * b._w, 6) AS bin_hi,
  coalesce(c.cnt, 0) AS count{dens}
FROM bw b LEFT JOIN c ON {jn}"""


HIST_FEATURES = ["danceability", "energy", "speechiness", "acousticness", "instrumentalness",
                 "liveness", "valence", "loudness", "tempo"]


def _long_sql(cols, src, extra_select: str = "", where: str = "TRUE") -> str:
    return " UNION ALL ".join(
        f"SELECT {extra_select}'{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {src} WHERE {where}"
        for c in cols)


@register("hist_features", _with_long(_hist_auto_sql(_long_sql(HIST_FEATURES, "silver"), ["feature"], 45), "silver"))
def hist_features(spark, sf):
    return rounded(stats.histogram_columns(frames.silver(spark, sf), HIST_FEATURES, 45))


@register("feature_mean_median", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, {r(f'avg(CAST({c} AS DOUBLE))', 'mean')}, "
    f"{r(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)', 'median')} FROM silver WHERE {c} IS NOT NULL"
    for c in HIST_FEATURES), "silver"))
def feature_mean_median(spark, sf):
    return rounded(stats.mean_median(frames.silver(spark, sf), HIST_FEATURES))


_DUR_WHERE = "duration_ms / 60000e0 > 0 AND duration_ms / 60000e0 < 10"


@register("hist_duration", _with_long(_hist_auto_sql(
    f"SELECT 'duration_min' AS feature, duration_ms / 60000e0 AS value FROM silver WHERE {_DUR_WHERE}",
    ["feature"], 60), "silver"))
def hist_duration(spark, sf):
    m = duration_minutes()
    s = frames.silver(spark, sf).where((m > 0) & (m < 10)).select(m.alias("duration_min"))
    return rounded(stats.histogram_auto(long_values(s, ["duration_min"]), ["feature"], 60))


@register("duration_median", with_ctes(
    f"SELECT {r('quantile_cont(duration_ms / 60000e0, 0.5)', 'median_min')}, count(*) AS track_count "
    f"FROM silver WHERE {_DUR_WHERE}", "silver"))
def duration_median(spark, sf):
    m = duration_minutes()
    s = frames.silver(spark, sf).where((m > 0) & (m < 10)).select(m.alias("duration_min"))
    mm = stats.mean_median(s, ["duration_min"]).select(F.col("median").alias("median_min"))
    return rounded(mm.crossJoin(s.agg(F.count(F.lit(1)).alias("track_count"))))


COND_FEATURES = ["energy", "danceability", "valence"]
_CLASS_SQL = "CASE WHEN popularity >= 70 THEN 'high' WHEN popularity < 30 THEN 'low' END"


def _cond_long(spark, sf):
    s = frames.silver(spark, sf).select(popularity_class("popularity").alias("popularity_class"),
                                        *COND_FEATURES).where(F.col("popularity_class").isNotNull())
    return long_values(s, COND_FEATURES, ["popularity_class"])


@register("conditional_density", _with_long(_hist_auto_sql(
    _long_sql(COND_FEATURES, "silver", f"{_CLASS_SQL} AS popularity_class, ", f"{_CLASS_SQL} IS NOT NULL"),
    ["popularity_class", "feature"], 35, density=True), "silver"))
def conditional_density(spark, sf):
    return rounded(stats.histogram_auto(_cond_long(spark, sf), ["popularity_class", "feature"], 35,
                                        density=True))


@register("conditional_means", with_ctes(
    "SELECT popularity_class, feature, round(avg(value), 6) AS mean, count(value) AS n FROM (" +
    _long_sql(COND_FEATURES, "silver", f"{_CLASS_SQL} AS popularity_class, ", f"{_CLASS_SQL} IS NOT NULL") +
    ") GROUP BY 1, 2", "silver"))
def conditional_means(spark, sf):
    return rounded(_cond_long(spark, sf).groupBy("popularity_class", "feature")
                   .agg(F.avg("value").alias("mean"), F.count("value").alias("n")))


BOX_FEATURES = ["danceability", "energy", "speechiness", "acousticness", "instrumentalness",
                "liveness", "valence", "popularity", "loudness", "tempo"]


def _box_sql(cols, src):
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"""
SELECT '{c}' AS feature, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
  round(q3 - q1, 6) AS iqr,
  round(coalesce((SELECT min({x}) FROM {src} WHERE {x} BETWEEN q1 - 1.5 * (q3 - q1) AND q1), q1), 6) AS whisker_low,
  round(coalesce((SELECT max({x}) FROM {src} WHERE {x} BETWEEN q3 AND q3 + 1.5 * (q3 - q1)), q3), 6) AS whisker_high,
  (SELECT count(*) FROM {src} WHERE {x} < q1 - 1.5 * (q3 - q1) OR {x} > q3 + 1.5 * (q3 - q1)) AS outlier_count,
  round(mean, 6) AS mean
FROM (SELECT quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.5) AS med,
        quantile_cont({x}, 0.75) AS q3, avg({x}) AS mean FROM {src} WHERE {c} IS NOT NULL)""")
    return " UNION ALL ".join(parts)


@register("box_stats", with_ctes(_box_sql(BOX_FEATURES, "silver"), "silver"))
def box_stats(spark, sf):
    return rounded(stats.box_stats(frames.silver(spark, sf), BOX_FEATURES))


@register("box_stats_duration_loudness", with_ctes(
    "SELECT * FROM (" + _box_sql(["duration_min", "loudness"],
                                 "(SELECT duration_ms / 60000e0 AS duration_min, loudness FROM silver)") + ")",
    "silver"))
def box_stats_duration_loudness(spark, sf):
    s = frames.silver(spark, sf).select(duration_minutes().alias("duration_min"), "loudness")
    return rounded(stats.box_stats(s, ["duration_min", "loudness"]))


IQR_COLS = ["duration_ms", "loudness", "tempo", "popularity"]


@register("iqr_outliers", with_ctes(" UNION ALL ".join(f"""
SELECT '{c}' AS feature, round(q1, 6) AS q1, round(q3, 6) AS q3, round(q1 - 1.5 * (q3 - q1), 6) AS lower_fence,
  round(q3 + 1.5 * (q3 - q1), 6) AS upper_fence, n AS outlier_count, round(n * 100.0 / t, 2) AS outlier_pct
FROM (SELECT q1, q3, (SELECT count(*) FROM silver) AS t,
  (SELECT count(*) FROM silver WHERE CAST({c} AS DOUBLE) < q1 - 1.5 * (q3 - q1)
     OR CAST({c} AS DOUBLE) > q3 + 1.5 * (q3 - q1)) AS n
  FROM (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3
        FROM silver WHERE {c} IS NOT NULL))""" for c in IQR_COLS), "silver"))
def iqr_outliers(spark, sf):
    return rounded(stats.iqr_outliers(frames.silver(spark, sf), IQR_COLS))


@register("approx_quantiles", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS used_rows, true AS q1_close, true AS median_close, true AS q3_close FROM silver"
    for c in IQR_COLS), "silver"))
def approx_quantiles_q(spark, sf):
    """Quartiles from a bounded sketch, each checked by its rank among all rows (within 1 %)."""
    long = long_values(frames.silver(spark, sf), IQR_COLS).where(F.col("value").isNotNull())
    q = approx_quantiles(long, ["feature"], [0.25, 0.5, 0.75])
    j = long.join(q, "feature").groupBy("feature")
    share = lambda c, p: ((F.count_if(F.col("value") < F.col(c)) <= F.count(F.lit(1)) * (p + 0.01))
                          & (F.count_if(F.col("value") <= F.col(c)) >= F.count(F.lit(1)) * (p - 0.01)))
    return j.agg(F.count(F.lit(1)).alias("used_rows"), share("q_0", 0.25).alias("q1_close"),
                 share("q_1", 0.5).alias("median_close"), share("q_2", 0.75).alias("q3_close"))


@register("genre_box", with_ctes("""
SELECT track_genre, track_count, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
  round(mn, 6) AS min, round(mx, 6) AS max, round(mean, 6) AS mean,
  round(greatest(mn, q1 - 1.5 * (q3 - q1)), 6) AS whisker_low,
  round(least(mx, q3 + 1.5 * (q3 - q1)), 6) AS whisker_high
FROM (SELECT track_genre, count(*) AS track_count, quantile_cont(CAST(popularity AS DOUBLE), 0.25) AS q1,
  quantile_cont(CAST(popularity AS DOUBLE), 0.5) AS med, quantile_cont(CAST(popularity AS DOUBLE), 0.75) AS q3,
  min(CAST(popularity AS DOUBLE)) AS mn, max(CAST(popularity AS DOUBLE)) AS mx, avg(popularity) AS mean
  FROM silver WHERE track_genre IN (
    SELECT track_genre FROM silver GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 22)
  GROUP BY 1)""", "silver"))
def genre_box(spark, sf):
    return rounded(stats.group_box(frames.silver(spark, sf), "track_genre", "popularity", 22))


def _corr_sql(cols, src, where="TRUE"):
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    sel = ", ".join(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS "{a}__{b}"' for a, b in pairs)
    diag = ", ".join(f"('{c}', '{c}', 1.0e0)" for c in cols)
    return f"""
w AS (SELECT {sel} FROM {src} WHERE {where}),
u AS (UNPIVOT w ON COLUMNS(*) INTO NAME k VALUE r)
SELECT split_part(k, '__', 1) AS feature_x, split_part(k, '__', 2) AS feature_y, round(r, 6) AS r FROM u
UNION ALL SELECT split_part(k, '__', 2), split_part(k, '__', 1), round(r, 6) FROM u
UNION ALL SELECT * FROM (VALUES {diag})"""


@register("corr_matrix", _with_long(_corr_sql(AUDIO_FEATURES, "silver"), "silver"))
def corr_matrix(spark, sf):
    return rounded(stats.corr_long(frames.silver(spark, sf), AUDIO_FEATURES))


_GAPPED = ["energy", "valence", "tempo", "loudness", "popularity"]
_GAPS = ("gaps AS (SELECT energy, valence, CASE WHEN popularity >= 20 THEN tempo END AS tempo, CASE WHEN mode = 1 THEN loudness END AS loudness, "
         "popularity FROM trk)")


@register("corr_matrix_pairwise", _with_long(_GAPS + "," + _corr_sql(_GAPPED, "gaps"), "trk"))
def corr_matrix_pairwise(spark, sf):
    """Pairwise-complete matrix of raw tracks with NULLs in three columns."""
    t = frames.bronze(spark, sf).select("energy", "valence", F.when(F.col("popularity") >= 20, F.col("tempo")).alias("tempo"),
                                        F.when(F.col("mode") == 1, F.col("loudness")).alias("loudness"), "popularity")
    return rounded(stats.corr_long(t, _GAPPED))


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns discovered from the schema."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


_FEAT_NUMERIC = [c for c in features.FEATURE_TABLE_COLUMNS
                 if c not in ("kafka_timestamp", "user_id", "event_type", "track_id", "track_name",
                              "artists", "album_name", "track_genre", "tempo_category")]


@register("corr_matrix_all", _with_long(_corr_sql(
    _FEAT_NUMERIC, "feat", " AND ".join(f"{c} IS NOT NULL" for c in _FEAT_NUMERIC)), "feat"))
def corr_matrix_all(spark, sf):
    f = frames.feature_table(spark, sf)
    return guards.guarded(f, numeric_columns(f), "corr_matrix_all", lambda f: rounded(stats.corr_long(f, numeric_columns(f), complete_rows=True)))


LINEAR_PAIRS = [("energy", "loudness"), ("danceability", "popularity")]


@register("linear_fit", with_ctes(" UNION ALL ".join(
    f"SELECT '{x}' AS x, '{y}' AS y, "
    f"{r(f'regr_slope(coalesce(CAST({y} AS DOUBLE), 0e0), coalesce(CAST({x} AS DOUBLE), 0e0))', 'slope')}, "
    f"{r(f'regr_intercept(coalesce(CAST({y} AS DOUBLE), 0e0), coalesce(CAST({x} AS DOUBLE), 0e0))', 'intercept')}, "
    f"{r(f'corr(CAST({x} AS DOUBLE), CAST({y} AS DOUBLE))', 'r')} FROM silver" for x, y in LINEAR_PAIRS),
    "silver"))
def linear_fit(spark, sf):
    return rounded(stats.linear_fit(frames.silver(spark, sf), LINEAR_PAIRS))
