"""Queries: profiles and quantiles from mergeable sketches, over the raw tracks in three parts.

Estimates have no twin in SQL; each is registered as it is, and once more beside the exact numbers (``*_check``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.operators import profile, sketches
from cadence.operators.ordered import long_values
from cadence.plans import frames
from cadence.plans.oracle_sql import with_ctes
from cadence.plans.q_explore import BOX_FEATURES, IQR_COLS, rounded
from cadence.plans.registry import register
from cadence.session import scratch_path
from cadence.sources.schemas import MESSAGE_COLUMNS, MESSAGE_SCHEMA

_TEXT = {f.name for f in MESSAGE_SCHEMA.fields if f.dataType.simpleString() == "string"}
#: A table that grows: parts by the month of the message.
PARTS = 3


def _parts(spark, sf):
    t = frames.bronze(spark, sf)
    month = F.substring("kafka_timestamp", 6, 2).cast("int")
    return [t.where(F.pmod(month, F.lit(PARTS)) == i) for i in range(PARTS)]


def _grown(spark, sf):
    """The stored profile after all parts came in one after the other, one of them twice."""
    store = scratch_path(spark, "profiles")
    for i, part in enumerate(_parts(spark, sf)):
        sketches.append_profile(part, store, f"p{i}")
    sketches.append_profile(_parts(spark, sf)[0], store, "p0")
    return sketches.stored_profile(spark, store)


@register("profile_sketch")
def profile_sketch(spark, sf):
    """The column profile of a table that grew by three parts, from their stored sketches."""
    return sketches.profile_rows(_grown(spark, sf))


_EXACT = with_ctes(" UNION ALL ".join(
    f"SELECT {i + 1} AS position, '{c}' AS column_name, count(*) AS row_count, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
    + ("CAST(NULL AS DOUBLE) AS min_value, CAST(NULL AS DOUBLE) AS max_value" if c in _TEXT else f"min(CAST({c} AS DOUBLE)) AS min_value, max(CAST({c} AS DOUBLE)) AS max_value")
    + f", CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS distinct_count, true AS within_3_percent FROM trk"
    for i, c in enumerate(MESSAGE_COLUMNS)), "trk")


@register("profile_sketch_check", _EXACT)
def profile_sketch_check(spark, sf):
    """The exact part of that profile, and its distinct counts beside the exact ones."""
    exact = profile.distinct_counts(frames.bronze(spark, sf))
    near = F.abs(F.col("distinct_estimate") - F.col("distinct_count")) <= 0.03 * F.col("distinct_count")
    return (sketches.profile_rows(_grown(spark, sf)).join(exact, "column_name")
            .select("position", "column_name", "row_count", "null_count", "min_value", "max_value", "distinct_count", near.alias("within_3_percent")))


@register("distinct_counts_sketch")
def distinct_counts_sketch(spark, sf):
    """Distinct values of each column (NULL is one), merged from the sketches of three parts."""
    merged = None
    for part in _parts(spark, sf):
        p = sketches.part_profile(part)
        merged = p if merged is None else merged.unionByName(p)
    return sketches.profile_rows(sketches.merge_profiles(merged)).select("column_name", F.col("distinct_estimate").alias("distinct_count"))


def _boxes(spark, sf, cols):
    return sketches.sketch_boxes(sketches.quantile_sketches(long_values(frames.silver(spark, sf), cols), ["feature"]), ["feature"])


@register("box_stats_sketch")
def box_stats_sketch(spark, sf):
    return rounded(_boxes(spark, sf, BOX_FEATURES))


@register("iqr_outliers_sketch")
def iqr_outliers_sketch(spark, sf):
    return rounded(_boxes(spark, sf, IQR_COLS).select("feature", "q1", "q3", "lower_fence", "upper_fence", "outlier_count", "outlier_pct"))


@register("quantiles_sketch")
def quantiles_sketch(spark, sf):
    """Quartiles of the raw columns, merged from the sketches of three parts."""
    merged = None
    for part in _parts(spark, sf):
        p = sketches.quantile_sketches(long_values(part, IQR_COLS), ["feature"])
        merged = p if merged is None else merged.unionByName(p)
    q = sketches.merge_sketches(merged, ["feature"])
    return rounded(q.select("feature", "n", *[sketches.quantile("sketch", p).alias(c) for c, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))]))


@register("quantiles_sketch_check", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS n, true AS q1_close, true AS median_close, true AS q3_close FROM trk" for c in IQR_COLS), "trk"))
def quantiles_sketch_check(spark, sf):
    """Each of these quartiles by its rank among all rows: within 1 %."""
    long = long_values(frames.bronze(spark, sf), IQR_COLS).where(F.col("value").isNotNull())
    j = long.join(quantiles_sketch(spark, sf).drop("n"), "feature").groupBy("feature")
    near = lambda c, p: ((F.count_if(F.col("value") < F.col(c)) <= F.count(F.lit(1)) * (p + 0.01))
                         & (F.count_if(F.col("value") <= F.col(c)) >= F.count(F.lit(1)) * (p - 0.01)))
    return j.agg(F.count(F.lit(1)).alias("n"), near("q1", 0.25).alias("q1_close"), near("median", 0.5).alias("median_close"), near("q3", 0.75).alias("q3_close"))


@register("genre_box_sketch")
def genre_box_sketch(spark, sf):
    """Boxes of the popularity of every genre, from one sketch a genre."""
    rows = frames.silver(spark, sf).select("track_genre", F.col("popularity").alias("value"))
    return rounded(sketches.sketch_boxes(sketches.quantile_sketches(rows, ["track_genre"]), ["track_genre"]))
