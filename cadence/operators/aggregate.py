"""Grouped summaries, counts and top-k reports.

Every top-k here is ``orderBy(..., tie-breakers).limit(k)``: Catalyst plans it as
``TakeOrderedAndProject`` (a per-partition top-k, then a merge of k rows per
partition), never a global sort. Ties are broken by the group name so the
result is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.functions.expressions import (DURATION_BANDS, TEMPO_GROUPS, duration_band,
                                           duration_minutes, tempo_group)

GENRE = "track_genre"


def gold_genre_summary(silver_df: DataFrame, genre_col: str = GENRE) -> DataFrame:
    """Per genre: track count and six rounded means, most popular first."""
    return (silver_df.groupBy(genre_col).agg(
        F.count("track_id").alias("track_count"),
        F.round(F.avg("popularity"), 2).alias("avg_popularity"),
        F.round(F.avg("danceability"), 4).alias("avg_danceability"),
        F.round(F.avg("energy"), 4).alias("avg_energy"),
        F.round(F.avg("tempo"), 2).alias("avg_tempo"),
        F.round(F.avg("loudness"), 2).alias("avg_loudness"),
        F.round(F.avg("valence"), 4).alias("avg_valence"),
    ).orderBy(F.desc("avg_popularity"), F.asc(genre_col)))


def group_counts(df: DataFrame, by: str = GENRE, name: str = "track_count") -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias(name))


def top_k(df: DataFrame, k: int, order: Sequence) -> DataFrame:
    return df.orderBy(*order).limit(k)


def genre_counts(df: DataFrame, genre_col: str = GENRE) -> DataFrame:
    return group_counts(df, genre_col).orderBy(genre_col)


def genre_counts_top(df: DataFrame, k: int = 20, genre_col: str = GENRE) -> DataFrame:
    return top_k(group_counts(df, genre_col), k, [F.desc("track_count"), F.asc(genre_col)])


def genre_counts_rarest(df: DataFrame, k: int = 20, genre_col: str = GENRE) -> DataFrame:
    return top_k(group_counts(df, genre_col), k, [F.asc("track_count"), F.asc(genre_col)])


def group_total(df: DataFrame, genre_col: str = GENRE) -> DataFrame:
    return df.agg(F.count_distinct(genre_col).alias("genre_total"))


def with_share(df: DataFrame, value_col: str, name: str = "share_pct") -> DataFrame:
    """value / sum(value) over the (already small, top-k) frame, in percent."""
    return df.withColumn(name, F.col(value_col) * 100.0 / F.sum(value_col).over(Window.partitionBy()))


def top_genres_by_popularity(df: DataFrame, k: int = 10, genre_col: str = GENRE) -> DataFrame:
    top = top_k(df.groupBy(genre_col).agg(F.avg("popularity").alias("avg_popularity")),
                k, [F.desc("avg_popularity"), F.asc(genre_col)])
    return with_share(top, "avg_popularity")


def top_genres_by_count(df: DataFrame, k: int = 10, genre_col: str = GENRE) -> DataFrame:
    top = genre_counts_top(df, k, genre_col)
    return with_share(top, "track_count")


def mean_by_genre_top(df: DataFrame, cols: Sequence[str], order_col: str, k: int,
                      genre_col: str = GENRE, drop_null: bool = False) -> DataFrame:
    src = df.where(F.col(order_col).isNotNull()) if drop_null else df
    agg = src.groupBy(genre_col).agg(*[F.avg(c).alias(f"avg_{c}") for c in cols])
    return top_k(agg, k, [F.desc(f"avg_{order_col}"), F.asc(genre_col)])


def explicit_effect(df: DataFrame) -> DataFrame:
    """Clean vs explicit: count and mean popularity (flag 0/1 -> label)."""
    label = F.when(F.col("explicit") == 1, "explicit").when(F.col("explicit") == 0, "clean")
    return (df.groupBy(F.col("explicit").alias("explicit"))
            .agg(F.count(F.lit(1)).alias("track_count"), F.avg("popularity").alias("avg_popularity"))
            .withColumn("content", label))


def genre_fingerprint(df: DataFrame, genres: Sequence[str], features: Sequence[str],
                      genre_col: str = GENRE) -> DataFrame:
    """Mean profile of chosen genres. The genre list is a literal parameter, so an
    ``isin`` filter reaches the Parquet scan as a pushed predicate."""
    return (df.where(F.col(genre_col).isin(list(genres)))
            .groupBy(genre_col).agg(*[F.avg(c).alias(f"avg_{c}") for c in features]))


def _ordered_dimension(spark, labels: Sequence[str], name: str) -> DataFrame:
    return spark.createDataFrame([(i + 1, lab) for i, lab in enumerate(labels)],
                                 f"band_order int, {name} string")


def duration_band_popularity(df: DataFrame) -> DataFrame:
    """Mean popularity per duration band over tracks of 0 < minutes < 10, in band
    order; a band with no track keeps its row with NULL mean and 0 count."""
    m = duration_minutes("duration_ms")
    agg = (df.where((m > 0) & (m < 10))
           .groupBy(duration_band(m).alias("duration_band"))
           .agg(F.count(F.lit(1)).alias("track_count"), F.avg("popularity").alias("avg_popularity")))
    dim = _ordered_dimension(df.sparkSession, DURATION_BANDS, "duration_band")
    return (F.broadcast(dim).join(agg, "duration_band", "left")
            .select("band_order", "duration_band",
                    F.coalesce("track_count", F.lit(0)).alias("track_count"), "avg_popularity")
            .orderBy("band_order"))


def tempo_group_popularity(df: DataFrame) -> DataFrame:
    agg = (df.where(F.col("tempo").isNotNull())
           .groupBy(tempo_group("tempo").alias("tempo_group"))
           .agg(F.count(F.lit(1)).alias("track_count"), F.avg("popularity").alias("avg_popularity")))
    dim = _ordered_dimension(df.sparkSession, TEMPO_GROUPS, "tempo_group")
    return (F.broadcast(dim).join(agg, "tempo_group", "left")
            .select("band_order", "tempo_group",
                    F.coalesce("track_count", F.lit(0)).alias("track_count"), "avg_popularity")
            .orderBy("band_order"))


def category_stats(df: DataFrame, cat_col: str = "tempo_category") -> DataFrame:
    return (df.groupBy(cat_col).agg(F.count(F.lit(1)).alias("track_count"),
                                    F.avg("tempo").alias("avg_tempo"),
                                    F.avg("popularity").alias("avg_popularity"))
            .orderBy(cat_col))


def category_counts(df: DataFrame, cat_col: str = "tempo_category") -> DataFrame:
    return df.groupBy(cat_col).agg(F.count(F.lit(1)).alias("track_count")).orderBy(cat_col)


def rows_by_feature(df: DataFrame, feature: str, cols: Sequence[str], k: int,
                    descending: bool = True) -> DataFrame:
    """Top (or bottom) k rows by a feature; every projected column breaks ties."""
    first = F.desc(feature) if descending else F.asc(feature)
    rest = [F.asc(c) for c in cols if c != feature]
    return df.select(*cols).orderBy(first, *rest).limit(k)
