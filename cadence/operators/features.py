"""Feature engineering: the five derived features and the 28-column feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.functions.expressions import TEMPO_CUTS_FEATURE, ratio, tempo_category
from cadence.sources.schemas import FEATURE_TABLE_COLUMNS


def _d(c: str) -> Column:
    return F.col(c).cast("double")


def energy_dance_ratio() -> Column:
    return ratio("energy", "danceability", 1e-4).alias("energy_danceability_ratio")


def contrast() -> Column:
    """energy - acousticness, in double (both inputs widened first)."""
    return (_d("energy") - _d("acousticness")).alias("energy_acoustic_contrast")


def dancefloor() -> Column:
    return ((_d("danceability") + _d("valence")) / F.lit(2.0)).alias("dancefloor_score")


def with_minmax(df: DataFrame, c: str, out: str, min_range: float = 0.0) -> DataFrame:
    """Min-max scale ``c`` by its global bounds.

    The bounds come from one aggregate (one row, so its broadcast is bounded by
    construction) joined back to every row; no driver round trip. A zero range
    gives 0.0; ``min_range`` > 0 floors the denominator instead, as the model
    step's fallback does.
    """
    bounds = df.agg(F.min(_d(c)).alias("_lo"), F.max(_d(c)).alias("_hi"))
    j = df.crossJoin(F.broadcast(bounds))
    rng = F.col("_hi") - F.col("_lo")
    if min_range > 0:
        scaled = (_d(c) - F.col("_lo")) / F.greatest(rng, F.lit(min_range))
    else:
        scaled = F.when(rng > 0, (_d(c) - F.col("_lo")) / rng).when(rng == 0, F.lit(0.0))
    return j.withColumn(out, scaled).drop("_lo", "_hi")


def with_tempo_category(df: DataFrame, cuts: Sequence[float] = TEMPO_CUTS_FEATURE,
                        out: str = "tempo_category") -> DataFrame:
    return df.withColumn(out, tempo_category("tempo", cuts))


def add_features(silver_df: DataFrame) -> DataFrame:
    base = silver_df.select("*", energy_dance_ratio(), contrast(), dancefloor())
    base = with_tempo_category(base)
    return with_minmax(base, "loudness", "loudness_normalized")


def feature_projection(df: DataFrame, wanted: Sequence[str] = FEATURE_TABLE_COLUMNS) -> DataFrame:
    """Project onto the wanted columns that are present, in wanted order."""
    present = [c for c in wanted if c in df.columns]
    return df.select(*present)


def feature_table(silver_df: DataFrame) -> DataFrame:
    """Silver + five features = 28 columns, in table order."""
    return feature_projection(add_features(silver_df))


def feature_ranges(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """min / max / mean of each feature from one aggregate, long form."""
    aggs = []
    for c in cols:
        aggs += [F.min(_d(c)).alias(f"{c}__min"), F.max(_d(c)).alias(f"{c}__max"),
                 F.avg(_d(c)).alias(f"{c}__mean")]
    wide = df.agg(*aggs)
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"{c}__min").alias("min_value"),
                 F.col(f"{c}__max").alias("max_value"), F.col(f"{c}__mean").alias("mean_value"))
        for c in cols])))
