"""Cleaning: NULL handling, deterministic de-duplication, range filters, Silver.

De-duplication keeps the first row of each key: ``row_number() = 1`` over the order columns and then every
other column. Catalyst plans it with a group limit on both sides of the shuffle, so a key holding a third of
all rows is one row a map task before the shuffle and never lands whole in one task; rows are
sorted in their binary form, no struct of all columns is built, compared or copied. A caller that knows that no key is hot and
how many partitions the rows need names these (``partitions``): the rows then are sorted once, behind the shuffle, in memory.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.functions.expressions import flag_to_int

DEDUPE_KEY = "track_id"
DEDUPE_ORDER = ["kafka_timestamp", "track_genre"]


def no_nulls(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def null_counts(df: DataFrame) -> DataFrame:
    """NULL count per column, long form (column_name, null_count), one scan."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "column_name", "null_count")


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in any (or any listed) column.

    Written as a conjunction of ``isNotNull`` rather than ``na.drop``: the latter's
    single ``AtLeastNNonNulls`` predicate sends constraint inference into a very
    long optimizer run once an aggregate and a filter sit on top of it.
    """
    return df.where(no_nulls(list(subset) if subset else df.columns))


def dedupe(df: DataFrame, key: str = DEDUPE_KEY,
           order: Sequence[str] = tuple(DEDUPE_ORDER), partitions: int | None = None) -> DataFrame:
    """One row per key: the smallest by ``order``, then by every other column. ``partitions``: into how many the
    rows are dealt by key, without a sort ahead of the shuffle (for keys that all have few rows)."""
    rest = [c for c in df.columns if c != key and c not in order]
    df = df.repartition(partitions, key) if partitions else df
    first = Window.partitionBy(key).orderBy(*order, *rest)
    return df.withColumn("_place", F.row_number().over(first)).where("_place = 1").drop("_place")


def in_range(df: DataFrame, c: str, lo, hi) -> DataFrame:
    """Inclusive range filter; NULL fails."""
    return df.where(F.col(c).between(lo, hi))


def with_flag(df: DataFrame, c: str = "explicit") -> DataFrame:
    return df.withColumn(c, flag_to_int(c))


def silver(bronze: DataFrame, partitions: int | None = None) -> DataFrame:
    """Bronze -> Silver: drop rows with any NULL, dedupe on track_id, popularity in
    [0, 100], explicit flag to 0/1. Order of the stages as in the reference."""
    return with_flag(in_range(dedupe(drop_nulls(bronze), partitions=partitions), "popularity", 0, 100))


def clean_stages(bronze: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows remaining after each cleaning stage: the row-wise stages from one aggregate over
    Bronze, the others from one over the de-duplicated rows."""
    rows = bronze.agg(F.count(F.lit(1)).alias("bronze"), F.count_if(no_nulls(bronze.columns)).alias("drop_nulls"))
    kept = dedupe(drop_nulls(bronze), partitions=partitions).agg(F.count(F.lit(1)).alias("dedupe"), F.count_if(F.col("popularity").between(0, 100)).alias("range_filter"))
    totals = rows.crossJoin(kept)  # one row each
    stages = ["bronze", "drop_nulls", "dedupe", "range_filter"]
    long = totals.select(F.inline(F.array(*[
        F.struct(F.lit(i + 1).alias("stage_no"), F.lit(s).alias("stage"),
                 F.coalesce(F.col(s), F.lit(0)).cast("bigint").alias("rows"))
        for i, s in enumerate(stages)])))
    return long


def layer_report(bronze: DataFrame, silver_df: DataFrame, gold_df: DataFrame,
                 genre_col: str = "track_genre") -> DataFrame:
    """Rows per layer, rows removed by cleaning, and the number of genres, as rows."""
    size = lambda df, name, *more: df.agg(F.count(F.lit(1)).alias(name), *more)
    one = (size(bronze, "bronze").crossJoin(size(silver_df, "silver"))
           .crossJoin(size(gold_df, "gold", F.count_distinct(genre_col).alias("genres"))))  # one row each
    one = one.withColumn("removed", F.col("bronze") - F.col("silver"))
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("bigint").alias("value"))
        for m in ("bronze", "silver", "gold", "removed", "genres")])))
