"""Profiling: schema listing, duplicate and distinct counts, column profile, summaries.

Each report is one aggregate over the table (the per-column loops of a
notebook become columns of a single ``agg``), then ``unpivot``/``inline`` into
one row per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_SIMPLE = ("int", "bigint", "float", "double", "smallint", "tinyint")


def schema_listing(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, nullable) of a frame's schema."""
    spark = df.sparkSession
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")


def duplicate_report(df: DataFrame, key: str = "track_id") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  F.count_distinct(key).alias("distinct_keys")) \
        .withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_keys"))


def _distinct_expr(c: str, approx: bool):
    # `distinct()` counts NULL as a value; count_distinct does not.
    base = F.approx_count_distinct(c) if approx else F.count_distinct(c)
    return base + F.max(F.when(F.col(c).isNull(), 1).otherwise(0))


def _as_key(f: T.StructField):
    c = F.col(f.name)
    if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
        c = c.cast("double") + F.lit(0.0)  # -0.0 and 0.0 are one value, as in grouping
    return c.cast("string")


def distinct_long(df: DataFrame) -> DataFrame:
    """(column_name, distinct_count) with NULL counted as a value, for all columns.

    The columns are stacked into (column, value) pairs and grouped twice: the
    first grouping is partial per map task, so repeated values collapse before
    any shuffle. One stacked pass replaces one distinct aggregate per column
    (which Spark would run as a row expansion, one copy per column)."""
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), _as_key(f).alias("v")) for f in df.schema.fields])))
    return (long.distinct()
            .groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_count")))


def distinct_counts(df: DataFrame, approx: bool = False) -> DataFrame:
    if approx:
        wide = df.agg(*[_distinct_expr(c, True).cast("bigint").alias(c) for c in df.columns])
        return wide.unpivot([], df.columns, "column_name", "distinct_count")
    return distinct_long(df)


def column_profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """Per column: type, distinct values (NULL counted as one), NULLs, and min/max
    for int/float/double columns, from one aggregate."""
    aggs, specs = [], []
    for f in df.schema.fields:
        c, t = f.name, f.dataType.simpleString()
        numeric = isinstance(f.dataType, (T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                                          T.ShortType, T.ByteType))
        if approx:
            aggs.append(_distinct_expr(c, True).cast("bigint").alias(f"{c}__d"))
        aggs.append(F.count_if(F.col(c).isNull()).cast("bigint").alias(f"{c}__n"))
        if numeric:
            aggs += [F.min(F.col(c).cast("double")).alias(f"{c}__lo"),
                     F.max(F.col(c).cast("double")).alias(f"{c}__hi")]
        specs.append((c, t, numeric))
    wide = df.agg(*aggs)
    nul = F.lit(None).cast("double")
    dcol = (lambda c: F.col(f"{c}__d")) if approx else (lambda c: F.lit(None).cast("bigint"))
    prof = wide.select(F.inline(F.array(*[
        F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("column_name"), F.lit(t).alias("data_type"),
                 dcol(c).alias("distinct_count"), F.col(f"{c}__n").alias("null_count"),
                 (F.col(f"{c}__lo") if num else nul).alias("min_value"),
                 (F.col(f"{c}__hi") if num else nul).alias("max_value"))
        for i, (c, t, num) in enumerate(specs)])))
    if approx:
        return prof
    # one row per column on both sides
    exact = distinct_long(df)
    return (prof.drop("distinct_count").join(exact, "column_name", "left")
            .select("position", "column_name", "data_type", "distinct_count", "null_count",
                    "min_value", "max_value"))


def summary_table(df: DataFrame, cols: Sequence[str], digits: int | None = 3) -> DataFrame:
    """count, mean, sample stddev, min, max per column, one row per column (the
    transposed ``summary``), optionally rounded."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)

    def r(e):
        return F.round(e, digits) if digits is not None else e
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"{c}__count").alias("count"),
                 r(F.col(f"{c}__mean")).alias("mean"), r(F.col(f"{c}__std")).alias("stddev"),
                 r(F.col(f"{c}__min")).alias("min"), r(F.col(f"{c}__max")).alias("max"))
        for c in cols])))
