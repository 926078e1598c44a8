"""Distribution and association statistics: histograms, boxes, quantiles, correlation.

Everything is an aggregate over the full table (no driver-side pandas). Small
dimension tables (bins, features, bounds) are built from ``spark.range`` or
from one-row-per-feature aggregates; their size is set by parameters (number
of bins, of features, of groups), never by the data volume, so broadcasting
them is bounded.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions.expressions import bin_index, hash_order
from cadence.operators.clean import no_nulls
from cadence.operators.ordered import approx_quantiles, exact_quantiles, long_values, value_counts, value_table


# ---------------------------------------------------------------- histograms

def _bin_grid(spark, n_bins: int) -> DataFrame:
    return spark.range(n_bins).select(F.col("id").cast("int").alias("bin"))


def histogram_fixed(df: DataFrame, c: str, lo: float, hi: float, n_bins: int) -> DataFrame:
    """Counts in ``n_bins`` equal bins over [lo, hi] (last bin closed); empty bins kept."""
    width = (hi - lo) / n_bins
    counts = (df.select(bin_index(c, lo, width, n_bins).alias("bin")).where(F.col("bin").isNotNull())
              .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    grid = _bin_grid(df.sparkSession, n_bins)
    return (grid.join(counts, "bin", "left")
            .select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_hi"),
                    F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def _auto_bounds(long: DataFrame, groups: Sequence[str], n_bins: int) -> DataFrame:
    """Per group: lo/hi of the data (numpy widens a constant range by 0.5 each side)."""
    b = long.groupBy(*groups).agg(F.min("value").alias("_mn"), F.max("value").alias("_mx"),
                                  F.count("value").alias("_n"))
    same = F.col("_mn") == F.col("_mx")
    return b.select(*groups, "_n",
                    F.when(same, F.col("_mn") - 0.5).otherwise(F.col("_mn")).alias("_lo"),
                    F.when(same, F.col("_mx") + 0.5).otherwise(F.col("_mx")).alias("_hi")) \
        .withColumn("_w", (F.col("_hi") - F.col("_lo")) / F.lit(float(n_bins)))


def histogram_auto(long: DataFrame, groups: Sequence[str], n_bins: int,
                   density: bool = False) -> DataFrame:
    """Equal-width histogram per group over the group's own min..max.

    ``long`` holds (groups..., value). Output: groups, bin, bin_lo, bin_hi, count
    (and density = count / (n * width) when asked)."""
    groups = list(groups)
    long = long.where(F.col("value").isNotNull())
    bounds = _auto_bounds(long, groups, n_bins)
    j = long.join(bounds, groups, "inner")
    counts = (j.select(*groups, bin_index("value", F.col("_lo"), F.col("_w"), n_bins, check_range=False).alias("bin"))
              .groupBy(*groups, "bin").agg(F.count(F.lit(1)).alias("count")))
    grid = bounds.crossJoin(F.broadcast(_bin_grid(long.sparkSession, n_bins)))
    out = grid.join(counts, groups + ["bin"], "left").select(
        *groups, "bin",
        (F.col("_lo") + F.col("bin") * F.col("_w")).alias("bin_lo"),
        (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("bin_hi"),
        F.coalesce("count", F.lit(0)).cast("bigint").alias("count"), "_n", "_w")
    if density:
        out = out.withColumn("density", F.col("count") / (F.col("_n") * F.col("_w")))
    return out.drop("_n", "_w")


def histogram_columns(df: DataFrame, cols: Sequence[str], n_bins: int) -> DataFrame:
    """``histogram_auto`` of several columns (feature, bin, bin_lo, bin_hi, count): bounds of all columns are one
    row beside every row, so a row becomes its bin numbers at once and nothing but these is grouped."""
    x = lambda c: F.col(f"`{c}`").cast("double")
    wide = df.agg(*[f(x(c)).alias(f"{a}_{c}") for c in cols for a, f in (("mn", F.min), ("mx", F.max))])
    flat = lambda c: F.col(f"mn_{c}") == F.col(f"mx_{c}")
    edges = wide.select(*[F.when(flat(c), F.col(f"mn_{c}") - 0.5).otherwise(F.col(f"mn_{c}")).alias(f"lo_{c}") for c in cols],
                        *[F.when(flat(c), F.col(f"mx_{c}") + 0.5).otherwise(F.col(f"mx_{c}")).alias(f"hi_{c}") for c in cols])
    bounds = edges.select("*", *[((F.col(f"hi_{c}") - F.col(f"lo_{c}")) / F.lit(float(n_bins))).alias(f"w_{c}") for c in cols])
    at = lambda i, c: F.when(x(c).isNotNull(), F.lit(i * n_bins) + bin_index(x(c), F.col(f"lo_{c}"), F.col(f"w_{c}"), n_bins, check_range=False))
    # one number for column and bin; NULL where the value is NULL
    counts = (df.crossJoin(F.broadcast(bounds)).select(F.explode(F.array(*[at(i, c) for i, c in enumerate(cols)])).alias("_at"))
              .where(F.col("_at").isNotNull()).groupBy("_at").agg(F.count(F.lit(1)).alias("count")))
    rows = bounds.select(F.inline(F.array(*[F.struct(F.lit(i).alias("_i"), F.lit(c).alias("feature"), F.col(f"lo_{c}").alias("_lo"), F.col(f"w_{c}").alias("_w"))
                                            for i, c in enumerate(cols)]))).where(F.col("_lo").isNotNull())
    grid = rows.crossJoin(F.broadcast(_bin_grid(df.sparkSession, n_bins))).withColumn("_at", F.col("_i") * n_bins + F.col("bin"))
    return grid.join(counts, "_at", "left").select(
        "feature", "bin", (F.col("_lo") + F.col("bin") * F.col("_w")).alias("bin_lo"), (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("bin_hi"),
        F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))


# ---------------------------------------------------------------- quantile summaries

def mean_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and exact median per feature."""
    counts = value_table(long_values(df, cols), ["feature"], "value")
    med = exact_quantiles(counts, ["feature"], [0.5])
    # mean from the value counts: sum(value * n) / sum(n)
    means = counts.groupBy("feature").agg((F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"))
    return means.join(med, "feature", "left").select("feature", "mean", F.col("q_0").alias("median"))


def _counts(long, groups, approx: bool):
    """Distinct-value counts: written once where exact quantiles read them, a plain plan where a sketch does."""
    return value_counts(long, groups, "value") if approx else value_table(long, groups, "value")


def _quantiles(long, counts, groups, probs, approx: bool):
    """Exact quantiles from the distinct-value counts, or approximate ones from the rows."""
    return approx_quantiles(long, groups, probs) if approx else exact_quantiles(counts, groups, probs)


def box_stats(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Box-plot statistics with the matplotlib whisker rule: whiskers at the most
    extreme data inside [q1 - 1.5 IQR, q3 + 1.5 IQR], or at the quartile where no
    datum lies between the two; exact interpolated quartiles (or approximate ones with ``approx``)."""
    long = long_values(df, cols).where(F.col("value").isNotNull())
    counts = _counts(long, ["feature"], approx)
    q = _quantiles(long, counts, ["feature"], [0.25, 0.5, 0.75], approx).select(
        "feature", F.col("q_0").alias("q1"), F.col("q_1").alias("median"), F.col("q_2").alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1")) \
        .withColumn("_lf", F.col("q1") - 1.5 * F.col("iqr")) \
        .withColumn("_uf", F.col("q3") + 1.5 * F.col("iqr"))
    j = counts.join(q.select("feature", "_lf", "_uf"), "feature", "inner")
    inner = j.groupBy("feature").agg(
        F.min(F.when(F.col("value") >= F.col("_lf"), F.col("value"))).alias("whisker_low"),
        F.max(F.when(F.col("value") <= F.col("_uf"), F.col("value"))).alias("whisker_high"),
        F.sum(F.when((F.col("value") < F.col("_lf")) | (F.col("value") > F.col("_uf")), F.col("n"))
              .otherwise(0)).alias("outlier_count"),
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"))
    # least and greatest skip a NULL: no datum inside the fence leaves the quartile
    return q.join(inner, "feature").select(
        "feature", "q1", "median", "q3", "iqr", F.least("whisker_low", "q1").alias("whisker_low"),
        F.greatest("whisker_high", "q3").alias("whisker_high"), "outlier_count", "mean")


def iqr_outliers(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """q1, q3, fences, outlier count and percent of all rows, per column
    (``approx``: quartiles from ``percentile_approx``, as ``approxQuantile`` gives)."""
    long = long_values(df, cols)
    counts = _counts(long, ["feature"], approx)
    q = _quantiles(long, counts, ["feature"], [0.25, 0.75], approx).select(
        "feature", F.col("q_0").alias("q1"), F.col("q_1").alias("q3"))
    q = q.select("feature", "q1", "q3",
                 (F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("lower_fence"),
                 (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("upper_fence"))
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    j = counts.join(q, "feature", "inner")
    cnt = j.groupBy("feature").agg(F.sum(F.when((F.col("value") < F.col("lower_fence")) |
                                                (F.col("value") > F.col("upper_fence")), F.col("n"))
                                         .otherwise(0)).alias("outlier_count"))
    return (q.join(cnt, "feature").crossJoin(F.broadcast(total))
            .select("feature", "q1", "q3", "lower_fence", "upper_fence",
                    F.col("outlier_count").cast("bigint").alias("outlier_count"),
                    F.round(F.col("outlier_count") * 100.0 / F.col("_total"), 2).alias("outlier_pct")))


def group_box(df: DataFrame, group_col: str, value_col: str, top_k: int, approx: bool = False) -> DataFrame:
    """Box statistics of ``value_col`` for the ``top_k`` largest groups, clipped
    whiskers (max(min, q1 - 1.5 IQR), min(max, q3 + 1.5 IQR)).

    The top-k groups (k rows) are a broadcast left-semi filter; all groups are
    then summarised by one grouped aggregate instead of one job per group."""
    sizes = df.groupBy(group_col).agg(F.count(F.lit(1)).alias("_size"))
    top = sizes.orderBy(F.desc("_size"), F.asc(group_col)).limit(top_k).select(group_col)
    rows = df.join(F.broadcast(top), group_col, "left_semi").select(
        group_col, F.col(value_col).cast("double").alias("value"))
    counts = _counts(rows, [group_col], approx)
    q = _quantiles(rows, counts, [group_col], [0.25, 0.5, 0.75], approx)
    basic = counts.groupBy(group_col).agg(
        F.min("value").alias("min"), F.max("value").alias("max"),
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"),
        F.sum("n").alias("track_count"))
    out = q.join(basic, group_col).select(
        group_col, "track_count", F.col("q_0").alias("q1"), F.col("q_1").alias("median"),
        F.col("q_2").alias("q3"), "min", "max", "mean")
    iqr = F.col("q3") - F.col("q1")
    return out.withColumn("whisker_low", F.greatest(F.col("min"), F.col("q1") - 1.5 * iqr)) \
              .withColumn("whisker_high", F.least(F.col("max"), F.col("q3") + 1.5 * iqr))


# ---------------------------------------------------------------- association

def corr_long(df: DataFrame, cols: Sequence[str], complete_rows: bool = False) -> DataFrame:
    """Pearson matrix in long form (feature_x, feature_y, r).

    Default is pairwise-complete (each pair uses rows where both are present);
    ``complete_rows`` first drops rows with any NULL among ``cols``."""
    if complete_rows:
        df = df.where(no_nulls(cols))
    return _corr_pairwise(df, cols)


def _corr_pairwise(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson matrix from masked Gram matrices.

    With X the values (0 where NULL) and M the mask of values that are there, the sums of every pair over
    the rows where both are there are entries of M'M, X'M, (X*X)'M and X'X: four k x k matrix products over
    Arrow batches, added up in each task and then by cell, instead of k(k-1)/2 correlation aggregates
    with six buffers each. Values are taken relative to a typical one of their column (any value gives
    the same r; it only keeps digits when a column lies far from 0). r is NULL where it is undefined: no
    common row, or a column that is constant over the common rows."""
    cols, k = list(cols), len(cols)
    src = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    typical = src.limit(1000).agg(*[F.nanvl(F.coalesce(F.avg(c), F.lit(0.0)), F.lit(0.0)).alias(f"t{c}") for c in src.columns])  # one row
    src = src.crossJoin(F.broadcast(typical)).select(*[(F.col(c) - F.col(f"t{c}")).alias(c) for c in src.columns])

    def run(batches):
        gram = np.zeros((4, k, k))
        for batch in batches:
            there = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns], 1).astype(float)
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], 1)
            x[there == 0] = 0.0
            gram += np.stack([there.T @ there, x.T @ there, (x * x).T @ there, x.T @ x])
        i, j = np.divmod(np.arange(k * k), k)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), *[pa.array(g.ravel()) for g in gram]], names=["i", "j", "n", "s", "q", "p"])

    cells = src.mapInArrow(run, "i int, j int, n double, s double, q double, p double").groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in "nsqp"])
    turned = cells.select(F.col("j").alias("i"), F.col("i").alias("j"), F.col("s").alias("t"), F.col("q").alias("u"))  # k x k rows
    both = cells.join(turned, ["i", "j"])
    var = lambda s, q: F.col(q) - F.col(s) * F.col(s) / F.col("n")
    cov = F.col("p") - F.col("s") * F.col("t") / F.col("n")
    vx, vy = F.greatest(var("s", "q"), F.lit(0.0)), F.greatest(var("t", "u"), F.lit(0.0))
    # what rounding leaves of the variance of a constant is no variance
    varies = (vx > 1e-12 * F.col("q")) & (vy > 1e-12 * F.col("u"))
    r = F.greatest(F.least(F.try_divide(cov, F.sqrt(vx * vy)), F.lit(1.0)), F.lit(-1.0))
    name = lambda c: F.element_at(F.lit(cols), F.col(c) + 1)
    return both.select(name("i").alias("feature_x"), name("j").alias("feature_y"),
                       F.when(F.col("i") == F.col("j"), F.lit(1.0)).when((F.col("n") > 0) & varies, r).alias("r"))


def linear_fit(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Least-squares line y = slope*x + intercept with NULLs read as 0 (as the
    chart's fit did), and the pairwise-complete Pearson r."""
    aggs, entries = [], []
    for i, (x, y) in enumerate(pairs):
        xd, yd = F.col(x).cast("double"), F.col(y).cast("double")
        x0, y0 = F.coalesce(xd, F.lit(0.0)), F.coalesce(yd, F.lit(0.0))
        aggs += [F.regr_slope(y0, x0).alias(f"s{i}"), F.regr_intercept(y0, x0).alias(f"i{i}"),
                 F.corr(xd, yd).alias(f"r{i}")]
        entries.append(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"s{i}").alias("slope"),
                                F.col(f"i{i}").alias("intercept"), F.col(f"r{i}").alias("r")))
    return df.agg(*aggs).select(F.inline(F.array(*entries)))


# ---------------------------------------------------------------- samples

def hash_sample(df: DataFrame, fraction: float, seed: int, key_cols: Sequence[str]) -> DataFrame:
    """Reproducible Bernoulli-like sample: keep rows whose md5 order key of
    (seed, key columns) falls under ``fraction`` of the 32-bit range.
    Independent of partitioning, unlike ``sample(fraction, seed)``."""
    h = hash_order(F.lit(str(seed)), *key_cols)
    return df.where(h < F.lit(int(fraction * 4294967296)))


def capped_rows(df: DataFrame, n: int, seed: int, key_cols: Sequence[str]) -> DataFrame:
    """A sampler: ``n`` rows in a fixed pseudo-random order, for a caller that asks for so many."""
    h = hash_order(F.lit(str(seed)), *key_cols)
    return df.withColumn("_h", h).orderBy("_h", *key_cols).limit(n).drop("_h")


def bins_2d(df: DataFrame, x: str, y: str, x_width: float, y_width: float) -> DataFrame:
    """Counts of all rows on a grid (x_bin, y_bin): a scatter of any size in bounded space."""
    at = lambda c, w: F.floor(F.col(c).cast("double") / F.lit(float(w))).cast("bigint")
    return (df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
            .groupBy(at(x, x_width).alias("x_bin"), at(y, y_width).alias("y_bin")).agg(F.count(F.lit(1)).alias("count")))
