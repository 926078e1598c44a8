"""Running totals over an ordered key, and exact quantiles built on them.

A running total over a whole ordering (ROC curves, AUC, exact quantiles, places in a long
sequence) written as a window without ``partitionBy`` runs in one task, and one written with it puts
each group into one task. Here the rows are sorted by one range exchange, every range is totalled on
its own, and a table of one row a range supplies what lies ahead of it. Callers collapse equal keys
first, so a hot value is one row, not a third of the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from cadence.session import cut_lineage

def arrange(df: DataFrame, by: Sequence[str], order: Sequence[Column | str] = (), ranges: int | None = None) -> DataFrame:
    """``df`` sorted by (by, order) over all its partitions, and the number of its range in ``_range``.
    One range exchange; as the order is part of the range key, a group of any size is spread over ranges."""
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*[F.col(b).asc_nulls_first() for b in by], *[F.col(o).asc_nulls_first() if isinstance(o, str) else o for o in order]]
    return df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("_range", F.spark_partition_id())


def running(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], sums: Mapping[str, str] | None = None,
            xors: Mapping[str, str] | None = None, lags: Mapping[str, str] | None = None, ranges: int | None = None) -> DataFrame:
    """``df`` with running totals (new column -> long column summed, or combined by exclusive or) over
    the rows of the same ``by`` up to and including this one in ``order``; NULL counts as 0. ``lags``: new
    column -> long column of the row ahead in the group, NULL at its first row.

    A distributed prefix sum: each range of one range exchange is summed on its own, as a stream; what
    the earlier ranges hold of a range's first group is added from a table of one row a range. The
    sorted rows are written once (checkpoint), so that ranges stay the same in both reads."""
    return running_again(arrange(df, by, order, ranges), by, sums, xors, lags)


def running_again(arranged: DataFrame, by: Sequence[str], sums: Mapping[str, str] | None = None,
                  xors: Mapping[str, str] | None = None, lags: Mapping[str, str] | None = None) -> DataFrame:
    """As ``running`` on rows that lie as ``arrange`` left them: ``running`` can follow ``running``
    without another exchange while only projections and filters lie between."""
    by, sums, xors, lags = list(by), dict(sums or {}), dict(xors or {}), dict(lags or {})
    local = cut_lineage(_local_totals(arranged, by, sums, xors, lags))
    group = F.struct(*[F.col(b) for b in by]) if by else F.struct(F.lit(0))
    # of each range: its first and last group, and what its last row hands on
    tail = F.struct(*[F.col(c) for c in [*sums, *xors]], *[F.col(old).alias(c) for c, old in lags.items()])
    ends = local.groupBy("_range").agg(F.min_by(group, "_row").alias("_first"), F.max_by(group, "_row").alias("_last"), F.max_by(tail, "_row").alias("_tail"))
    none = F.struct(*[F.lit(0).cast("long").alias(c) for c in [*sums, *xors]], *[F.lit(None).cast("long").alias(c) for c in lags])
    sides = ends.select(F.inline(F.array(
        F.struct(F.col("_first").alias("_group"), "_range", F.lit(0).alias("_side"), none.alias("_value")),
        F.struct(F.col("_last").alias("_group"), "_range", F.lit(1).alias("_side"), F.col("_tail").alias("_value")))))
    line = Window.partitionBy("_group").orderBy("_range", "_side")
    before = line.rowsBetween(Window.unboundedPreceding, 0)
    held = {c: F.sum(F.col(f"_value.{c}")).over(before) for c in sums} | {c: F.bit_xor(F.col(f"_value.{c}")).over(before) for c in xors}
    held |= {c: F.lag(F.col(f"_value.{c}")).over(line) for c in lags}
    carry = sides.select("_group", "_range", "_side", *[x.alias(f"_before_{c}") for c, x in held.items()])
    carry = carry.where("_side = 0").drop("_side")  # one row for each range
    whole = local.join(F.broadcast(carry), "_range", "left")
    goes_on = group.eqNullSafe(F.col("_group"))
    out = [F.when(goes_on, F.col(c) + F.col(f"_before_{c}")).otherwise(F.col(c)).alias(c) for c in sums]
    out += [F.when(goes_on, F.col(c).bitwiseXOR(F.col(f"_before_{c}"))).otherwise(F.col(c)).alias(c) for c in xors]
    out += [F.when(goes_on & (F.col("_row") == 0), F.col(f"_before_{c}")).otherwise(F.col(c)).alias(c) for c in lags]
    return whole.select(*arranged.columns, *out)


def _changes(n: int, columns: list[pa.Array], before: list) -> np.ndarray:
    """Whether each row's group differs from that of the row ahead (``before``: the group ahead of the first row)."""
    out = np.zeros(n, bool)
    for column, ahead in zip(columns, before, strict=True):
        shifted = pa.concat_arrays([pa.array([ahead], column.type), column.slice(0, n - 1)])
        same = pc.or_(pc.fill_null(pc.equal(column, shifted), False), pc.and_(pc.is_null(column), pc.is_null(shifted)))
        out |= ~same.to_numpy(zero_copy_only=False)
    return out


def _totals(values: np.ndarray, starts: np.ndarray, carry: int, total: Callable, join: Callable) -> np.ndarray:
    """Running totals that restart at each of ``starts``; rows ahead of the first start go on from ``carry``."""
    whole = total.accumulate(values)
    base = np.full(len(values), 0, values.dtype)
    at = np.maximum.accumulate(np.where(starts, np.arange(len(values)), -1))
    base[at > 0] = whole[at[at > 0] - 1]
    out = join(whole, base)
    out[at < 0] = total(out[at < 0], values.dtype.type(carry))
    return out


def _local_totals(arranged: DataFrame, by: list[str], sums: Mapping[str, str], xors: Mapping[str, str], lags: Mapping[str, str]) -> DataFrame:
    """Running totals and values of the row ahead within each range, and the row's number in it (``_row``)."""
    names, new = arranged.columns, [*sums, *xors, *lags]
    kinds = [(np.add, np.subtract)] * len(sums) + [(np.bitwise_xor, np.bitwise_xor)] * len(xors)
    source = [names.index(c) for c in [*sums.values(), *xors.values()]]
    shown = [names.index(c) for c in lags.values()]
    groups = [names.index(b) for b in by]
    types = [to_arrow_type(f.dataType) for f in arranged.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, carry, before, ahead = 0, [0] * len(kinds), None, [None] * len(lags)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = [batch.column(g) for g in groups]
            starts = _changes(n, keys, before or [None] * len(keys))
            starts[0] |= before is None
            out = []
            for i, (c, (total, join)) in enumerate(zip(source, kinds, strict=True)):
                values = pc.fill_null(batch.column(c).cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
                out.append(_totals(values, starts, carry[i], total, join))
            shifted = [pc.if_else(pa.array(starts), pa.scalar(None, pa.int64()), pa.concat_arrays([pa.array([a], pa.int64()), batch.column(c).cast(pa.int64()).slice(0, n - 1)]))
                       for a, c in zip(ahead, shown, strict=True)]
            carry, before = [int(x[-1]) for x in out], [k[n - 1].as_py() for k in keys]
            ahead = [batch.column(c)[n - 1].as_py() for c in shown]
            yield pa.RecordBatch.from_arrays([*[c.cast(t) for c, t in zip(batch.columns, types, strict=True)], *[pa.array(x) for x in out], *shifted, pa.array(np.arange(row, row + n))],
                                             names=[*names, *new, "_row"])
            row += n

    more = [T.StructField(c, T.LongType()) for c in [*new, "_row"]]
    return arranged.mapInArrow(run, T.StructType([*arranged.schema.fields, *more]))


def pairs_below(arranged: DataFrame, by: Sequence[str], upper: str, lower: str) -> DataFrame:
    """(by, _upper, _lower, _pairs) for each group of rows that lie as ``arrange`` left them: the sums of two long columns,
    and over all rows the product of ``upper`` and the running total of ``lower`` (the row's own counts half).

    Each range is summed on its own, as a stream, to a row a group; what the earlier ranges hold of a group is added to these few
    rows. No row is written or read again."""
    by = list(by)
    narrow = arranged.select("_range", *by, F.col(upper).cast("long").alias("_upper"), F.col(lower).cast("long").alias("_lower"))
    kinds = [to_arrow_type(f.dataType) for f in narrow.schema.fields] + [pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, [0, 0, 0.0]  # the group that goes on: range and group columns, sums so far
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            columns = [c.cast(t) for c, t in zip(batch.columns, kinds[:-1], strict=True)]
            labels = columns[:-2]
            starts = _changes(n, labels[1:], key[1:] if key else [None] * len(by))
            starts[0] |= key is None
            x, y = (pc.fill_null(c, 0).to_numpy(zero_copy_only=False) for c in columns[-2:])
            below = _totals(y, starts, held[1], np.add, np.subtract) - y / 2.0
            at = np.flatnonzero(starts) if starts[0] else np.concatenate([[0], np.flatnonzero(starts)])
            sums = list(zip(*[np.add.reduceat(v, at).tolist() for v in (x, y, x * below)], strict=True))
            keys = [[c[i].as_py() for c in labels] for i in at.tolist()]
            done = []
            for k, (found, more) in enumerate(zip(keys, sums, strict=True)):
                if k == 0 and not starts[0]:
                    held = [a + b for a, b in zip(held, more, strict=True)]
                    continue
                if key is not None:
                    done.append([*key, *held])
                key, held = found, list(more)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), kinds, strict=True)], names=names)
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip([*key, *held], kinds, strict=True)], names=names)

    schema = T.StructType([*narrow.schema.fields, T.StructField("_pairs", T.DoubleType())])
    names = schema.names
    ranges = narrow.mapInArrow(run, schema)  # at most a row a range and a row a group
    ahead = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = ranges.withColumn("_pairs", F.col("_pairs") + F.col("_upper") * F.coalesce(F.sum("_lower").over(ahead), F.lit(0)).cast("double"))
    return whole.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("_upper", "_lower", "_pairs")])


def value_counts(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """(groups, value, n) for non-NULL values; partial aggregation collapses hot values."""
    return (df.where(F.col(value).isNotNull())
            .groupBy(*groups, F.col(value).cast("double").alias("value"))
            .agg(F.count(F.lit(1)).alias("n")))


def value_table(df: DataFrame, groups: Sequence[str], value: str, ranges: int | None = None) -> DataFrame:
    """``value_counts`` in order, with the running count ``cum_n``; written once for the branches that read it."""
    return running(value_counts(df, groups, value), groups, ["value"], sums={"cum_n": "n"}, ranges=ranges).drop("_range")


def long_values(df: DataFrame, cols: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """Stack columns into (groups..., feature, value double)."""
    return df.select(*groups, F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols])))


def exact_quantiles(counts: DataFrame, groups: Sequence[str], probs: Sequence[float], ranges: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (as ``percentile``/``quantile_cont``) from (groups, value, n)
    rows, or from a ``value_table``, which is not sorted again. Returns (groups, q_<i> for each prob)."""
    groups = list(groups)
    cum = counts if "cum_n" in counts.columns else running(counts, groups, ["value"], sums={"cum_n": "n"}, ranges=ranges)
    cum = cum.withColumn("_prev", F.col("cum_n") - F.col("n"))
    totals = cum.groupBy(*groups).agg(F.max("cum_n").alias("_total")) if groups else cum.agg(F.max("cum_n").alias("_total"))
    # targets: per group and prob, the two 0-based ranks to interpolate between
    targets = totals.select(*groups, F.inline(F.array(*[
        F.struct(F.lit(i).alias("_pi"), ((F.col("_total") - 1) * F.lit(float(p))).alias("_h"))
        for i, p in enumerate(probs)])))
    targets = targets.select(*groups, "_pi", "_h",
                             F.floor("_h").cast("bigint").alias("_r_lo"),
                             F.ceil("_h").cast("bigint").alias("_r_hi"))
    ranks = targets.select(*groups, "_pi", F.explode(F.array(
        F.struct(F.lit("lo").alias("_side"), F.col("_r_lo").alias("_r")),
        F.struct(F.lit("hi").alias("_side"), F.col("_r_hi").alias("_r")))).alias("_t")) \
        .select(*groups, "_pi", "_t._side", "_t._r")
    # groups x probs x 2 rows
    ranks = ranks.select(*[F.col(g).alias(f"_g_{g}") for g in groups], "_pi", "_side", "_r")
    cond = [F.col(g) == F.col(f"_g_{g}") for g in groups]
    cond.append((F.col("_prev") <= F.col("_r")) & (F.col("_r") < F.col("cum_n")))
    hit = cum.join(ranks, cond, "inner").select(*groups, "_pi", "_side", "value")
    sides = hit.groupBy(*groups, "_pi").agg(
        F.max(F.when(F.col("_side") == "lo", F.col("value"))).alias("_v_lo"),
        F.max(F.when(F.col("_side") == "hi", F.col("value"))).alias("_v_hi"))
    q = sides.join(targets, groups + ["_pi"], "inner").select(
        *groups, "_pi",
        (F.col("_v_lo") + (F.col("_h") - F.floor("_h")) * (F.col("_v_hi") - F.col("_v_lo"))).alias("_q"))
    aggs = [F.max(F.when(F.col("_pi") == i, F.col("_q"))).alias(f"q_{i}") for i in range(len(probs))]
    return q.groupBy(*groups).agg(*aggs) if groups else q.agg(*aggs)



def approx_quantiles(long: DataFrame, groups: Sequence[str], probs: Sequence[float],
                     accuracy: int = 10000) -> DataFrame:
    """Approximate quantiles of ``value`` per group from the row-level frame:
    ``percentile_approx`` keeps a bounded, mergeable sketch per group and is
    partially aggregated in every map task. Returns (groups, q_<i>)."""
    groups = list(groups)
    agg = F.percentile_approx(F.col("value").cast("double"), list(probs), accuracy).alias("_q")
    src = long.where(F.col("value").isNotNull())
    q = src.groupBy(*groups).agg(agg) if groups else src.agg(agg)
    return q.select(*groups, *[F.col("_q")[i].alias(f"q_{i}") for i in range(len(probs))])
