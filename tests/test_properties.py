"""Property tests (hypothesis): counts add up, quantiles equal a sort-based
reference, results do not depend on partitioning."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cadence.operators import clean, evaluate, ordered, stats

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
values = st.lists(st.one_of(st.none(), st.integers(-20, 20).map(float)), min_size=1, max_size=40)


def _pct(xs, p):
    xs = sorted(xs)
    h = (len(xs) - 1) * p
    lo, hi = math.floor(h), math.ceil(h)
    return xs[lo] + (h - lo) * (xs[hi] - xs[lo])


@SETTINGS
@given(values, st.integers(1, 6))
def test_histogram_counts_every_non_null_value(spark, xs, parts):
    df = spark.createDataFrame([("f", x) for x in xs], "feature string, value double").repartition(parts)
    h = stats.histogram_auto(df, ["feature"], 10).collect()
    assert sum(r["count"] for r in h) == sum(1 for x in xs if x is not None)


@SETTINGS
@given(values)
def test_quantiles_equal_sorted_reference(spark, xs):
    present = [x for x in xs if x is not None]
    df = spark.createDataFrame([("g", x) for x in xs], "g string, x double")
    out = ordered.exact_quantiles(ordered.value_counts(df, ["g"], "x"), ["g"], [0.1, 0.5, 0.9], ranges=3).collect()
    if not present:
        assert out == []
        return
    got = (out[0].q_0, out[0].q_1, out[0].q_2)
    exp = tuple(_pct(present, p) for p in (0.1, 0.5, 0.9))
    assert all(math.isclose(a, b, abs_tol=1e-9) for a, b in zip(got, exp))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3), st.integers(0, 2)), min_size=1, max_size=40),
       st.integers(1, 5))
def test_dedupe_and_support_independent_of_partitioning(spark, rows, parts):
    df = spark.createDataFrame([(str(k), str(t), f"g{g}") for k, t, g in rows],
                               "track_id string, kafka_timestamp string, track_genre string")
    a = sorted(map(tuple, clean.dedupe(df).collect()))
    b = sorted(map(tuple, clean.dedupe(df.repartition(parts)).collect()))
    assert a == b and len(a) == len({k for k, _, _ in rows})
    pairs = spark.createDataFrame([(g, t % 3) for _, t, g in rows], "label int, prediction int")
    pc = evaluate.per_class(evaluate.confusion_long(pairs, 3)).collect()
    assert sum(r.support for r in pc) == len(rows)
