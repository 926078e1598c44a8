"""Per-operator tests on small literal frames with the edge rows of each operator."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cadence.functions import expressions as X
from cadence.operators import clean, evaluate, features, ordered, profile, stats
from cadence.sources import messages
from cadence.sources.schemas import MESSAGE_SCHEMA


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


# ---------------------------------------------------------------- messages

def test_decode_edge_rows(spark):
    texts = [
        '{"track_id": "a", "popularity": 7, "explicit": "True"}',          # valid
        '{"track_id": "b", "popularity": 8, "extra": 1}',                   # extra field
        '{"popularity": 9}',                                                # missing field
        'not json',                                                         # not JSON
        None,                                                               # NULL value
        '{"track_id": "c", "popularity": "7"}',                             # wrong kind (string)
        '{"track_id": "d", "popularity": 1.5}',                             # wrong kind (float)
        '{"track_id": "e", "explicit": true}',                              # JSON boolean
    ]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    out = messages.decode(df, MESSAGE_SCHEMA).collect()
    assert len(out) == len(texts)
    assert (out[0].track_id, out[0].popularity, out[0].explicit) == ("a", 7, "True")
    assert (out[1].track_id, out[1].popularity) == ("b", 8)
    assert (out[2].track_id, out[2].popularity) == (None, 9)
    assert all(v is None for v in out[3])
    assert all(v is None for v in out[4])
    assert out[5].track_id == "c"
    assert out[6].track_id == "d" and out[6].popularity is None
    # a JSON boolean arrives as the text "true", which the flag maps to 0
    assert out[7].explicit == "true"
    flag = spark.createDataFrame([(out[7].explicit,)], "e string").select(X.flag_to_int("e")).first()[0]
    assert flag == 0


def test_encode_decode_round_trip_keeps_nulls(spark):
    df = spark.createDataFrame([("a", None, 1.5)], "track_id string, track_name string, tempo float")
    enc = messages.encode(df).first()[0]
    assert '"track_name":null' in enc
    back = messages.decode(messages.encode(df), df.schema).first()
    assert tuple(back) == ("a", None, 1.5)


def test_quarantine_keeps_bad_text(spark):
    df = spark.createDataFrame([("{bad",), ('{"track_id": "x"}',)], "value string")
    out = messages.decode_with_quarantine(df).collect()
    assert out[0][messages.CORRUPT_COLUMN] == "{bad"
    assert out[1][messages.CORRUPT_COLUMN] is None and out[1].track_id == "x"


# ---------------------------------------------------------------- cleaning

def test_drop_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, None)], "a int, b string")
    assert rows(clean.drop_nulls(df), "a", "b") == [(1, "a")]
    empty = spark.createDataFrame([(None, None)], "a int, b string")
    assert clean.drop_nulls(empty).count() == 0


def test_dedupe_is_deterministic_and_idempotent(spark):
    data = [
        ("k1", "2024-01-02", "rock", 1),
        ("k1", "2024-01-01", "pop", 2),     # earlier time wins
        ("k2", "2024-01-01", "rock", 3),
        ("k2", "2024-01-01", "jazz", 4),    # same time: genre order wins
        ("k3", "2024-01-01", "pop", 5),
        ("k3", "2024-01-01", "pop", 5),     # fully equal rows
    ]
    df = spark.createDataFrame(data, "track_id string, kafka_timestamp string, track_genre string, x int")
    d = clean.dedupe(df)
    got = sorted(rows(d, "track_id", "track_genre", "x"))
    assert got == [("k1", "pop", 2), ("k2", "jazz", 4), ("k3", "pop", 5)]
    assert sorted(rows(clean.dedupe(d), "track_id", "x")) == sorted(rows(d, "track_id", "x"))
    assert sorted(rows(clean.dedupe(df.repartition(5)), "track_id", "x")) == sorted(rows(d, "track_id", "x"))


def test_range_and_flag(spark):
    df = spark.createDataFrame([(-1,), (0,), (100,), (101,), (None,)], "popularity int")
    assert sorted(r[0] for r in clean.in_range(df, "popularity", 0, 100).collect()) == [0, 100]
    f = spark.createDataFrame([("True",), ("False",), ("true",), ("yes",), (None,)], "e string")
    assert [r[0] for r in f.select(X.flag_to_int("e")).collect()] == [1, 0, 0, 0, 0]


def test_clean_stages_counts(spark):
    data = [("k1", "t1", "g", 10), ("k1", "t2", "g", 10), ("k2", "t1", "g", 200), ("k3", "t1", None, 5)]
    df = spark.createDataFrame(data, "track_id string, kafka_timestamp string, track_genre string, popularity int")
    got = {r.stage: r.rows for r in clean.clean_stages(df).collect()}
    assert got == {"bronze": 4, "drop_nulls": 3, "dedupe": 2, "range_filter": 1}


# ---------------------------------------------------------------- features

def test_ratio_minmax_tempo(spark):
    df = spark.createDataFrame([(0.5, 0.0), (0.0, 0.0), (None, 0.2)], "energy double, danceability double")
    r = [x[0] for x in df.select(X.ratio("energy", "danceability")).collect()]
    assert r[0] == pytest.approx(5000.0) and r[1] == 0.0 and r[2] is None
    const = spark.createDataFrame([(3.0,), (3.0,)], "loudness double")
    assert [x[0] for x in features.with_minmax(const, "loudness", "n").select("n").collect()] == [0.0, 0.0]
    guarded = features.with_minmax(const, "loudness", "n", min_range=1e-9)
    assert [x[0] for x in guarded.select("n").collect()] == [0.0, 0.0]
    t = spark.createDataFrame([(99.99,), (100.0,), (140.0,), (140.01,), (None,)], "tempo double")
    assert [x[0] for x in t.select(X.tempo_category("tempo")).collect()] == \
        ["slow", "medium", "medium", "fast", None]


def test_duration_bands(spark):
    mins = [0.0, 1.99, 2.0, 3.0, 4.0, 5.0, 9.99, 10.0]
    df = spark.createDataFrame([(m,) for m in mins], "m double")
    got = [x[0] for x in df.select(X.duration_band("m")).collect()]
    assert got == ["< 2 min", "< 2 min", "2-3 min", "3-4 min", "4-5 min", "> 5 min", "> 5 min", "> 5 min"]


def test_safe_name(spark):
    df = spark.createDataFrame([("Random Forest",), ("GBT One-vs-Rest (OvR)",)], "n string")
    assert [x[0] for x in df.select(X.safe_name("n")).collect()] == ["random_forest", "gbt_one_vs_rest_ovr"]


# ---------------------------------------------------------------- histograms and quantiles

def test_fixed_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (99.9,), (100.0,), (100.5,), (-1.0,), (None,)], "x double")
    h = {r.bin: r["count"] for r in stats.histogram_fixed(df, "x", 0.0, 100.0, 10).collect()}
    assert h[0] == 1 and h[1] == 1 and h[9] == 2 and sum(h.values()) == 4 and len(h) == 10


def test_auto_histogram_sums_and_density(spark):
    vals = [random.Random(1).random() * 7 for _ in range(200)]
    df = spark.createDataFrame([("f", v) for v in vals], "feature string, value double")
    h = stats.histogram_auto(df, ["feature"], 35, density=True).collect()
    assert sum(r["count"] for r in h) == 200
    assert sum(r.density * (r.bin_hi - r.bin_lo) for r in h) == pytest.approx(1.0)
    const = spark.createDataFrame([("f", 2.0), ("f", 2.0)], "feature string, value double")
    hc = stats.histogram_auto(const, ["feature"], 45).collect()
    assert sum(r["count"] for r in hc) == 2 and len(hc) == 45


def _np_percentile(xs, p):
    xs = sorted(xs)
    h = (len(xs) - 1) * p
    lo, hi = math.floor(h), math.ceil(h)
    return xs[lo] + (h - lo) * (xs[hi] - xs[lo])


@pytest.mark.parametrize("n", [1, 2, 7, 10, 333])
def test_exact_quantiles_match_brute_force(spark, n):
    rnd = random.Random(n)
    data = [("a", float(rnd.randint(0, 20))) for _ in range(n)] + [("b", rnd.random()) for _ in range(n)]
    df = spark.createDataFrame(data, "g string, x double")
    counts = ordered.value_counts(df, ["g"], "x")
    q = {r.g: (r.q_0, r.q_1, r.q_2) for r in ordered.exact_quantiles(counts, ["g"], [0.25, 0.5, 0.75], ranges=4).collect()}
    for g in ("a", "b"):
        xs = [x for k, x in data if k == g]
        assert q[g] == pytest.approx(tuple(_np_percentile(xs, p) for p in (0.25, 0.5, 0.75)))


@pytest.mark.parametrize("ranges", [1, 5, 23])
def test_running_totals_match_brute_force(spark, ranges):
    rnd = random.Random(ranges)
    # one group holds most rows and spans ranges, one is NULL, keys are tied
    data = [(rnd.choice([None, 1, 1, 1, 1, 2, 3]), rnd.randint(0, 40), rnd.choice([None, 0, 1, 5, -(2**40)]), i) for i in range(400)]
    df = spark.createDataFrame(data, "g int, key int, v long, id long").repartition(7)
    out = ordered.running(df, ["g"], [F.desc("key"), "id"], sums={"s": "v"}, xors={"x": "v"}, lags={"a": "id"}, ranges=ranges)
    # a second pass over what is left lies where the first one put it
    again = ordered.running_again(out.where("id % 3 > 0").withColumn("one", F.lit(1).cast("long")), ["g"], sums={"n": "one"})
    got, got_n = {r.id: (r.s, r.x, r.a) for r in out.collect()}, {r.id: r.n for r in again.collect()}
    for g in {d[0] for d in data}:
        s = x = n = 0
        ahead = None
        for _, _, v, i in sorted((d for d in data if d[0] == g), key=lambda d: (-d[1], d[3])):
            s, x, n = s + (v or 0), x ^ (v or 0), n + (i % 3 > 0)
            assert got[i] == (s, x, ahead)
            assert i % 3 == 0 or got_n[i] == n
            ahead = i


def test_running_totals_over_everything_and_nothing(spark):
    df = spark.range(50).withColumn("one", F.lit(1).cast("long"))
    assert [r.at for r in ordered.running(df, [], [F.desc("id")], sums={"at": "one"}, ranges=6).orderBy("id").collect()] == list(range(50, 0, -1))
    assert ordered.running(df.where("id < 0"), [], ["id"], sums={"at": "one"}, lags={"a": "id"}, ranges=6).collect() == []


def test_box_stats_matplotlib_rule(spark):
    xs = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 100.0, -50.0]
    df = spark.createDataFrame([(x,) for x in xs], "v double")
    b = stats.box_stats(df, ["v"]).first()
    q1, q3 = _np_percentile(xs, 0.25), _np_percentile(xs, 0.75)
    iqr = q3 - q1
    inside = [x for x in xs if q1 - 1.5 * iqr <= x <= q3 + 1.5 * iqr]
    assert (b.q1, b.q3, b.whisker_low, b.whisker_high, b.outlier_count) == \
        pytest.approx((q1, q3, min(inside), max(inside), 2))


def test_top_k_ties_broken_by_name(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "track_genre string")
    from cadence.operators import aggregate
    got = rows(aggregate.genre_counts_top(df, 2), "track_genre", "track_count")
    assert got == [("c", 2), ("a", 1)]


def test_distinct_counts_count_null_once(spark):
    df = spark.createDataFrame([(1, 0.0), (1, -0.0), (None, None), (2, 1.5)], "a int, b double")
    got = {r.column_name: r.distinct_count for r in profile.distinct_counts(df).collect()}
    assert got == {"a": 3, "b": 3}


def test_hash_sample_ignores_partitioning(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    a = sorted(r.k for r in stats.hash_sample(df, 0.3, 42, ["k"]).collect())
    b = sorted(r.k for r in stats.hash_sample(df.repartition(7), 0.3, 42, ["k"]).collect())
    assert a == b and 450 < len(a) < 750


def test_timestamp_parse_bad_text(spark):
    df = spark.createDataFrame([("2024-01-01T10:15:00.123456",), ("2024-01-01T10:15:00",), ("garbage",), (None,)],
                               "t string")
    got = [r[0] for r in df.select(F.hour(F.try_to_timestamp("t"))).collect()]
    assert got == [10, 10, None, None]


# ---------------------------------------------------------------- evaluation

def test_weighted_scores_golden(spark):
    # hand-computed: labels 0,0,0,1,1,2 ; predictions 0,0,1,1,2,2 (class 2 never confused into 0)
    pairs = [(0, 0), (0, 0), (0, 1), (1, 1), (1, 2), (2, 2)]
    df = spark.createDataFrame(pairs, "label int, prediction int")
    s = evaluate.scores(evaluate.confusion_long(df, 3)).first()
    # per class: p = (1, .5, .5), r = (2/3, .5, 1), f1 = (.8, .5, 2/3); support (3, 2, 1)
    assert s.accuracy == pytest.approx(4 / 6)
    assert s.precision_weighted == pytest.approx((3 * 1 + 2 * .5 + 1 * .5) / 6)
    assert s.recall_weighted == pytest.approx((3 * 2 / 3 + 2 * .5 + 1 * 1) / 6)
    assert s.f1_weighted == pytest.approx((3 * .8 + 2 * .5 + 1 * 2 / 3) / 6)


def test_class_never_predicted_or_true(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "label int, prediction int")
    pc = {r["class"]: r for r in evaluate.per_class(evaluate.confusion_long(df, 3)).collect()}
    assert pc[1].precision == 0.0 and pc[1].recall == 0.0 and pc[1].f1 == 0.0
    assert pc[2].support == 0
    assert evaluate.confusion_long(df, 3).count() == 9


def _brute_auc(ys, ss):
    pos = [s for y, s in zip(ys, ss) if y]
    neg = [s for y, s in zip(ys, ss) if not y]
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def test_auc_matches_pairwise_count_and_flips(spark):
    rnd = random.Random(5)
    data = [(rnd.randint(0, 2), [float(rnd.randint(0, 6)) for _ in range(3)]) for _ in range(150)]
    df = spark.createDataFrame(data, "label int, raw array<double>")
    probs = evaluate.probabilities(df, 3, prob_col=None, raw_col="raw")
    got = {r["class"]: r.auc for r in evaluate.auc_per_class(probs, 3).collect()}
    sc = [r.scores for r in probs.select("scores").collect()]
    for c in range(3):
        ys = [lab == c for lab, _ in data]
        assert got[c] == pytest.approx(_brute_auc(ys, [s[c] for s in sc]))
    neg = df.select("label", F.transform("raw", lambda v: -v).alias("raw"))
    pn = evaluate.probabilities(neg, 3, prob_col=None, raw_col="raw")
    flipped = {r["class"]: r.auc for r in evaluate.auc_per_class(pn, 3).collect()}
    # softmax is not odd, so compare the identity on the probability scores themselves
    probs_neg = probs.select("label", F.transform("scores", lambda v: -v).alias("scores"))
    inv = {r["class"]: r.auc for r in evaluate.auc_per_class(probs_neg, 3).collect()}
    for c in range(3):
        assert inv[c] == pytest.approx(1 - got[c])
    assert set(flipped) == {0, 1, 2}


def test_scores_are_chosen_by_column(spark):
    rows = [([0.2, 0.3, 0.5],), ([1000.0, 1000.0, 0.0],), ([float("nan"), 0.0, 0.0],), ([float("inf"), 2.0],)]
    df = spark.createDataFrame(rows, "given array<double>")
    raw = [r.scores for r in evaluate.probabilities(df, 3, prob_col=None, raw_col="given").collect()]
    assert raw[0] == pytest.approx([0.28943, 0.31987, 0.39069], abs=1e-4)
    assert raw[1] == pytest.approx([0.5, 0.5, 0.0])                 # large values, no overflow
    assert raw[2] == pytest.approx([1 / 3, 1 / 3, 1 / 3])           # NaN counts as 0
    assert raw[3] == pytest.approx([0.10650, 0.78699, 0.10650], abs=1e-4)  # infinite counts as 0, width is fitted
    as_is = [r.scores for r in evaluate.probabilities(df.withColumnRenamed("given", "probability"), 3).collect()]
    assert as_is[0] == [0.2, 0.3, 0.5] and as_is[1] == [1000.0, 1000.0, 0.0]  # one odd row changes no scale


def test_tiny_scores_are_ranked_as_they_are(spark):
    rows = [(1, 1e-14), (1, 3e-14), (0, 0.5e-14), (0, 0.2e-14)]
    df = spark.createDataFrame([(y, [1 - x, x]) for y, x in rows], "label int, scores array<double>")
    assert evaluate.auc_weighted(evaluate.auc_per_class(df, 2), 2).first().auc == 1.0


def test_out_of_range_predictions_are_wrong_predictions(spark):
    df = spark.createDataFrame([(0, 0), (0, 5)], "label int, prediction int")
    s = evaluate.scores(evaluate.pair_counts(df)).first()
    assert (s.accuracy, s.recall_weighted, s.precision_weighted, s.rows) == (0.5, 0.5, 1.0, 2)
    assert sum(r["count"] for r in evaluate.confusion_long(df, 2).collect()) == 1


def test_scores_without_rows(spark):
    df = spark.createDataFrame([], "label int, prediction int")
    s = evaluate.scores(evaluate.pair_counts(df)).first()
    assert s.accuracy is None and s.rows == 0
    assert [r.support for r in evaluate.per_class(evaluate.pair_counts(df), 2).collect()] == [0, 0]


def test_roc_pools_only_classes_of_the_truth(spark):
    df = spark.createDataFrame([(0, [0.9, 0.1, 0.0]), (1, [0.6, 0.3, 0.1]), (0, [0.5, 0.2, 0.3])], "label int, scores array<double>")
    got = [(r.fpr, r.tpr) for r in evaluate.roc_points(df, 3).orderBy("ord").collect()]
    ys = [y == c for y in (0, 1, 0) for c in range(2)]
    ss = [x for row in ([0.9, 0.1], [0.6, 0.3], [0.5, 0.2]) for x in row]
    assert [v for p in got for v in p] == pytest.approx([v for p in _brute_roc(ys, ss) for v in p])


@pytest.mark.parametrize("k", [2, 3])
def test_one_class_gives_the_diagonal_and_nan(spark, k):
    df = spark.createDataFrame([(1, [0.5] * k), (1, [0.2] * k)], "label int, scores array<double>")
    auc = evaluate.auc_weighted(evaluate.auc_per_class(df, k), k).first().auc
    assert math.isnan(auc)
    if k == 2:
        assert [(r.fpr, r.tpr) for r in evaluate.roc_points(df, k).orderBy("ord").collect()] == [(0.0, 0.0), (1.0, 1.0)]


def test_whiskers_stay_outside_the_box(spark):
    from cadence.operators import stats
    df = spark.createDataFrame([(0.0,), (0.0,), (0.0,), (100.0,)], "x double")
    r = stats.box_stats(df, ["x"]).first()
    assert (r.q3, r.whisker_high, r.whisker_low, r.outlier_count) == (25.0, 25.0, 0.0, 1)
    low = spark.createDataFrame([(0.0,), (100.0,), (100.0,), (100.0,)], "x double")
    r = stats.box_stats(low, ["x"]).first()
    assert (r.q1, r.whisker_low, r.whisker_high) == (75.0, 75.0, 100.0)


def test_replaced_input_gives_fresh_layers(spark, tmp_path):
    from cadence.plans import frames
    small = "/root/testdata/sf0.001"
    for t in ("lineitem", "part"):
        spark.read.parquet(f"{small}/{t}.parquet").coalesce(1).write.parquet(str(tmp_path / f"{t}.parquet"))
    first = frames.silver(spark, str(tmp_path)).count()
    spark.read.parquet(f"{small}/lineitem.parquet").limit(100).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "lineitem.parquet"))
    assert 0 < frames.silver(spark, str(tmp_path)).count() <= 100 < first


def test_quantile_counts_are_written_once(spark, monkeypatch):
    from cadence.operators import ordered, stats
    cuts = []
    real = ordered.cut_lineage
    monkeypatch.setattr(ordered, "cut_lineage", lambda df: cuts.append(1) or real(df))
    df = spark.range(100).selectExpr("double(id) AS x", "id % 3 AS g")
    for run, most in ((lambda: stats.box_stats(df, ["x"]), 1), (lambda: stats.iqr_outliers(df, ["x"]), 1), (lambda: stats.group_box(df, "g", "x", 2), 1),
                      (lambda: stats.mean_median(df, ["x"]), 1), (lambda: stats.box_stats(df, ["x"], approx=True), 0)):
        cuts.clear()
        run().collect()
        assert len(cuts) == most


def test_importances_need_a_name_for_each_slot(spark):
    from cadence.operators import ml

    class Model:
        featureImportances = None

    from pyspark.ml.linalg import Vectors
    a, b, both = Model(), Model(), Model()
    a.featureImportances, b.featureImportances, both.models = Vectors.dense([0.2, 0.8]), Vectors.dense([0.6, 0.4]), [a, b]
    got = {r.feature: r.importance for r in ml.importances(spark, both, ["x", "y"]).collect()}
    assert got == pytest.approx({"x": 0.4, "y": 0.6})
    with pytest.raises(ValueError):
        ml.importances(spark, both, ["x"])


def _brute_roc(ys, ss):
    """Reference algorithm: thresholds at distinct scores (high to low), drop
    collinear interior points by second differences, prepend (0, 0)."""
    pts = sorted(set(ss), reverse=True)
    tps, fps = [], []
    for t in pts:
        tps.append(sum(1 for y, s in zip(ys, ss) if s >= t and y))
        fps.append(sum(1 for y, s in zip(ys, ss) if s >= t and not y))
    keep = [0] + [i for i in range(1, len(pts) - 1)
                  if (fps[i + 1] - 2 * fps[i] + fps[i - 1]) or (tps[i + 1] - 2 * tps[i] + tps[i - 1])] + \
        [len(pts) - 1]
    fpr = [0.0] + [fps[i] / fps[-1] for i in keep]
    tpr = [0.0] + [tps[i] / tps[-1] for i in keep]
    return list(zip(fpr, tpr))


def test_roc_points_match_brute_force(spark):
    rnd = random.Random(9)
    data = [(rnd.randint(0, 2), [rnd.choice([0.1, 0.2, 0.3, 0.6]) for _ in range(3)]) for _ in range(120)]
    df = spark.createDataFrame(data, "label int, scores array<double>")
    got = [(r.fpr, r.tpr) for r in evaluate.roc_points(df, 3).orderBy("ord").collect()]
    ys = [lab == c for lab, _ in data for c in range(3)]
    ss = [round(s[c], 12) for _, s in data for c in range(3)]
    exp = _brute_roc(ys, ss)
    assert len(got) == len(exp)
    assert [v for p in got for v in p] == pytest.approx([v for p in exp for v in p])


def test_roc_thinning_keeps_evenly_spaced_points(spark):
    rnd = random.Random(2)
    data = [(rnd.randint(0, 2), [rnd.random(), rnd.random(), rnd.random()]) for _ in range(1500)]
    df = spark.createDataFrame(data, "label int, scores array<double>")
    got = evaluate.roc_points(df, 3, max_points=50).orderBy("ord").collect()
    assert len(got) == 50 and got[0].ord == 0 and got[0].fpr == 0.0 and got[-1].tpr == 1.0


def test_binary_roc_and_auc_use_class_one(spark):
    rnd = random.Random(4)
    data = [(rnd.randint(0, 1), rnd.choice([0.1, 0.4, 0.7, 0.9])) for _ in range(200)]
    df = spark.createDataFrame([(y, [1 - s, s]) for y, s in data], "label int, scores array<double>")
    got = [(r.fpr, r.tpr) for r in evaluate.roc_points(df, 2).orderBy("ord").collect()]
    exp = _brute_roc([y == 1 for y, _ in data], [round(s, 12) for _, s in data])
    assert [v for p in got for v in p] == pytest.approx([v for p in exp for v in p])
    auc = evaluate.auc_weighted(evaluate.auc_per_class(df, 2), 2).first().auc
    assert auc == pytest.approx(_brute_auc([y == 1 for y, _ in data], [s for _, s in data]))


def test_approx_quantiles_close_to_exact(spark):
    rnd = random.Random(11)
    xs = [float(rnd.randint(0, 100)) for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in xs], "v double")
    exact = stats.box_stats(df, ["v"]).first()
    approx = stats.box_stats(df, ["v"], approx=True).first()
    assert abs(exact.q1 - approx.q1) <= 2 and abs(exact.q3 - approx.q3) <= 2
    assert approx.median in xs   # an approximate percentile is a data value


# ---------------------------------------------------------------- guards and file sources

def test_model_frame_derives_missing_features_and_guards(spark):
    from cadence.operators import ml
    silver = spark.createDataFrame(
        [("t1", "g", 0.5, 0.6, -10.0, 0.1, 0.2, 0.0, 0.3, 0.4, 95.0, 50, 1, 0, 4),
         ("t2", "g", 0.7, 0.2, -20.0, 0.1, 0.9, 0.0, 0.3, None, 135.0, 60, 2, 1, 4)],
        "track_id string, track_genre string, danceability float, energy float, loudness float, "
        "speechiness float, acousticness float, instrumentalness float, liveness float, valence float, "
        "tempo float, popularity int, key int, mode int, time_signature int")
    mf = ml.model_frame(silver).orderBy("track_id").collect()
    assert [r.tempo_category for r in mf] == ["medium", "fast"]          # 90/130 cut points
    assert [r.loudness_normalized for r in mf] == [1.0, 0.0]
    assert mf[1].dancefloor_score is None
    with pytest.raises(ValueError, match="track_genre"):
        ml.model_frame(silver.drop("track_genre"))


def test_resolve_layer_and_required_results(spark):
    from cadence.session import scratch_path
    from cadence.sources import results, tables
    base = scratch_path(spark, "guards")
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    tables.write_layer(df, f"{base}/silver")
    path, got = tables.resolve_layer(spark, [f"{base}/features", f"{base}/silver"])
    assert path.endswith("/silver") and got.count() == 1
    with pytest.raises(FileNotFoundError):
        tables.resolve_layer(spark, [f"{base}/nothing"])
    results.write_csv(df, f"{base}/res/a")
    assert results.load_required(spark, f"{base}/res", {"a": df.schema})["a"].count() == 1
    with pytest.raises(FileNotFoundError, match="b"):
        results.load_required(spark, f"{base}/res", {"a": df.schema, "b": df.schema})


def test_layer_overwrite_while_reading(spark):
    from cadence.session import scratch_path
    from cadence.sources import tables
    root = scratch_path(spark, "ow")
    tables.write_layer(spark.range(3), root)
    current = tables.read_layer(spark, root)
    tables.write_layer(current.withColumn("twice", F.col("id") * 2), root)   # reads what it replaces
    got = tables.read_layer(spark, root)
    assert got.columns == ["id", "twice"] and got.count() == 3


def test_time_column_guard(spark):
    from cadence.plans.q_stream import _msg_time
    with pytest.raises(ValueError):
        _msg_time(spark.createDataFrame([(1,)], "x int"))


def test_layer_has_a_current_version_at_every_moment(spark, monkeypatch):
    """A write that dies before its pointer leaves the earlier version in force."""
    from cadence.session import scratch_path
    from cadence.sources import tables
    root = scratch_path(spark, "dies")
    tables.write_layer(spark.range(3), root)
    monkeypatch.setattr(tables, "POINTER_DIR", "_elsewhere")
    tables.write_layer(spark.range(9), root)
    monkeypatch.undo()
    assert tables.read_layer(spark, root).count() == 3
    tables.write_layer(spark.range(5), root)
    assert tables.read_layer(spark, root).count() == 5


def test_unreadable_layer_is_not_replaced_by_the_next(spark):
    from pyspark.errors import AnalysisException

    from cadence.session import scratch_path
    from cadence.sources import tables
    base = scratch_path(spark, "broken")
    spark.createDataFrame([(f"{base}/features/v-gone",)], "value string").write.text(f"{base}/other")
    spark.range(1).selectExpr("cast(id as string) AS value").write.text(f"{base}/features")  # a folder that is no Parquet table
    tables.write_layer(spark.range(2), f"{base}/silver")
    with pytest.raises(Exception) as e:
        tables.resolve_layer(spark, [f"{base}/features", f"{base}/silver"])[1].count()
    assert not isinstance(e.value, FileNotFoundError) and (not isinstance(e.value, AnalysisException) or e.value.getCondition() != "PATH_NOT_FOUND")
