"""What keeps figures of large inputs in proportion: partitions of bounded rows, of sorted rows, and passes over them."""

import re

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cadence.operators import clean, ml
from cadence.operators import evaluate as ev
from cadence.plans import binding, frames, q_ml, q_stream
from cadence.sources import messages


@pytest.fixture
def conf(spark):
    """Sets session settings for one test."""
    before = {}

    def put(name, value):
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield put
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_fit_rows_lie_in_few_partitions_and_fits_repeat(spark, sf_small, conf):
    """A fit runs hundreds of jobs, so the partitions of its bounded rows must not follow the session's setting."""
    conf("spark.sql.adaptive.enabled", "false")
    features = frames.feature_table(spark, sf_small)
    trees = []
    for n in (5, 40):
        conf("spark.sql.shuffle.partitions", str(n))
        prepared = ml.prepare(features)
        most = len(prepared.labels) * ml.FIT_ROWS_PER_CLASS
        assert prepared.train.rdd.getNumPartitions() <= -(-most // ml.FIT_ROWS_PER_PARTITION)
        forest = dict(ml.classifiers(len(prepared.labels)))["Random Forest"].setNumTrees(3).setMaxDepth(4)
        trees.append(forest.fit(prepared.train).toDebugString.split("\n", 1)[1])
        prepared.release()
    assert trees[0] == trees[1]


def test_roc_points_count_scores_in_one_exchange(spark, monkeypatch):
    """The classes are pooled, so their (row, class) scores are exchanged once by score, not by (class, score) first."""
    rows = [(i % 3, [((i * 7 + c * 3) % 11) / 11.0 for c in range(3)]) for i in range(60)]
    df = spark.createDataFrame(rows, "label int, scores array<double>")
    seen = []
    whole = ev.running
    monkeypatch.setattr(ev, "running", lambda pooled, *a, **kw: (seen.append(pooled), whole(pooled, *a, **kw))[1])
    got = {(r.fpr, r.tpr) for r in ev.roc_points(df, 3).collect()}
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"hashpartitioning\(score#", plan)) == 1 and not re.search(r"hashpartitioning\(class#\d+, score#", plan)
    pairs = [(s, y == c) for y, scores in rows for c, s in enumerate(scores)]
    pos, neg = sum(hit for _, hit in pairs), sum(not hit for _, hit in pairs)
    at = [(t, sum(s >= t and not hit for s, hit in pairs) / neg, sum(s >= t and hit for s, hit in pairs) / pos) for t in {s for s, _ in pairs}]
    assert got <= {(0.0, 0.0)} | {(f, t) for _, f, t in at} and {(0.0, 0.0), (1.0, 1.0)} <= got


def _sorts(df):
    return len(re.findall(r"(?m)^[ :+*()\d-]*Sort \[", df._jdf.queryExecution().executedPlan().toString()))


def test_silver_of_large_inputs_is_sorted_once_in_enough_partitions(spark, sf_small, monkeypatch, conf):
    """Partitions follow the input's size, rows are sorted behind the shuffle only, and the rows are the same."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    want = sorted(map(tuple, frames.compute_silver(spark, sf_small).collect()))
    few = frames.compute_silver(spark, sf_small)
    monkeypatch.setattr(binding, "PARTITION_BYTES", 2048)
    n = binding.partitions(spark, sf_small)
    assert n > 8 and frames.dedupe_partitions(spark, sf_small) == n
    assert sorted(map(tuple, frames.compute_silver(spark, sf_small).collect())) == want
    many = frames.compute_silver(spark, sf_small)  # not run: its first plan is read
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(rf"Exchange hashpartitioning\([lp]_partkey#\d+L?, {n}\)", plan)) >= 2
    assert re.search(rf"Exchange hashpartitioning\(track_id#\d+, {n}\)", plan) and _sorts(many) == _sorts(few) - 1


def test_rows_are_dealt_by_track_as_the_columns_of_the_tables(spark, sf_small, monkeypatch, conf):
    """The widest shuffle carries the 14 columns that the 23 fields are made of, and the key, once each."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    want = sorted(map(tuple, clean.dedupe(clean.drop_nulls(binding.tracks(spark, sf_small))).collect()))
    monkeypatch.setattr(binding, "PARTITION_BYTES", 2048)
    dealt = clean.dedupe(clean.drop_nulls(frames.bronze_by_track(spark, sf_small)))
    assert sorted(map(tuple, dealt.collect())) == want
    plan = frames.compute_silver(spark, sf_small)._jdf.queryExecution().executedPlan().toString()  # not run: its first plan is read
    carried = re.search(r"Exchange hashpartitioning\(track_id#\d+, \d+\).*\n[ :+*()\d-]*Project \[(.*)\]", plan).group(1).split(", ")
    assert len(carried) == 15 and sum(" AS track_id" in c for c in carried) == 1, carried


def test_a_hot_track_is_cut_down_ahead_of_the_shuffle(spark, sf_small, monkeypatch):
    monkeypatch.setattr(binding, "PARTITION_BYTES", 2048)
    monkeypatch.setattr(frames, "HOT_KEY_ROWS", 1)
    assert binding.partitions(spark, sf_small) > 8 and frames.dedupe_partitions(spark, sf_small) is None


def test_message_files_are_compressed_and_read_back(spark, tmp_path):
    df = spark.range(5000).select(F.to_json(F.struct(F.col("id"), F.lit("the same text in every row").alias("text"))).alias("value"))
    messages.write_messages(df, f"{tmp_path}/m")
    written = sum(f.stat().st_size for f in (tmp_path / "m").glob("part-*"))
    assert written * 3 < df.agg(F.sum(F.length("value") + 1)).first()[0]
    assert sorted(messages.read_messages(spark, f"{tmp_path}/m").collect()) == sorted(df.collect())


def test_one_vs_rest_scores_without_python_functions(spark, sf_small):
    """The class models' scores and the predicted class are those of PySpark's own transform, with no Python in the plan."""
    prepared = ml.prepare(frames.feature_table(spark, sf_small))
    model = dict(ml.classifiers(len(prepared.labels)))["GBT One-vs-Rest"]
    model = model.setClassifier(model.getClassifier().copy().setMaxIter(1).setMaxDepth(2)).fit(prepared.train)
    got = ml.one_vs_rest_scores(model, prepared.test).select("track_id", "rawPrediction", "prediction")
    want = model.transform(prepared.test).select("track_id", vector_to_array("rawPrediction"), "prediction")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert "EvalPython" not in got._jdf.queryExecution().executedPlan().toString()
    prepared.release()


def test_auc_needs_one_pass_over_the_scores(spark, conf, monkeypatch):
    """Exact, whatever ranges and Arrow batches cut a class's scores, and no score row is written."""
    from cadence.operators import ordered

    conf("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    written = []
    monkeypatch.setattr(ordered, "cut_lineage", lambda df: (written.append(df), df)[1])
    rows = [((i * 5 + i // 7) % 4, [0.25 if c == 1 and i % 3 else ((i * 37 + c * 11) % 101) / 101.0 for c in range(3)]) for i in range(300)]
    df = spark.createDataFrame(rows, "label int, scores array<double>")
    for n in (1, 5, 40):
        conf("spark.sql.shuffle.partitions", str(n))
        got = {r["class"]: (r.positives, r.negatives, r.auc) for r in ev.auc_per_class(df, 3).collect()}
        assert sorted(got) == [0, 1, 2]
        for c, (p, q, auc) in got.items():
            pos, neg = [s[c] for y, s in rows if y == c], [s[c] for y, s in rows if y != c]
            pairs = sum((a > b) + (a == b) / 2 for a in pos for b in neg)
            assert (p, q) == (len(pos), len(neg)) and abs(auc - pairs / (len(pos) * len(neg))) < 1e-12
    assert not written


def test_result_files_come_from_one_evaluation(spark, sf_small, monkeypatch):
    """The metrics of a model are worked out once for all result files, and the files agree with the queries."""
    seen = []
    whole = ev.auc_per_class
    monkeypatch.setattr(ev, "auc_per_class", lambda *a, **kw: (seen.append(a), whole(*a, **kw))[1])
    root, schemas = q_stream.write_results(spark, sf_small)
    assert len(seen) == len(q_ml.MODEL_NAMES)
    files = q_stream.load_results(spark, (root, schemas))
    assert sorted(files["best_confusion_matrix"].collect()) == sorted(q_ml.best_model_confusion(spark, sf_small).collect())
    assert files["best_model"].first().best_model_name == q_ml.best_model_row(spark, sf_small).first().best_model_name
