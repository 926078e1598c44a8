"""The five models on the smallest tables: every published number against one counted by hand from the scored rows."""

import math

import pytest
from pyspark.sql import functions as F

from cadence.plans import q_ml, q_stream
from cadence.plans.registry import QUERIES


@pytest.fixture(scope="module")
def scored(spark, sf_small):
    """Scored test rows of each model, fitted here, and the class names."""
    fitted = q_ml.Fitted(spark, sf_small)
    q_ml._FITTED.clear()
    q_ml._FITTED[q_ml.frames.stamp(spark, sf_small, "lineitem", "part")] = fitted
    return {name: fitted.predictions(name).collect() for name in q_ml.MODEL_NAMES}, fitted.prepared.labels


def by_hand(rows):
    n = len(rows)
    out = {"accuracy": sum(r.label == r.prediction for r in rows) / n, "precision_weighted": 0.0, "recall_weighted": 0.0, "f1_weighted": 0.0}
    for c in {r.label for r in rows}:
        support, predicted = sum(r.label == c for r in rows), sum(r.prediction == c for r in rows)
        tp = sum(r.label == c == r.prediction for r in rows)
        p, q = tp / predicted if predicted else 0.0, tp / support
        out["precision_weighted"] += p * support / n
        out["recall_weighted"] += q * support / n
        out["f1_weighted"] += (2 * p * q / (p + q) if p + q else 0.0) * support / n
    return out


def auc_by_hand(rows, k):
    total = weight = 0
    for c in range(k):
        pos, neg = [r.scores[c] for r in rows if r.label == c], [r.scores[c] for r in rows if r.label != c]
        if pos and neg:
            wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
            total, weight = total + wins / len(neg), weight + len(pos)
    return total / weight


@pytest.mark.parametrize(("key", "name"), list(zip(("model_logistic", "model_tree", "model_forest", "model_gbt_ovr", "model_bayes"), q_ml.MODEL_NAMES, strict=True)))
def test_metrics_of_a_refitted_model(spark, sf_small, scored, key, name):
    rows, labels = scored[0][name], scored[1]
    got = QUERIES[key](spark, sf_small).first()
    assert (got.model, got.rows) == (name, len(rows))
    for metric, value in by_hand(rows).items():
        assert got[metric] == pytest.approx(value)
    assert got.auc_roc == pytest.approx(auc_by_hand(rows, len(labels)))


def test_predictions_carry_classes_and_names(spark, sf_small, scored):
    rows, labels = scored
    got = {(r.model, r.track_id): (r.label, r.prediction, r.label_name, r.prediction_name) for r in q_ml.predictions(spark, sf_small).collect()}
    want = {(name, r.track_id): (r.label, r.prediction, labels[r.label], labels[r.prediction]) for name, rs in rows.items() for r in rs}
    assert got == want


def test_leaderboard_and_best_model(spark, sf_small, scored):
    f1 = {name: by_hand(rows)["f1_weighted"] for name, rows in scored[0].items()}
    order = sorted(q_ml.MODEL_NAMES, key=lambda n: (-f1[n], q_ml.MODEL_NAMES.index(n)))
    board = q_ml.model_leaderboard(spark, sf_small).orderBy("rank").collect()
    assert [r.model for r in board] == order and [r.f1_weighted for r in board] == pytest.approx([f1[n] for n in order])
    rows = scored[0][order[0]]
    got = {r.track_id: (r.label, r.prediction) for r in q_ml.best_model_predictions(spark, sf_small).collect()}
    assert got == {r.track_id: (r.label, r.prediction) for r in rows}
    labels = scored[1]
    wide = {r.label_name: r for r in q_ml.best_model_confusion(spark, sf_small).collect()}
    assert len(wide) == len(labels)
    for i, a in enumerate(labels):
        assert [wide[a][b] for b in labels] == [sum(r.label == i and r.prediction == j for r in rows) for j in range(len(labels))]


def test_importances_are_the_models(spark, sf_small, scored):
    fitted = q_ml.fitted(spark, sf_small)
    forest = fitted.model("Random Forest").featureImportances.toArray().tolist()
    each = [m.featureImportances.toArray() for m in fitted.model("GBT One-vs-Rest").models]
    boosted = (sum(each) / len(each)).tolist()
    for key, values in ((q_ml.importance_forest, forest), (q_ml.importance_gbt, boosted)):
        got = {r.feature: r.importance for r in key(spark, sf_small).collect()}
        names = q_ml.ml.slot_names(fitted.prepared.test)
        assert got == pytest.approx(dict(zip(names, values, strict=True)))
    top = q_ml.importance_topk(spark, sf_small).collect()
    for model, values in (("Random Forest", forest), ("GBT One-vs-Rest", boosted)):
        want = sorted(zip((-v for v in values), names))[:10]
        assert [(r.feature, r.importance) for r in sorted((t for t in top if t.model == model), key=lambda t: t.rank)] == [(n, pytest.approx(-v)) for v, n in want]


def test_roc_points_of_each_model(spark, sf_small, scored):
    got = q_ml.model_roc_points(spark, sf_small).collect()
    for name, rows in scored[0].items():
        present = sorted({r.label for r in rows})
        pool = sorted(((r.scores[c], r.label == c) for r in rows for c in present), reverse=True)
        pos, neg = sum(y for _, y in pool), sum(not y for _, y in pool)
        points, tp, fp = [(0.0, 0.0)], 0, 0
        for i, (s, y) in enumerate(pool):
            tp, fp = tp + y, fp + (not y)
            if i + 1 == len(pool) or pool[i + 1][0] != s:
                points.append((fp / neg, tp / pos))
        own = [(r.fpr, r.tpr) for r in sorted((g for g in got if g.model == name), key=lambda g: g.ord)]
        assert own[0] == (0.0, 0.0) and own[-1] == pytest.approx((1.0, 1.0))
        every = {(round(a, 9), round(b, 9)) for a, b in points}
        assert all((round(a, 9), round(b, 9)) in every for a, b in own)
        area = lambda ps: math.fsum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(ps, ps[1:]))
        assert area(own) == pytest.approx(area(points))  # only points within straight runs are left out


def test_result_files_hold_the_results(spark, sf_small, scored):
    loaded = q_stream.load_results(spark, q_stream.write_results(spark, sf_small))
    labels = scored[1]
    matrix = {r.label_name: [r[n] for n in labels] for r in loaded["best_confusion_matrix"].collect()}
    assert matrix == {r.label_name: [r[n] for n in labels] for r in q_ml.best_model_confusion(spark, sf_small).collect()}
    best = loaded["best_model"].collect()
    assert [tuple(b) for b in best] == [tuple(b) for b in q_ml.best_model_row(spark, sf_small).collect()]
    metrics = {r.model: r.f1_weighted for r in loaded["model_metrics"].collect()}
    documents = {r.model: (r.document, r.f1_weighted) for r in q_stream.model_metrics_documents(spark, sf_small).collect()}
    assert {m: f for m, (_, f) in documents.items()} == pytest.approx(metrics) and documents["GBT One-vs-Rest"][0] == "gbt_one_vs_rest"
    assert loaded["forest_importance"].agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
