"""The models are fitted on all training rows, however many a class has."""

import math

import pytest
from pyspark.sql import functions as F

from cadence.operators import ml
from cadence.plans import frames, q_ml
from cadence.plans.registry import QUERIES


@pytest.fixture(scope="module")
def uneven(spark, sf_small, tmp_path_factory):
    """The smallest tables with three brands, one of which has nearly all rows, and the number of their training rows."""
    folder = str(tmp_path_factory.mktemp("uneven"))
    brand = F.when(F.col("p_brand").isin("Brand#11", "Brand#12"), F.col("p_brand")).otherwise("Brand#13")
    spark.read.parquet(f"{sf_small}/part.parquet").withColumn("p_brand", brand).write.parquet(f"{folder}/part.parquet")
    spark.read.parquet(f"{sf_small}/lineitem.parquet").write.parquet(f"{folder}/lineitem.parquet")
    train = ml.hash_split(frames.feature_table(spark, folder)).where("split = 'train'")
    most = train.groupBy("track_genre").count().agg(F.max("count")).first()[0]
    assert most > ml.FIT_ROWS_PER_CLASS
    return folder, train.count()


@pytest.mark.parametrize("name", ["best_model_confusion", "best_model_predictions", "best_model_predictions_check", "importance_gbt", "importance_topk",
                                  "model_gbt_ovr", "model_gbt_ovr_check", "model_leaderboard", "model_leaderboard_check", "model_metrics_documents",
                                  "model_roc_points", "model_tree"])
def test_queries_fit_on_all_training_rows(spark, uneven, monkeypatch, name):
    folder, rows = uneven
    seen, model = [], q_ml.Fitted.model
    monkeypatch.setattr(q_ml.Fitted, "model", lambda self, of: (seen.append(self.prepared.train.count()), model(self, of))[1])
    monkeypatch.setattr(q_ml, "_FITTED", {key: _without_scores(f) for key, f in q_ml._FITTED.items()})
    QUERIES[name](spark, folder).count()
    assert seen and set(seen) == {rows}


def _without_scores(fitted):
    """Scored rows are forgotten, so that the next query asks for its models again; the models stay."""
    fitted.scored.clear()
    return fitted


def test_fitted_models_have_seen_all_training_rows(spark, uneven):
    folder, rows = uneven
    fitted = q_ml.fitted(spark, folder)
    assert fitted.model("Decision Tree")._call_java("rootNode").impurityStats().rawCount() == rows
    assert fitted.model("Logistic Regression").summary.predictions.count() == rows
    prior = [p.n for p in fitted.prepared.train.groupBy("label").agg(F.count("*").alias("n")).orderBy("label").collect()]
    assert [math.exp(x) for x in fitted.model("Naive Bayes").pi.toArray()] == pytest.approx([(n + 1.0) / (rows + len(prior)) for n in prior])


@pytest.mark.parametrize(("rows", "want"), [(0, 1), (940, 1), (12_500, 4), (94_000, 8), (1_000_000, 8), (5_600_000, 24), (34_000_000, 24), (100_000_000, 48)])
def test_partitions_of_fit_rows_follow_their_number(rows, want):
    assert ml.fit_partitions(rows) == want
