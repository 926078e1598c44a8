"""The driver contract: entry runs, every oracle key is a query, ML queries produce rows."""

import __spark_entry__ as E


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["track_genre", "track_count"]
    assert df.count() > 0


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 100


def test_queries_without_twin_run(spark, sf_small):
    qs, twins = E.queries(), E.oracle_sql()
    open_ = [k for k in qs if k not in twins and not k.startswith("op") and k != "pipeline"]
    # fitted numbers and estimates: each is counted by hand in test_models and test_guards_sketches
    assert sorted(open_) == sorted(["importance_topk", "importance_forest", "importance_gbt", "model_metrics", "model_metrics_documents", "model_roc_points", "model_leaderboard",
                                    "model_logistic", "model_tree", "model_forest", "model_gbt_ovr", "model_bayes", "predictions", "best_model_predictions", "best_model_confusion",
                                    "profile_sketch", "distinct_counts_sketch", "quantiles_sketch", "box_stats_sketch", "iqr_outliers_sketch", "genre_box_sketch"])
    for key in open_:
        assert qs[key](spark, sf_small).count() > 0, key


def test_library_works_without_the_training_data_package(monkeypatch):
    import sys

    for name in [n for n in sys.modules if n == "corpus_pipeline" or n.startswith("cadence.llm")] + ["corpus_pipeline", "cadence.llm"]:
        monkeypatch.setitem(sys.modules, name, None)
    assert not [k for k in E.queries() if k == "pipeline" or k.startswith("op") and k[2].isdigit()]
    assert set(E.oracle_sql()) <= set(E.queries())
