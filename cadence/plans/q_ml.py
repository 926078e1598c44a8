"""Queries: model frame, balancing, MLlib preprocessing, the five models, importances, runs."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import OneVsRestModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from cadence.functions.expressions import safe_name
from cadence.operators import evaluate as ev
from cadence.operators import ml
from cadence.plans import binding, frames
from cadence.plans.q_explore import _md5_order_sql, _with_long, rounded
from cadence.plans.registry import register
from cadence.session import cut_lineage, scratch_path
from cadence.sources.schemas import MODEL_FEATURES, MODEL_NUMERIC
from cadence.sources.tables import read_layer, write_layer

_MF_SQL = ("mf AS (SELECT track_id, CAST(track_genre AS VARCHAR) AS track_genre, "
           + ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'unknown') AS {c}" if c == "tempo_category"
                       else f"CAST({c} AS DOUBLE) AS {c}" for c in MODEL_FEATURES)
           + " FROM feat WHERE track_genre IS NOT NULL)")
TOP = 10
_TOP_SQL = f"topg AS (SELECT track_genre FROM mf GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT {TOP})"
_CAP_SQL = (f"capped AS (SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY track_genre "
            f"ORDER BY {_md5_order_sql(42, ['track_id'])}, track_id) AS _rn FROM mf) WHERE _rn <= {ml.FIT_ROWS_PER_CLASS})")
_SPLIT_SQL = (f"lab AS (SELECT track_genre, row_number() OVER (ORDER BY count(*) DESC, track_genre) - 1 AS label FROM mf GROUP BY 1),\n"
              f"split AS (SELECT mf.*, lab.label, CASE WHEN {_md5_order_sql('split-42', ['track_id'])} < {int(0.8 * 4294967296)} "
              f"THEN 'train' ELSE 'test' END AS split FROM mf JOIN lab USING (track_genre))")


def _ml_sql(body: str, cap: bool = True) -> str:
    """``cap``: with the table ``capped``, which only ``balanced_cap`` reads."""
    return _with_long(",\n".join([_MF_SQL, _TOP_SQL, *[_CAP_SQL] * cap, _SPLIT_SQL]) + "\n" + body, "feat")


def _mf(spark, sf):
    return ml.model_frame(frames.feature_table(spark, sf))


def _capped(spark, sf):
    """At most ``FIT_ROWS_PER_CLASS`` rows a class, an operator of its own: no model is fitted on its rows."""
    return ml.balanced_cap(_mf(spark, sf))


@register("ml_frame", _ml_sql("SELECT * FROM mf"))
def ml_frame(spark, sf):
    return _mf(spark, sf)


@register("top_groups_filter", _ml_sql("SELECT * FROM mf WHERE track_genre IN (SELECT track_genre FROM topg)"))
def top_groups_filter(spark, sf):
    return ml.keep_top_classes(_mf(spark, sf), TOP)


@register("balanced_cap", _ml_sql("SELECT * FROM capped"))
def balanced_cap(spark, sf):
    return _capped(spark, sf)


@register("ml_frame_derived", _with_long("""
lo AS (SELECT min(CAST(loudness AS DOUBLE)) AS lo, max(CAST(loudness AS DOUBLE)) AS hi FROM silver)
SELECT track_id, track_genre,
  (CAST(loudness AS DOUBLE) - lo.lo) / greatest(lo.hi - lo.lo, 1e-9) AS loudness_normalized,
  CASE WHEN popularity < 10 THEN 'unknown' WHEN tempo < 90 THEN 'slow' WHEN tempo <= 130 THEN 'medium' ELSE 'fast' END AS tempo_category,
  CAST(energy AS DOUBLE) - CAST(acousticness AS DOUBLE) AS energy_acoustic_contrast,
  (CAST(danceability AS DOUBLE) + CAST(valence AS DOUBLE)) / 2 AS dancefloor_score
FROM silver, lo WHERE track_genre <> 'Brand#11'""", "silver"))
def ml_frame_derived(spark, sf):
    """Model frame from Silver: absent features are derived, a NULL tempo is 'unknown', rows without a label go."""
    s = frames.silver(spark, sf)
    s = s.withColumn("tempo", F.when(F.col("popularity") < 10, F.lit(None)).otherwise(F.col("tempo")))
    s = s.withColumn("track_genre", F.nullif("track_genre", F.lit("Brand#11"))).withColumn("energy_danceability_ratio", F.lit(0.0))
    return ml.model_frame(s).select("track_id", "track_genre", "loudness_normalized", "tempo_category",
                                    "energy_acoustic_contrast", "dancefloor_score")


@register("label_mapping", _ml_sql("SELECT CAST(label AS INTEGER) AS label_index, track_genre FROM lab"))
def label_mapping(spark, sf):
    labels = ml.label_indexer().fit(_mf(spark, sf)).labels
    # the fitted indexer's label list is model metadata (one entry per class)
    return spark.createDataFrame(list(enumerate(labels)), "label_index int, track_genre string")


@register("train_test_split", _ml_sql("SELECT track_id, track_genre, split FROM split"))
def train_test_split(spark, sf):
    return ml.hash_split(_mf(spark, sf)).select("track_id", "track_genre", "split")


@register("test_split_size", _ml_sql("""
SELECT split, CAST(label AS INTEGER) AS label, track_genre, count(*) AS "rows" FROM split GROUP BY ALL"""))
def test_split_size(spark, sf):
    split, _ = ml.labelled_split(_mf(spark, sf))
    return split.groupBy("split", F.col("label").cast("int").alias("label"), "track_genre").agg(F.count(F.lit(1)).alias("rows"))


def _with_gaps(spark, sf):
    """Model rows from the raw tracks, whose valence and tempo have NULLs."""
    t = binding.tracks(spark, sf).withColumn("tempo", F.when(F.col("popularity") < 10, F.lit(None)).otherwise(F.col("tempo")))
    return t.select("track_id", *[F.col(c).cast("double").alias(c) for c in GAPPED])


GAPPED = ["valence", "tempo", "energy"]
_GAPS_SQL = """WITH g AS (SELECT track_id, CAST(valence AS DOUBLE) AS valence, CASE WHEN popularity < 10 THEN NULL
  ELSE CAST(tempo AS DOUBLE) END AS tempo, CAST(energy AS DOUBLE) AS energy FROM (""" + binding.TRACKS_SQL + """)),
lowest AS (SELECT """ + ", ".join(
    f"(SELECT {c} FROM (SELECT {c}, row_number() OVER (ORDER BY {c}) AS r, count(*) OVER () AS n FROM g WHERE {c} IS NOT NULL) "
    f"WHERE r = ceil(n / 2e0)) AS {c}" for c in GAPPED) + ")\n"


@register("impute_median", _GAPS_SQL + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, (SELECT {c} FROM lowest) AS median, count(*) FILTER (WHERE {c} IS NULL) AS filled_count, "
    f"round(sum(coalesce({c}, (SELECT {c} FROM lowest))), 3) AS filled_sum FROM g" for c in GAPPED))
def impute_median(spark, sf):
    """Each feature's median (the lower one of an even number, exact), the NULLs it fills and the sum after filling."""
    gaps = _with_gaps(spark, sf)
    model = ml.imputer(GAPPED).setRelativeError(0.0).fit(gaps)
    done = model.transform(gaps)
    wide = done.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_n") for c in GAPPED],
                    *[F.round(F.sum(ml.filled(c)), 3).alias(f"{c}_s") for c in GAPPED])
    sums = wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"{c}_n").alias("filled_count"),
                                                   F.col(f"{c}_s").alias("filled_sum")) for c in GAPPED])))
    return model.surrogateDF.unpivot([], GAPPED, "feature", "median").join(sums, "feature")


@register("impute_median_values", _ml_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS used_rows, true AS close FROM mf" for c in MODEL_NUMERIC)))
def impute_median_values(spark, sf):
    """The Imputer's default (approximate) medians of all model rows, checked by rank: within 0.5 % of the middle."""
    rows = _mf(spark, sf)
    found = ml.imputer().fit(rows).surrogateDF.first()
    wide = rows.agg(*[F.count(c).alias(f"{c}_n") for c in MODEL_NUMERIC],
                    *[F.count_if(F.col(c) < found[c]).alias(f"{c}_lt") for c in MODEL_NUMERIC],
                    *[F.count_if(F.col(c) <= found[c]).alias(f"{c}_le") for c in MODEL_NUMERIC])
    near = lambda c: (F.col(f"{c}_lt") <= F.col(f"{c}_n") * 0.505) & (F.col(f"{c}_le") >= F.col(f"{c}_n") * 0.495)
    return wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"{c}_n").alias("used_rows"), near(c).alias("close")) for c in MODEL_NUMERIC])))


def _prep_full(spark, sf):
    rows = cut_lineage(_mf(spark, sf))
    prep = Pipeline(stages=ml.preprocessing_stages()).fit(rows)
    return prep, prep.transform(rows)


@register("onehot_tempo", _ml_sql("""
, cats AS (SELECT tempo_category, count(*) AS track_count FROM mf GROUP BY 1),
ranked AS (SELECT tempo_category, track_count,
  CAST(row_number() OVER (ORDER BY track_count DESC, tempo_category) - 1 AS DOUBLE) AS category_index FROM cats)
SELECT tempo_category, category_index, CAST((SELECT count(*) FROM cats) + 1 AS INTEGER) AS onehot_size,
  CAST(category_index AS INTEGER) AS hot_slot, track_count FROM ranked""").replace("\n, cats AS", ",\ncats AS"))
def onehot_tempo(spark, sf):
    _, t = _prep_full(spark, sf)
    arr = vector_to_array("tempo_category__hot")
    return (t.select("tempo_category", F.col("tempo_category__at").alias("category_index"),
                     F.size(arr).alias("onehot_size"),
                     (F.array_position(arr, 1.0) - 1).cast("int").alias("hot_slot"))
            .groupBy("tempo_category", "category_index", "onehot_size", "hot_slot")
            .agg(F.count(F.lit(1)).alias("track_count")))


def _slot_sql(scaled: bool) -> str:
    cats = ("cats AS (SELECT tempo_category, row_number() OVER (ORDER BY count(*) DESC, tempo_category) - 1 AS idx "
            "FROM mf GROUP BY 1), ncat AS (SELECT count(*) AS n FROM cats)")
    parts, slot = [], 0
    for c in MODEL_FEATURES:
        if c == "tempo_category":
            for j in range(4):
                parts.append(f"SELECT track_id, {slot} AS slot, CASE WHEN (SELECT idx FROM cats k WHERE "
                             f"k.tempo_category = mf.tempo_category) = {j} THEN 1e0 ELSE 0e0 END AS value FROM mf")
                slot += 1
        else:
            parts.append(f"SELECT track_id, {slot} AS slot, {c} AS value FROM mf")
            slot += 1
    longv = "slots AS (" + " UNION ALL ".join(parts) + ")"
    if not scaled:
        return _ml_sql(f", {cats}, {longv}\nSELECT track_id, CAST(slot AS INTEGER) AS slot, value FROM slots"
                       ).replace("\n, cats AS", ",\ncats AS")
    return _ml_sql(f""", {cats}, {longv},
b AS (SELECT slot, min(value) AS lo, max(value) AS hi FROM slots GROUP BY slot)
SELECT s.track_id, CAST(s.slot AS INTEGER) AS slot,
  round(CASE WHEN b.hi = b.lo THEN 0.5e0 ELSE (s.value - b.lo) / (b.hi - b.lo) END, 6) AS value
FROM slots s JOIN b USING (slot)""").replace("\n, cats AS", ",\ncats AS")


@register("feature_vector", _slot_sql(False))
def feature_vector(spark, sf):
    _, t = _prep_full(spark, sf)
    return t.select("track_id", F.posexplode(vector_to_array("raw_features")).alias("slot", "value")) \
        .select("track_id", F.col("slot").cast("int").alias("slot"), "value")


@register("minmax_vector", _slot_sql(True))
def minmax_vector(spark, sf):
    _, t = _prep_full(spark, sf)
    out = t.select("track_id", F.posexplode(vector_to_array("features")).alias("slot", "value")) \
        .select("track_id", F.col("slot").cast("int").alias("slot"), "value")
    return rounded(out)


# ------------------------------------------------------------------ training

MODEL_NAMES = ["Logistic Regression", "Decision Tree", "Random Forest", "GBT One-vs-Rest", "Naive Bayes"]


class Fitted:
    """Models fitted on one session's rows of one directory: scored test rows are written once, the
    training rows are released after the fits. A change of the input files gives another one."""

    def __init__(self, spark, sf):
        self.spark = spark
        self.prepared = ml.prepare(frames.feature_table(spark, sf))
        self.k = len(self.prepared.labels)
        self.estimators = self.prepared.classifiers()
        self.models: dict = {}
        self.scored: dict = {}

    def model(self, name: str):
        if name not in self.models:
            self.models[name] = self.estimators[name].fit(self.prepared.train)
        return self.models[name]

    def predictions(self, name: str):
        """All test rows scored by a model: track_id, label, prediction, scores."""
        if name not in self.scored:
            model, test = self.model(name), self.prepared.test
            done = ml.one_vs_rest_scores(model, test) if isinstance(model, OneVsRestModel) else model.transform(test)
            scored = ev.probabilities(done, self.k)
            path = scratch_path(self.spark, "predictions")
            scored.select("track_id", F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"), "scores").write.parquet(path)
            self.scored[name] = path
        return self.spark.read.parquet(self.scored[name])

    def label_map(self):
        return self.spark.createDataFrame(list(enumerate(self.prepared.labels)), "label_index int, name string")


_FITTED: dict = {}


def fitted(spark, sf) -> Fitted:
    key = frames.stamp(spark, sf, "lineitem", "part")
    if key not in _FITTED:
        for old in _FITTED.values():
            old.prepared.release()
        _FITTED.clear()
        _FITTED[key] = Fitted(spark, sf)
    return _FITTED[key]


def _model_metrics(spark, sf, names=MODEL_NAMES):
    """One row for each model, over the whole test side."""
    f, out = fitted(spark, sf), None
    for order, name in enumerate(MODEL_NAMES):
        if name in names:
            p = f.predictions(name)
            auc = ev.auc_weighted(ev.auc_per_class(p, f.k), f.k)
            m = ev.scores(ev.pair_counts(p)).crossJoin(auc).select(
                F.lit(order).alias("model_order"), F.lit(name).alias("model"), "accuracy", "f1_weighted",
                "precision_weighted", "recall_weighted", F.col("auc").alias("auc_roc"), "rows")
            out = m if out is None else out.unionByName(m)
    return out


#: What SQL can say of a fit: its rows are the test rows, and its metrics lie in their range.
_FIT_SQL = "SELECT {order} AS model_order, '{name}' AS model, count(*) AS \"rows\", true AS in_range, true AS recall_is_accuracy FROM split WHERE split = 'test'"


def _checked(metrics):
    parts = [F.col(c).between(0.0, 1.0) for c in ("accuracy", "f1_weighted", "precision_weighted", "recall_weighted", "auc_roc")]
    ok = parts[0]
    for x in parts[1:]:
        ok = ok & x
    return metrics.select("model_order", "model", "rows", ok.alias("in_range"),
                          (F.abs(F.col("accuracy") - F.col("recall_weighted")) < 1e-9).alias("recall_is_accuracy"))


def _fit_key(key: str, name: str):
    order = MODEL_NAMES.index(name)

    @register(key)
    def metrics(spark, sf):
        return _model_metrics(spark, sf, [name])

    @register(f"{key}_check", _ml_sql(_FIT_SQL.format(order=order, name=name), cap=key != "model_gbt_ovr"))
    def check(spark, sf):
        return _checked(_model_metrics(spark, sf, [name]))


for _key, _name in zip(("model_logistic", "model_tree", "model_forest", "model_gbt_ovr", "model_bayes"), MODEL_NAMES, strict=True):
    _fit_key(_key, _name)


@register("model_metrics")
def model_metrics(spark, sf):
    """The fitted numbers themselves: they have no twin in SQL."""
    return _model_metrics(spark, sf)


@register("model_leaderboard")
def model_leaderboard(spark, sf):
    """The five models with their metrics, ranked by weighted F1."""
    return ev.leaderboard(cut_lineage(_model_metrics(spark, sf)))


@register("model_leaderboard_check", _ml_sql("SELECT r.range + 1 AS rank, count(*) AS \"rows\", true AS not_above_the_one_before FROM split, range(5) r WHERE split = 'test' GROUP BY 1, r.range", cap=False))
def model_leaderboard_check(spark, sf):
    """Ranks 1 to 5 by weighted F1; each is checked against the one before."""
    board = cut_lineage(model_leaderboard(spark, sf))
    before = board.select((F.col("rank") + 1).alias("rank"), F.col("f1_weighted").alias("_before"))
    return board.join(before, "rank", "left").select(F.col("rank").cast("long").alias("rank"), "rows",
                                                     (F.coalesce("_before", F.lit(1.0)) >= F.col("f1_weighted")).alias("not_above_the_one_before"))


@register("predictions")
def predictions(spark, sf):
    """Test-set predictions of all five models: class numbers and names of both sides."""
    f, out = fitted(spark, sf), None
    for order, name in enumerate(MODEL_NAMES):
        p = f.predictions(name).select(F.lit(order).cast("long").alias("model_order"), F.lit(name).alias("model"), "track_id", "label", "prediction")
        out = p if out is None else out.unionByName(p)
    return ev.with_names(out, f.label_map(), ["label", "prediction"])


@register("predictions_check", _ml_sql("SELECT m.range AS model_order, s.track_id, CAST(s.label AS INTEGER) AS label, s.track_genre AS label_name, true AS named FROM split s, range(5) m WHERE split = 'test'"))
def predictions_check(spark, sf):
    """What SQL can say of them: every test row once a model, with its true class and some known class predicted."""
    known = F.array(*[F.lit(x) for x in fitted(spark, sf).prepared.labels])
    return predictions(spark, sf).select("model_order", "track_id", "label", "label_name", F.array_contains(known, F.col("prediction_name")).alias("named"))


@register("model_roc_points")
def model_roc_points(spark, sf):
    """All ROC points of each model, stacked with the model's name."""
    f, out = fitted(spark, sf), None
    for name in MODEL_NAMES:
        r = ev.roc_points(f.predictions(name), f.k).select(F.lit(name).alias("model"), "ord", "threshold", "fpr", "tpr")
        out = r if out is None else out.unionByName(r)
    return out


def best_model_row(spark, sf):
    return ev.best_model(_model_metrics(spark, sf))


def _best(spark, sf) -> str:
    return best_model_row(spark, sf).first().best_model_name


@register("best_model_predictions")
def best_model_predictions(spark, sf):
    """All test rows of the best model with actual and predicted classes and their names."""
    f = fitted(spark, sf)
    return ev.with_names(f.predictions(_best(spark, sf)).drop("scores"), f.label_map(), ["label", "prediction"])


@register("best_model_predictions_check", _ml_sql("SELECT track_id, track_genre AS label_name, true AS named FROM split WHERE split = 'test'", cap=False))
def best_model_predictions_check(spark, sf):
    return best_model_predictions(spark, sf).select("track_id", "label_name", (F.col("prediction_name") != "unknown").alias("named"))


@register("best_model_confusion")
def best_model_confusion(spark, sf):
    """The best model's confusion matrix: a row for each true class, a column for each predicted one, by name."""
    return confusion(spark, sf, _best(spark, sf))


def confusion(spark, sf, name):
    """A model's confusion matrix by class names."""
    f = fitted(spark, sf)
    wide = ev.confusion_wide(ev.confusion_long(f.predictions(name), f.k), f.k, f.prepared.labels)
    return ev.with_names(wide, f.label_map(), ["label"]).select("label", "label_name", *[f"`{n}`" for n in f.prepared.labels])


@register("best_model_confusion_check", _ml_sql("SELECT track_genre AS label_name, count(*) AS support FROM split WHERE split = 'test' GROUP BY 1"))
def best_model_confusion_check(spark, sf):
    """Its row sums are the test rows of each class."""
    names = fitted(spark, sf).prepared.labels
    total = sum((F.col(f"`{n}`") for n in names[1:]), F.col(f"`{names[0]}`"))
    return best_model_confusion(spark, sf).select("label_name", total.alias("support")).where("support > 0")


def importance(spark, sf, name):
    f = fitted(spark, sf)
    return ml.importances(spark, f.model(name), ml.slot_names(f.prepared.test)).withColumn("model", F.lit(name))


_SLOTS = [c for c in MODEL_FEATURES if c != "tempo_category"]
_IMPORTANCE_SQL = ("SELECT '{model}' AS model, 18 AS slots, true AS sums_to_one, true AS numerics_named")


def _importance_check(spark, sf, name):
    named = F.size(F.array_intersect(F.collect_set("feature"), F.lit(_SLOTS))) == len(_SLOTS)
    return importance(spark, sf, name).groupBy("model").agg(F.count(F.lit(1)).cast("int").alias("slots"),
                                                             (F.abs(F.sum("importance") - 1) < 1e-6).alias("sums_to_one"), named.alias("numerics_named"))


@register("importance_forest")
def importance_forest(spark, sf):
    """Every slot of the forest's features with its importance."""
    return importance(spark, sf, "Random Forest")


@register("importance_gbt")
def importance_gbt(spark, sf):
    """Every slot's importance, the mean over the one-vs-rest models."""
    return importance(spark, sf, "GBT One-vs-Rest")


@register("importance_forest_check", _IMPORTANCE_SQL.format(model="Random Forest"))
def importance_forest_check(spark, sf):
    return _importance_check(spark, sf, "Random Forest")


@register("importance_gbt_check", _IMPORTANCE_SQL.format(model="GBT One-vs-Rest"))
def importance_gbt_check(spark, sf):
    return _importance_check(spark, sf, "GBT One-vs-Rest")


@register("importance_topk")
def importance_topk(spark, sf):
    """The ten most important slots of both tree models."""
    both = importance(spark, sf, "Random Forest").unionByName(importance(spark, sf, "GBT One-vs-Rest"))
    order = Window.partitionBy("model").orderBy(F.desc("importance"), "feature")
    return both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= 10)


@register("run_log", _ml_sql("SELECT r.range AS model_order, count(*) FILTER (WHERE split = 'train') AS train_rows, count(*) FILTER (WHERE split = 'test') AS test_rows, 2 AS logged, true AS artifact_loads FROM split, range(5) r GROUP BY 1"))
def run_log(spark, sf):
    """Every model logged twice to one append-only table: parameters, features, counts, metrics and the
    folder of the saved pipeline, which is loaded again."""
    f, root = fitted(spark, sf), scratch_path(spark, "runs")
    counts = {r.split: r.n for r in ml.hash_split(_mf(spark, sf)).groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    metrics = cut_lineage(_model_metrics(spark, sf))
    saved = []
    for order, name in enumerate(MODEL_NAMES):
        folder = f"{root}/models/{spark.range(1).select(safe_name(F.lit(name))).first()[0]}"
        PipelineModel(stages=[*f.prepared.prep.stages, f.model(name)]).write().overwrite().save(folder)
        params = {p.name: str(v) for p, v in f.estimators[name].extractParamMap().items()}
        params |= {"features": ",".join(MODEL_FEATURES), "classes": str(f.k), "fit_rows": str(f.prepared.train_rows)}
        saved.append((order, folder, params, counts["train"], counts["test"]))
    info = spark.createDataFrame(saved, "model_order int, artifact string, params map<string, string>, train_rows long, test_rows long")
    runs = metrics.join(info, "model_order").withColumn("logged_at", F.current_timestamp())
    for _ in range(2):
        runs.withColumn("run_id", F.concat(F.lit(f"{uuid.uuid4().hex}-"), "model_order")).write.mode("append").parquet(f"{root}/log")
    loads = spark.createDataFrame([(order, len(PipelineModel.load(folder).stages) == len(f.prepared.prep.stages) + 1)
                                   for order, folder, *_ in saved], "model_order int, artifact_loads boolean")
    log = spark.read.parquet(f"{root}/log")
    return (log.groupBy("model_order", "train_rows", "test_rows").agg(F.count_distinct("run_id").cast("int").alias("logged")).join(loads, "model_order")
            .select(F.col("model_order").cast("long").alias("model_order"), "train_rows", "test_rows", "logged", "artifact_loads"))


@register("model_roundtrip", _ml_sql("SELECT count(*) AS \"rows\", 0 AS mismatches FROM split WHERE split = 'test'"))
def model_roundtrip(spark, sf):
    """Save the fitted forest pipeline, load it back, score all test rows again."""
    f = fitted(spark, sf)
    path = scratch_path(spark, f"model-{uuid.uuid4().hex[:6]}")
    PipelineModel(stages=[*f.prepared.prep.stages, f.model("Random Forest")]).write().overwrite().save(path)
    raw = f.prepared.test.select("track_id", "track_genre", "label", *MODEL_FEATURES)
    again = PipelineModel.load(path).transform(raw).select("track_id", F.col("prediction").cast("int").alias("_again"))
    both = f.predictions("Random Forest").join(again, "track_id")
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("prediction") != F.col("_again")).cast("int").alias("mismatches"))


@register("features_layer_model_input", _ml_sql("SELECT * FROM mf"))
def features_layer_model_input(spark, sf):
    """Model input read from a written feature layer (write, then resolve and read)."""
    root = scratch_path(spark, "features")
    write_layer(frames.feature_table(spark, sf), root)
    return ml.model_frame(read_layer(spark, root))
