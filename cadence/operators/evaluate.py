"""Classifier evaluation as distributed aggregates (no scores collected to the driver).

Counting metrics come from one ``groupBy(label, prediction)`` (k x k rows at
most), so everything after it is tiny. Ranking metrics (AUC, ROC) collapse the
scores to one row per distinct (class, score) and then need one range exchange of these: running
totals within the ranges, and a table of one row a range that adds what lies ahead (``ordered.running``); an AUC
needs sums only, so its ranges give a row a class each and no row is written (``ordered.pairs_below``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.operators.ordered import arrange, pairs_below, running, running_again

LABEL, PRED = "label", "prediction"


def class_grid(spark, k: int) -> DataFrame:
    c = spark.range(k).select(F.col("id").cast("int").alias("label"))
    p = spark.range(k).select(F.col("id").cast("int").alias("prediction"))
    return c.crossJoin(p)  # k*k rows: bounded by the number of classes


def pair_counts(df: DataFrame, label: str = LABEL, pred: str = PRED) -> DataFrame:
    """(label, prediction, count) of every row, whatever its class numbers are."""
    return (df.groupBy(F.col(label).cast("int").alias("label"), F.col(pred).cast("int").alias("prediction"))
            .agg(F.count(F.lit(1)).alias("count")))


def on_grid(counts: DataFrame, k: int) -> DataFrame:
    """Pair counts over the full k x k grid; empty cells are 0, pairs outside it have no cell."""
    return (class_grid(counts.sparkSession, k).join(counts, ["label", "prediction"], "left")
            .select("label", "prediction", F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def confusion_long(df: DataFrame, k: int, label: str = LABEL, pred: str = PRED) -> DataFrame:
    """The k x k matrix in long form. Scores are not computed from it but from ``pair_counts``:
    a prediction outside 0..k-1 has no cell here and still is a wrong prediction there."""
    return on_grid(pair_counts(df, label, pred), k)


def confusion_wide(conf_long: DataFrame, k: int, names: Sequence[str] | None = None) -> DataFrame:
    """Rows = true label, one column per predicted class (``pred_<i>``, or the class names)."""
    names = list(names) if names else [f"pred_{i}" for i in range(k)]
    cells = [F.sum(F.when(F.col("prediction") == i, F.col("count")).otherwise(0)).cast("bigint").alias(n)
             for i, n in enumerate(names)]
    return conf_long.groupBy("label").agg(*cells)


def per_class(counts: DataFrame, k: int | None = None) -> DataFrame:
    """Per class: tp, fp, fn, support, precision, recall, F1 (zero division -> 0) from pair
    counts; with ``k``, a row for each of the classes 0..k-1 and none for others."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0)
    zero = F.lit(0).cast("bigint")
    sides = counts.select(F.inline(F.array(
        F.struct(F.col("label").alias("class"), F.col("count").cast("bigint").alias("support"),
                 hit.cast("bigint").alias("tp"), zero.alias("predicted")),
        F.struct(F.col("prediction").alias("class"), zero.alias("support"), zero.alias("tp"),
                 F.col("count").cast("bigint").alias("predicted")))))
    t = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "tp", "predicted")])
    if k is not None:
        classes = counts.sparkSession.range(k).select(F.col("id").cast("int").alias("class"))
        t = classes.join(t, "class", "left").na.fill(0, ["support", "tp", "predicted"])
    share = lambda part, whole: F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))
    t = t.select("class", "tp", (F.col("predicted") - F.col("tp")).alias("fp"),
                 (F.col("support") - F.col("tp")).alias("fn"), "support",
                 share(F.col("tp"), F.col("predicted")).alias("precision"),
                 share(F.col("tp"), F.col("support")).alias("recall"))
    return t.withColumn("f1", share(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def scores(counts: DataFrame) -> DataFrame:
    """accuracy and support-weighted precision / recall / F1 over all rows (one row; NULLs without rows)."""
    mean = lambda c: F.try_divide(F.sum(c), F.sum("support").cast("double"))
    return per_class(counts).agg(
        mean(F.col("tp")).alias("accuracy"),
        *[mean(F.col(m) * F.col("support")).alias(f"{m}_weighted") for m in ("precision", "recall", "f1")],
        F.coalesce(F.sum("support"), F.lit(0)).cast("bigint").alias("rows"))


def probabilities(df: DataFrame, k: int, prob_col: str | None = "probability",
                  raw_col: str | None = "rawPrediction", out: str = "scores") -> DataFrame:
    """Class scores, chosen by column for the whole frame: ``prob_col`` as it is where the
    frame has it, else the softmax of ``raw_col``. Width is fitted to k with zeros."""
    from pyspark.ml.functions import vector_to_array
    name = next((c for c in (prob_col, raw_col) if c and c in df.columns), None)
    if name is None:
        raise ValueError("no score column")
    values = df[name]
    if "vector" in df.schema[name].dataType.simpleString():
        values = vector_to_array(values)
    fitted = df.withColumn("_given", F.slice(F.concat(values, F.array_repeat(F.lit(0.0), k)), 1, k))
    if name == prob_col:
        return fitted.withColumnRenamed("_given", out) if out not in df.columns else fitted.withColumn(out, F.col("_given")).drop("_given")
    # array steps: the generated code stays small for any number of classes
    finite = lambda x: F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(0.0)).otherwise(x)
    step = fitted.withColumn("_given", F.transform("_given", finite))
    step = step.withColumn("_top", F.array_max("_given"))
    step = step.withColumn("_power", F.transform("_given", lambda x: F.exp(x - F.col("_top"))))
    step = step.withColumn("_all", F.aggregate("_power", F.lit(0.0), lambda a, x: a + x))
    return step.withColumn(out, F.transform("_power", lambda x: x / F.col("_all"))).drop("_given", "_top", "_power", "_all")


def class_scores(df: DataFrame, k: int, label: str = LABEL, score_col: str = "scores",
                 digits: int | None = None) -> DataFrame:
    """(class, score, pos, neg): one row per distinct score of each class's column. Scores
    are ranked as they are; ``digits`` rounds them first, for a comparison across engines
    whose ``exp`` differs in the last bit."""
    return _counted(_score_rows(df, k, label, score_col, digits), "class", "score")


def _score_rows(df: DataFrame, k: int, label: str, score_col: str, digits: int | None) -> DataFrame:
    """(_y, class, score): one row for each score of a row."""
    long = df.select(F.col(label).cast("int").alias("_y"),
                     F.posexplode(F.slice(score_col, 1, k)).alias("class", "score"))
    return long.withColumn("score", F.round("score", digits)) if digits is not None else long


def _counted(long: DataFrame, *by: str) -> DataFrame:
    return long.groupBy(*by).agg(
        F.count_if(F.col("_y") == F.col("class")).alias("pos"),
        F.count_if(F.col("_y").isNull() | (F.col("_y") != F.col("class"))).alias("neg"))


def auc_per_class(df: DataFrame, k: int, label: str = LABEL, score_col: str = "scores",
                  digits: int | None = None) -> DataFrame:
    """One-vs-rest AUC per class (tie-averaged), for classes with positives and
    negatives; AUC = sum pos(s) * (neg below s + neg(s)/2) / (P * N)."""
    cs = class_scores(df, k, label, score_col, digits)
    agg = pairs_below(arrange(cs, ["class"], ["score"]), ["class"], "pos", "neg")
    return agg.where((F.col("_upper") > 0) & (F.col("_lower") > 0)).select(
        F.col("class").cast("int").alias("class"), F.col("_upper").cast("bigint").alias("positives"),
        F.col("_lower").cast("bigint").alias("negatives"),
        (F.col("_pairs") / (F.col("_upper").cast("double") * F.col("_lower"))).alias("auc"))


def auc_weighted(per_class_auc: DataFrame, k: int | None = None) -> DataFrame:
    """Positives-weighted mean of the per-class AUCs; with two classes the AUC of
    class 1 alone (the binary definition). NaN where no class has both sides."""
    src = per_class_auc.where(F.col("class") == 1) if k == 2 else per_class_auc
    mean = F.try_divide(F.sum(F.col("auc") * F.col("positives")), F.sum("positives").cast("double"))
    return src.agg(F.coalesce(mean, F.lit(float("nan"))).alias("auc"))


def roc_points(df: DataFrame, k: int, label: str = LABEL, score_col: str = "scores",
               max_points: int | None = None, digits: int | None = None) -> DataFrame:
    """Micro-averaged ROC: the (row, class) scores of all classes that occur in the truth, pooled;
    with two classes the curve of class 1's score. Thresholds are the distinct scores, high
    to low; points mid-way on a straight run are dropped (they add nothing to the curve) and
    (0, 0) comes first. Fewer than two classes in the truth: the diagonal. All points are
    returned unless ``max_points`` asks for evenly spaced ones."""
    spark = df.sparkSession
    rows = _score_rows(df, k, label, score_col, digits)
    truth = df.select(F.col(label).cast("int").alias("class")).where(F.col("class").between(0, k - 1)).distinct()
    used = rows.where(F.col("class") == 1) if k == 2 else rows.join(F.broadcast(truth), "class", "left_semi")  # at most k rows
    # counted by score at once: the curve pools the classes, so one exchange does
    pooled = _counted(used, "score").withColumn("one", F.lit(1).cast("long"))
    # from the lowest score up, so that the row ahead is the next point of the curve
    up = running(pooled, [], ["score"], sums={"_at": "one", "_tp": "pos", "_fp": "neg"}, lags={"_next_pos": "pos", "_next_neg": "neg"})
    ends = up.agg(F.max("_at").alias("_last"), F.max("_tp").alias("_pos"), F.max("_fp").alias("_neg"))
    bend = (F.col("_next_pos") != F.col("pos")) | (F.col("_next_neg") != F.col("neg"))  # the next step differs from the one that led here
    j = up.crossJoin(F.broadcast(ends))
    kept = j.where((F.col("_next_pos").isNull() | (F.col("_at") == F.col("_last")) | bend) & (F.col("_pos") > 0) & (F.col("_neg") > 0))
    placed = running_again(kept.select("score", "pos", "neg", "one", "_tp", "_fp", "_pos", "_neg", "_range"), [], sums={"_place": "one"})
    curve = placed.crossJoin(F.broadcast(placed.agg(F.max("_place").alias("_m")))).select(
        (F.col("_m") - F.col("_place") + 1).alias("ord"), F.col("score").cast("double").alias("threshold"),
        ((F.col("_neg") - F.col("_fp") + F.col("neg")) / F.col("_neg")).alias("fpr"), ((F.col("_pos") - F.col("_tp") + F.col("pos")) / F.col("_pos")).alias("tpr"))
    fixed = spark.range(2).select(F.col("id").alias("ord"), F.lit(None).cast("double").alias("threshold"),
                                  F.col("id").cast("double").alias("fpr"), F.col("id").cast("double").alias("tpr"))
    sides = ends.select((F.coalesce("_pos", F.lit(0)) > 0).alias("a"), (F.coalesce("_neg", F.lit(0)) > 0).alias("b"))
    start = fixed.crossJoin(F.broadcast(sides)).where((F.col("ord") == 0) | ~(F.col("a") & F.col("b"))).drop("a", "b")
    curve = start.unionByName(curve)
    if max_points is None:
        return curve
    m = curve.agg(F.count(F.lit(1)).alias("_m"))
    spread = spark.range(max_points).crossJoin(F.broadcast(m)).select(
        F.when(F.col("_m") > max_points, F.floor(F.col("id") * (F.col("_m") - 1) / (max_points - 1.0)))
        .otherwise(F.col("id")).cast("bigint").alias("ord")).distinct()
    return curve.join(spread, "ord", "left_semi")


def top_confusions(conf_long: DataFrame, k: int = 5) -> DataFrame:
    """Largest off-diagonal cells (true label, predicted label, count)."""
    return (conf_long.where((F.col("label") != F.col("prediction")) & (F.col("count") > 0))
            .orderBy(F.desc("count"), "label", "prediction").limit(k))


def with_names(df: DataFrame, label_map: DataFrame, idx_cols: Sequence[str], default: str = "unknown",
               index_col: str = "label_index", name_col: str = "name") -> DataFrame:
    """Index -> name for each index column; an index missing from the map gets
    ``default``. The map has one entry per class."""
    # the map as one row of a map column: read once, whatever the number of looked-up columns
    entry = F.struct(F.col(index_col).cast("int"), F.col(name_col))
    one = label_map.agg(F.map_from_entries(F.collect_list(entry)).alias("_names"))
    out = df.crossJoin(F.broadcast(one))
    for c in idx_cols:
        out = out.withColumn(f"{c}_name", F.coalesce(F.try_element_at("_names", F.col(c).cast("int")), F.lit(default)))
    return out.drop("_names")


def actual_vs_predicted(named: DataFrame, top: int = 10, actual: str = "label_name",
                        predicted: str = "prediction_name") -> DataFrame:
    """For the ``top`` most frequent actual classes: actual and predicted counts,
    long form (class_name, kind, count); a class never predicted counts 0."""
    act = named.groupBy(F.col(actual).alias("class_name")).agg(F.count(F.lit(1)).alias("actual"))
    top_cls = act.orderBy(F.desc("actual"), "class_name").limit(top)
    prd = named.groupBy(F.col(predicted).alias("class_name")).agg(F.count(F.lit(1)).alias("predicted"))
    wide = top_cls.join(prd, "class_name", "left").select(
        "class_name", "actual", F.coalesce("predicted", F.lit(0)).alias("predicted"))
    return wide.unpivot(["class_name"], ["actual", "predicted"], "kind", "count")


def leaderboard(metric_rows: DataFrame, by: str = "f1_weighted") -> DataFrame:
    """Models sorted by a metric, best first; earlier listed model wins ties."""
    w = Window.orderBy(F.desc(by), F.asc("model_order"))
    return metric_rows.withColumn("rank", F.row_number().over(w))


def best_model(metric_rows: DataFrame, by: str = "f1_weighted") -> DataFrame:
    return (metric_rows.orderBy(F.desc(by), F.asc("model_order")).limit(1)
            .select(F.col("model").alias("best_model_name"), F.lit(by).alias("selection_metric"),
                    F.col(by).alias(f"best_{by}")))
