"""Queries: evaluation of classifier output (bound to lineitem, see ``binding.predictions``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.functions.expressions import safe_name
from cadence.operators import evaluate as ev
from cadence.operators import guards
from cadence.plans import binding
from cadence.plans.q_explore import _with_long, rounded
from cadence.plans.registry import register

K = len(binding.PRED_CLASSES)


def _pred(spark, sf):
    return binding.predictions(spark, sf)


def _probs(spark, sf):
    return ev.probabilities(_pred(spark, sf), K, prob_col=None, raw_col="raw_scores")


_PROB_CTES = """
pe AS (SELECT *, greatest(s0, s1, s2, s3) AS mx FROM pred),
prob AS (SELECT *, 1 / (exp(s0 - s0) + exp(s1 - s0) + exp(s2 - s0) + exp(s3 - s0)) AS p0,
  1 / (exp(s0 - s1) + exp(s1 - s1) + exp(s2 - s1) + exp(s3 - s1)) AS p1,
  1 / (exp(s0 - s2) + exp(s1 - s2) + exp(s2 - s2) + exp(s3 - s2)) AS p2,
  1 / (exp(s0 - s3) + exp(s1 - s3) + exp(s2 - s3) + exp(s3 - s3)) AS p3 FROM pe)"""

_CONF_CTES = """
conf AS (SELECT CAST(a.range AS INTEGER) AS label, CAST(b.range AS INTEGER) AS prediction,
  (SELECT count(*) FROM pred WHERE label = a.range AND prediction = b.range) AS count FROM range(4) a, range(4) b)"""

# from the rows, not from the grid: a prediction outside it is a wrong one
_PER_CLASS_CTE = """
pc1 AS (SELECT c.range AS class,
  (SELECT count(*) FROM pred WHERE label = c.range AND prediction = c.range) AS tp,
  (SELECT count(*) FROM pred WHERE label <> c.range AND prediction = c.range) AS fp,
  (SELECT count(*) FROM pred WHERE label = c.range AND prediction <> c.range) AS fn,
  (SELECT count(*) FROM pred WHERE label = c.range) AS support FROM range(4) c),
pc AS (SELECT *, coalesce(tp / nullif(tp + fp, 0e0), 0e0) AS precision, coalesce(tp / nullif(tp + fn, 0e0), 0e0) AS recall,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0e0), 0e0) AS f1 FROM pc1)"""


def _ctes(*extra: str) -> str:
    return _with_long(",\n".join(extra), "pred")


@register("confusion_long", _ctes(_CONF_CTES + "\nSELECT * FROM conf"))
def confusion_long(spark, sf):
    return ev.confusion_long(_pred(spark, sf), K)


@register("confusion_wide", _ctes(_CONF_CTES + """
SELECT label, """ + ", ".join(f"CAST(sum(count) FILTER (WHERE prediction = {i}) AS BIGINT) AS pred_{i}" for i in range(K))
    + " FROM conf GROUP BY label"))
def confusion_wide(spark, sf):
    return ev.confusion_wide(ev.confusion_long(_pred(spark, sf), K), K)


@register("confusion_named", _ctes(_CONF_CTES + """
SELECT label, """ + ", ".join(f'CAST(sum(count) FILTER (WHERE prediction = {i}) AS BIGINT) AS "{n}"'
                              for i, n in enumerate(binding.PRED_CLASSES)) + " FROM conf GROUP BY label"))
def confusion_named(spark, sf):
    return ev.confusion_wide(ev.confusion_long(_pred(spark, sf), K), K, binding.PRED_CLASSES)


@register("eval_per_class", _ctes(_CONF_CTES + "," + _PER_CLASS_CTE + """
SELECT CAST(class AS INTEGER) AS class, tp, fp, fn, support, round(precision, 6) AS precision,
  round(recall, 6) AS recall, round(f1, 6) AS f1 FROM pc"""))
def eval_per_class(spark, sf):
    return rounded(ev.per_class(ev.pair_counts(_pred(spark, sf)), K))


@register("eval_scores", _ctes(_CONF_CTES + "," + _PER_CLASS_CTE + """
SELECT round((SELECT avg(CASE WHEN label = prediction THEN 1e0 ELSE 0e0 END) FROM pred), 6) AS accuracy,
  round(sum(precision * support) / (SELECT count(*) FROM pred), 6) AS precision_weighted,
  round(sum(recall * support) / (SELECT count(*) FROM pred), 6) AS recall_weighted,
  round(sum(f1 * support) / (SELECT count(*) FROM pred), 6) AS f1_weighted,
  (SELECT count(*) FROM pred) AS "rows" FROM pc"""))
def eval_scores(spark, sf):
    return rounded(ev.scores(ev.pair_counts(_pred(spark, sf))))


@register("softmax_scores", _ctes(_PROB_CTES + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, label,
  round(p0, 6) AS p0, round(p1, 6) AS p1, round(p2, 6) AS p2, round(p3, 6) AS p3 FROM prob"""))
def softmax_scores(spark, sf):
    p = _probs(spark, sf)
    return rounded(p.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "label",
                            *[F.col("scores")[i].alias(f"p{i}") for i in range(K)]))


# Both engines round scores to 12 digits here, because their exp differs in the last bit; the
# operators rank scores as they are.
DIGITS = 12
_LONG_SCORES = "\nsl AS (" + " UNION ALL ".join(
    f"SELECT label, {i} AS class, round(p{i}, {DIGITS}) AS score FROM prob" for i in range(K)) + """),
cs AS (SELECT class, score, count(*) FILTER (WHERE label = class) AS pos,
       count(*) FILTER (WHERE label <> class) AS neg FROM sl GROUP BY 1, 2)"""

_AUC_CTE = """
rk AS (SELECT class, score, pos, neg,
  sum(pos + neg) OVER (PARTITION BY class ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    - (pos + neg) AS below FROM cs),
auc AS (SELECT class, sum(pos) AS positives, sum(neg) AS negatives,
  (sum(pos * (below + (pos + neg + 1) / 2e0)) - sum(pos) * (sum(pos) + 1) / 2e0)
    / (sum(pos) * CAST(sum(neg) AS DOUBLE)) AS auc
  FROM rk GROUP BY class HAVING sum(pos) > 0 AND sum(neg) > 0)"""


@register("eval_auc", _ctes(_PROB_CTES + "," + _LONG_SCORES + "," + _AUC_CTE + """
SELECT CAST(class AS INTEGER) AS class, CAST(positives AS BIGINT) AS positives,
  CAST(negatives AS BIGINT) AS negatives, round(auc, 6) AS auc FROM auc"""))
def eval_auc(spark, sf):
    return rounded(ev.auc_per_class(_probs(spark, sf), K, digits=DIGITS))


@register("eval_auc_weighted", _ctes(_PROB_CTES + "," + _LONG_SCORES + "," + _AUC_CTE + """
SELECT round(sum(auc * positives) / sum(positives), 6) AS auc FROM auc"""))
def eval_auc_weighted(spark, sf):
    return rounded(ev.auc_weighted(ev.auc_per_class(_probs(spark, sf), K, digits=DIGITS), K))


@register("roc_points", _ctes(_PROB_CTES + "," + _LONG_SCORES + """,
pooled AS (SELECT score, sum(pos) AS pos, sum(neg) AS neg FROM cs
  WHERE class IN (SELECT DISTINCT label FROM pred) GROUP BY score),
pts AS (SELECT row_number() OVER (ORDER BY score DESC) AS ord, score,
  sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tps,
  sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fps FROM pooled),
nb AS (SELECT *, lag(tps) OVER (ORDER BY ord) AS tp_prev, lead(tps) OVER (ORDER BY ord) AS tp_next,
  lag(fps) OVER (ORDER BY ord) AS fp_prev, lead(fps) OVER (ORDER BY ord) AS fp_next,
  count(*) OVER () AS npts, max(tps) OVER () AS ptot, max(fps) OVER () AS ntot FROM pts),
kept AS (SELECT * FROM nb WHERE npts <= 2 OR fp_prev IS NULL OR fp_next IS NULL
  OR fp_next - 2 * fps + fp_prev <> 0 OR tp_next - 2 * tps + tp_prev <> 0)
SELECT row_number() OVER (ORDER BY ord) AS ord, round(score, 6) AS threshold,
    round(CAST(fps AS DOUBLE) / ntot, 6) AS fpr, round(CAST(tps AS DOUBLE) / ptot, 6) AS tpr FROM kept
  UNION ALL SELECT 0, NULL, 0e0, 0e0"""))
def roc_points(spark, sf):
    return rounded(ev.roc_points(_probs(spark, sf), K, digits=DIGITS))


@register("confused_pairs", _ctes(_CONF_CTES + """
SELECT * FROM conf WHERE label <> prediction AND count > 0 ORDER BY count DESC, label, prediction LIMIT 5"""))
def confused_pairs(spark, sf):
    return ev.top_confusions(ev.confusion_long(_pred(spark, sf), K), 5)


def _label_map(spark, sf):
    """Class index -> name, derived from the data (one row per class)."""
    li = binding.read_table(spark, sf, "lineitem", ["l_returnflag"])
    idx = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    return li.groupBy(idx.cast("int").alias("label_index")).agg(F.min("l_returnflag").alias("name"))


_NAMES_CTE = """
lm AS (SELECT CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS INTEGER) AS label_index,
  min(l_returnflag) AS name FROM lineitem GROUP BY 1),
named AS (SELECT p.l_orderkey, p.l_linenumber, p.label, p.prediction,
  coalesce(a.name, 'unknown') AS label_name, coalesce(b.name, 'unknown') AS prediction_name
  FROM pred p LEFT JOIN lm a ON a.label_index = p.label LEFT JOIN lm b ON b.label_index = p.prediction)"""


@register("label_map_classes", _ctes(_NAMES_CTE + "\nSELECT * FROM lm"))
def label_map_classes(spark, sf):
    return _label_map(spark, sf)


@register("prediction_names", _ctes(_NAMES_CTE + "\nSELECT * FROM named"))
def prediction_names(spark, sf):
    p = _pred(spark, sf).select("l_orderkey", "l_linenumber", "label", "prediction")
    return ev.with_names(p, _label_map(spark, sf), ["label", "prediction"])


@register("actual_vs_predicted", _ctes(_NAMES_CTE + """,
act AS (SELECT label_name AS class_name, count(*) AS actual FROM named GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10),
prd AS (SELECT prediction_name AS class_name, count(*) AS predicted FROM named GROUP BY 1),
wide AS (SELECT a.class_name, a.actual, coalesce(p.predicted, 0) AS predicted FROM act a
         LEFT JOIN prd p USING (class_name))
SELECT class_name, 'actual' AS kind, actual AS count FROM wide
UNION ALL SELECT class_name, 'predicted', predicted FROM wide"""))
def actual_vs_predicted(spark, sf):
    def report(p):
        return ev.actual_vs_predicted(ev.with_names(p.select("label", "prediction"), _label_map(spark, sf), ["label", "prediction"]), 10)

    return guards.guarded(_pred(spark, sf), ["label", "prediction"], "actual_vs_predicted", report)


# Three rule "models" scored on the same rows, compared like trained models.
RULE_MODELS = [
    ("Quantity Band (rule)", "l_quantity", 18.0, 35.0),
    ("Discount-Band (rule)", "l_discount", 0.03, 0.07),
    ("Tax Band (rule)", "l_tax", 0.02, 0.05),
]


def _rule_metrics(spark, sf):
    li = binding.read_table(spark, sf, "lineitem", ["l_quantity", "l_discount", "l_tax", "l_returnflag"])
    label = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    preds = [F.struct(F.lit(i).alias("model_order"), F.lit(name).alias("model"),
                      F.when(F.col(c) < lo, 0).when(F.col(c) < hi, 1).otherwise(2).alias("prediction"))
             for i, (name, c, lo, hi) in enumerate(RULE_MODELS)]
    stacked = li.select(label.alias("label"), F.inline(F.array(*preds)))
    # one aggregate for all models: (model, label, prediction) counts
    counts = stacked.groupBy("model_order", "model", "label", "prediction").agg(F.count(F.lit(1)).alias("count"))
    rows = None
    for i, (name, _, _, _) in enumerate(RULE_MODELS):
        m = ev.scores(counts.where(F.col("model_order") == i)).select(F.lit(i).alias("model_order"), F.lit(name).alias("model"), "accuracy",
                                   "f1_weighted", "precision_weighted", "recall_weighted")
        rows = m if rows is None else rows.unionByName(m)
    return rounded(rows)


def _rules_sql():
    parts = []
    for i, (name, c, lo, hi) in enumerate(RULE_MODELS):
        parts.append(f"""SELECT {i} AS model_order, '{name}' AS model,
  CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS INTEGER) AS label,
  CAST(CASE WHEN {c} < {lo!r}e0 THEN 0 WHEN {c} < {hi!r}e0 THEN 1 ELSE 2 END AS INTEGER) AS prediction
  FROM lineitem""")
    return f"""
rp AS ({' UNION ALL '.join(parts)}),
models AS (SELECT DISTINCT model_order, model FROM rp),
grid AS (SELECT m.model_order, m.model, CAST(a.range AS INTEGER) AS label, CAST(b.range AS INTEGER) AS prediction
         FROM models m, range(3) a, range(3) b),
cnt AS (SELECT model_order, label, prediction, count(*) AS n FROM rp GROUP BY 1, 2, 3),
conf AS (SELECT g.model_order, g.model, g.label, g.prediction, coalesce(c.n, 0) AS count FROM grid g
  LEFT JOIN cnt c USING (model_order, label, prediction)),
t AS (SELECT model_order, model, label AS class, sum(count) AS support,
  sum(CASE WHEN label = prediction THEN count ELSE 0 END) AS tp FROM conf GROUP BY 1, 2, 3),
p AS (SELECT model_order, prediction AS class, sum(count) AS predicted FROM conf GROUP BY 1, 2),
pc1 AS (SELECT t.model_order, t.model, t.support, t.tp,
  CASE WHEN p.predicted > 0 THEN CAST(t.tp AS DOUBLE) / p.predicted ELSE 0e0 END AS precision,
  CASE WHEN t.support > 0 THEN CAST(t.tp AS DOUBLE) / t.support ELSE 0e0 END AS recall
  FROM t JOIN p USING (model_order, class)),
pc AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
  ELSE 0e0 END AS f1 FROM pc1),
metrics AS (SELECT model_order, model, round(sum(tp) / CAST(sum(support) AS DOUBLE), 6) AS accuracy,
  round(sum(f1 * support) / CAST(sum(support) AS DOUBLE), 6) AS f1_weighted,
  round(sum(precision * support) / CAST(sum(support) AS DOUBLE), 6) AS precision_weighted,
  round(sum(recall * support) / CAST(sum(support) AS DOUBLE), 6) AS recall_weighted
  FROM pc GROUP BY 1, 2)"""


def _rules_q(body: str) -> str:
    return "WITH " + _rules_sql().strip() + "\n" + body


@register("leaderboard", _rules_q("""
SELECT CAST(model_order AS INTEGER) AS model_order, model, accuracy, f1_weighted, precision_weighted,
  recall_weighted, CAST(row_number() OVER (ORDER BY f1_weighted DESC, model_order) AS INTEGER) AS rank
FROM metrics"""))
def leaderboard(spark, sf):
    return ev.leaderboard(_rule_metrics(spark, sf))


@register("best_model", _rules_q("""
SELECT model AS best_model_name, 'f1_weighted' AS selection_metric, f1_weighted AS best_f1_weighted
FROM metrics ORDER BY f1_weighted DESC, model_order LIMIT 1"""))
def best_model(spark, sf):
    return ev.best_model(_rule_metrics(spark, sf))


@register("metrics_long", _rules_q("""
SELECT model, metric, value FROM (
  SELECT model, 'accuracy' AS metric, accuracy AS value FROM metrics
  UNION ALL SELECT model, 'f1_weighted', f1_weighted FROM metrics
  UNION ALL SELECT model, 'precision_weighted', precision_weighted FROM metrics
  UNION ALL SELECT model, 'recall_weighted', recall_weighted FROM metrics)"""))
def metrics_long(spark, sf):
    m = _rule_metrics(spark, sf)
    return m.unpivot(["model"], ["accuracy", "f1_weighted", "precision_weighted", "recall_weighted"],
                     "metric", "value")


@register("safe_name", _rules_q("""
SELECT model, replace(replace(replace(replace(lower(model), ' ', '_'), '-', '_'), '(', ''), ')', '') AS safe_name
FROM metrics"""))
def safe_name_q(spark, sf):
    return _rule_metrics(spark, sf).select("model", safe_name("model").alias("safe_name"))


@register("safe_part_name", """SELECT p_partkey, replace(replace(replace(replace(lower(p_type || ' (' || p_name || ')'),
  ' ', '_'), '-', '_'), '(', ''), ')', '') AS safe_name FROM part""")
def safe_part_name(spark, sf):
    name = F.concat("p_type", F.lit(" ("), "p_name", F.lit(")"))
    return binding.read_table(spark, sf, "part", ["p_partkey", "p_type", "p_name"]).select(
        "p_partkey", safe_name(name).alias("safe_name"))
