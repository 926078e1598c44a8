"""Toxicity: significant passages by maximum-scoring segments over token log-odds.

Fit (rows with a label whose crc32(doc_id) mod 5 is not 0, at most ``fit_docs`` ids a label, those with
the smallest hashes): log-odds of each token between toxic and clean texts with an informative
Dirichlet prior (the pooled counts), kept for at most ``TABLE`` tokens, words or stems of words, whose
document counts differ most clearly; every other token costs ``DRIFT``. On rows of fold 4, whose tokens were not counted, the extreme-value
parameter lambda of the scores is solved from clean tokens, and one logistic step maps the
calibrated total to a probability. Where the bound cuts a label, its rows and tokens weigh the inverse of its
sampling rate in the pooled counts and in the logistic step, so 0.5 means the same at every size of the table.

Scoring: a linear scan keeps the list of disjoint segments whose score cannot grow by
extension; each has the expected number of as good segments in clean text
n * exp(-lambda * score). A text's evidence is the sum over its segments of
max(0, lambda * score - log n). Only text and labels enter; lang, source and doc_id never do.
Null and empty texts have no evidence; with no labels, or one kind only, every score is 0.
Repeated rows keep a row each; in the fit a repeated label or document counts once.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import append, cut, fold, narrow, parts
from cadence.llm.language import sample

TABLE, DRIFT, PRIOR, Z, KNOWN, STEMS = 200_000, -0.4, 1000.0, 4.0, 20, (6, 5, 4, 3)
CACHE = 300_000
_BREAK = bytes(32 if b < 128 and not chr(b).isalnum() else b for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Lower-cased words, in order: ASCII other than letters and digits breaks words."""
    return (text or "").lower().encode().translate(_BREAK).split()


def segments(score: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in one pass over runs of positive tokens."""
    up = np.flatnonzero(score > 0)
    if not len(up):
        return []
    total = np.concatenate([[0.0], np.cumsum(score)])
    first = up[np.concatenate([[True], np.diff(up) > 1])]
    last = up[np.concatenate([np.diff(up) > 1, [True]])] + 1
    kept: list[list] = []  # start, end, total before, total after, index of the nearest lower one
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        low, high = float(total[a]), float(total[b])
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= low:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= high:
                kept.append([a, b, low, high, j])
                break
            a, low = kept[j][0], kept[j][2]
            del kept[j:]
    return [(a, b, high - low) for a, b, low, high, _ in kept]


class Weights(dict):
    """Scores of words, worked out once each: the word's own, or that of its longest stem in the table."""

    def __init__(self, table: dict[bytes, float]):
        super().__init__()
        self.table = table

    def __missing__(self, word: bytes) -> float:
        if len(self) > CACHE:
            self.clear()
        got = self[word] = next((x for f in forms(word) if (x := self.table.get(f)) is not None), DRIFT)
        return got


def forms(word: bytes) -> list[bytes]:
    """A word and its stems of a few lengths in characters, marked by a star, longest first."""
    text = word.decode(errors="ignore")
    return [word, *[text[:n].encode() + b"*" for n in STEMS if len(text) > n]]


def scored(text: str | None, weights: Weights) -> np.ndarray:
    w = words(text)
    return np.fromiter(map(weights.__getitem__, w), np.float64, len(w))


def passages(text: str | None, weights: Weights, lam: float) -> tuple[float, list[tuple[int, int, float]]]:
    """Evidence of a text, and its passages (first word, end, evidence) that are expected less than once in clean text."""
    s = scored(text, weights)
    price = math.log(max(1, len(s)))
    found = [(a, b, lam * x - price) for a, b, x in segments(s) if lam * x > price]
    return sum(e for _, _, e in found), found


def labelled(docs: DataFrame, labels: DataFrame, fit_docs: int) -> tuple[DataFrame, dict[int, float]]:
    """text, toxic, part of the rows to learn from, and how many rows one of each kind stands for; the labels sent to
    every task are at most ``fit_docs`` a kind. A label or document that is repeated counts once."""
    rows = narrow(labels, doc_id="doc_id", toxic="toxic").where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (fold() != 0))
    some, counts = sample(rows, "toxic", fit_docs)
    met = docs.where("text IS NOT NULL").join(F.broadcast(some), "doc_id").groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    out = met.select("text", "toxic", fold().alias("part"))
    return out, {int(x): max(1.0, n / fit_docs) for x, n in counts.items()}


def log_odds(rows: DataFrame, weight: dict[int, float]) -> dict[bytes, float]:
    """Scores of words and stems, from rows of folds 1 to 3: log-odds with a Dirichlet prior for those whose document
    counts differ clearly between the labels (signed root of the likelihood ratio), and the
    drift for other words that are common enough to be known, which keeps a stem from speaking for them."""

    def count(batches):
        for batch in parts(batches, 4096):
            n: dict[bytes, list[int]] = {}
            for t, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own: dict[bytes, int] = {}
                for w in words(t):
                    own[w] = own.get(w, 0) + 1
                more: dict[bytes, int] = {}
                for w, c in own.items():
                    for f in forms(w):
                        more[f] = more.get(f, 0) + c
                for f, c in more.items():
                    x = n.setdefault(f, [0, 0, 0, 0])
                    x[toxic] += c
                    x[2 + toxic] += 1
            yield pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.binary()), *(pa.array([v[k] for v in n.values()], pa.int64()) for k in range(4))], names=["w", "c0", "c1", "d0", "d1"])

    some = rows.where("part <> 4").select("text", "toxic")
    n = {r.toxic: r for r in some.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if set(n) != {0, 1}:
        return {}
    counts = cut(some.mapInArrow(count, "w binary, c0 long, c1 long, d0 long, d1 long").groupBy("w").agg(*[F.sum(c).alias(c) for c in ("c0", "c1", "d0", "d1")])
                 .where("d0 + d1 >= 3"))
    size = counts.where("NOT endswith(w, X'2a')").agg(F.sum("c0"), F.sum("c1")).first()
    n0, n1 = (float(x or 0) + 1 for x in size)
    share = n[1].n / (n[0].n + n[1].n)
    # the pooled counts are those of the whole table; the test below compares rows that were drawn with the share among rows drawn
    w0, w1 = weight[0], weight[1]
    prior = 0.5 + (F.col("c0") * w0 + F.col("c1") * w1) * (PRIOR / (n0 * w0 + n1 * w1))
    delta = F.log((F.col("c1") + prior) / n1) - F.log((F.col("c0") + prior) / n0)
    both = F.col("d0") + F.col("d1")
    part = lambda d, e: F.when(d > 0, d * F.log(d / e)).otherwise(0.0)
    ratio = 2 * (part(F.col("d1"), both * share) + part(F.col("d0"), both * (1 - share)))
    z = F.signum(F.col("d1") - both * share) * F.sqrt(F.greatest(ratio, F.lit(0.0)))
    told = counts.select("w", delta.alias("d"), z.alias("z"), both.alias("n"))
    clear = (F.col("d") > -DRIFT) & (F.col("z") > Z)
    table = {bytes(r.w): float(r.d) + DRIFT for r in told.where(clear).orderBy(F.desc("z"), "w").limit(TABLE).collect()}
    known = told.where(~clear & (F.col("n") >= KNOWN) & ~F.expr("endswith(w, X'2a')")).orderBy(F.desc("n"), "w").limit(TABLE).collect()
    return {bytes(r.w): DRIFT + min(0.0, float(r.d)) for r in known} | table


def extreme(values: np.ndarray, n: np.ndarray) -> float:
    """lambda with sum of n * exp(lambda * value) equal to sum of n."""
    if not len(values) or values.max() <= 0:
        return 1.0
    p = n / n.sum()
    if (p * values).sum() >= 0:
        return 0.1
    low, high = 0.0, 1.0
    while (p * np.exp(np.minimum(high * values, 500))).sum() < 1:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if (p * np.exp(np.minimum(mid * values, 500))).sum() < 1 else (low, mid)
    return max(low, 1e-3)


def fit(docs: DataFrame, labels: DataFrame, fit_docs: int = 6000) -> dict:
    """Token table, lambda and the two numbers of the logistic step."""
    rows, weight = labelled(docs, labels, fit_docs)
    table = log_odds(rows, weight)
    if not table:
        return {"table": {}, "lambda": 1.0, "a": 0.0, "b": -50.0}
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(table)

    def tally(batches):
        for batch in parts(batches, 4096):
            n: dict[float, int] = {}
            weights = Weights(shared.value)
            for t in batch.column(0).to_pylist():
                for v, c in zip(*np.unique(np.round(scored(t, weights), 2), return_counts=True), strict=True):
                    n[float(v)] = n.get(float(v), 0) + int(c)
            yield pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.float64()), pa.array(n.values(), pa.int64())], names=["v", "n"])

    held = rows.where("part = 4")
    got = held.where("toxic = 0").select("text").mapInArrow(tally, "v double, n long").groupBy("v").agg(F.sum("n").alias("n")).toPandas()
    lam = extreme(got.v.to_numpy(float), got.n.to_numpy(float))

    def start():
        weights = Weights(shared.value)
        return lambda texts: [[passages(t, weights, lam)[0] for t in texts]]

    seen = append(held, "text", "x double", start)
    pairs = seen.select("x", F.col("toxic").cast("double")).toPandas().to_numpy(float)  # at most 2 * fit_docs rows
    a, b = logistic(np.log1p(pairs[:, 0]), pairs[:, 1], np.where(pairs[:, 1] == 1, weight[1], weight[0])) if len(pairs) else (1.0, -1.0)
    return {"table": table, "lambda": lam, "a": a, "b": b}


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope and intercept by Newton steps with a small ridge; a row counts ``n`` times."""
    X, w = np.stack([x, np.ones_like(x)], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(X @ w, -30, 30)))
        step = np.linalg.solve((X * (n * p * (1 - p))[:, None]).T @ X + 1e-2 * np.eye(2), X.T @ (n * (y - p)) - 1e-2 * w)
        w += np.clip(step, -2, 2)
    return float(w[0]), float(w[1])


def add_scores(df: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``df`` with tox_score and the number of significant passages, tox_passages."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def start():
        m = shared.value
        weights = Weights(m["table"])

        def work(texts):
            got = [passages(t, weights, m["lambda"]) for t in texts]
            x = np.log1p([e for e, _ in got])
            p = 1 / (1 + np.exp(-np.clip(m["a"] * x + m["b"], -50, 50)))
            return [p.tolist(), [len(f) for _, f in got]]

        return work

    return append(df, text, "tox_score double, tox_passages long", start)


def toxicity(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", fit_docs: int = 6000) -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages, one row for each input row."""
    docs = narrow(df, doc_id=doc_id, text=text)
    out = add_scores(docs, fit(docs, labels, fit_docs))
    return out.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), F.col("tox_score").alias("score"),
                      (F.col("tox_score") >= 0.5).cast("int").alias("predicted"), F.col("tox_passages").alias("n_passages"))
