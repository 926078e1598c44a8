"""Language identification: multinomial naive Bayes over hashed character n-grams.

Fitted on rows with a language whose crc32(doc_id) mod 5 is not 0, at most ``fit_docs`` ids a language
(those with the smallest hashes; all while there are fewer), one row an id. The priors are the shares of
the languages among all these ids, drawn or not. Each task adds up n-gram counts of its rows; the log-probability matrix, at most ``MATRIX`` bytes by choice of
the bucket number, is broadcast, and whole texts are scored in batches: one gather and one
segmented sum. A null text or one without a letter is ``und`` with score 0, as is every
text if nothing could be learned. Ties go to the first language by name. Repeated rows keep a row each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import append, fold, narrow

BITS, ORDERS, MATRIX = 16, (1, 2, 3), 64 << 20


def has_letter(text: str) -> bool:
    """Whether a character of the Unicode letter categories is there (numbers such as a half or a Roman eight are none)."""
    return any(map(str.isalpha, text))


def grams(texts: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of all n-grams of the texts, and where each text starts among them."""
    codes = [np.frombuffer(f" {t.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4") for t in texts]
    out, sizes = [], []
    for c in codes:
        a = c.astype(np.uint32) * np.uint32(0x9E3779B1)
        own, h = [], np.zeros(len(a), np.uint32)
        for n in range(1, max(ORDERS) + 1):
            h = h[:len(a) - n + 1] * np.uint32(0x85EBCA6B) + a[n - 1:]
            if n in ORDERS and len(h):
                own.append((h ^ (h >> np.uint32(15))) * np.uint32(0xC2B2AE35) >> np.uint32(32 - bits))
        out += own
        sizes.append(sum(map(len, own)))
    return np.concatenate(out).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)


def sample(df: DataFrame, label: str, most: int, *keep: str) -> tuple[DataFrame, dict]:
    """One row (label, doc_id, columns ``keep``) of each of at most ``most`` different ids of a label, those with the
    smallest hashes, and the number of different ids that each label has. An id that is repeated counts once
    and brings one row (that of the smallest hash of its columns), however many it has."""
    counts = {r[0]: r.n for r in df.select(label, "doc_id").distinct().groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    h, ok = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 30)), F.lit(False)
    for x, n in counts.items():  # somewhat more than are wanted, then exactly as many
        ok = ok | ((F.col(label) == F.lit(x)) & (h < F.lit(int(min(1.0, (1.2 * most + 50) / n) * (1 << 30)))))
    one = df.where(ok).groupBy(label, "doc_id").agg(F.count(F.lit(1)).alias("_n"), *[F.min_by(c, F.xxhash64(*keep)).alias(c) for c in keep])
    place = F.row_number().over(Window.partitionBy(label).orderBy(h, "doc_id"))
    return one.withColumn("_k", place).where(F.col("_k") <= most).drop("_n", "_k"), counts


def fit(docs: DataFrame, fit_docs: int = 3000) -> tuple[list[str], np.ndarray]:
    """Languages in order of name and the matrix of log probabilities, a row for each bucket and one for the priors."""
    train = docs.where("lang IS NOT NULL AND text IS NOT NULL AND NOT held_out")
    some, rows = sample(train, "lang", fit_docs, "text")
    langs = sorted(rows)
    if not langs:
        return [], np.zeros((1, 0), np.float32)
    bits = min(BITS, int(np.log2(MATRIX / 4 / len(langs))))
    number = {x: k for k, x in enumerate(langs)}
    cells = (1 << bits) * len(langs)

    def count(batches):
        total = np.zeros(cells, np.int64)
        for batch in batches:
            names, texts = (batch.column(c).to_pylist() for c in (0, 1))
            for at in range(0, len(texts), 64):
                part = [t for t in texts[at:at + 64]]
                g, starts = grams(part, bits)
                own = np.array([number[x] for x in names[at:at + 64]], np.int64)
                total += np.bincount(g * len(langs) + np.repeat(own, np.diff([*starts, len(g)])), minlength=cells)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])

    got = some.select("lang", "text").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(cells)
    n[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    counts = n.reshape(-1, len(langs)) + 0.5
    share = np.array([rows[x] + 1.0 for x in langs])
    prior = np.log(share / share.sum())
    return langs, np.vstack([np.log(counts / counts.sum(axis=0)), prior]).astype(np.float32)


def predictor(langs: list[str], matrix: np.ndarray):
    bits = int(np.log2(max(1, len(matrix) - 1)))

    def work(texts):
        lang, score = ["und"] * len(texts), [0.0] * len(texts)
        able = [k for k, t in enumerate(texts) if t and has_letter(t)] if langs else []
        chunk: list[int] = []
        room = 200_000

        def flush():
            g, starts = grams([texts[k] for k in chunk], bits)
            total = np.add.reduceat(matrix[g], starts, axis=0, dtype=np.float64)
            n = np.diff([*starts, len(g)])[:, None]
            best = (total + matrix[-1]).argmax(axis=1)
            # n-grams of a text overlap and are far from independent: the posterior is flattened by the root of their number
            flat = (total - total.max(axis=1, keepdims=True)) / np.sqrt(n) + matrix[-1]
            p = np.exp(flat - flat.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            for k, b, own in zip(chunk, best.tolist(), p, strict=True):
                lang[k], score[k] = langs[b], float(own[b])

        for k in able:
            chunk.append(k)
            room -= len(texts[k])
            if room < 0:
                flush()
                chunk, room = [], 200_000
        if chunk:
            flush()
        return [lang, score]

    return work


def identify(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", fit_docs: int = 3000) -> DataFrame:
    """doc_id, held_out, lang_pred, score, one row for each input row."""
    docs = narrow(df, doc_id=doc_id, text=text, lang=lang).withColumn("held_out", F.coalesce(fold() == 0, F.lit(False)))
    langs, matrix = fit(docs.where("doc_id IS NOT NULL"), fit_docs)
    shared = docs.sparkSession.sparkContext.broadcast((langs, matrix))
    out = append(docs.select("doc_id", "held_out", "text"), "text", "lang_pred string, score double", lambda: predictor(*shared.value))
    return out.drop("text")
