"""Token counts of whole texts under a sentencepiece model, by a two-tier map-side lookup.

A text is cut into pre-tokens at places that no vocabulary piece can span (this is
checked against the vocabulary when a worker loads the model, not assumed), so the
count of a text is the sum over its pre-tokens. Tier one is a broadcast table of the
most frequent pre-tokens of the whole corpus with their token counts, at most
``TABLE`` entries; tier two is a cache in each Python worker, bounded by
``CACHE`` entries, filled by encoding misses. Neither pre-tokens nor texts are
shuffled: the frequency pass sends at most ``SUMMARY`` entries from each task.
Counts do not depend on the table or the caches, only speed does.

Null and empty texts have 0 bytes and 0 tokens. Repeated rows and ids each keep a row.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import CACHES, append, narrow

TABLE, SUMMARY, CACHE = 32_768, 8_192, 1_500_000
LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
STOP = ".,;:!?"
_WORKER: dict = {}
CACHES["token_counts"] = lambda: [x.known.clear() for x in _WORKER.values()]


class Counts:
    """Sentencepiece model of a worker with its cache of pre-token lengths."""

    def __init__(self, model: str):
        import public_tokenizers
        import sentencepiece

        self.table: dict[str, int] = {}

        self.sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        self.whole = any("▁" in p.lstrip("▁") for p in pieces) or self.sp.encode(" ", out_type=str) != ["▁▁"]
        words = not any(re.search(f"[{LETTER}][{STOP}]", p) for p in pieces)
        lines = not any("\n" in p and p != "\n" for p in pieces) and len(self.sp.encode("\na")) > len(self.sp.encode("\n"))
        if words and lines:
            self.cut = re.compile(rf" *[{LETTER}]++(?![^ {STOP}\n])| *[^ \n]+| *\n+| +").findall
        else:
            self.cut = re.compile(r" +[^ ]*").findall
        self.newline = len(self.sp.encode("\n"))
        self.known: dict[str, int] = {}

    def units(self, text: str) -> list[str]:
        """The model sets one space before a text; a lower block is the same to it as a space."""
        return self.cut(" " + text.replace("▁", " ") if "▁" in text else " " + text)

    def learn(self, units: list[str]) -> None:
        if len(self.known) > CACHE:
            self.known = dict(self.table)
        got = self.sp.encode([u[1:] if u[0] == " " else "\n" + u for u in units], num_threads=1)
        # a unit has a token at least: the last space of a text, after which nothing is left to encode, is one
        self.known.update((u, max(1, len(g) - (0 if u[0] == " " else self.newline))) for u, g in zip(units, got, strict=True))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.whole:
            return len(self.sp.encode(text))
        units = self.units(text)
        found = list(map(self.known.get, units))
        if None in found:
            self.learn(list({u for u, n in zip(units, found, strict=True) if n is None}))
            found = [self.known[u] if n is None else n for u, n in zip(units, found, strict=True)]
        return sum(found)


def worker(model: str) -> Counts:
    if model not in _WORKER:
        _WORKER[model] = Counts(model)
    return _WORKER[model]


def frequent(df: DataFrame, text: str, model: str, size: int = TABLE) -> list[tuple[str, int]]:
    """The about ``size`` most frequent pre-tokens of the whole corpus. Each task keeps a
    lossy count: beyond 20 summaries' worth of entries only the most frequent stay."""

    def summarise(batches):
        tok, seen = worker(model), Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if t:
                    seen.update(tok.units(t))
                    if len(seen) > 20 * SUMMARY:
                        seen = Counter(dict(seen.most_common(4 * SUMMARY)))
        top = [(u, n) for u, n in seen.most_common(SUMMARY) if len(u) <= 64]
        yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["unit", "n"])

    got = (df.select(text).mapInArrow(summarise, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "unit").limit(size).collect())
    return [(r.unit, r.n) for r in got]


def token_counts(df: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 model: str = "piece_bpe_32k.model", limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens), one row for each input row."""
    docs = narrow(df, doc_id=doc_id, text=text)
    units = [u for u, _ in frequent(docs, "text", model)]
    tok = worker(model)
    if units and not tok.whole:
        tok.learn(units)
    shared = docs.sparkSession.sparkContext.broadcast(("\0".join(units), bytes(min(255, tok.known.get(u, 0)) for u in units)))

    def start():
        own = worker(model)
        keys, sizes = shared.value
        # a key holds no NUL: sentencepiece units with one are rare enough to be left to the cache
        keys = keys.split("\0")
        if len(keys) == len(sizes):
            own.table = {k: n for k, n in zip(keys, sizes, strict=True) if 0 < n < 255}
            own.known.update(own.table)
        return lambda texts: [[own.count(t) for t in texts]]

    out = append(docs, "text", "n_tokens long", start, "token_counts")
    return out.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "n_tokens",
                      (F.col("n_tokens") > limit).alias("over_limit"))
