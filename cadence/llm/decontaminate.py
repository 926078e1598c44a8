"""Benchmark decontamination: short test items found inside long documents.

Items are partitioned by size (number of distinct ``width``-word shingles, powers of two). An item of a
partition with at most u shingles is indexed by its floor((1 - threshold) * u) + 1
smallest shingle hashes (a bottom MinHash signature, all hashes if it has fewer): a document
that contains at least ``threshold`` of the item's shingles lacks at most floor((1 -
threshold) * u) of them, so it holds at least one hash of the signature and the search
misses nothing. Candidates are verified by exact containment on the shingles' words.

The index is broadcast in blocks of at most ``BLOCK`` bytes of item text, measured first. Items of several
blocks mean several passes over the documents, written as a table in between, so that neither a task nor
the driver holds more than one block; no document is shuffled and no
pair that shares nothing is looked at. Items with fewer words than ``width`` are found wherever their
whole sequence of words occurs; items without a word match nothing.
Null and empty texts contain nothing. Repeated items and documents each count. Item ids of any number type become long,
others keep their type.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.llm.common import append, narrow, passed
from cadence.llm.toxicity import words

BLOCK, WIDTH, THRESHOLD = 32 << 20, 5, 0.8
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


def hashes(w: list[bytes], width: int = WIDTH) -> np.ndarray:
    """Hash of each shingle; words are hashed by this process, which also holds the index."""
    h = np.fromiter(map(hash, w), np.int64, len(w)).view(np.uint64)
    out = np.zeros(len(w) - width + 1, np.uint64)
    for k in range(width):
        out = (out + h[k:len(h) - width + 1 + k]) * _MIX[k % len(_MIX)]
    return out ^ (out >> np.uint64(29))


class Items:
    """Index of a block of items."""

    def __init__(self, rows: list[tuple], width: int, threshold: float):
        self.width, self.threshold = width, threshold
        self.short: dict[tuple, list] = {}
        self.items: list[tuple[object, set, np.ndarray]] = []
        sign, owner = [], []
        for key, text in rows:
            w = words(text)
            if len(w) < width:
                if w:
                    self.short.setdefault(tuple(w), []).append(key)
                continue
            sets = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)}
            h = np.unique(hashes(w, width))
            most = 1 << max(0, len(sets) - 1).bit_length()  # largest size of the item's partition
            own = h[:int((1 - threshold) * most + 1e-9) + 1]
            sign.append(own)
            owner.append(np.full(len(own), len(self.items)))
            self.items.append((key, sets, h))
        self.sizes = {n: np.unique([hashes(list(s), n)[0] for s in self.short if len(s) == n]) for n in sorted({len(s) for s in self.short})}
        sign, owner = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((sign, np.uint64), (owner, np.int64)))
        order = np.argsort(sign, kind="stable")
        self.sign, self.owner = sign[order], owner[order]
        self.bits = max(16, min(26, int(len(sign) * 32).bit_length()))
        self.some = np.zeros(1 << self.bits, bool)
        self.some[(self.sign >> np.uint64(64 - self.bits)).astype(np.int64)] = True

    def inside(self, text: str | None) -> list[tuple]:
        """(item, containment) of the items that a whole text contains."""
        w = words(text)
        out = []
        for size, known in self.sizes.items():
            if len(w) >= size:
                at = np.flatnonzero(np.isin(hashes(w, size), known))
                out += [(k, 1.0) for s in sorted({tuple(w[i:i + size]) for i in at.tolist()}) for k in self.short.get(s, ())]
        return out + self.long_inside(w) if len(w) >= self.width else out

    def long_inside(self, w: list[bytes]) -> list[tuple]:
        h = hashes(w, self.width)
        hit = h[self.some[(h >> np.uint64(64 - self.bits)).astype(np.int64)]]
        if not len(hit):
            return []
        left, right = np.searchsorted(self.sign, hit, "left"), np.searchsorted(self.sign, hit, "right")
        found = sorted({int(x) for a, b in zip(left, right, strict=True) for x in self.owner[a:b]})
        out, own, all_h = [], None, None
        for x in found:
            key, sets, item_h = self.items[x]
            all_h = np.unique(h) if all_h is None else all_h
            if np.isin(item_h, all_h).sum() < self.threshold * len(sets) - 1e-9:
                continue
            own = {tuple(w[k:k + self.width]) for k in range(len(w) - self.width + 1)} if own is None else own
            share = len(sets & own) / len(sets)
            if share >= self.threshold - 1e-9:
                out.append((key, share))
        return out


def item_blocks(items: DataFrame, block: int) -> tuple[int, Iterator[list[tuple]]]:
    """The number of blocks of items whose text stays near ``block`` bytes, and the blocks, each read when it is its turn."""
    n = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    count = -(-n // block)
    part = lambda k: items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k) if count > 1 else items
    return count, ([(r.item_id, r.text) for r in part(k).collect()] for k in range(count))


def add_leaks(df: DataFrame, benchmark: DataFrame, text: str = "text", width: int = WIDTH, threshold: float = THRESHOLD, block: int | None = None) -> DataFrame:
    """``df`` with leak_items and leak_shares: the items inside each text and their containment (empty arrays: none)."""
    items = narrow(benchmark, item_id="item_id", text="text").where("text IS NOT NULL")
    if isinstance(items.schema["item_id"].dataType, T.NumericType):
        items = items.withColumn("item_id", F.col("item_id").cast("long"))
    kind, sc = items.schema["item_id"].dataType.simpleString(), df.sparkSession.sparkContext
    count, blocks = item_blocks(items, block or BLOCK)
    out = None
    for number, rows in enumerate(blocks):
        shared = sc.broadcast(rows)

        def start(shared=shared):
            own = Items(shared.value, width, threshold)

            def work(texts):
                got = [own.inside(t) for t in texts]
                return [[[k for k, _ in g] for g in got], [[s for _, s in g] for g in got]]

            return work

        if out is None:
            out = append(df, text, f"leak_items array<{kind}>, leak_shares array<double>", start)
        else:
            more = append(out, text, f"_items array<{kind}>, _shares array<double>", start)
            out = more.withColumn("leak_items", F.concat("leak_items", "_items")).withColumn("leak_shares", F.concat("leak_shares", "_shares")).drop("_items", "_shares")
        if number + 1 < count:
            out = passed(out, "leaks")
            shared.unpersist()
    empty = lambda of: F.expr(f"cast(array() as array<{of}>)")
    return out if out is not None else df.withColumn("leak_items", empty(kind)).withColumn("leak_shares", empty("double"))


def leaks(df: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, threshold: float = THRESHOLD,
          block: int | None = None) -> DataFrame:
    """doc_id, item_id, containment: a row for each item inside a document."""
    found = add_leaks(narrow(df, doc_id=doc_id, text=text), benchmark, "text", width, threshold, block)
    return found.select("doc_id", F.explode(F.arrays_zip("leak_items", "leak_shares")).alias("x")).select(
        "doc_id", F.col("x.leak_items").alias("item_id"), F.col("x.leak_shares").alias("containment"))
