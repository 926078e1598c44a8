"""Corpus-wide line dedup: documents probe a sharded minimal perfect hash of repeated lines.

One pass counts, for each line key (128-bit hash of the stripped, ASCII-lower-cased line),
the documents that hold it; tasks and Spark's partial aggregation both combine before the
shuffle, so a line in a third of all documents costs one row a task. Keys at or above the
threshold are cut into shards of bounded size; a task turns each shard into a minimal
perfect hash (levels of bit arrays with rank counts) that indexes two arrays, the second
half of each key's hash as fingerprint and its document count. Documents then probe these
arrays; no line is joined. The index is broadcast only in blocks of at most ``BLOCK``
bytes, whose size is read before anything is sent: beyond one block, documents are
probed block by block and written as a table in between, so that neither a task nor the driver holds more than one
block; a line dropped by one block is simply no longer there for the next.

Null and empty texts are one empty line. Empty keys are never dropped.
Repeated rows count as documents of their own.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import append, cut, narrow, parts, passed

BLOCK = 64 << 20
SHARD = 1 << 18
GAMMA, LEVELS = 1.7, 40


def keys_of(data: bytes) -> list[bytes]:
    """bytes.lower and bytes.strip touch exactly A-Z and [\\x20\\x09-\\x0D]."""
    return list(map(bytes.strip, data.lower().split(b"\n")))


def halves(keys: list[bytes]) -> np.ndarray:
    """Two unsigned halves of each key's 128-bit hash."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), ">u8").reshape(-1, 2).astype(np.uint64)


def spread(h: np.ndarray, seed: int) -> np.ndarray:
    """Another 64-bit mix of h for each level."""
    x = h ^ np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash over distinct 64-bit keys: at each level a key whose bit no other
    key shares is settled, the rest go on; a key's index is the rank of its bit."""

    def __init__(self, levels: list[np.ndarray], last: np.ndarray):
        self.levels, self.last = levels, np.sort(last)
        self.ranks, n = [], 0
        for bits in levels:
            self.ranks.append(n + np.concatenate([[0], np.cumsum(bits)]))
            n = int(self.ranks[-1][-1])
        self.size = n + len(self.last)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys) and len(levels) < LEVELS:
            m = max(64, int(GAMMA * len(keys)))
            at = (spread(keys, len(levels)) % np.uint64(m)).astype(np.int64)
            alone = np.bincount(at, minlength=m) == 1
            levels.append(alone)
            keys = keys[~alone[at]]
        return cls(levels, keys)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key; a key outside the set gets some index, or -1."""
        out, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for k, (bits, rank) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = (spread(keys[open_], k) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[open_[hit]] = rank[at[hit]]
            open_ = open_[~hit]
        if len(self.last) and len(open_):
            at = np.minimum(np.searchsorted(self.last, keys[open_]), len(self.last) - 1)
            same = self.last[at] == keys[open_]
            out[open_[same]] = self.size - len(self.last) + at[same]
        return out


def pack(keys: np.ndarray, prints: np.ndarray, counts: np.ndarray) -> tuple[list[bytes], list[int], bytes, bytes, bytes]:
    """Level bits, their lengths, unsettled keys, fingerprint and count arrays in index order."""
    h = PerfectHash.build(keys)
    at = h.find(keys)
    fp, n = np.zeros(h.size, np.uint64), np.zeros(h.size, np.int64)
    fp[at], n[at] = prints, counts
    return [np.packbits(b).tobytes() for b in h.levels], [len(b) for b in h.levels], h.last.tobytes(), fp.tobytes(), n.tobytes()


class Shard:
    def __init__(self, levels, lengths, last, prints, counts):
        bits = [np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool) for b, n in zip(levels, lengths, strict=True)]
        self.hash = PerfectHash(bits, np.frombuffer(last, np.uint64))
        self.prints, self.counts = np.frombuffer(prints, np.uint64), np.frombuffer(counts, np.int64)

    def probe(self, keys: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """Document count of each key, 0 where the key is not in the shard."""
        at = self.hash.find(keys)
        return np.where((at >= 0) & (self.prints[at] == prints), self.counts[at], 0) if self.hash.size else np.zeros(len(keys), np.int64)


def line_counts(df: DataFrame, text: str = "text", min_chars: int = 1) -> DataFrame:
    """h1, h2, n_docs: documents that hold each line key."""

    def run(batches):
        for batch in parts(batches, 2048):
            digests: list[bytes] = []
            for t in batch.column(0).to_pylist():
                if t:
                    keys = set(keys_of(t.encode()))
                    digests.extend(map(xxhash.xxh3_128_digest, (k for k in keys if k and (min_chars == 1 or len(k.decode()) >= min_chars))))
            h = np.frombuffer(b"".join(digests), "S16" if digests else "S1")
            got, n = np.unique(np.frombuffer(b"".join(digests), ">i8").reshape(-1, 2).astype(np.int64), axis=0, return_counts=True) if len(h) else (np.zeros((0, 2), np.int64), np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(got[:, 0]), pa.array(got[:, 1]), pa.array(n.astype(np.int64))], names=["h1", "h2", "n"])

    return df.select(text).mapInArrow(run, "h1 long, h2 long, n long").groupBy("h1", "h2").agg(F.sum("n").alias("n_docs"))


def index(df: DataFrame, text: str = "text", min_docs: int = 10, min_chars: int = 1) -> tuple[DataFrame, int]:
    """One row for each shard of repeated line keys, and the number of shards."""
    keys = cut(line_counts(df, text, min_chars).where(F.col("n_docs") >= min_docs))
    shards = max(1, -(-keys.count() // SHARD))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        # h2 places the key, h1 is its fingerprint; equal h2 with another h1 is kept beside the hash
        h1, h2 = pdf.h1.to_numpy().view(np.uint64), pdf.h2.to_numpy().view(np.uint64)
        _, first = np.unique(h2, return_index=True)
        twin = np.ones(len(h2), bool)
        twin[first] = False
        levels, lengths, last, fp, n = pack(h2[first], h1[first], pdf.n_docs.to_numpy()[first])
        more = np.stack([h2[twin], h1[twin]], 1).tobytes()
        return pd.DataFrame({"shard": [int(pdf.shard.iloc[0])], "levels": [levels], "lengths": [lengths], "last": [last], "prints": [fp], "counts": [n], "twins": [more]})

    made = (keys.withColumn("shard", F.expr(f"pmod(h1, {shards})").cast("long")).groupBy("shard")
            .applyInPandas(build, "shard long, levels array<binary>, lengths array<long>, last binary, prints binary, counts binary, twins binary"))
    return cut(made), shards


def blocks(made: DataFrame, block: int = BLOCK) -> list[list[int]]:
    """Shard numbers in groups whose arrays stay under ``block`` bytes."""
    size = F.length("prints") + F.length("counts") + F.length("last") + F.expr("aggregate(lengths, 0L, (a, x) -> a + x)")
    out: list[list[int]] = []
    room = 0
    for r in made.select("shard", size.alias("b")).orderBy("shard").toLocalIterator():
        if not out or r.b > room:
            out.append([])
            room = block
        out[-1].append(r.shard)
        room -= r.b
    return out


def drop_lines(df: DataFrame, text: str = "text", min_docs: int = 10, min_chars: int = 1, block: int | None = None) -> DataFrame:
    """``df`` with the repeated lines gone from ``text``; n_lines and n_dropped are appended."""
    made, shards = index(df, text, min_docs, min_chars)
    plan = blocks(made, block or BLOCK) or [[]]
    for k, part in enumerate(plan):
        rows = [tuple(r)[1:] + (r.shard,) for r in made.where(F.col("shard").isin(part)).collect()] if part else []
        shared = df.sparkSession.sparkContext.broadcast(rows)

        def start(shared=shared):
            own = {r[6]: (Shard(*r[:5]), {tuple(x) for x in np.frombuffer(r[5], np.uint64).reshape(-1, 2).tolist()}) for r in shared.value}

            def repeated(keys: list[bytes]) -> np.ndarray:
                h = halves(keys)
                shard = (h[:, 0].view(np.int64) % shards).astype(np.int64)
                hit = np.zeros(len(keys), bool)
                for s in np.unique(shard).tolist():
                    if s in own:
                        at = np.flatnonzero(shard == s)
                        table, twins = own[s]
                        hit[at] = table.probe(h[at, 1], h[at, 0]) >= min_docs
                        if twins:
                            hit[at] |= [(b, a) in twins for a, b in h[at].tolist()]
                return hit & np.fromiter((len(x) > 0 if min_chars == 1 else len(x.decode()) >= min_chars for x in keys), bool, len(keys))

            def work(texts):
                kept, n_lines, n_dropped = [], [], []
                part = [(t or "").encode() for t in texts]
                lines = [keys_of(d) for d in part]
                hit = repeated([x for own_lines in lines for x in own_lines])
                ends = np.cumsum([len(x) for x in lines])
                for t, data, x, end in zip(texts, part, lines, ends, strict=True):
                    gone = hit[end - len(x):end]
                    n_lines.append(len(x))
                    n_dropped.append(int(gone.sum()))
                    kept.append(b"\n".join([y for y, g in zip(data.split(b"\n"), gone, strict=True) if not g]).decode() if gone.any() else t)
                return [kept, n_lines, n_dropped]

            return work

        out = append(df, text, f"{text} string, _lines long, _dropped long", start)
        first = k == 0
        df = (out.withColumn("n_lines", F.col("_lines") if first else F.col("n_lines"))
              .withColumn("n_dropped", F.col("_dropped") if first else F.col("n_dropped") + F.col("_dropped"))
              .drop("_lines", "_dropped"))
        if k + 1 < len(plan):
            df = passed(df, "lines")
            shared.unpersist()
    return df


def line_dedup(df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_docs: int = 10) -> DataFrame:
    """doc_id, n_lines, n_dropped and the kept text, one row for each input row."""
    return drop_lines(narrow(df, doc_id=doc_id, text=text), "text", min_docs)


def sha256(text: str | None) -> str:
    return hashlib.sha256((text or "").encode()).hexdigest()
