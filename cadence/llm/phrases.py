"""Phrase collocation mining by SON partitioning.

Texts are dealt to ``shards`` shards by a hash of their content. A phrase that occurs ``min_count``
times must occur ceil(min_count / shards) times in at least one shard, so each shard is mined
completely at that lower support, level by level: words and pairs first, then phrases of k words only
where both phrases of k - 1 words inside them are frequent in the shard. A shard is no task; its counts
(64-bit hashes of language, shard and words) are combined in the tasks, then grouped by Spark.
The locally frequent phrases of a level become two bitmaps (by shard, for the next level, and of all shards, for
the last pass) of at most ``MOST_BITS`` bits, the only thing that is broadcast (32 MB each); a foreign phrase that
meets a set bit is merely counted as well. The last pass counts the union of all shards' candidates over the whole corpus, exactly and as
words, not as hashes, so neither collisions nor a full bitmap change a result.

Words of a null language belong to ``und``; null and empty texts hold no word. Repeated rows count
each. Phrases never cross pieces or documents. A text of any length is read in steps of ``STEP``
bytes; a task holds ``HELD`` words, half as many where it keeps the words themselves. An empty table gives no row. Ties of score and count are ranked
by the phrase's UTF-8 bytes.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import cut, parts
from cadence.llm.line_dedup import spread

HELD, STEP = 1 << 21, 1 << 20
LEAST_BITS, MOST_BITS, BLOCK_BITS = 1 << 19, 1 << 28, 1 << 19
#: A-Z to lower case; piece ends to one byte, which then is written as the mark below; tabs to spaces.
PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 10)
END = b"."
END_HASH = np.uint64(xxhash.xxh3_64_intdigest(END))


class Reader:
    """Word hashes of texts, by key, in reading order; hash 0 ends a piece. With ``numbered`` also the words
    of a buffer and the number of the word at each place, 0 for an end."""

    def __init__(self, longest: int, held: int, step: int, numbered: bool):
        self.longest, self.held, self.step, self.numbered = longest, held, step, numbered
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[bytes, int] = defaultdict(count(1).__next__)
        self.numbers[END] = 0
        self.runs: dict = defaultdict(list)
        self.size = 0

    def add(self, key, words: list[bytes]) -> None:
        if self.numbered:
            got = np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words))
        else:
            got = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
            got[got == END_HASH] = 0
        self.runs[key].append(got)
        self.size += len(words)

    def read(self, key, data: bytes) -> Iterator[tuple]:
        at = 0
        while at < len(data):
            end, cut_at = at, -1
            while cut_at < 0 and end < len(data):  # to the last word end of this step, or of a longer one if it has none
                end += max(self.step, end - at)
                seen = data[at:end].translate(PLAIN)
                cut_at = max(seen.rfind(b" "), seen.rfind(b"\n"))
            if end < len(data):
                seen = seen[:cut_at + 1]
            self.add(key, seen.replace(b"\n", b" . ").split())
            at += len(seen)
            if self.size >= self.held:
                yield from self.take(key)
        self.add(key, [END])

    def take(self, open_key=None) -> Iterator[tuple]:
        """Key, words, word hashes and word numbers read so far. Phrases start at all places but the last
        longest - 1, which are ends, or, for a text still being read, are handed over again."""
        words, runs, more = list(self.numbers), self.runs, self.longest - 1
        marks = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        marks[0] = 0
        self.clear()
        for key, run in runs.items():
            a = np.concatenate(run)
            if key == open_key:
                tail = a[max(0, len(a) - more):]
                if self.numbered:
                    self.add(key, [words[i] for i in tail])
                else:
                    self.runs[key].append(tail)
            else:
                a = np.concatenate([a, np.zeros(more, a.dtype)])
            if len(a) > more:
                yield (key, words, marks[a], a) if self.numbered else (key, words, a, None)


def seed(*key) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(repr(key).encode()))


def hashes(one: np.ndarray, longest: int, lang: str) -> list[np.ndarray]:
    """For each k a hash of the k words from every place on (the last places wrap and are never used)."""
    out = [spread(one ^ seed(lang), 1)]
    for k in range(1, longest):
        out.append(spread(out[-1] * np.uint64(0x9E3779B97F4A7C15) + np.roll(one, -k), k))
    return out


def inside(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h & np.uint64(len(bits) * 8 - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def frequent(one: np.ndarray, known: list[np.ndarray], tested: int, test: Callable[[int, np.ndarray], np.ndarray]) -> Iterator[np.ndarray]:
    """For k = 1, 2, ... the places whose k words are to be counted: no piece ends among them, the k - 1 words from
    here and from the next place on are of the same kind, and, up to k = ``tested``, they pass the test."""
    ok = one != 0
    for k, h in enumerate(known):
        if k:
            ok = ok & np.roll(ok, -1)
        if k < tested:
            at, ok = np.flatnonzero(ok), ok.copy()
            ok[at] = test(k, h[at])
        yield ok


def scan(df: DataFrame, schema: str, longest: int, start: Callable[[], Callable], held: int, step: int, numbered: bool = False) -> DataFrame:
    """Rows that the function from ``start`` makes of each (key, words, hashes, numbers) of a task's texts, read
    by (language, shard), or by language alone where words are numbered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, reader = start(), Reader(longest, held // 2 if numbered else held, step, numbered)
        for batch in parts(batches):
            for lang, shard, data in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                for got in reader.read(lang if numbered else (lang, shard), data):
                    yield make(*got)
        for got in reader.take():
            yield make(*got)

    return df.mapInArrow(run, schema)


def in_shard(h: np.ndarray, shard: int, shards: int) -> np.ndarray:
    """The key of a phrase in a shard: its hash with the shard as remainder."""
    return h - h % np.uint64(shards) + np.uint64(shard)


def local_counts(df: DataFrame, longest: int, levels: tuple[int, ...], maps: list, shards: int, held: int, step: int) -> DataFrame:
    """key (of language, words and shard), c: a task's counts of the phrases of so many words whose parts are frequent in their shard."""

    def start():
        bits = [np.frombuffer(m.value, np.uint8) for m in maps]

        def make(key, words, one, _):
            lang, shard = key
            known = hashes(one, levels[-1], lang)
            here = len(one) - longest + 1
            found = frequent(one, known, levels[0] - 1, lambda n, h: inside(bits[max(0, n - 1)], spread(in_shard(h, shard, shards), 0)))
            each = [in_shard(h[:here][ok[:here]], shard, shards) for k, (h, ok) in enumerate(zip(known, found, strict=True)) if k + 1 in levels]
            h, c = np.unique(np.concatenate(each), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.astype(np.int32))], names=["key", "c"])

        return make

    return scan(df, "key long, c int", longest, start, held, step)


def bitmap(keys: DataFrame, shards: int, size: int, most: int = MOST_BITS) -> tuple[bytes, bytes]:
    """Two maps of the phrases of column ``key``: with their shard and without. 16 bits for each of ``size`` keys
    while that fits ``most``. Each block of a map is made by one task; the driver receives the maps once."""
    bits = LEAST_BITS
    while bits < min(most, 16 * size):
        bits *= 2
    bits = min(bits, most)
    block = min(bits, BLOCK_BITS)

    def places(batches):
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for whole, h in ((0, key), (1, key // np.uint64(shards))):
                at = np.unique(spread(h, 0) & np.uint64(bits - 1)).astype(np.int64) + whole * bits
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array((at // block).astype(np.int32))], names=["at", "block"])

    def build(batches):
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            at, of = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            for b in np.unique(of).tolist():
                own.setdefault(b, np.zeros(block, bool))[at[of == b] - b * block] = True
        for b, set_ in own.items():
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([np.packbits(set_, bitorder="little").tobytes()])], names=["block", "data"])

    out, own = bytearray(2 * bits // 8), block // 8
    for r in keys.mapInArrow(places, "at long, block int").repartition("block").mapInArrow(build, "block int, data binary").collect():
        out[r.block * own: (r.block + 1) * own] = r.data
    return bytes(out[:bits // 8]), bytes(out[bits // 8:])


def mine(df: DataFrame, longest: int, min_count: int, shards: int, held: int, step: int) -> list:
    """The broadcast bitmaps of the phrases that are frequent in any shard: of one and two words (mined in one
    pass), of three, and so on."""
    local, union, sc = [], [], df.sparkSession.sparkContext
    for levels in ((1, 2), *[(k,) for k in range(3, longest + 1)]):
        counted = local_counts(df, longest, levels, local, shards, held, step).groupBy("key").agg(F.sum("c").alias("c"))
        keys = cut(counted.where(F.col("c") >= -(-min_count // shards)).select("key"))
        one, any_ = bitmap(keys, shards, keys.count())
        local.append(sc.broadcast(one))
        union.append(sc.broadcast(any_))
    return union


def exact_counts(df: DataFrame, longest: int, maps: list, shards: int, held: int, step: int) -> DataFrame:
    """lang, phrase, size, c: a task's counts of the candidates of any shard; the row of size 0 counts all words."""

    def start():
        bits = [np.frombuffer(m.value, np.uint8) for m in maps]

        def test(n: int, h: np.ndarray) -> np.ndarray:
            return inside(bits[max(0, n - 1)], spread(h // np.uint64(shards), 0))

        def make(lang, words, one, a):
            here = len(a) - longest + 1
            known = hashes(one, longest, lang)
            phrases, sizes, counts = [""], [0], [int(np.count_nonzero(a[:here]))]
            number = a.astype(np.int64)  # of the k words from each place on, equal for equal words
            for k, ok in enumerate(frequent(one, known, longest, test)):
                at = np.flatnonzero(ok[:here])
                if k:
                    _, first, number[at], c = np.unique(number[at] * len(words) + a[at + k], return_index=True, return_inverse=True, return_counts=True)
                    parts_of = a[at[first][:, None] + np.arange(k + 1)].tolist()
                    phrases += [b" ".join(map(words.__getitem__, p)).decode() for p in parts_of]
                else:
                    c = np.bincount(a[at], minlength=len(words))
                    first = np.flatnonzero(c)
                    phrases += [words[i].decode() for i in first.tolist()]
                    c = c[first]
                sizes += [k + 1] * len(first)
                counts += c.tolist()
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(sizes)), pa.array(phrases), pa.array(sizes, pa.int32()), pa.array(counts, pa.int64())],
                                              names=["lang", "phrase", "size", "c"])

        return make

    return scan(df, "lang string, phrase string, size int, c long", longest, start, held, step, numbered=True)


def frequent_phrases(df: DataFrame, text: str = "text", lang: str = "lang", longest: int = 3, min_count: int = 10, shards: int = 2,
                     held: int = HELD, step: int = STEP) -> DataFrame:
    """lang, phrase, size, f of all phrases of 1 to ``longest`` words with f >= ``min_count``,
    and per language a row of size 0 with the number of its words."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    src = df.select(F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"), F.expr(f"pmod(xxhash64(`{text}`), {shards})").cast("int").alias("shard"), whole.cast("binary").alias("data"))
    src = src.where(F.length("data") > 0)
    maps = mine(src, longest, min_count, shards, held, step)
    counted = exact_counts(src, longest, maps, shards, held, step).groupBy("lang", "phrase", "size").agg(F.sum("c").alias("f"))
    return cut(counted.where((F.col("f") >= min_count) | (F.col("size") == 0)))


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", longest: int = 3, min_count: int = 10, cover: int = 50, top: int | None = 2000,
                 shards: int = 2, held: int = HELD, step: int = STEP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases (None: all) of 2 to
    ``longest`` words, scored by their weakest cut; one that lies inside a longer frequent phrase with
    at least ``cover`` percent of its count goes."""
    known = frequent_phrases(df, text, lang, longest, min_count, shards, held, step)
    some = known.where("size >= 2").withColumn("w", F.split("phrase", " "))
    part = lambda size, at: F.array_join(F.slice("w", at, size), " ")
    longer = some.where("size >= 3").select("lang", "f", F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("size") - 1), lambda s: F.transform(F.sequence(F.lit(1), F.col("size") - s + 1), lambda i: part(s, i))))).alias("phrase"))
    around = longer.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    left = some.join(around, ["lang", "phrase"], "left").where(F.col("most").isNull() | (100 * F.col("most") < cover * F.col("f")))
    cuts = left.select("lang", "phrase", F.col("f").alias("a"), "w", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.col("k"), F.lit(1)).alias("first"), part(F.col("size") - F.col("k"), F.col("k") + 1).alias("rest"))
    side = lambda phrase, f: known.where("size >= 1").select("lang", F.col("phrase").alias(phrase), F.col("f").alias(f))
    both = cuts.join(side("first", "l"), ["lang", "first"]).join(side("rest", "r"), ["lang", "rest"])
    wide = lambda c: F.col(c).cast("decimal(18,0)")  # noqa: E731  38 digits hold both products
    both = both.select("lang", "phrase", "a", "k", "l", "r", (F.lit(1_000_000).cast("decimal(7,0)") * wide("a") * wide("a")).alias("up"), (wide("l") * wide("r")).alias("down"))
    weak = both.groupBy("lang", "phrase").agg(F.min(F.struct(F.expr("up div down").alias("score"), "k", "a", "l", "r")).alias("x"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = weak.select("lang", "phrase", "x.*").withColumn("rank", F.row_number().over(order))
    ranked = ranked.where(F.col("rank") <= top) if top is not None else ranked
    words = known.where("size = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
