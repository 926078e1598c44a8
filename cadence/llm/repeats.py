"""Suffix-array dedup: every byte that a ``width``-byte string starting elsewhere too covers is removed.

Texts are UTF-8 bytes, strings never cross documents and are judged on the input; another
place in the same document counts. The corpus has no single suffix array: only
places that can repeat are brought together, by content.

1. Each window of ``width`` bytes has an anchor, the smallest hash of its 32-byte strings (the first
   on ties). Equal windows have equal anchors at equal offsets. Anchors found in two texts, or twice in one, are
   kept by an aggregate that never lists their places; exact copies count as one text here.
2. Texts meet their kept anchors (one shuffle of the text). An exact copy of ``width`` bytes or more is
   removed whole; a text without kept anchors stays whole. The others send, for each kept
   anchor, the stretch of bytes that its windows span, once a task; equal stretches are merged.
3. Stretches of an anchor are sorted in one shard. Those of anchors that occur at most ``HOT`` times, which step 1
   counts, are dealt by anchor and put in order: a task reads anchor after anchor and sorts about ``SHARD`` bytes at a time, so
   their bytes are exchanged once. An anchor that occurs more often and has over ``HOT`` different stretches is
   split by content first: windows are dealt by offset into blocks of 64, then 16, 4
   and 1, and a block goes with those that agree in all bytes that its windows share. Blocks that agree with no
   other end there; blocks of one window need no sorting. So no shard grows with the number of documents that hold a
   passage, and nothing is dropped to get there.
4. In a shard, suffixes are sorted in two stages to a depth of ``width`` bytes: those smaller than their
   successors directly, the others induced by scanning the buckets from the left. Neighbours
   whose common prefix reaches ``width`` are repeats.
5. Repeated windows return to their texts as intervals.

Null and empty texts have no bytes: nothing is removed. Texts shorter than ``width`` are never touched.
Repeated rows are copies of each other. Rows keep their (possibly null or repeated) ids.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import cut, narrow
from cadence.session import scratch_path

GRAM, HOT, SHARD, PIECE, BLOCKS = 32, 2048, 1 << 20, 1 << 22, (64, 16, 4, 1)
#: Different stretches that a task remembers, so as to send their bytes once; those beyond go each time.
KNOWN = 100_000
_ODD = 0x9E3779B97F4A7C15


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM-byte string at each place, by doubling its length."""
    h, k = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93), 1
    while k < GRAM:
        h = h[:-k] * np.uint64(pow(_ODD, k, 1 << 64)) + h[k:]
        k *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def runs(data: bytes, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of windows with one anchor: first window, number of windows, place and hash of the anchor."""
    n = len(data) - width + 1
    if n <= 0:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    first, count, place, value = [], [], [], []
    for at in range(0, n, PIECE):
        part = np.frombuffer(data, np.uint8, count=min(n, at + PIECE) - at + width - 1, offset=at)
        h = gram_hashes(part)
        low = (h & ~np.uint64((1 << 24) - 1)) | np.arange(len(h), dtype=np.uint64)
        span, reach = width - GRAM + 1, 1
        while reach * 2 <= span:
            low = np.minimum(low[:-reach], low[reach:])
            reach *= 2
        if reach < span:
            low = np.minimum(low[:len(low) - (span - reach)], low[span - reach:])
        anchor = (low & np.uint64((1 << 24) - 1)).astype(np.int64)
        start = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        first.append(at + start)
        count.append(np.diff([*start.tolist(), len(anchor)]))
        place.append(at + anchor[start])
        value.append(h[anchor[start]])
    return tuple(np.concatenate(x) for x in (first, count, place, value))


def sort_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of all suffixes of ``text``, in order of at least their first ``depth`` bytes."""
    n = len(text)
    # stage 0: a suffix is smaller than its successor if the next other byte is larger; the end is smallest
    step = np.sign(np.concatenate([text[1:].astype(np.int16), [-1]]) - text.astype(np.int16))
    last = np.minimum.accumulate(np.where(step != 0, np.arange(n), n)[::-1])[::-1]
    small = step[last] > 0
    # stage 1: the smaller ones directly, 8 bytes at a time, only where still tied
    order = np.flatnonzero(small)
    w = words8(text, depth)
    order = order[np.argsort(w[order], kind="stable")]
    tied = np.arange(len(order))
    group = np.zeros(len(order), np.int64)
    for at in range(0, depth, 8):
        if at:
            key = w[np.minimum(order[tied] + at, len(w) - 1)]
            by = np.lexsort((key, group[tied]))
            order[tied] = order[tied][by]
        key = w[np.minimum(order[tied] + at, len(w) - 1)]
        old = group[tied]
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (old[1:] != old[:-1])]) if len(tied) else np.zeros(0, bool)
        number = np.cumsum(new)
        group[tied] = number
        alone = np.bincount(number, minlength=len(tied) + 2)[number] == 1
        tied = tied[~alone]
        if not len(tied):
            break
    # stage 2: scan the buckets from the left; the suffix before each scanned one is put at its bucket's end
    direct = np.searchsorted(text[order], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    prior = np.concatenate([[0], text[:-1]]).astype(np.int64)
    large = np.concatenate([[False], ~small[:-1]])  # the suffix before this one is larger than this one

    def hand(places: np.ndarray, own: int) -> np.ndarray:
        """Deal the larger suffixes before ``places`` to their buckets; those of bucket ``own`` are returned."""
        p = places[large[places]]
        c = prior[p]
        by = np.argsort(c, kind="stable")
        p, c = p[by] - 1, c[by]
        ends = np.flatnonzero(np.concatenate([c[1:] != c[:-1], [True]])) + 1 if len(c) else []
        mine, a = np.zeros(0, np.int64), 0
        for b in ends:
            if c[a] == own:
                mine = p[a:b]
            else:
                waiting[c[a]].append(p[a:b])
            a = b
        return mine

    if not small[n - 1]:
        waiting[int(text[n - 1])].append(np.array([n - 1]))  # before the empty end
    out = []
    for c in range(256):
        got = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        while len(got):
            out.append(got)
            got = hand(got, c)
        if direct[c] < direct[c + 1]:
            own = order[direct[c]:direct[c + 1]]
            out.append(own)
            hand(own, c)
    return np.concatenate(out)


def words8(text: np.ndarray, depth: int) -> np.ndarray:
    """The 8 bytes at each place as one number that sorts as they do; zeros follow the end."""
    long = np.concatenate([text, np.zeros(depth + 8, np.uint8)])
    w = np.zeros(len(text) + depth + 1, np.uint64)
    for k in range(8):
        w = (w << np.uint64(8)) | long[k:k + len(w)]
    return w


def repeated(pieces: list[bytes], width: int) -> list[np.ndarray]:
    """For each stretch, whether each of its windows starts in another stretch, or elsewhere in it, too."""
    sizes = np.array([len(p) for p in pieces])
    text = np.frombuffer(b"".join(pieces), np.uint8)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    valid = np.zeros(len(text), bool)
    for a, s in zip(starts.tolist(), sizes.tolist()):
        valid[a:a + max(0, s - width + 1)] = True
    order = sort_suffixes(text, width)
    order = order[valid[order]]
    w = words8(text, width)
    same = np.arange(len(order) - 1)  # neighbours whose common prefix goes on
    for at in range(0, width - 7, 8):
        same = same[w[order[same] + at] == w[order[same + 1] + at]]
    if width % 8:
        same = same[w[order[same] + width - 8] == w[order[same + 1] + width - 8]]
    twice = np.zeros(len(text), bool)
    twice[order[same]] = twice[order[same + 1]] = True
    return [twice[a:a + max(0, s - width + 1)] for a, s in zip(starts.tolist(), sizes.tolist())]


def intervals(hit: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), (edge[1::2] - edge[::2]).tolist()))


def digest(*parts: bytes) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(b"".join(parts))
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)] if rows else [pa.array([], t) for t in schema.types], schema=schema)


def number8(x: int) -> bytes:
    return (int(x) & (2**64 - 1)).to_bytes(8, "little")


STRETCH = pa.schema([("t1", pa.int64()), ("t2", pa.int64()), ("p", pa.int64()), ("g1", pa.int64()), ("g2", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()),
                     ("a", pa.int64()), ("off", pa.int64()), ("n", pa.int64()), ("busy", pa.bool_()), ("twin", pa.bool_()), ("data", pa.binary())])
HITS = pa.schema([("c1", pa.int64()), ("c2", pa.int64()), ("hits", pa.list_(pa.struct([("s", pa.int64()), ("n", pa.int64())])))])


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 200, kept: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and the remaining bytes if ``kept``), one row for each input row."""
    if width < 2 * GRAM:
        raise ValueError(f"width must be at least {2 * GRAM}")
    spark = df.sparkSession
    docs = narrow(df, doc_id=doc_id, text=text).withColumn("text", F.coalesce("text", F.lit("")))
    keyed = docs.withColumn("t1", F.xxhash64("text")).withColumn("t2", F.xxhash64(F.lit("text"), "text"))
    long = keyed.where(F.octet_length("text") >= width)
    anchors = long.select("t1", "t2", "text").mapInArrow(lambda b: anchor_rows(b, width), "a long, t1 long, c long")
    own = Window.partitionBy("a")  # one exchange both finds the kept anchors and leaves them with their texts
    often = (anchors.select("a", "t1", F.min("t1").over(own).alias("x"), F.max("t1").over(own).alias("y"), F.max("c").over(own).alias("c"), F.sum("c").over(own).alias("all"))
             .where("x <> y OR c > 1"))
    # by one half of the text's key: two texts that share it would only bring each other's stretches along
    wanted = often.groupBy("t1").agg(F.collect_set("a").alias("anchors"), F.collect_set(F.when(F.col("all") > HOT, F.col("a"))).alias("busy"))
    copies = long.groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least"))
    facts = copies.join(wanted, "t1", "left")
    kind = docs.schema["doc_id"].dataType.simpleString()
    small = keyed.mapInArrow(compressed, f"doc_id {kind}, text binary, t1 long, t2 long")
    met = small.join(facts, ["t1", "t2"], "left").select("doc_id", "t1", "t2", "text", "copies", "anchors", "busy", (F.col("doc_id").eqNullSafe(F.col("least"))).alias("first"))
    path = scratch_path(spark, "repeats")
    fields = f"kind string, doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, t1 long, t2 long, p long, g1 long, g2 long, c1 long, c2 long, a long, off long, n long, busy boolean, twin boolean, data binary"
    met.mapInArrow(lambda b: first_rows(b, width, kept), fields).write.option("compression", "zstd").partitionBy("kind").parquet(path)
    rows = spark.read.schema(fields).parquet(path)
    done = rows.where("kind = 'done'").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")

    stretches = rows.where("kind = 'stretch'").select(*STRETCH.names)
    found, places = settle(stretches.where("busy"), width)
    found = found.unionByName(searched(stretches.where("NOT busy"), width))
    places = places.unionByName(stretches.where("NOT busy").select("t1", "t2", "p", "c1", "c2"))
    spans = (places.join(found, ["c1", "c2"]).select("t1", "t2", F.explode("hits").alias("h"), "p")
             .groupBy("t1", "t2").agg(F.collect_list(F.struct((F.col("p") + F.col("h.s")).alias("s"), F.col("h.n").alias("n"))).alias("spans")))
    open_ = rows.where("kind = 'text'").select("doc_id", "t1", "t2", F.col("data").alias("text")).join(spans, ["t1", "t2"], "left")
    last = open_.select("doc_id", "text", "spans").mapInArrow(lambda b: last_rows(b, width, kept), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    out = done.unionByName(last)
    return out if kept else out.drop("kept")


def compressed(batches):
    """Texts as small as they go through the shuffle: it is the only one that moves them all."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        texts = pa.array([pack(t.encode()) for t in batch.column(1).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), texts, batch.column(2), batch.column(3)], names=["doc_id", "text", "t1", "t2"])


def anchor_rows(batches, width: int):
    seen: set[int] = set()
    schema = pa.schema([("a", pa.int64()), ("t1", pa.int64()), ("c", pa.int64())])
    for batch in batches:
        cols: list[list[np.ndarray]] = [[], [], []]
        for t1, t2, text in zip(*(c.to_pylist() for c in batch.columns)):
            if (t1, t2) in seen:
                continue  # a copy in this task adds nothing
            if len(seen) < 500_000:
                seen.add((t1, t2))
            a, c = np.unique(runs(text.encode(), width)[3], return_counts=True)
            for to, x in zip(cols, (a.view(np.int64), np.full(len(a), t1), c.astype(np.int64))):
                to.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else np.zeros(0, np.int64)) for x in cols], schema=schema)


def first_rows(batches, width: int, kept: bool):
    """Results of texts that are settled; texts (as compressed as they came) and stretches of the others. The second stretch
    of a kind in a task brings no bytes, those after it are places only (``twin`` is null)."""
    schema, unpack = None, zstandard.ZstdDecompressor().decompress
    empty, known = (None,) * 13, {}
    for batch in batches:
        if schema is None:
            schema = pa.schema([("kind", pa.string()), ("doc_id", batch.schema.field(0).type), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                                ("kept_sha256", pa.string()), ("kept", pa.binary()), *STRETCH])
        rows, room = [], 16 << 20
        for key, t1, t2, text, copies, anchors, busy, first in zip(*(c.to_pylist() for c in batch.columns)):
            data = unpack(text)
            copy = copies is not None and copies > 1  # only long texts are counted
            if copy or not anchors:
                rest = b"" if copy else data
                rows.append(("done", key, len(data), len(data) - len(rest), int(copy), hashlib.sha256(rest).hexdigest(), rest if kept else None, *empty))
            else:
                rows.append(("text", key, None, None, None, None, None, t1, t2, *empty[:10], text))
                room -= len(text)
            if anchors and (first or not copy):
                begin, n, place, value = runs(data, width)
                value, busy = value.view(np.int64), set(busy)
                for k in np.flatnonzero(np.isin(value, anchors)).tolist():
                    p, a, off = int(begin[k]), int(value[k]), int(place[k] - begin[k])
                    part = data[p:p + int(n[k]) + width - 1]
                    own = digest(number8(a), number8(off), part)
                    times = known.get(own, 0)
                    if times < 2 and (times or len(known) < KNOWN):
                        known[own] = times + 1
                    twin, part = ((copy, part), (True, None), (None, None))[times]
                    rows.append(("stretch", None, None, None, None, None, None, t1, t2, p, a, 0, *own, a, off, int(n[k]), a in busy, twin, part))
                    room -= len(part or b"") + 100
            if room < 0:
                yield batch_of(rows, schema)
                rows, room = [], 16 << 20
        if rows:
            yield batch_of(rows, schema)


def last_rows(batches, width: int, kept: bool):
    schema, unpack = None, zstandard.ZstdDecompressor().decompress
    for batch in batches:
        schema = schema or pa.schema([("doc_id", batch.schema.field(0).type), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])
        rows = []
        for key, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
            data = unpack(text)
            edge = np.zeros(len(data) + 1, np.int32)
            for s in spans or ():
                edge[s["s"]] += 1
                edge[s["s"] + s["n"] + width - 1] -= 1
            gone = np.cumsum(edge[:-1]) > 0
            rest = np.frombuffer(data, np.uint8)[~gone].tobytes()
            rows.append((key, len(data), len(data) - len(rest), len(intervals(gone)), hashlib.sha256(rest).hexdigest(), rest if kept else None))
        yield batch_of(rows, schema)


def searched(stretches: DataFrame, width: int) -> DataFrame:
    """Repeated windows of each different stretch (c1, c2, hits), for anchors with at most HOT stretches each."""
    n = int(stretches.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # sorting takes time: not by bytes alone
    rows = stretches.where("twin IS NOT NULL").select("a", "c1", "c2", "twin", "data").repartition(n, "a")
    rows = rows.sortWithinPartitions("a", "c1", "c2", F.col("data").isNull()).select("a", "c1", "c2", "twin", "data")
    return rows.mapInArrow(lambda b: search_rows(b, width), "c1 long, c2 long, hits array<struct<s: long, n: long>>")


def search_rows(batches, width: int):
    """Stretches come in order of anchor and content; whole anchors of about SHARD bytes together are sorted at a time."""
    shard: list[list] = []
    group: list[list] = []  # anchor, c1, c2, twin, data of the different stretches of one anchor
    size = 0

    def whole(data: bytes) -> list[dict]:
        return [{"s": 0, "n": len(data) - width + 1}]

    def ended() -> list[tuple]:
        """What is known of an anchor at its end: a stretch found twice repeats whole, and the others are sorted with it."""
        nonlocal size
        if len(group) > 1:
            shard.extend(group)
            size += sum(len(g[4]) for g in group)
        out = [(c1, c2, whole(data)) for _, c1, c2, twin, data in group if twin]
        group.clear()
        return out

    def sorted_() -> list[tuple]:
        nonlocal size
        got = repeated([g[4] for g in shard], width) if shard else []
        out = [(c1, c2, [{"s": s, "n": n} for s, n in intervals(h)]) for (_, c1, c2, twin, _), h in zip(shard, got) if not twin and h.any()]
        shard.clear()
        size = 0
        return out

    for batch in batches:
        rows = []
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if group and group[-1][1:3] == list(row[1:3]):
                group[-1][3] = True  # the same stretch from another task, or again from one
                continue
            if group and group[-1][0] != row[0]:
                rows += ended()
                if size >= SHARD:
                    rows += sorted_()
            group.append(list(row))
        yield batch_of(rows, HITS)
    yield batch_of(ended() + sorted_(), HITS)


def split_rows(batches, width: int, size: int):
    """Stretches of hot groups cut into blocks of windows: parent, shift, and the block as a stretch of its own."""
    schema = pa.schema([("c1", pa.int64()), ("c2", pa.int64()), ("shift", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("g1", pa.int64()), ("g2", pa.int64()),
                        ("a", pa.int64()), ("off", pa.int64()), ("n", pa.int64()), ("twin", pa.bool_()), ("data", pa.binary())])
    for batch in batches:
        rows = []
        for c1, c2, a, off, n, twin, data in zip(*(c.to_pylist() for c in batch.columns)):
            j = 0
            while j < n:  # window j lies off - j bytes before the anchor
                block = (off - j) // size
                end = min(n, off - block * size + 1)
                part = data[j:end + width - 1]
                low = off - block * size  # the last window of the whole block starts here
                core = data[max(low, 0):low - size + 1 + width]
                own = digest(b"s", number8(size), number8(a), number8(off - j), part)
                rows.append((c1, c2, j, *own, *digest(b"g", number8(size), number8(a), number8(block), core), a, off - j, end - j, twin, part))
                j = end
        yield batch_of(rows, schema)


def settle(stretches: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """Repeated windows of each different stretch (c1, c2, hits), and the places (t1, t2, p) of the stretches, where an
    anchor may have any number of them."""
    places = stretches.select("t1", "t2", "p", "c1", "c2")
    now = (stretches.where("twin IS NOT NULL").groupBy("g1", "g2", "c1", "c2").agg(F.first("a").alias("a"), F.first("off").alias("off"), F.first("n").alias("n"),
                                                           ((F.count(F.lit(1)) > 1) | F.max("twin")).alias("twin"), F.first("data", ignorenulls=True).alias("data")))
    all_found, all_places = None, places
    hits = "hits array<struct<s: long, n: long>>"
    whole = F.array(F.struct(F.lit(0).cast("long").alias("s"), F.col("n").alias("n"))).alias("hits")
    for size in (*BLOCKS, 0):
        now = cut(now)
        counts = now.groupBy("g1", "g2").agg(F.count(F.lit(1)).alias("m"), F.sum(F.length("data")).alias("bytes"))
        told = now.join(counts, ["g1", "g2"])
        twins = now.where("twin").select("c1", "c2", whole)
        total = counts.where(f"m > 1 AND m <= {HOT}").agg(F.sum("bytes")).first()[0] or 0
        shards = max(1, -(-total // SHARD))

        def search(pdf: pd.DataFrame) -> pd.DataFrame:
            got = repeated([bytes(d) for d in pdf.data], width)
            rows = [(a, b, [{"s": s, "n": n} for s, n in intervals(h)]) for a, b, t, h in zip(pdf.c1, pdf.c2, pdf.twin, got) if not t and h.any()]
            return pd.DataFrame(rows, columns=["c1", "c2", "hits"])

        sorted_ = (told.where(f"m > 1 AND m <= {HOT}").select("c1", "c2", "twin", "data", F.pmod(F.xxhash64("g1", "g2"), F.lit(shards)).alias("shard"))
                   .groupBy("shard").applyInPandas(search, f"c1 long, c2 long, {hits}"))
        found = twins.unionByName(sorted_)
        all_found = found if all_found is None else all_found.unionByName(found)
        if not size:
            break
        hot = told.where(f"m > {HOT}").select("c1", "c2", "a", "off", "n", "twin", "data")
        if not counts.where(f"m > {HOT}").limit(1).count():
            break
        blocks = cut(hot.mapInArrow(lambda b, size=size: split_rows(b, width, size),
                                    "c1 long, c2 long, shift long, d1 long, d2 long, g1 long, g2 long, a long, off long, n long, twin boolean, data binary"))
        inner = places.join(blocks.select("c1", "c2", "shift", "d1", "d2"), ["c1", "c2"])
        places = inner.select("t1", "t2", (F.col("p") + F.col("shift")).alias("p"), F.col("d1").alias("c1"), F.col("d2").alias("c2"))
        all_places = all_places.unionByName(places)
        now = (blocks.groupBy("g1", "g2", F.col("d1").alias("c1"), F.col("d2").alias("c2"))
               .agg(F.first("a").alias("a"), F.first("off").alias("off"), F.first("n").alias("n"), ((F.count(F.lit(1)) > 1) | F.max("twin")).alias("twin"), F.first("data").alias("data")))
        # a block that agrees with no other in the bytes its windows share is settled: nothing repeats
        several = now.groupBy("g1", "g2").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
        now = now.join(several.select("g1", "g2", F.lit(True).alias("more")), ["g1", "g2"], "left").where("more OR twin").drop("more")
    return all_found, all_places
