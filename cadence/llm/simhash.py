"""SimHash near-dedup: fingerprints, links within a few bits by sharded BK-trees, components.

Fingerprint: A-Z are lower-cased, words are runs of other characters than \\x20 and
\\x09-\\x0D, shingles of ``width`` words (repeats included, one space between; fewer words:
the whole sequence) are hashed by XXH64 with seed 42, and a bit is set if it is set in
over half of the hashes. No word (null, empty or white space): fingerprint zero, linked like any other.

Links: only distinct fingerprints travel. Two of them that differ in at most 3 bits agree in
one of any 4 parts of their bits, and again in one of 4 parts of the rest, so a fingerprint goes to
16 shards, each holding those that agree in 28 bits. Within a shard a BK-tree (children keyed
by their distance to the parent) is built level by level and searched for every member,
following only edges within the radius. A shard with over ``HOT`` members is refined by the
same rule to 44 and then 53 bits, which leaves at most 2 ** 11 members: no shard is
unbounded, none is cut. Trees are built where their shard is, not broadcast: sending every tree to
every task would compare all fingerprints with all trees.

Components: each shard emits a star of links to the smallest fingerprint of each of its
groups; large-star and small-star rounds over these links, each written to the checkpoint
folder, join them into components. Fingerprints and links never reach the driver.

component_id is the smallest non-null doc_id of the component (null if there is none).
Repeated rows and ids keep one row each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import append, cut, narrow, passed

HOT = 4096
FULL = (1 << 64) - 1


def fingerprint(text: str | None, width: int = 3) -> int:
    """Unsigned 64-bit SimHash of a whole text."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = max(0, len(words) - width)
    xx = xxhash.xxh64_intdigest
    if last == 0:
        return xx(line, 42)  # one hash: its bits are all in over half
    ones, n = np.zeros(64, np.int64), last + 1
    a, b = starts[:n].tolist(), ends[width - 1:].tolist()
    for k in range(0, n, 65536):
        h = np.array([xx(line[i:j], 42) for i, j in zip(a[k:k + 65536], b[k:k + 65536], strict=True)], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, text: str = "text", width: int = 3, name: str = "fp") -> DataFrame:
    """``df`` with the fingerprint as a signed long in column ``name``."""

    def work(texts):
        return [np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64)]

    return append(df, text, f"{name} long", lambda: work)


def masks(depth: int) -> list[int]:
    """Bits that a shard agrees in: at each step one of 4 parts of the bits that are still free."""
    found = [0]
    for _ in range(depth):
        more = []
        for m in found:
            free = [b for b in range(64) if not m >> b & 1]
            at = [round(len(free) * k / 4) for k in range(5)]
            more += [m | sum(1 << b for b in free[i:j]) for i, j in zip(at, at[1:])]
        found = more
    return found


def links(group: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (x, smallest of its group's component) between members of equal ``group`` numbers,
    by BK-trees of all groups at once; ``group`` is ascending."""
    n = len(fp)
    label = np.arange(n)
    # build: a node stands for the first of its members, the others go to children by distance to it
    parent, members = group.astype(np.int64), np.arange(n)
    nodes, edge_parent, edge_key, up = [], [], [], None
    dist = np.zeros(n, np.int64)
    while len(members):
        order = np.lexsort((members, dist[members], parent[members]))
        members = members[order]
        p, d = parent[members], dist[members]
        new = np.concatenate([[True], (p[1:] != p[:-1]) | (d[1:] != d[:-1])])
        head = members[new][np.cumsum(new) - 1]
        nodes.append(members[new])
        edge_parent.append(p[new] if up is not None else np.full(int(new.sum()), -1))
        edge_key.append(d[new])
        up = True
        rest = members != head
        members, head = members[rest], head[rest]
        parent[members] = head
        dist[members] = np.bitwise_count(fp[members] ^ fp[head])
    node, over, key = np.concatenate(nodes), np.concatenate(edge_parent), np.concatenate(edge_key)
    roots = node[over < 0]
    root_of = np.full(int(group.max()) + 1, -1)
    root_of[group[roots]] = roots
    child = over >= 0
    code = over[child] * 128 + key[child]
    order = np.argsort(code, kind="stable")
    code, kids = code[order], node[child][order]
    # search: all members together, a level at a time
    for at in range(0, n, 2048):
        q = np.arange(at, min(n, at + 2048))
        x = root_of[group[q]]
        pairs_a, pairs_b = [], []
        while len(q):
            for lo in range(0, len(q), 4_000_000):
                a, b = q[lo:lo + 4_000_000], x[lo:lo + 4_000_000]
                near = (np.bitwise_count(fp[a] ^ fp[b]) <= radius) & (a != b)
                pairs_a.append(a[near])
                pairs_b.append(b[near])
            d = np.bitwise_count(fp[q] ^ fp[x]).astype(np.int64)
            left = np.searchsorted(code, x * 128 + np.maximum(d - radius, 0), "left")
            right = np.searchsorted(code, x * 128 + d + radius, "right")
            many = right - left
            q = np.repeat(q, many)
            x = kids[np.repeat(left - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(len(q))] if len(q) else q
        label = join(label, np.concatenate(pairs_a), np.concatenate(pairs_b))
    out = label != np.arange(n)
    return np.flatnonzero(out), label[out]


def join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after linking a to b: every member has the smallest label of its component."""
    while len(a):
        la, lb = label[a], label[b]
        differ = la != lb
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        if len(a):
            np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
            while not np.array_equal(label, label[label]):
                label = label[label]
    return label


def shard_links(radius: int):
    """Rows (key, fp) sorted by (key, fp) to links (a, b), a the larger (signed) fingerprint."""

    def solve(key: np.ndarray, fp: np.ndarray):
        first = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.cumsum(first) - 1
        many = np.bincount(group)[group] > 1
        if not many.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        group, fp = np.unique(group[many], return_inverse=True)[1], fp[many]
        x, y = links(group, fp.view(np.uint64), radius)
        return fp[x], fp[y]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            k, f = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            key, fp = np.concatenate([key, k]), np.concatenate([fp, f])
            at = int(np.searchsorted(key == key[-1], True)) if len(key) else 0  # the last shard may go on
            if at > 50_000:
                a, b = solve(key[:at], fp[:at])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                key, fp = key[at:], fp[at:]
        if len(key):
            a, b = solve(key, fp)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def near_links(fps: DataFrame, radius: int = 3) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints ``fps`` (column fp) as all links within ``radius`` (at most 3) bits do."""
    if not 0 <= radius <= 3:
        raise ValueError("shards are dealt for a radius of at most 3 bits")
    spark = fps.sparkSession
    out, todo = None, fps.select("fp", F.lit(None).cast("long").alias("inside"))
    for depth in (2, 4, 6):
        plan = masks(depth)
        # inside: number of the mask that a hot shard of the last round agreed in
        if depth == 2:
            keyed = todo.select("fp", F.explode(F.array(*[F.struct(F.lit(k).alias("m"), F.col("fp").bitwiseAND(F.lit(signed(m)).cast("long")).alias("v")) for k, m in enumerate(plan)])).alias("s"))
        else:
            more = spark.createDataFrame([(k // 16, k, signed(m)) for k, m in enumerate(plan)], "inside long, m int, mask long")
            keyed = todo.join(F.broadcast(more), "inside").select("fp", F.struct("m", F.col("fp").bitwiseAND(F.col("mask")).alias("v")).alias("s"))
        keyed = keyed.select("fp", F.col("s.m").cast("long").alias("m"), F.xxhash64("s.m", "s.v").alias("key"))
        if depth < 6:
            hot = cut(keyed.groupBy("key", "m").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT).select("key", "m"))
            n_hot = hot.count()
            cold = keyed.join(hot, ["key", "m"], "left_anti") if n_hot else keyed
        else:
            n_hot, cold = 0, keyed
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        got = cold.select("key", "fp").repartition(parts, "key").sortWithinPartitions("key", "fp").mapInArrow(shard_links(radius), "a long, b long")
        out = got if out is None else out.unionByName(got)
        if not n_hot:
            break
        todo = cut(keyed.join(hot, ["key", "m"]).select("fp", F.col("m").alias("inside")).distinct())
    return out.distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node of each component of the links (a, b); nodes without a link are left out."""

    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:  # each node hands its larger neighbours to the smallest of its neighbours and itself
            both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
            least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
            return both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
        least = e.groupBy("a").agg(F.min("b").alias("m"))
        return (e.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
                .where("a > b").distinct())

    sign = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct())
    before = sign(edges)
    while before[0]:
        edges = cut(star(star(edges, True), False))
        now = sign(edges)
        if now == before:
            break
        before = now
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def groups(keyed: DataFrame, radius: int = 3) -> DataFrame:
    """fp, root, component_id for each distinct fingerprint of ``keyed`` (columns doc_id, fp)."""
    fps = cut(keyed.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = components(near_links(fps, radius))
    at = fps.join(found, fps.fp == found.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    low = at.groupBy("root").agg(F.min("least").alias("component_id"))
    return at.join(low, "root").select("fp", "root", "component_id")


def near_dedup(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, radius: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id, one row for each input row."""
    keyed = cut(fingerprints(narrow(df, doc_id=doc_id, text=text), "text", width).select("doc_id", "fp"))
    return keyed.join(groups(keyed, radius), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, radius: int = 3) -> DataFrame:
    """``df`` with one row of each component: that of the smallest doc_id, ties by the other columns."""
    marked = passed(fingerprints(df, text, width, "_fp"), "simhash")  # read twice: the fingerprints are worked out once
    keyed = cut(marked.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col("_fp").alias("fp")))
    found = groups(keyed, radius).select(F.col("fp").alias("_fp"), F.col("root").alias("_root"), F.col("component_id").alias("_least"))
    first = marked.join(found, "_fp").where(F.col(f"`{doc_id}`").eqNullSafe(F.col("_least")))
    order = Window.partitionBy("_root").orderBy(F.xxhash64(*[f"`{c}`" for c in df.columns]), *[F.col(f"`{c}`") for c in df.columns if dict(df.dtypes)[c] != "map"])
    return first.withColumn("_k", F.row_number().over(order)).where("_k = 1").select(*[f"`{c}`" for c in df.columns])
