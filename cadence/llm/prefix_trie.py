"""Prefix trie of conversations by fixed-length block hashing.

Conversations are cut into blocks of ``block`` turns. A block is named by the 128-bit digest of all turns
up to its end, so conversations are first grouped by their successive block digests: however many
share a block, one row stands for it. Only where a parent block has several different children do
siblings diverge, and only inside those blocks the single turns are told apart, on the distinct
blocks with their numbers of conversations. Elsewhere the turns of the block are nodes as they are.
The digest of the first d turns is the exclusive or of two 64-bit hashes of (place, role, text), a running total
(``operators.ordered.running``) that is cut by ranges, so that one very long conversation is no task.
Each conversation ends in a mark, which makes its end a child of its last node.

Subtree sums need no walk of the tree. A node belongs to its smallest conversation; a conversation
belongs to others up to some depth and to itself from there on. So sums over a node's subtree are sums over
its other conversations of what each has in common with smaller ones: ``saved`` adds the words that
a conversation shares, ``n_leaves`` the conversations that own a leaf. They are grouped like the nodes, again
by block first.

Null roles and texts are empty; rows with a null conversation id belong to no conversation and give none.
Turns of one number (also repeated rows) are in order of their hash. An empty table gives no row.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import narrow
from cadence.operators.ordered import arrange, running, running_again
from cadence.session import scratch_path

BLOCK, CHUNK = 8, 4096
NODE = ["depth", "x", "y"]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read by several branches."""
    path = scratch_path(df.sparkSession, f"trie-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def turn_rows(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """c, turn, a, b (hashes of role and text) and w (words of the text); texts go no further."""
    df = narrow(df, c=conv_id, turn=turn, role=role, text=text)
    r, t = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return df.where(F.col("c").isNotNull()).select(
        F.col("c").cast("long").alias("c"), F.col("turn").cast("long").alias("turn"), F.xxhash64(F.lit(1), r, t).alias("a"), F.xxhash64(F.lit(2), r, t).alias("b"),
        F.regexp_count(t, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("w"))


def sequences(own: DataFrame, lent: DataFrame | None = None, skipped: Column | int = 0) -> DataFrame:
    """c, depth, x, y (digest of the turns up to here), px, py (of those before), w, words (up to here) and
    end (the mark after the last turn). ``lent`` rows (c, turn, a, b, w) come ahead of a conversation's
    own, of which the first ``skipped`` (a column over c) go."""
    rows = own.select("c", F.lit(1).alias("src"), "turn", "a", "b", "w")
    if lent is not None:
        rows = rows.unionByName(lent.select("c", F.lit(0).alias("src"), "turn", "a", "b", "w"))
    zero = F.lit(0).cast("long")
    rows = rows.unionByName(own.select("c").distinct().select("c", F.lit(2).alias("src"), zero.alias("turn"), zero.alias("a"), zero.alias("b"), zero.alias("w")))
    rows = rows.withColumn("_one", F.lit(1).cast("long")).withColumn("_lent", (F.col("src") == 0).cast("long"))
    placed = running(rows, ["c"], ["src", "turn", "a", "b"], sums={"_at": "_one", "_ahead": "_lent"})
    skip = skipped if isinstance(skipped, Column) else F.lit(skipped)
    mine = F.col("_at") - F.col("_ahead")  # number among the conversation's own turns; the mark is one more
    depth = (F.when(F.col("src") == 0, F.col("_at")).when(F.col("src") == 1, mine - skip + F.col("_ahead"))
             .otherwise(F.greatest(mine - 1 - skip, F.lit(0)) + F.col("_ahead") + 1))
    placed = placed.where((F.col("src") != 1) | (mine > skip)).select("c", depth.cast("long").alias("depth"), "a", "b", "w", (F.col("src") == 2).alias("end"), "_range")
    mark = lambda k: F.xxhash64(F.lit(k), "end", "depth", "a", "b")
    placed = placed.withColumn("_x", mark(3)).withColumn("_y", mark(4))
    whole = running_again(placed, ["c"], sums={"words": "w"}, xors={"x": "_x", "y": "_y"})
    return whole.select("c", *NODE, F.col("x").bitwiseXOR(F.col("_x")).alias("px"), F.col("y").bitwiseXOR(F.col("_y")).alias("py"), "w", "words", "end")


def rebuilt(own: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """Sequences in which conversation c starts with the first h turns of conversation c - c % family
    and goes on with its own after the first h; h = crc32 of the id in decimal, modulo ``most``."""
    h = F.crc32(F.col("c").cast("string").cast("binary")) % most
    place = F.row_number().over(Window.partitionBy("c").orderBy(F.col("turn").asc_nulls_first(), "a", "b"))
    first = own.withColumn("turn", place.cast("long")).where(F.col("turn") < most)  # limited to these rows ahead of the shuffle
    heads = first.groupBy("c").agg(F.sort_array(F.collect_list(F.struct("turn", "a", "b", "w"))).alias("head"))
    asked = own.select("c").distinct().withColumn("h", h.cast("int")).where("h > 0").withColumn("base", F.col("c") - F.col("c") % family)
    lent = asked.join(heads.withColumnRenamed("c", "base"), "base").select("c", F.inline(F.slice("head", F.lit(1), F.col("h"))))
    return sequences(own, lent, h.cast("long"))


def _unpacked(blocks: DataFrame, *columns: str) -> DataFrame:
    """The turns of each block with the digest ahead of each."""
    ahead = F.concat(F.array(F.struct(F.col("px").alias("x"), F.col("py").alias("y"))), F.transform("turns", lambda t: F.struct(t["x"].alias("x"), t["y"].alias("y"))))
    pairs = F.arrays_zip(F.col("turns").alias("t"), F.slice(ahead, F.lit(1), F.size("turns")).alias("p"))
    return blocks.select(*columns, F.explode(pairs).alias("z")).select(*columns, "z.t.*", F.col("z.p.x").alias("px"), F.col("z.p.y").alias("py"))


def block_table(seqs: DataFrame, block: int = BLOCK) -> DataFrame:
    """c, k (number of the block), its turns, ox, oy (digest at its end) and px, py (ahead of it)."""
    turn = F.struct("depth", "x", "y", "w", "words", "end")
    got = (seqs.groupBy("c", F.expr(f"(depth - 1) div {block}").alias("k"))
           .agg(F.sort_array(F.collect_list(turn)).alias("turns"), F.min_by(F.struct("px", "py"), "depth").alias("p")))
    last = F.element_at("turns", -1)
    return got.select("c", "k", "turns", last["x"].alias("ox"), last["y"].alias("oy"), "p.*")


def nodes(blocks: DataFrame) -> DataFrame:
    """NODE, px, py, n_convs, owner (smallest conversation), w, words, end: the turns as nodes and the marks."""
    groups = written(blocks.groupBy("k", "ox", "oy").agg(F.count(F.lit(1)).alias("n_convs"), F.min("c").alias("owner"), F.first("turns").alias("turns"),
                                                         F.first("px").alias("px"), F.first("py").alias("py")), "groups")
    child = F.struct("ox", "oy")
    alone = (groups.groupBy("k", "px", "py").agg(F.min(child).alias("one"), F.max(child).alias("other"))
             .where("one = other").select("k", "one.*", F.lit(True).alias("alone")))
    told = groups.join(alone, ["k", "ox", "oy"], "left")
    rest = ["px", "py", "n_convs", "owner", "w", "words", "end"]
    whole = _unpacked(told.where("alone"), "n_convs", "owner").select(*NODE, *rest)
    apart = _unpacked(told.where("alone is null"), "n_convs", "owner")
    apart = apart.groupBy(*NODE).agg(F.first("px").alias("px"), F.first("py").alias("py"), F.sum("n_convs").alias("n_convs"), F.min("owner").alias("owner"),
                                     *[F.first(c).alias(c) for c in ("w", "words", "end")])
    zero = F.lit(0).cast("long")
    root = (groups.where("k = 0").agg(F.sum("n_convs").alias("n_convs"), F.min("owner").alias("owner")).where("n_convs > 0")
            .select(*[zero.alias(c) for c in NODE], F.lit(None).cast("long").alias("px"), F.lit(None).cast("long").alias("py"), "n_convs", "owner",
                    zero.alias("w"), zero.alias("words"), F.lit(False).alias("end")))
    return whole.unionByName(apart).unionByName(root)


def shared_sums(blocks: DataFrame, owners: DataFrame) -> DataFrame:
    """NODE, shared (sum over the node's conversations but its owner of the words each has in common with
    smaller conversations) and leaves (how many of them own a leaf)."""
    start = F.element_at("turns", 1)["depth"]
    real = F.size(F.filter("turns", lambda t: ~t["end"]))
    b = blocks.join(owners.select("c", "birth", "common", "leaf"), "c", "left")
    b = b.withColumn("upto", F.when(F.col("birth").isNull(), real).otherwise(F.least(real, F.col("birth") - start)).cast("int")).where("upto > 0")
    # a conversation that owns no node has all its words in common, known from its last turns only
    total = blocks.where(F.element_at("turns", -1)["end"]).select("c", F.element_at("turns", -1)["words"].alias("total"))
    b = b.join(total, "c").withColumn("turns", F.slice("turns", F.lit(1), F.col("upto")))
    last = F.element_at("turns", -1)
    groups = b.groupBy(last["depth"].alias("d"), last["x"].alias("lx"), last["y"].alias("ly")).agg(
        F.sum(F.coalesce("common", "total")).alias("shared"), F.sum(F.coalesce("leaf", F.lit(0).cast("long"))).alias("leaves"), F.first("turns").alias("turns"))
    each = groups.select("shared", "leaves", F.explode("turns").alias("t")).select("t.depth", "t.x", "t.y", "shared", "leaves")
    below = each.groupBy(*NODE).agg(F.sum("shared").alias("shared"), F.sum("leaves").alias("leaves"))
    others = owners.where("birth > 0").agg(F.sum("common").alias("s"), F.sum("leaf").alias("n"))
    unborn = total.join(owners, "c", "left_anti").agg(F.sum("total").alias("s"))
    zero = F.lit(0).cast("long")
    root = others.crossJoin(unborn.withColumnRenamed("s", "u")).select(  # one row each
        *[zero.alias(c) for c in NODE], (F.coalesce("s", zero) + F.coalesce("u", zero)).alias("shared"), F.coalesce("n", zero).alias("leaves"))
    return below.unionByName(root)


def end_hashes(seqs: DataFrame) -> DataFrame:
    """NODE and ends_sha256: the hash of the ids, ascending and comma-joined, of the conversations that end there.
    Sorted ids are joined in chunks where they lie; a node's chunks are hashed as a stream."""
    ends = seqs.where("end").select((F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y"), "c")

    def chunks(batches):
        key, first, ids = None, None, []
        for batch in batches:
            done = []
            for *at, c in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                if at != key or len(ids) == CHUNK:
                    if ids:
                        done.append((*key, first, ",".join(ids)))
                    key, first, ids = at, c, []
                ids.append(str(c))
            yield rows(done)
        if ids:
            yield rows([(*key, first, ",".join(ids))])

    def rows(done):
        columns = list(zip(*done, strict=True)) or [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 4 + [pa.string()], strict=True)], names=[*NODE, "first", "ids"])

    def digests(batches):
        key, digest = None, None
        for batch in batches:
            done = []
            for *at, ids in zip(*[batch.column(i).to_pylist() for i in (0, 1, 2, 4)], strict=True):
                if at != key:
                    if key is not None:
                        done.append((*key, digest.hexdigest()))
                    key, digest = at, hashlib.sha256(ids.encode())
                else:
                    digest.update(f",{ids}".encode())
            yield hashed(done)
        if key is not None:
            yield hashed([(*key, digest.hexdigest())])

    def hashed(done):
        columns = list(zip(*done, strict=True)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 3 + [pa.string()], strict=True)], names=[*NODE, "ends_sha256"])

    joined = arrange(ends, NODE, ["c"]).drop("_range").mapInArrow(chunks, "depth long, x long, y long, first long, ids string")
    return joined.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(digests, "depth long, x long, y long, ends_sha256 string")


def trie(seqs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row for each node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (words that members have in common below and at the node) and ends_sha256."""
    seqs = written(seqs, "turns")
    blocks = written(block_table(seqs, block), "blocks")
    known = written(nodes(blocks), "nodes").where("not end")
    parents = known.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")).agg(F.count(F.lit(1)).alias("n_children"))
    tree = written(known.join(parents, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "tree")
    births = tree.groupBy("owner").agg(F.min_by(F.struct("depth", "px", "py", (F.col("words") - F.col("w")).alias("common")), "depth").alias("b"),
                                       F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    births = births.select(F.col("owner").alias("c"), F.col("b.depth").alias("birth"), "b.px", "b.py", "b.common", "leaf")
    above = tree.select((F.col("depth") + 1).alias("birth"), F.col("x").alias("px"), F.col("y").alias("py"), F.col("owner").alias("above"))
    owners = written(births.join(above, ["birth", "px", "py"], "left").select("c", "birth", "common", "leaf", "above"), "owners")
    out = tree.join(shared_sums(blocks, owners), NODE, "left").join(end_hashes(seqs), NODE, "left").join(owners.withColumnRenamed("c", "owner"), "owner")
    zero = F.lit(0).cast("long")
    return out.select(
        F.col("owner").alias("conv_id"), "depth", F.when(F.col("depth") > F.col("birth"), F.col("owner")).otherwise(F.col("above")).alias("parent_conv_id"),
        "n_convs", "n_children", (F.col("leaf") + F.coalesce("leaves", zero)).alias("n_leaves"),
        (F.coalesce("shared", zero) - (F.col("n_convs") - 1) * (F.col("words") - F.col("w"))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def conversation_trie(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", family: int = 20, most: int = 4,
                      block: int = BLOCK) -> DataFrame:
    """The trie of the rebuilt conversations of ``df``."""
    own = written(turn_rows(df, conv_id, turn, role, text), "own")  # texts are read and hashed once
    return trie(rebuilt(own, family, most), block)
