"""Prefix trie of conversations: which openings are shared, and how much a shared one saves.

A turn becomes a digest and a length at once, so no shuffle carries texts. Turn numbers and digests of prefixes are running
values over ranges of the turns: a conversation of any length is spread over many tasks, like any other rows. A node
of the trie is a group of equal prefixes, reduced before its shuffle. Sums over subtrees come from an Euler tour
(``euler_tour``). A prefix is known by its length and 128 bits made of SHA-256 digests of its turns.

Defined cases: rows without a conversation id belong to no conversation and are left out. A null role or text is empty. Turns
are ordered by number, null first, equal numbers by role and digest; repeated rows are turns of their own. Without
conversations there is no node, not even a root. Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.euler_tour import WALK, subtree_sums
from shelfcast.llm.running import running
from shelfcast.llm.tables import written

# Ids joined to one string before they are hashed together.
IDS = 4096


def turns(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, chars): the turns of every conversation, numbered from 1.

    Equal rows are counted before the numbering, so that a heap of copies is one row of it.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    short = rows.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), digest.alias("digest"), F.length(text).cast("long").alias("chars")
    )
    counted = short.groupBy("conv_id", "turn", "role", "digest").agg(F.max("chars").alias("chars"), F.count("*").alias("n"))
    numbered = running(counted, ["conv_id", "turn", "role", "digest"], ["conv_id"], {"upto": ("sum", "n")}, "turns")
    return numbered.select("conv_id", F.explode(F.sequence(F.col("upto") - F.col("n") + 1, F.col("upto"))).alias("pos"), "digest", "chars")


def rebuilt(own: DataFrame, every: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """(conversations with their new length, their new turns).

    The first h turns of a conversation give way to those of the one whose id is the multiple of ``every`` at or
    below its own; h is the CRC-32 of the id modulo ``heads``. The lookup side holds the few first turns of one
    conversation per hundred, and each is asked for by a hundred.
    """
    c = F.col("conv_id")
    convs = own.groupBy("conv_id").agg(F.count("*").alias("n_own")).select(
        "conv_id", "n_own", (c - c % every).alias("source"), (F.crc32(c.cast("string")) % heads).cast("int").alias("h")
    )
    first = own.where((F.col("pos") < heads) & (c % every == 0)).groupBy(c.alias("source")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "digest", "chars"))).alias("head")
    )
    shared = F.least(F.coalesce(F.size("head"), F.lit(0)), F.col("h"))
    convs = convs.join(first, "source", "left").withColumn("shared", F.when(F.col("head").isNull(), 0).otherwise(shared).cast("int"))
    convs = convs.withColumn("length", (F.col("shared") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).cast("int"))
    convs = written(convs, "conversations")
    taken = convs.where("shared > 0").select("conv_id", "length", F.explode(F.slice("head", 1, F.col("shared"))).alias("t"))
    taken = taken.select("conv_id", "length", F.col("t.pos").cast("int").alias("i"), "t.digest", "t.chars")
    rest = own.join(convs.select("conv_id", "h", "shared", "length"), "conv_id").where("pos > h")
    rest = rest.select("conv_id", "length", (F.col("pos") - F.col("h") + F.col("shared")).cast("int").alias("i"), "digest", "chars")
    return convs.select("conv_id", "length"), taken.unionByName(rest)


def prefixes(rows: DataFrame) -> DataFrame:
    """Each turn with the 128 bits of its prefix (p1, p2) and of the one before (q1, q2).

    The digest of a prefix is the exclusive or of what its turns and their places hash to: a running value that needs no order of
    evaluation, unlike a chain.
    """
    placed = rows.withColumns({"x1": F.xxhash64("i", "digest"), "x2": F.xxhash64(F.lit(7), "digest", "i")})
    run = running(placed, ["conv_id", "i"], ["conv_id"], {"p1": ("xor", "x1"), "p2": ("xor", "x2")}, "prefixes")
    return run.withColumns({"q1": F.col("p1").bitwiseXOR(F.col("x1")), "q2": F.col("p2").bitwiseXOR(F.col("x2"))})


def joined_digests(members: DataFrame) -> DataFrame:
    """SHA-256 of the ids of each (depth, p1, p2), in order and joined by commas.

    The ids are sorted by ranges of (node, id) and joined to strings of bounded length there; the task that
    hashes a node streams its strings. SHA-256 allows no other order, but what reaches the task is ids, no turns.
    """
    order = ["depth", "p1", "p2", "conv_id"]
    key = order[:3]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("conv_id").to_numpy()
            if not len(ids):
                continue
            cols = [batch.column(k).to_numpy() for k in key]
            fresh = np.zeros(len(ids), bool)
            fresh[::IDS] = True
            for k in cols:
                fresh[1:] |= k[1:] != k[:-1]
            starts = np.flatnonzero(fresh)
            ends = np.r_[starts[1:], len(ids)]
            text = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(starts, ends)]
            yield pa.RecordBatch.from_arrays([*[pa.array(k[starts]) for k in cols], pa.array(ids[starts]), pa.array(text)], names=[*order, "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            done = []
            cols = [batch.column(k).to_pylist() for k in key]
            for *node, ids in zip(*cols, batch.column("ids").to_pylist()):
                if node != at:
                    if state is not None:
                        done.append((*at, state.hexdigest()))
                    at, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield from out(done)
        if state is not None:
            yield from out([(*at, state.hexdigest())])

    def out(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        if rows:
            d, a, b, h = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(d, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(h)], names=[*key, "ends_sha256"])

    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = members.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    strings = ranged.mapInArrow(join, "depth int, p1 long, p2 long, conv_id long, ids string")
    return strings.repartition(parts, *key).sortWithinPartitions(*order).mapInArrow(digest, "depth int, p1 long, p2 long, ends_sha256 string")


def trie(conversations: DataFrame, every: int = 100, heads: int = 6, walk: int = WALK) -> DataFrame:
    """One row per node of the trie of rebuilt conversations; see the module and ``rebuilt``.

    Columns: conv_id (the least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    own = written(turns(conversations.select("conv_id", "turn", "role", "text")), "turns")
    convs, rows = rebuilt(own, every, heads)
    rows = prefixes(rows)
    none = [F.lit(0).cast("long").alias(n) for n in ("p1", "p2", "q1", "q2")]
    root = convs.groupBy().agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    root = root.select(F.lit(0).alias("depth"), *none, "n_convs", "conv_id", F.lit(0).cast("long").alias("chars"))
    nodes = rows.groupBy(F.col("i").alias("depth"), "p1", "p2").agg(
        F.min("q1").alias("q1"), F.min("q2").alias("q2"), F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("chars").alias("chars")
    )
    nodes = written(nodes.select(*root.columns).unionByName(root), "nodes")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.join(above, ["depth", "q1", "q2"], "left").withColumn("parent", F.coalesce("parent_conv_id", F.lit(0)))
    # Least member first among the children of a node; the root is the only node of depth 0.
    nodes = running(nodes, ["depth", "parent", "conv_id"], ["depth", "parent"], {"elder": ("last", "conv_id")}, "siblings")
    below = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("conv_id")).agg(
        F.count("*").alias("n_children"), F.min("conv_id").alias("first_child"), F.max("conv_id").alias("last_child")
    )
    nodes = nodes.join(below, ["depth", "conv_id"], "left").withColumns(
        {
            "n_children": F.coalesce("n_children", F.lit(0).cast("long")),
            "saved_tokens": (F.col("n_convs") - 1) * F.col("chars"),
        }
    )
    nodes = written(nodes.withColumn("n_leaves", (F.col("n_children") == 0).cast("long")), "trie")
    sums = subtree_sums(nodes, ["n_leaves", "saved_tokens"], walk)
    ended = rows.where("i = length").select(F.col("i").alias("depth"), "p1", "p2", "conv_id")
    ended = ended.unionByName(convs.where("length = 0").select(F.lit(0).alias("depth"), *none[:2], "conv_id"))
    out = nodes.drop("n_leaves", "saved_tokens").join(sums, ["conv_id", "depth"]).join(joined_digests(ended), ["depth", "p1", "p2"], "left")
    empty: Column = F.sha2(F.lit(""), 256)
    return out.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", empty).alias("ends_sha256"),
    )
