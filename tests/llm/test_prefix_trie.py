"""Running values, list ranking and the trie against plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict
from functools import reduce

import pytest
from pyspark.sql import functions as F

from shelfcast.llm.euler_tour import list_ranks
from shelfcast.llm.prefix_trie import IDS, joined_digests, trie
from shelfcast.llm.running import running

FIELDS = "conv_id long, turn long, role string, text string"


def plain(rows, every=100, heads=6):
    """Nodes by the definition: prefixes as tuples, subtrees by walking down."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, role, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), text))
    own = {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in own.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        new = tuple(own.get(c - (c % every if c >= 0 else -(-c % every)), [])[:h] + ts[h:])
        for d in range(len(new) + 1):
            members[new[:d]].add(c)
        ends[new].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0) + sum(saved[k] for k in kids[node])
    return sorted(
        (min(m), len(n), min(members[n[:-1]]) if n else -1, len(m), len(kids[n]), leaves[n], saved[n], hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest())
        for n, m in members.items()
    )


def nodes(df, **more):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    out = trie(df, **more)
    assert out.columns == names and all(t == "bigint" for _, t in out.dtypes[:-1])
    return sorted(tuple(-1 if x is None else x for x in r) for r in out.collect())


def sample(n=260, seed=2):
    rng = random.Random(seed)
    say = lambda: rng.choice(["hello", "hi", "Étude 日本", "", "what is new", "a longer remark \U0001f600"])
    rows = []
    for c in range(n):
        if c % 7 == 3:
            continue
        opening = [("user", "hello"), ("assistant", "hi")] if rng.random() < 0.6 else []
        ts = opening + [(rng.choice(["user", "assistant", None]), say()) for _ in range(rng.randint(0, 9))]
        rows += [(c * 3, i, r, t) for i, (r, t) in enumerate(ts)]
    return rows


ODD = [
    (None, 0, "user", "nobody's turn"), (5, None, "user", "first"), (5, 0, None, None), (5, 0, "b", "tie"), (5, 0, "a", "tie"), (5, 1, "x", "twice"), (5, 1, "x", "twice"),
    (100, 0, "user", "only"), (100, 1, "user", ""), (101, None, None, None), (102, 3, "user", "no such head"), (-7, 0, "user", "below zero"), (205, 0, "user", "one"),
    *[(300, i, "user", f"line {i % 3}") for i in range(700)], *[(301 + i, 0, "user", "same") for i in range(40)],
]


@pytest.mark.parametrize("rows, every, heads", [(sample(), 100, 6), (ODD, 100, 6), (sample(90, 8), 10, 3)], ids=["sample", "odd", "parameters"])
def test_against_plain_tries(spark, rows, every, heads):
    df = spark.createDataFrame(rows, FIELDS).withColumn("depth", F.lit("clash")).repartition(5)
    assert nodes(df, every=every, heads=heads, walk=64) == plain(rows, every, heads)


def test_no_conversations(spark):
    assert nodes(spark.createDataFrame([], FIELDS)) == []
    assert nodes(spark.createDataFrame(ODD[:1], FIELDS)) == []


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_running_values_over_many_ranges(spark, partitions):
    rng = random.Random(partitions)
    rows = [(0 if i % 3 == 0 else rng.randint(1, 40), i, rng.randint(-(2**40), 2**40)) for i in range(600)]
    df = spark.createDataFrame(rows, "k long, i long, v long").repartition(9)
    values = {"s": ("sum", "v"), "x": ("xor", "v"), "b": ("last", "v")}
    got = {r.i: (r.s, r.x, r.b) for r in running(df, ["k", "i"], ["k"], values, "t", partitions).collect()}
    groups = defaultdict(list)
    for k, i, v in sorted(rows):
        groups[k].append((i, v))
    for vs in groups.values():
        seen = []
        for i, v in vs:
            before = seen[-1] if seen else None
            seen.append(v)
            assert got[i] == (sum(seen), reduce(lambda a, b: a ^ b, seen), before)
    whole = {r.i: r.s for r in running(df, ["i"], [], {"s": ("sum", "v")}, "t", partitions).collect()}
    total = 0
    for _, i, v in sorted(rows, key=lambda r: r[1]):
        total += v
        assert whole[i] == total


@pytest.mark.parametrize("n", [1, 2, 500])
def test_list_ranks(spark, n):
    order = list(range(n))
    random.Random(n).shuffle(order)
    links = [(c, c % 5, order[i + 1] if i + 1 < n else None, order[i + 1] % 5 if i + 1 < n else None) for i, c in enumerate(order)]
    ranks = list_ranks(spark.createDataFrame(links, "c long, a long, nc long, na long"), walk=8)
    assert {r.c: r["rank"] for r in ranks.collect()} == {c: n - 1 - i for i, c in enumerate(order)}


def test_digests_of_many_members(spark):
    ids = [*range(-20, 3 * IDS)]
    rows = spark.range(-20, 3 * IDS).select(F.lit(1).alias("depth"), F.lit(5).cast("long").alias("p1"), F.lit(-3).cast("long").alias("p2"), F.col("id").alias("conv_id"))
    assert [r.ends_sha256 for r in joined_digests(rows.repartition(6)).collect()] == [hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()]
