"""Near-duplicate groups: exact Jaccard links on word shingles by a grouped prefix join.

1. Documents with equal shingle sets form a class; all later work is on classes.
2. A class can only link if few of its shingles are its own. A hashed part of all shingles is counted
   over the corpus; a class whose unique shingles alone fill its prefix is ready.
3. The shingles of the rest are ordered by document frequency. Two classes that link share a shingle
   among the first ``n - ceil(t n) + 1`` of both. Classes with the same prefix and size form one group.
4. Group pairs that share a prefix shingle pass the size and the position filter. A shingle of more than
   ``LONG_LIST`` groups yields no pairs: its groups meet in a hub per size band, so its rows stay
   linear. Components of pairs and hubs hold every pair that can link.
5. The groups are expanded and verified exactly inside their component. Components of up to ``AT_ONCE``
   classes are verified in one task. Larger ones compare all members with chosen pivots, round after round, until
   the members that never were a pivot have one label; a pair is then either linked through others or
   has been compared. Work there is members times pivots, split over tasks, and no pair is skipped.

Defined cases: a null text counts as empty; a document without words has no shingles and links with
nothing; under ``k`` words the whole sequence is one shingle; repeated rows are members each. Links are between texts, so a
row with a null id or an id that occurs twice links like any other; it takes the component of its class, which is null
if no member has an id. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm import text_hash as th
from shelfcast.llm.components import connected_components
from shelfcast.llm.tables import written

WORDS = 5
PERCENT = 75
#: Shares of the hash space whose shingles are counted over the corpus, in fifths.
COUNTED_FIFTHS = 2
LONG_LIST = 64
AT_ONCE = 512
PIVOTS = 128
#: Members of one task when a large component is compared with its pivots.
TASK_MEMBERS = 2_000
#: Surviving classes, of about 60 bytes each, are broadcast up to this number and shuffled beyond; the rows are the same.
BROADCAST_ROWS = 100_000
_U = np.uint64


def _set_key(x: np.ndarray) -> tuple[int, int]:
    """128 bits that do not depend on the order of the set."""
    return int(th.mix(x).sum(dtype=np.uint64).view(np.int64)), int(th.mix(x ^ _U(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64).view(np.int64))


def shingle_keys(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """id, tid, n (distinct shingles) and the 128-bit key of the set, for rows (id, tid, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(len(x), *_set_key(x)) for x in th.shingle_sets(batch.column("text"), k)]
            n, k1, k2 = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("tid"), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64())],
                ["id", "tid", "n", "k1", "k2"],
            )

    return docs.mapInArrow(run, "id long, tid long, n long, k1 long, k2 long")


def _counted_shingles(docs: DataFrame, k: int) -> DataFrame:
    """(shingle, k1) of the counted part of the hash space; sets seen in the same batch only once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[tuple[int, int]] = set()
            parts, owners, size = [], [], 0
            for x in th.shingle_sets(batch.column("text"), k):
                key = _set_key(x)
                if key in seen:
                    continue
                seen.add(key)
                part = x[x % _U(5) < _U(COUNTED_FIFTHS)]
                parts.append(part)
                owners.append(np.full(len(part), key[0], np.int64))
                size += len(part)
                if size > 500_000:
                    yield _pairs(parts, owners)
                    parts, owners, size = [], [], 0
            yield _pairs(parts, owners)

    def _pairs(parts: list[np.ndarray], owners: list[np.ndarray]) -> pa.RecordBatch:
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        return pa.RecordBatch.from_arrays([pa.array(join(parts, np.uint64).view(np.int64)), pa.array(join(owners, np.int64))], ["h", "k1"])

    return docs.select("text").mapInArrow(run, "h long, k1 long")


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """cid, n, shingles (sorted, little-endian) of rows (text, cid, n, k1, k2) whose text has that key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = zip(*(batch.column(c).to_pylist() for c in ("cid", "k1", "k2")))
            rows = [(c, len(x), x.tobytes()) for (c, k1, k2), x in zip(wanted, th.shingle_sets(batch.column("text"), k)) if _set_key(x) == (k1, k2)]
            c, n, x = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(n, pa.int64()), pa.array(x, pa.binary())], ["cid", "n", "shingles"])

    return docs.mapInArrow(run, "cid long, n long, shingles binary")


def _tokens(sets: DataFrame) -> DataFrame:
    """(h, cid, n), a row per shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                n = part.column("n").to_numpy()
                h = np.frombuffer(b"".join(part.column("shingles").to_pylist()), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(np.repeat(part.column("cid").to_numpy(), n)), pa.array(np.repeat(n, n))], ["h", "cid", "n"])

    return sets.mapInArrow(run, "h long, cid long, n long")


def prefix_length(n: Column, percent: int) -> Column:
    return n - F.ceil(n * percent / 100) + 1


def _survivors(docs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """Classes that still can link: their unique shingles do not fill the prefix."""
    seen = _counted_shingles(docs, k).groupBy("h").agg(F.min("k1").alias("k1"), F.max("k1").alias("other"))
    unique = seen.filter("k1 = other").groupBy("k1").agg(F.count("*").alias("unique"))
    left = classes.join(unique, "k1", "left").filter(F.coalesce("unique", F.lit(0)) < prefix_length(F.col("n"), percent))
    return written(left.select("cid", "rep", "n", "k1", "k2"), "survivors")


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(cid, n, h, pos): the shared shingles in the prefix of each class, with their place in the order."""
    tokens = _tokens(sets)
    df = tokens.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1")
    shared = tokens.join(df, "h")
    rare_first = Window.partitionBy("cid").orderBy("df", "h")
    count = F.count("*").over(Window.partitionBy("cid"))
    ranked = shared.withColumn("pos", F.col("n") - count + F.row_number().over(rare_first) - 1)
    return written(ranked.filter(F.col("pos") < prefix_length(F.col("n"), percent)).select("cid", "n", "h", "pos"), "prefixes")


def _candidates(prefixes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(members, edges): the group of each class, and edges between groups and hubs."""
    # Classes with a shingle of their own in the prefix start at pos > 0 and are alone.
    own = prefixes.groupBy("cid", "n").agg(F.min("pos").alias("first"), F.sort_array(F.collect_list(F.struct("pos", "h"))).alias("prefix"))
    alone = F.when(F.col("first") > 0, F.col("cid"))
    own = own.select("cid", "n", alone.alias("alone"), F.xxhash64("prefix").alias("p1"), F.xxhash64(F.lit(1), "prefix").alias("p2"))
    groups = own.groupBy("n", "alone", "p1", "p2").agg(F.min("cid").alias("gid"))
    keys = [own[c].eqNullSafe(groups[c]) for c in ("n", "alone", "p1", "p2")]
    members = written(own.join(groups, reduce(Column.__and__, keys)).select(own["cid"], "gid"), "members")

    leaders = members.filter("cid = gid").select("gid", "cid")
    postings = prefixes.join(leaders, "cid").select("h", "gid", "n", "pos")
    lists = postings.groupBy("h").agg(F.count("*").alias("groups")).filter("groups > 1")
    postings = written(postings.join(lists, "h"), "postings")
    short = postings.filter(F.col("groups") <= LONG_LIST)
    a, b = short.alias("a"), short.alias("b")
    least = F.ceil((F.col("a.n") + F.col("b.n")) * percent / (100 + percent))
    fits = (
        (F.col("a.h") == F.col("b.h")) & (F.col("a.gid") < F.col("b.gid"))
        & (100 * F.least("a.n", "b.n") >= percent * F.greatest("a.n", "b.n"))
        & (F.least(F.col("a.n") - F.col("a.pos"), F.col("b.n") - F.col("b.pos")) >= least)
    )
    pairs = a.join(b, fits).select(F.col("a.gid").alias("a"), F.col("b.gid").alias("b")).distinct()
    long = postings.filter(F.col("groups") > LONG_LIST)
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)) + 1e-9)
    hub = lambda b: F.xxhash64(F.col("h"), b).bitwiseOR(F.lit(-(1 << 63)))  # noqa: E731  hubs are negative, classes are not
    banded = long.select("h", "gid", band.alias("band"))
    # Sizes that fit lie in the same band or in neighbours.
    spokes = banded.select("gid", F.explode(F.array(hub(F.col("band")), hub(F.col("band") + 1))).alias("hub"))
    # Groups of a cluster share their hubs: a group is tied to its first hub, and that one to the others once.
    first = spokes.groupBy("gid").agg(F.min("hub").alias("first"))
    hubs = spokes.join(first, "gid").select(F.col("first").alias("a"), F.col("hub").alias("b")).distinct()
    return members, pairs.union(first.select(F.col("gid").alias("a"), F.col("first").alias("b"))).union(hubs)


def _links(x: list[np.ndarray], y: list[np.ndarray] | None, percent: int) -> np.ndarray:
    """Which sets of x and y link, as a matrix; shared shingles are counted by products of incidence blocks."""
    both = x if y is None else [*x, *y]
    sizes = np.array([len(s) for s in both])
    rows = np.repeat(np.arange(len(both)), sizes)
    values, columns = np.unique(np.concatenate(both), return_inverse=True)
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    m = len(x)
    shared = np.zeros((m, m if y is None else len(y)), np.float32)
    step = max(256, 8_000_000 // max(1, len(both)))
    edges = np.searchsorted(columns, np.arange(0, len(values) + step, step))
    for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        block = np.zeros((len(both), step), np.float32)
        block[rows[lo:hi], columns[lo:hi] - i * step] = 1
        shared += block[:m] @ (block if y is None else block[m:]).T
    total = sizes[:m, None] + (sizes[:m] if y is None else sizes[m:])[None, :]
    return (100 * shared.astype(np.int64)) >= percent * (total - shared.astype(np.int64))


def _labels(linked: np.ndarray) -> np.ndarray:
    """Least index that each row reaches."""
    label = np.arange(len(linked))
    while True:
        near = np.where(linked, label[None, :], len(linked)).min(axis=1)
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _verify_small(rows: DataFrame, percent: int) -> DataFrame:
    """(cid, root) of classes (component, cid, shingles), all pairs of a bounded component in one task."""

    def solve(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("cid")
        sets = [np.frombuffer(b, np.uint64) for b in part["shingles"]]
        cid = part["cid"].to_numpy()
        return pd.DataFrame({"cid": cid, "root": cid[_labels(_links(sets, None, percent))]})

    return rows.groupBy("component").applyInPandas(solve, "cid long, root long")


def _verify_large(rows: DataFrame, percent: int) -> DataFrame:
    """(cid, root) of classes (component, cid, shingles) by rounds of pivots."""
    state = written(rows.select("component", "cid", F.col("cid").alias("root"), F.lit(False).alias("done"), "shingles"), "large")
    size = state.groupBy("component").agg(F.count("*").alias("members"))
    salts = F.ceil(F.col("members") / TASK_MEMBERS).cast("int")

    def compare(members: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        if not len(members) or not len(pivots):
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        y = [np.frombuffer(b, np.uint64) for b in pivots["shingles"]]
        out = []
        for at in range(0, len(members), 500):
            part = members.iloc[at : at + 500]
            i, j = np.nonzero(_links([np.frombuffer(b, np.uint64) for b in part["shingles"]], y, percent))
            out.append(pd.DataFrame({"a": part["cid"].to_numpy()[i], "b": pivots["cid"].to_numpy()[j]}))
        found = pd.concat(out)
        # One link to each label of the pivots is enough for a member.
        found["label"] = found["b"].map(dict(zip(pivots["cid"], pivots["root"])))
        return found.drop_duplicates(["a", "label"])[["a", "b"]]

    links = state.select(F.col("cid").alias("a"), F.col("cid").alias("b"))
    first = True
    while True:
        # All but the most frequent label of a component become pivots, a bounded number in a round.
        counts = state.groupBy("component", "root").agg(F.count("*").alias("n"), F.sum((~F.col("done")).cast("int")).alias("open"))
        largest = F.row_number().over(Window.partitionBy("component").orderBy(F.desc("open"), F.desc("n"), "root"))
        minor = counts.filter("open > 0").withColumn("rank", largest).filter("rank > 1").select("component", "root")
        left = state.filter("NOT done").join(minor, ["component", "root"])
        pick = F.row_number().over(Window.partitionBy("component").orderBy(F.xxhash64("cid")))
        chosen = written(left.withColumn("pick", pick).filter(F.col("pick") <= (PIVOTS if first else 8 * PIVOTS)).select("component", "cid", "root", "shingles"), "pivots")
        first = False
        if chosen.limit(1).count() == 0:
            return state.select("cid", "root")
        open_parts = chosen.select("component").distinct()
        members = state.join(open_parts, "component").join(size, "component")
        members = members.select("component", "cid", "shingles", F.pmod(F.xxhash64("cid"), salts).alias("salt"))
        pivots = chosen.join(size, "component").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("members")
        members = members.withColumn("salt", F.col("salt").cast("int"))
        found = members.groupBy("component", "salt").cogroup(pivots.groupBy("component", "salt")).applyInPandas(compare, "a long, b long")
        links = written(links.union(found), "links")
        roots = connected_components(links.union(state.select(F.col("cid").alias("a"), F.col("root").alias("b"))))
        pivot = chosen.select("cid", F.lit(True).alias("was"))
        state = written(
            state.drop("root").join(roots.select(F.col("node").alias("cid"), F.col("component").alias("root")), "cid").join(pivot, "cid", "left")
            .select("component", "cid", "root", (F.col("done") | F.coalesce("was", F.lit(False))).alias("done"), "shingles"),
            "large",
        )


def class_roots(docs: DataFrame, classes: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(cid, root) of the classes that may link with another one."""
    left = _survivors(docs, classes, k, percent)
    left = left.select("cid", "n", "k1", "k2", F.col("rep.id").alias("rid"), F.col("rep.tid").alias("rtid"))
    # A text stands for its class by id and hash: ids may be null or occur twice. ``_sets`` leaves out texts of another set.
    same = F.col("id").eqNullSafe(F.col("rid")) & (F.col("tid") == F.col("rtid"))
    texts = docs.join(F.broadcast(left) if left.count() <= BROADCAST_ROWS else left, same)
    sets = written(_sets(texts.select("text", "cid", "n", "k1", "k2"), k).dropDuplicates(["cid"]), "sets")
    members, edges = _candidates(_prefixes(sets, percent), percent)
    loops = members.select(F.col("gid").alias("a"), F.col("gid").alias("b"))
    parts = connected_components(edges.union(loops)).filter("node >= 0").withColumnRenamed("node", "gid")
    parts = members.join(parts, "gid").select("cid", "component")
    sizes = parts.groupBy("component").agg(F.count("*").alias("members")).filter("members > 1")
    rows = written(sets.join(parts, "cid").join(sizes, "component"), "candidates")
    small = _verify_small(rows.filter(F.col("members") <= AT_ONCE).select("component", "cid", "shingles"), percent)
    large = rows.filter(F.col("members") > AT_ONCE)
    if large.limit(1).count():
        small = small.union(_verify_large(large, percent))
    return written(small, "roots")


def _row_key(id: str, text: str) -> list[Column]:
    """(id, tid): what tells rows apart whose ids are null or occur twice; ``tid`` hashes the text."""
    return [F.col(id).cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("tid")]


def _rows(docs: DataFrame, id: str, text: str, k: int, percent: int) -> DataFrame:
    """(id, tid, n, root, component_id) of every row; ``root`` names the component also where no member has an id, and is null without words."""
    docs = docs.select(*_row_key(id, text), F.col(text).alias("text"))
    keys = written(shingle_keys(docs, k), "keys")
    # The text of the least id stands for a class, one with a null id only if there is no other.
    rep = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "tid")).alias("rep")
    classes = keys.filter("n > 0").groupBy("n", "k1", "k2").agg(rep)
    classes = written(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    roots = class_roots(docs, classes, k, percent)
    linked = classes.join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    least = linked.groupBy("root").agg(F.min("rep.id").alias("component_id"))
    answer = linked.join(least, "root").select("n", "k1", "k2", "root", "component_id")
    return keys.join(answer, ["n", "k1", "k2"], "left").select("id", "tid", "n", "root", "component_id")


def similar_components(docs: DataFrame, id: str = "doc_id", text: str = "text", k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """id, n_shingles and component_id (the least id that links reach) of every row."""
    out = _rows(docs, id, text, k, percent)
    return out.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def one_per_component(docs: DataFrame, id: str = "doc_id", text: str = "text", k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The row of ``docs`` with the least id of each component, with a null id only if the component has no other.

    Rows are told apart by id and text, so different texts under one id stay if they do not link. Rows without words link with
    nothing and stay. Of rows equal in id and text one stays, an arbitrary one if they differ in other columns.
    """
    found = written(_rows(docs, id, text, k, percent), "components")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "tid")).alias("x")
    heads = found.filter("n > 0").groupBy("root").agg(first).select(F.col("x.id").alias("__id"), F.col("x.tid").alias("__tid"))
    bare = found.filter("n = 0").select(F.col("id").alias("__id"), F.col("tid").alias("__tid")).distinct()
    stay = written(heads.unionByName(bare), "kept")
    key_id, key_tid = _row_key(id, text)
    same = key_id.eqNullSafe(F.col("__id")) & (key_tid == F.col("__tid"))
    kept = docs.join(stay, same, "left_semi")
    # Rows that are equal in id and text are rare: only if there are any are the texts grouped.
    rows_of_kept = found.join(stay, F.col("id").eqNullSafe(F.col("__id")) & (F.col("tid") == F.col("__tid")), "left_semi")
    if rows_of_kept.groupBy("id", "tid").agg(F.count("*").alias("c")).filter("c > 1").limit(1).count():
        kept = kept.withColumn("__tid", key_tid).dropDuplicates([id, "__tid"])
    return kept.select(*docs.columns)
