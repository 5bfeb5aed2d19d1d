"""Twelve-level hierarchy: membership, roll-up, roll-down, labels."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.schema import KEYS, LEAF, LEVELS


def node_label(keys: Sequence[str]) -> Column:
    """Label of a node: ``Total_X``, ``<key>_X`` or two keys joined by an underscore."""
    if not keys:
        return F.lit("Total_X")
    if len(keys) == 1:
        return F.concat(F.col(keys[0]), F.lit("_X"))
    return F.concat_ws("_", *keys)


def membership(series: DataFrame, levels: dict = LEVELS, keep: Sequence[str] = ()) -> DataFrame:
    """One row per (level, node, id): the sparse form of the 0/1 hierarchy matrix.

    A narrow explode of the series dimension; nothing is shuffled. ``keep`` names columns of the series that its rows carry.
    """
    nodes = [F.struct(F.lit(name).alias("level"), node_label(keys).alias("node")) for name, keys in levels.items()]
    return series.select("id", *keep, F.explode(F.array(*nodes)).alias("n")).select("n.level", "n.node", "id", *keep)


def node_list(series: DataFrame, levels: dict = LEVELS) -> DataFrame:
    """Distinct node labels with the number of series below each."""
    return membership(series, levels).groupBy("level", "node").agg(F.count("*").alias("n_series"))


def _grouped(
    df: DataFrame, levels: dict, measures: Sequence[str], by: Sequence[str], parts: dict, sums: Sequence[Column], finish: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Aggregate for every (level, part) pair with one grouping-sets aggregate."""
    keys = [k for k in dict.fromkeys(k for ks in levels.values() for k in ks)]
    part_cols = [c for c in dict.fromkeys(c for cs in parts.values() for c in cs)]
    columns = [*keys, *part_cols, *by]
    pairs = [(lname, pname) for lname in levels for pname in parts]
    sets = [[*levels[lname], *parts[pname], *by] for lname, pname in pairs]

    if not columns:
        grouped = df.agg(*sums).withColumn("gid", F.lit(0).cast("long"))
    else:
        grouped = df.groupingSets(sets, *columns).agg(*sums, F.grouping_id().alias("gid"))

    def gid(pair: tuple[str, str]) -> int:
        kept = {*levels[pair[0]], *parts[pair[1]], *by}
        return sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in kept)

    by_gid = {gid(pair): pair for pair in pairs}

    def pick(value) -> Column:
        # One CASE branch per grouping set; the grouping id, not NULL keys, tells the sets apart.
        out = None
        for g, pair in by_gid.items():
            cond = F.col("gid") == F.lit(g)
            out = F.when(cond, value(pair)) if out is None else out.when(cond, value(pair))
        return out

    grouped = finish(grouped)
    out = [pick(lambda p: F.lit(p[0])).alias("level"), pick(lambda p: node_label(levels[p[0]])).alias("node")]
    if list(parts) != [""]:
        out.append(pick(lambda p: F.lit(p[1])).alias("part"))
    return grouped.select(*out, *part_cols, *by, *measures)


def rollup(
    df: DataFrame,
    measures: Sequence[str],
    by: Sequence[str] = (),
    levels: dict = LEVELS,
    parts: dict | None = None,
    leaf_rows: bool = False,
    aggregates: Sequence[Column] | None = None,
    finish: Callable[[DataFrame], DataFrame] = lambda df: df,
    by_item: bool = False,
) -> DataFrame:
    """Sum leaf rows up to every node of every level.

    ``by`` columns stay as extra group keys (day, anchor, store for the per-store
    hierarchy H2). ``parts`` adds groupings inside each level, as needed by the
    encodings: ``{"all": (), "wday": ("wday",)}``.

    Two steps keep the expansion small. Levels with ``item_id`` come straight from
    the leaf rows (at most three copies of each row before the map-side combine).
    The nine coarser levels come from one store x department aggregate, which is
    tiny, so the leaf rows are never copied twelve times. The hottest node (the
    root) sees one partial row per task.

    ``leaf_rows`` promises at most one row per (id, ``by``). The leaf level, the
    largest of all, is then a plain projection and is not shuffled.

    ``by_item`` says that the rows are partitioned by ``item_id``. Each level with an item is then an aggregate of its
    own, which neither copies nor shuffles the rows.

    ``aggregates`` replace the sums, for measures that merge in another way, and ``finish`` makes the measures out of
    what they return. Both steps use them, so merging merged measures must be right.
    """
    sums = [F.sum(m).alias(m) for m in measures] if aggregates is None else list(aggregates)
    if leaf_rows and parts is None and LEAF in levels:
        others = {n: k for n, k in levels.items() if n != LEAF}
        leaf = df.select(F.lit(LEAF).alias("level"), node_label(levels[LEAF]).alias("node"), *by, *measures)
        return rollup(df, measures, by, others, aggregates=aggregates, finish=finish, by_item=by_item).unionByName(leaf) if others else leaf
    parts = {"": ()} if parts is None else parts
    fine = {n: k for n, k in levels.items() if "item_id" in k}
    coarse = {n: k for n, k in levels.items() if n not in fine}
    pieces = []
    if fine and by_item:
        pieces += [_one_level(df, level, part, fine, parts, measures, by, sums, finish) for level in fine for part in parts]
    elif fine:
        pieces.append(_grouped(df, fine, measures, by, parts, sums, finish))
    if coarse:
        keys = dict.fromkeys(k for ks in coarse.values() for k in ks)
        part_cols = dict.fromkeys(c for cs in parts.values() for c in cs)
        group = [*keys, *part_cols, *by]
        base = finish(df.groupBy(*group).agg(*sums) if group else df.agg(*sums))
        pieces.append(_grouped(base, coarse, measures, by, parts, sums, finish))
    return reduce(DataFrame.unionByName, pieces)


def _one_level(
    df: DataFrame, level: str, part: str, levels: dict, parts: dict, measures: Sequence[str], by: Sequence[str], sums: Sequence[Column], finish: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Aggregate for one (level, part) pair: a plain group, for which rows laid out by item stay where they are."""
    used = parts[part]
    grouped = finish(df.groupBy(*levels[level], *used, *by).agg(*sums))
    out = [F.lit(level).alias("level"), node_label(levels[level]).alias("node")]
    if list(parts) != [""]:
        out.append(F.lit(part).alias("part"))
    for c in dict.fromkeys(c for cs in parts.values() for c in cs):
        out.append(F.col(c) if c in used else F.lit(None).cast(df.schema[c].dataType).alias(c))
    return grouped.select(*out, *by, *measures)


def fold_nodes(
    df: DataFrame, measures: Sequence[str], by: Sequence[str], fold: Callable[[DataFrame, Sequence[str]], DataFrame], levels: dict = LEVELS, leaf_rows: bool = False
) -> DataFrame:
    """Roll up and ``fold`` the rows of each node, level by level.

    ``fold`` gets the rows and the columns that name a node, and keeps these columns. Of a level with an item
    they are its keys: rows laid out by item are summed and folded where they lie, and only what ``fold`` leaves goes on. The
    levels without an item are folded together, under their label.
    """
    fine = {n: k for n, k in levels.items() if "item_id" in k}
    coarse = {n: k for n, k in levels.items() if n not in fine}
    pieces = []
    for name, keys in fine.items():
        # At most one row per (id, ``by``): the leaf level needs no sum.
        rows = df if leaf_rows and name == LEAF else df.groupBy(*keys, *by).agg(*[F.sum(m).alias(m) for m in measures])
        folded = fold(rows.select(*keys, *by, *measures), keys)
        rest = [c for c in folded.columns if c not in keys]
        pieces.append(folded.select(F.lit(name).alias("level"), node_label(keys).alias("node"), *rest))
    if coarse:
        pieces.append(fold(rollup(df, measures, by, coarse), ["level", "node"]))
    return reduce(DataFrame.unionByName, pieces)


UPPER = tuple(k for k in KEYS if k != "item_id")


def ancestor_sum(rows: DataFrame, node_values: DataFrame, value: str | Sequence[str], levels: dict = LEVELS, by: Sequence[str] = ()) -> DataFrame:
    """``rows`` with ``value`` summed over the ancestors of each row (A10); an ancestor without a value counts as 0.

    All levels without an item are one value per (store, department): they are looked up for the distinct pairs, added
    up there, and meet the rows in a single join; each level with an item is one more. ``by`` columns, like the day, are
    part of every key; several values, like one per day, are added up side by side. The lookup sides hold one row per key, so a
    hot node never multiplies rows. The item level meets by item, where rows laid out by item stay in place.
    """
    values = [value] if isinstance(value, str) else list(value)
    fine = {n: k for n, k in levels.items() if "item_id" in k}
    coarse = {n: k for n, k in levels.items() if n not in fine}
    kept = rows.columns

    def looked_up(df: DataFrame, chosen: dict) -> DataFrame:
        totals = {v: F.lit(0.0) for v in values}
        for name, keys in chosen.items():
            one = node_values.where(F.col("level") == name)
            found = [F.col(v).alias(f"_{name}_{v}") for v in values]
            if list(keys) == ["item_id"]:
                # A label is the item and ``_X``.
                one = one.select(F.expr("left(node, length(node) - 2)").alias("item_id"), *by, *found)
                df = df.join(one, ["item_id", *by], "left")
            else:
                df = df.withColumn("_node", node_label(keys)).join(one.select(F.col("node").alias("_node"), *by, *found), ["_node", *by], "left").drop("_node")
            totals = {v: t + F.coalesce(F.col(f"_{name}_{v}"), F.lit(0.0)) for v, t in totals.items()}
        return df.withColumns({f"_sum_{v}": t for v, t in totals.items()}).drop(*[f"_{n}_{v}" for n in chosen for v in values])

    out = rows
    if coarse:
        groups = looked_up(rows.select(*UPPER, *by).distinct(), coarse).withColumnsRenamed({f"_sum_{v}": f"_upper_{v}" for v in values})
        out = out.join(groups, [*UPPER, *by], "left")
    upper = {v: F.col(f"_upper_{v}") if coarse else F.lit(0.0) for v in values}
    return looked_up(out, fine).select(*kept, *[(upper[v] + F.col(f"_sum_{v}")).alias(v) for v in values])


def rolldown(series: DataFrame, node_values: DataFrame, value: str, levels: dict = LEVELS) -> DataFrame:
    """Sum of a node value over all ancestors of each series (A10, H6): four lookups for twelve levels."""
    return ancestor_sum(series.select("id", *KEYS), node_values, value, levels).select("id", value)
