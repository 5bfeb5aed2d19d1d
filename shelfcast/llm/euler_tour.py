"""Subtree sums in a forest of one root by an Euler tour that is ranked distributedly.

Every node has an arc that enters and one that leaves it. The arcs form one list; its ranking gives each arc its
place, and the sum over a subtree is a difference of running sums at the places of the node's two arcs.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.running import running
from shelfcast.llm.tables import written

# A list of so many arcs is ranked by one task; longer ones are contracted first.
WALK = 1 << 14


def list_ranks(links: DataFrame, walk: int = WALK) -> DataFrame:
    """(c, a, rank): how many steps the element (c, a) stands before the end of its list.

    ``links`` has (c, a) and the next element (nc, na), null at the end: one list. A round flips a coin for each
    element, by hash, and takes out those with heads whose predecessor shows tails: about a quarter, and never two in a row, so
    each round is a join of a part of the list with itself. When ``walk`` elements are left, one task walks them; then the
    rounds are undone in reverse: an element taken out is as far from the end as its successor and its own
    step together. The rows of all rounds are a multiple of the list, whatever its order, and each round is written.
    """
    alive = written(links.select("c", "a", "nc", "na", F.when(F.col("nc").isNull(), 0).otherwise(1).cast("long").alias("w")), "list")
    out: list[DataFrame] = []
    while alive.count() > walk:
        turn = len(out)
        coin = lambda c, a: F.pmod(F.xxhash64(F.lit(turn), c, a), F.lit(2)) == 1  # noqa: E731, B023
        heads = coin(F.col("c"), F.col("a"))
        next_heads = F.col("nc").isNotNull() & coin(F.col("nc"), F.col("na"))
        splice = alive.where(~heads & next_heads).select(
            F.col("c").alias("uc"), F.col("a").alias("ua"), F.col("w").alias("uw"), F.col("nc").alias("c"), F.col("na").alias("a")
        )
        same = alive.where(~heads & ~next_heads).select("c", "a", "nc", "na", "w", F.lit(False).alias("gone"))
        met = alive.where(heads).join(splice, ["c", "a"], "left")
        taken = F.col("uc").isNotNull()
        self = F.struct("c", "a", "nc", "na", "w", taken.alias("gone"))
        merged = F.struct(F.col("uc").alias("c"), F.col("ua").alias("a"), "nc", "na", (F.col("uw") + F.col("w")).alias("w"), F.lit(False).alias("gone"))
        met = met.select(F.explode(F.when(taken, F.array(self, merged)).otherwise(F.array(self))).alias("x")).select("x.*")
        both = written(same.unionByName(met), "list")
        alive = both.where("NOT gone").drop("gone")
        out.append(both.where("gone").drop("gone"))

    def by_walk(rows: pd.DataFrame) -> pd.DataFrame:
        place = {x: i for i, x in enumerate(zip(rows.c, rows.a))}
        end = len(rows)
        after = np.array([end if pd.isna(c) else place[int(c), int(a)] for c, a in zip(rows.nc, rows.na)], dtype=np.int64)
        follows = np.zeros(end + 1, bool)
        follows[after] = True
        order, at = [], int(np.flatnonzero(~follows[:end])[0])
        while at != end:
            order.append(at)
            at = after[at]
        rank = np.zeros(end, np.int64)
        rank[order] = np.cumsum(rows.w.to_numpy()[order][::-1])[::-1]
        return pd.DataFrame({"c": rows.c, "a": rows.a, "rank": rank})

    ranks = alive.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(by_walk, "c long, a long, rank long")
    for removed in reversed(out):
        ranks = written(ranks, "ranks")
        ahead = ranks.select(F.col("c").alias("nc"), F.col("a").alias("na"), F.col("rank").alias("ahead"))
        ranks = ranks.unionByName(
            removed.join(ahead, ["nc", "na"], "left").select("c", "a", (F.col("w") + F.coalesce("ahead", F.lit(0))).alias("rank"))
        )
    return written(ranks, "ranks")


def tour(nodes: DataFrame) -> DataFrame:
    """Links (c, a, nc, na) of the tour: arc 2 * depth enters the node (conv_id, depth), arc 2 * depth + 1 leaves it.

    ``nodes`` has (conv_id, depth, parent_conv_id, n_children, first_child, last_child, elder): the least and largest
    ``conv_id`` among the children, and the next smaller one among the siblings.
    """
    c, enter = F.col("conv_id"), (2 * F.col("depth")).cast("long")
    arc = lambda c, a, nc, na: F.struct(c.cast("long").alias("c"), a.cast("long").alias("a"), nc.cast("long").alias("nc"), na.cast("long").alias("na"))
    null = F.lit(None).cast("long")
    leaf = F.col("n_children") == 0
    arcs = F.array_compact(
        F.array(
            F.when(leaf, arc(c, enter, c, enter + 1)).otherwise(arc(c, enter, F.col("first_child"), enter + 2)),
            F.when(~leaf, arc(F.col("last_child"), enter + 3, c, enter + 1)),
            F.when(F.col("elder").isNotNull(), arc(F.col("elder"), enter + 1, c, enter)),
            F.when(F.col("depth") == 0, arc(c, enter + 1, null, null)),
        )
    )
    return nodes.select(F.explode(arcs).alias("x")).select("x.*")


def subtree_sums(nodes: DataFrame, values: Sequence[str], walk: int = WALK) -> DataFrame:
    """(conv_id, depth) and each of ``values`` summed over the node's subtree; ``nodes`` as for ``tour``."""
    ranks = list_ranks(tour(nodes), walk)
    sides = ranks.groupBy(F.col("c").alias("conv_id"), F.floor(F.col("a") / 2).cast("int").alias("depth")).agg(
        F.max(F.when(F.col("a") % 2 == 0, F.col("rank"))).alias("enter"), F.max(F.when(F.col("a") % 2 == 1, F.col("rank"))).alias("leave")
    )
    placed = nodes.select("conv_id", "depth", *values).join(sides, ["conv_id", "depth"])
    zero = [F.lit(0).cast("long").alias(v) for v in values]
    # The first arc of the tour has the largest rank.
    arcs = placed.select(
        "conv_id", "depth",
        F.explode(F.array(
            F.struct((-F.col("enter")).alias("at"), *[F.col(v).cast("long").alias(v) for v in values], F.lit(True).alias("enters")),
            F.struct((-F.col("leave")).alias("at"), *zero, F.lit(False).alias("enters")),
        )).alias("x"),
    ).select("conv_id", "depth", "x.*")
    sums = running(arcs, ["at"], [], {f"upto_{v}": ("sum", v) for v in values}, "tour")
    inside = lambda v: F.sum(F.when(F.col("enters"), F.col(v) - F.col(f"upto_{v}")).otherwise(F.col(f"upto_{v}")))
    return sums.groupBy("conv_id", "depth").agg(*[inside(v).alias(v) for v in values])
