"""Connected components of an edge table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.tables import written


def connected_components(edges: DataFrame) -> DataFrame:
    """node and component (its least node) from edges (a, b) of long node ids.

    In a round every node moves to the neighbour, or itself, that a hash of the round puts first; the
    edges are mapped along, and loops and repeats drop out. An edge between two nodes becomes one between their
    images, so components neither merge nor part, while the random order shrinks any graph, chains and
    stars alike, by a share in each round: the rows of all rounds are a multiple of the edges. The
    first neighbour is an aggregate with partial results, so a hub gets one row per task. Rounds are
    written, so a lost executor repeats one at most. Loops keep a lone node in the result.
    """
    edges = written(edges.select("a", "b").distinct(), "edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct()
    places = written(nodes.select("node", F.col("node").alias("place")), "places")
    left, turn = written(edges.filter("a <> b"), "edges"), 0
    while left.limit(1).count():
        turn += 1
        order = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("to"))
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moves = both.groupBy("a").agg(F.min(order("b")).alias("near")).select("a", F.least("near", order("a"))["to"].alias("to"))
        moves = written(moves, "moves")
        of = lambda c: moves.select(F.col("a").alias(c), F.col("to").alias(f"{c}_to"))
        moved = left.join(of("a"), "a").join(of("b"), "b").filter("a_to <> b_to")
        left = written(moved.select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct(), "edges")
        places = written(places.join(of("place"), "place", "left").select("node", F.coalesce("place_to", "place").alias("place")), "places")
    least = places.groupBy("place").agg(F.min("node").alias("component"))
    return places.join(least, "place").select("node", "component")
