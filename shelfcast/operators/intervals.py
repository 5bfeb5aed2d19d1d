"""Prediction intervals for every hierarchy node from back-test errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.forecast import horizon_columns
from shelfcast.operators.hierarchy import fold_nodes, rollup
from shelfcast.schema import ANCHORS, HORIZON, LEVELS, TAIL_RANKS


def anchor_of(h: Column) -> Column:
    """Back-test anchor whose errors describe a horizon (F27). 4, 11, 18, 25."""
    return F.when(h <= 4, 1).when(h <= 11, 7).when(h <= 18, 14).when(h <= 25, 21).otherwise(28)


def anchor_for(h: int) -> int:
    return next(a for limit, a in zip((4, 11, 18, 25, 28), ANCHORS) if h <= limit)


def lag_bucket(h: Column) -> Column:
    """Horizon rounded up to whole weeks."""
    return (F.ceil(h / 7) * 7).cast("int")


def node_errors(errors: DataFrame, levels: dict = LEVELS, columns: Sequence[str] | None = None, block: str | None = None) -> DataFrame:
    """Signed leaf errors summed up to every node, then sorted by absolute value.

    ``errors`` holds one row (anchor, keys, d, err) per leaf and day and may be sparse. The array has at most
    one value per back-test day (84), however large the node is.

    With ``columns``, one per day and NULL for an absent day, there is one row per leaf and anchor, laid out by item: the days of a
    node are one row, and no row is shuffled for a day.

    ``block`` names a column, like the term, whose values have a row each: the days of a node then are sorted over all its rows.
    """
    if block is not None:

        def sort_days(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
            days = F.array_compact(F.array(*[F.abs(c) for c in columns]))
            return rows.groupBy("anchor", *keys).agg(F.sort_array(F.flatten(F.collect_list(days))).alias("abs_err"))

        return fold_nodes(errors, columns, ["anchor", block], sort_days, levels, leaf_rows=True).select("anchor", "level", "node", "abs_err")
    if columns is not None:
        nodes = rollup(errors, columns, by=["anchor"], levels=levels, leaf_rows=True, by_item=True)
        return nodes.select("anchor", "level", "node", F.sort_array(F.array_compact(F.array(*[F.abs(c) for c in columns]))).alias("abs_err"))
    sums = rollup(errors, ["err"], by=["anchor", "d"], levels=levels, leaf_rows=True)
    return sums.groupBy("anchor", "level", "node").agg(F.sort_array(F.collect_list(F.abs("err"))).alias("abs_err"))


def halfwidths(node_errs: DataFrame, n_days: int, ranks: dict[float, int] = TAIL_RANKS) -> DataFrame:
    """Order statistics of the absolute errors and one appended zero, per tail.

    Back-test days without a row are errors of zero. They would sort in front, so a
    rank is moved down by their number instead of storing them.
    """
    missing = F.lit(n_days + 1) - F.size("abs_err")
    columns = {}
    for q, rank in ranks.items():
        at = F.lit(rank) - missing
        columns[halfwidth_name(q)] = F.when(at >= 0, F.get("abs_err", at)).otherwise(F.lit(0.0))
    return node_errs.select("anchor", "level", "node", *[c.alias(n) for n, c in columns.items()])


def halfwidth_name(q: float) -> str:
    return f"hw_{round(q * 1000):03d}"


def quantile_levels(ranks: dict[float, int] = TAIL_RANKS) -> list[float]:
    """All reported probabilities: both tails and the median."""
    return sorted([*ranks, *[1 - q for q in ranks], 0.5])


def _bound(point: Column, half, q: float) -> Column:
    """Point forecast moved by the half-width of its tail, never below zero."""
    if q == 0.5:
        moved = point
    elif q < 0.5:
        moved = point - half(q)
    else:
        moved = point + half(round(1 - q, 3))
    return F.greatest(moved, F.lit(0.0))


def interval_rows(node_forecast: DataFrame, half: DataFrame, ranks: dict[float, int] = TAIL_RANKS) -> DataFrame:
    """Rows (level, node, h, q, value) from node forecasts and half-widths.

    The half-widths hold one row per node and anchor; a node asks for at most 28.
    """
    joined = node_forecast.withColumn("anchor", anchor_of(F.col("h"))).join(half, ["anchor", "level", "node"], "left")

    def of(q: float) -> Column:
        return F.coalesce(F.col(halfwidth_name(q)), F.lit(0.0))

    entries = [
        F.struct(F.lit(round(q, 3)).alias("q"), _bound(F.col("forecast"), of, q).alias("value"))
        for q in quantile_levels(ranks)
    ]
    return joined.select("level", "node", "h", F.explode(F.array(*entries)).alias("e")).select(
        "level", "node", "h", "e.q", "e.value"
    )


def interval_lines(node_forecast_wide: DataFrame, half: DataFrame, ranks: dict[float, int] = TAIL_RANKS, horizon: int = HORIZON) -> DataFrame:
    """Rows (level, node, q, F1..F28): the quantiles of each node, one line each.

    A node's 28 point forecasts and its half-widths of five anchors meet in one
    row; the nine quantiles are then a narrow explode of signed half-widths, and each line moves
    its own forecasts. All 9 x 28 cells in one array would be a generated method too long for the JIT compiler. The long
    form (28 x 9 rows per node) is never shuffled.
    """
    tails = [halfwidth_name(q) for q in ranks]
    by_anchor = half.groupBy("level", "node").agg(
        *[F.max(F.when(F.col("anchor") == a, F.col(t))).alias(f"{t}_{a}") for a in ANCHORS for t in tails]
    )
    joined = node_forecast_wide.join(by_anchor, ["level", "node"], "left")

    def move(q: float, anchor: int) -> Column:
        if q == 0.5:
            return F.lit(0.0)
        half_width = F.coalesce(F.col(f"{halfwidth_name(min(q, round(1 - q, 3)))}_{anchor}"), F.lit(0.0))
        return half_width if q > 0.5 else -half_width

    moves = [F.struct(F.lit(round(q, 3)).alias("q"), *[move(q, a).alias(f"_move_{a}") for a in ANCHORS]) for q in quantile_levels(ranks)]
    cols = horizon_columns(horizon)
    # The moves are made ahead of the explode: with it and the cells they are one method, too long for what may follow.
    lines = joined.select("level", "node", *cols, F.array(*moves).alias("_moves")).select("level", "node", *cols, F.inline("_moves"))
    cells = [F.greatest(F.col(c) + F.col(f"_move_{anchor_for(h)}"), F.lit(0.0)).alias(c) for h, c in enumerate(cols, 1)]
    return lines.select("level", "node", "q", *cells)


def interval_layout(
    node_forecast_wide: DataFrame,
    half: DataFrame,
    ranks: dict[float, int] = TAIL_RANKS,
    suffixes: Sequence[str] = ("evaluation", "validation"),
    horizon: int = HORIZON,
) -> DataFrame:
    """Wide rows ``<node>_<q>_<suffix>, F1..F28``: the lines of the quantiles under each suffix."""
    cols = horizon_columns(horizon)
    lines = interval_lines(node_forecast_wide, half, ranks, horizon)
    flat = lines.withColumn("q", F.coalesce(*[F.when(F.col("q") == round(q, 3), F.lit(f"{q:.3f}")) for q in quantile_levels(ranks)]))
    suffix = F.explode(F.array(*[F.lit(s) for s in suffixes]))
    return flat.select("node", "q", suffix.alias("_suffix"), *cols).select(
        F.concat_ws("_", "node", "q", "_suffix").alias("id"), *cols
    )
