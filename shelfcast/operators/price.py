"""Weekly price features."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def price_features(prices: DataFrame, weeks: DataFrame) -> DataFrame:
    """Distinct-price counts, price momentum and weeks on sale per weekly price row.

    ``prices`` has one row per (store_id, item_id, wm_yr_wk) and a ``state_id``.
    ``weeks`` gives month and year of each week (one row per week, bounded by the
    length of history).

    A (store, item) group is no longer than the number of weeks, so its statistics
    are windows over one partitioning. A (state, item) group grows with the number
    of stores: it is aggregated with a map-side combine down to one row, and that
    row is looked up by every price of the group.
    """
    p = prices.join(F.broadcast(weeks), "wm_yr_wk", "left")

    item = Window.partitionBy("store_id", "item_id")
    by_week = item.orderBy("wm_yr_wk")
    price = F.col("sell_price")
    p = p.withColumns(
        {
            "price_unique_item_store": F.size(F.collect_set(price).over(item)),
            "sell_start": F.row_number().over(by_week),
            "price_momentum_m_item_store": price / F.avg(price).over(Window.partitionBy("store_id", "item_id", "month")),
            "price_momentum_y_item_store": price / F.avg(price).over(Window.partitionBy("store_id", "item_id", "year")),
        }
    ).withColumn("sell_start_log", F.log("sell_start"))

    p = p.join(state_item_prices(prices, weeks), ["state_id", "item_id"], "left")
    return p.withColumns(
        {
            "price_momentum_m_item_state": price / F.element_at("mean_by_month", F.col("month")),
            "price_momentum_y_item_state": price / F.element_at("mean_by_year", F.col("year")),
        }
    ).drop("mean_by_month", "mean_by_year", "month", "year")


def state_item_prices(prices: DataFrame, weeks: DataFrame) -> DataFrame:
    """One row per (state, item): distinct prices, mean price by month and by year.

    The maps hold at most twelve months and one entry per year of history.
    """
    keys = ["state_id", "item_id"]
    p = prices.join(F.broadcast(weeks), "wm_yr_wk", "left")
    sets = [[*keys, "month"], [*keys, "year"], [*keys, "sell_price"]]
    cells = p.groupingSets(sets, *keys, "month", "year", "sell_price").agg(
        F.avg("sell_price").alias("mean"),
        # Bits of the three optional keys, 0 where the row is grouped by it.
        (F.grouping_id() % 8).alias("gid"),
    )

    def means(unit: str, gid: int):
        entry = F.when((F.col("gid") == gid) & F.col(unit).isNotNull(), F.struct(unit, "mean"))
        return F.map_from_entries(F.collect_list(entry)).alias(f"mean_by_{unit}")

    distinct = F.sum(((F.col("gid") == 6) & F.col("sell_price").isNotNull()).cast("long"))
    return cells.groupBy(*keys).agg(
        distinct.alias("price_unique_item_state"), means("month", 3), means("year", 5)
    )


def join_prices(fact: DataFrame, prices: DataFrame) -> DataFrame:
    """Fact with the price of its store, item and week.

    Both sides are large, so they meet in a shuffle on the full three-column key,
    which spreads a hot item over its stores and weeks.
    """
    return fact.join(prices, ["store_id", "item_id", "wm_yr_wk"], "left")
