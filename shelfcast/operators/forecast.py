"""Forecast layout and blending."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.reshape import pivot_sum
from shelfcast.schema import HORIZON

SUFFIXES = ("validation", "evaluation")


def retrend(baseline: Column, predicted_residual: Column) -> Column:
    """Forecast = baseline + predicted residual (M8)."""
    return baseline + predicted_residual


def horizon_columns(horizon: int = HORIZON) -> list[str]:
    return [f"F{i}" for i in range(1, horizon + 1)]


def forecast_wide(forecast: DataFrame, value: str = "forecast", horizon: int = HORIZON, index: Sequence[str] = ("id",)) -> DataFrame:
    """(id, h, value) rows to columns F1..F28."""
    return pivot_sum(forecast, index, "h", value, range(1, horizon + 1), "F")


def with_suffixes(wide: DataFrame, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """Every row once per id suffix.

    The suffix is set, not replaced inside the id, so ids cannot come out twice
    when they already carry one of the suffixes (Q12).
    """
    bare = F.regexp_replace("id", "_(" + "|".join(suffixes) + ")$", "")
    both = F.explode(F.array(*[F.lit(s) for s in suffixes]))
    rest = [c for c in wide.columns if c != "id"]
    return wide.select(bare.alias("_id"), both.alias("_suffix"), *rest).select(
        F.concat_ws("_", "_id", "_suffix").alias("id"), *rest
    )


def only_suffix(wide: DataFrame, suffix: str) -> DataFrame:
    """Rows whose id ends in one suffix (R17): half of a submission, whatever its row order."""
    return wide.where(F.col("id").endswith(f"_{suffix}"))


def forecast_grid(series: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """(id, h) for every series and day of the horizon: a forecast without a row there is zero."""
    return series.select("id", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))


def on_grid(forecast: DataFrame, grid: DataFrame, keys: Sequence[str] = ("id", "h"), value: str = "forecast") -> DataFrame:
    """The sparse forecast on every key of the grid, zero where it has no row."""
    return grid.join(forecast.select(*keys, value), list(keys), "left").withColumn(value, F.coalesce(value, F.lit(0.0)))


def wide_on(series: DataFrame, wide: DataFrame, keys: Sequence[str] = ("id",), horizon: int = HORIZON) -> DataFrame:
    """A wide forecast on every row of ``series``, zero where it has none: ``on_grid`` without a row per day."""
    return blend_wide([wide], series, horizon, keys)


def wide_to_rows(wide: DataFrame, keys: Sequence[str] = ("id",), value: str = "forecast", horizon: int = HORIZON) -> DataFrame:
    """F1..F28 to rows (keys, h, value): the way back of ``forecast_wide``, a narrow step."""
    cells = [F.struct(F.lit(i).alias("h"), F.col(c).alias(value)) for i, c in enumerate(horizon_columns(horizon), 1)]
    return wide.select(*keys, F.inline(F.array(*cells)))


def blend(forecasts: Sequence[DataFrame], grid: DataFrame | None = None, keys: Sequence[str] = ("id", "h"), value: str = "forecast") -> DataFrame:
    """Mean of N forecasts.

    Sparse forecasts need the ``grid`` of keys, on which an absent row is a forecast of zero.
    Without a grid the forecasts must be dense, and only keys that all of them have come out. Rows
    meet by key and not by position. The union is reduced before the shuffle, so N files cost one aggregate.
    """
    n = len(forecasts)
    stacked = forecasts[0].select(*keys, value)
    for f in forecasts[1:]:
        stacked = stacked.unionByName(f.select(*keys, value))
    sums = stacked.groupBy(*keys).agg(F.sum(value).alias("_sum"), F.count("*").alias("_n"))
    if grid is None:
        sums = sums.where(F.col("_n") == n)
    means = sums.select(*keys, (F.col("_sum") / n).alias(value))
    return means if grid is None else on_grid(means, grid, keys, value)


def blend_wide(forecasts: Sequence[DataFrame], series: DataFrame | None = None, horizon: int = HORIZON, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Mean of N wide forecast tables, column by column.

    With ``series``, one row per key, every key of it has a row, and absent rows and empty cells are zero. Without, a cell that is
    empty in any of the tables stays empty. Series and forecasts are stacked and meet in one aggregate: frames that all are laid
    out by one of the ``keys`` stay where they lie, which a join on all keys would not leave them.
    """
    n = len(forecasts)
    cols = horizon_columns(horizon)
    stacked = forecasts[0].select(*keys, *cols)
    for f in forecasts[1:]:
        stacked = stacked.unionByName(f.select(*keys, *cols))
    if series is None:
        means = [F.when(F.count(c) == n, F.sum(c) / n).alias(c) for c in cols]
        return stacked.groupBy(*keys).agg(*means, F.count("*").alias("_n")).where(F.col("_n") == n).drop("_n")
    listed = series.select(*keys, *[F.lit(None).cast("double").alias(c) for c in cols], F.lit(1).alias("_listed"))
    stacked = stacked.withColumn("_listed", F.lit(0)).unionByName(listed)
    means = stacked.groupBy(*keys).agg(*[(F.sum(c) / n).alias(c) for c in cols], F.max("_listed").alias("_listed"))
    return means.where(F.col("_listed") == 1).drop("_listed").na.fill(0.0, cols)


def missing_ids(forecast: DataFrame, expected: DataFrame) -> DataFrame:
    """Ids of the expected layout without a forecast row."""
    return expected.select("id").join(forecast.select("id"), "id", "left_anti")
