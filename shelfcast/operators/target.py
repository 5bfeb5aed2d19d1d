"""De-trended target and last-sale day."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.operators.lags import SINCE, stretch_start


WEEK, MONTH = 7, 28


def add_baseline(df: DataFrame, shift: int = 28, window: int = 365, id_col: str = "id") -> DataFrame:
    """Mean of ``window`` days that end ``shift`` days before the row.

    Needs one row per day. The window is put together from totals of 28 days, which are
    put together from totals of 7, and the days left over: a few dozen lags per row for a year. Only values inside
    the window enter, so what lies before it leaves no rounding error behind. NULL unless all ``window`` days
    have a value and no day is missing. All passes share the partitioning and the sort by (id, d).
    """
    w = Window.partitionBy(id_col).orderBy("d")
    kept = df.columns

    def at(column: str, offset: int) -> Column:
        return F.lag(column, offset).over(w) if offset else F.col(column)

    months, rest = divmod(window, MONTH)
    weeks, days = divmod(rest, WEEK)
    # The first day of the gap-free stretch comes with the totals, not in passes of its own.
    df = df.withColumns({"_step": F.col("d") - F.lag("d").over(w)} | ({"_week": _total(at("sales", i) for i in range(WEEK))} if months or weeks else {}))
    since = F.max(stretch_start("_step")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    df = df.withColumns({SINCE: since} | ({"_month": _total(at("_week", WEEK * i) for i in range(MONTH // WEEK))} if months else {}))
    parts = [at("_month", shift + MONTH * i) for i in range(months)]
    parts += [at("_week", shift + MONTH * months + WEEK * i) for i in range(weeks)]
    parts += [at("sales", shift + window - 1 - i) for i in range(days)]
    whole = F.col("d") - (shift + window - 1) >= F.col(SINCE)
    return df.select(*kept, F.when(whole, _total(parts) / window).alias("baseline"))


def _total(columns: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def add_residual(df: DataFrame) -> DataFrame:
    """Sales minus baseline."""
    return df.withColumn("residual", F.col("sales") - F.col("baseline"))


def baseline_on(
    observed: DataFrame,
    first: int,
    last: int,
    shift: int = 28,
    window: int = 365,
    id_col: str = "id",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Baseline of every series on the days ``first..last`` only, from sparse sales.

    Missing days count as zero, so history before ``first`` is never filled in: the
    asked-for days are added to the observed rows and one range frame by day number
    sums what lies in the window. ``keep`` names columns that are constant per id.
    """
    days = F.explode(F.sequence(F.lit(first), F.lit(last))).alias("d")
    asked = observed.select(id_col, *keep).distinct().select(id_col, *keep, days, F.lit(0.0).alias("sales"), F.lit(True).alias("_asked"))
    rows = observed.where(F.col("d").between(first - shift - window + 1, last)).select(
        id_col, *keep, F.col("d").cast("int").alias("d"), F.col("sales").cast("double").alias("sales"), F.lit(False).alias("_asked")
    )
    by_day = Window.partitionBy(id_col).orderBy("d")
    history = by_day.rangeBetween(-(shift + window - 1), -shift)
    same_day = by_day.rangeBetween(0, 0)
    return (
        asked.unionByName(rows)
        .withColumns(
            {
                "actual": F.sum("sales").over(same_day),
                "baseline": F.coalesce(F.sum("sales").over(history), F.lit(0.0)) / window,
            }
        )
        .where("_asked")
        .select(id_col, *keep, "d", F.col("actual").alias("sales"), "baseline")
    )


def baseline_columns(
    observed: DataFrame, first: int, last: int, shift: int = 28, window: int = 365, keys: Sequence[str] = ("id",)
) -> DataFrame:
    """``baseline_on`` as one row per series: columns ``baseline_<d>`` and ``sales_<d>`` for the days ``first..last``.

    Each stored sale is added to the days whose window it lies in and to its own day, all in one aggregate, so a series
    never takes a row per asked-for day. A series without sales in reach has zeros.
    """
    d, sales = F.col("d"), F.col("sales").cast("double")

    def total(inside: Column) -> Column:
        return F.sum(F.when(inside, sales).otherwise(F.lit(0.0)))

    days = range(first, last + 1)
    baseline = [(total(d.between(day - shift - window + 1, day - shift)) / window).alias(f"baseline_{day}") for day in days]
    return observed.groupBy(*keys).agg(*baseline, *[total(d == day).alias(f"sales_{day}") for day in days])


def last_positive_day(sales: DataFrame, cutoff: int, id_col: str = "id") -> DataFrame:
    """Last day up to ``cutoff`` with sales, 0 if there is none."""
    day = F.max(F.when((F.col("sales") > 0) & (F.col("d") <= cutoff), F.col("d")))
    return sales.groupBy(id_col).agg(F.coalesce(day, F.lit(0)).cast("int").alias("last_sales"))


def first_positive_day(node_sales: DataFrame, keys: list[str]) -> DataFrame:
    """First day with sales, 9999 if there is none."""
    day = F.min(F.when(F.col("sales") > 0, F.col("d")))
    return node_sales.groupBy(*keys).agg(F.coalesce(day, F.lit(9999)).cast("int").alias("first_day"))
