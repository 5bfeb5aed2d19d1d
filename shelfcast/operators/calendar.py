"""Calendar dimension and its join to the fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions import calendar as fc


def calendar_between(bounds: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Gap-free calendar with one row per date, from a one-row frame of bounds."""
    return bounds.select(F.explode(F.sequence(F.col(lo), F.col(hi))).alias("date"))


def calendar_features(cal: DataFrame, first: Column, d: Column | None = None) -> DataFrame:
    """Date, week, moon and event features of a calendar.

    Every feature is arithmetic on the row's own date, so the calendar is neither
    sorted nor shuffled.
    """
    date = F.col("date")
    serial = F.datediff(date, first) + 1 if d is None else d
    return cal.withColumns(
        {
            "d": serial,
            "wday": F.dayofweek(date) % 7 + 1,
            "is_weekend": fc.is_weekend(date),
            "w_serial": fc.week_serial(date, first),
            "day": F.dayofmonth(date),
            "month": F.month(date),
            "year": F.year(date),
            "moon": fc.moon_phase(date),
            "week_of_month": fc.week_of(date, first, "MM"),
            "week_of_year": fc.week_of(date, first, "YYYY"),
            "olympic_president_elec_year": fc.year_flag(date),
            **fc.event_columns(serial),
        }
    )


def join_calendar(fact: DataFrame, cal: DataFrame, on: str = "d", how: str = "left") -> DataFrame:
    """Fact with calendar columns.

    A calendar has one row per day, a few thousand at most, so its size is bounded
    by the length of history and it is broadcast.
    """
    return fact.join(F.broadcast(cal), on, how)


def weeks_of(cal: DataFrame) -> DataFrame:
    """Month and year of each sales week, taken from the week's first calendar row."""
    first = F.min_by(F.struct("month", "year"), F.col("date")).alias("p")
    return cal.groupBy("wm_yr_wk").agg(first).select("wm_yr_wk", "p.month", "p.year")


def flag_holidays(fact: DataFrame, holidays: DataFrame) -> DataFrame:
    """0/1 flag for (state, date) pairs listed in the holiday table.

    The holiday table has a handful of days per state and year. It is left to
    Catalyst to broadcast it when its size allows.
    """
    days = holidays.select("state_id", "date").distinct().withColumn("_holiday", F.lit(1))
    return (
        fact.join(days, ["state_id", "date"], "left")
        .withColumn("national_holiday", F.coalesce(F.col("_holiday"), F.lit(0)))
        .drop("_holiday")
    )
