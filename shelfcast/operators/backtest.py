"""Terms, date splits and back-test errors."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.schema import ANCHORS, HORIZON, TERMS


def term_windows(last_observed: int, terms: Sequence[str] = TERMS, horizon: int = HORIZON) -> dict[str, tuple[int, int]]:
    """First and last day of each term (M7): 28 days each, the newest one is the future."""
    return {
        term: (last_observed + 1 - i * horizon, last_observed + (1 - i) * horizon) for i, term in enumerate(terms)
    }


def term_dates(end: date, train_start: date, terms: Sequence[str] = TERMS, horizon: int = HORIZON) -> dict[str, dict[str, date]]:
    """Training, validation and scoring dates of each term (M1, M7).

    ``end`` is the last observed date. The newest term has no held-out truth: it
    trains on everything and its validation window lies inside (Q11).
    """
    out = {}
    for i, term in enumerate(terms):
        train_end = end - timedelta(days=i * horizon)
        score = (train_end + timedelta(days=1), train_end + timedelta(days=horizon))
        val = (train_end - timedelta(days=horizon - 1), train_end) if i == 0 else score
        out[term] = {
            "train_start": train_start,
            "train_end": train_end,
            "val_start": val[0],
            "val_end": val[1],
            "eval_start": score[0],
            "eval_end": score[1],
        }
    return out


def assign_term(d: Column, last_observed: int | Column, terms: Sequence[str] = TERMS, horizon: int = HORIZON) -> Column:
    """Term that a day belongs to, NULL outside all terms.

    The windows have equal length and do not overlap, so the term is arithmetic on
    the day number, not a range join.
    """
    last = last_observed if isinstance(last_observed, Column) else F.lit(last_observed)
    index = F.floor((last + horizon - d) / horizon).cast("int")
    inside = (d <= last + horizon) & (index < len(terms))
    return F.when(inside, F.element_at(F.array(*[F.lit(t) for t in terms]), index + 1))


def split_flags(date_col: Column, dates: dict[str, date]) -> dict[str, Column]:
    """Training, validation and scoring flags, closed ranges (R12, M1). Windows may overlap (Q11)."""
    return {
        f"in_{part}": date_col.between(F.lit(dates[f"{part}_start"]), F.lit(dates[f"{part}_end"]))
        for part in ("train", "val", "eval")
    }


def train_days(dates: dict[str, date]) -> int:
    """Number of training days, both ends counted."""
    return (dates["train_end"] - dates["train_start"]).days + 1


def days_between(first: Column, last: Column) -> Column:
    """Number of days of a closed date range."""
    return F.datediff(last, first) + 1


def prediction_slots(fact: DataFrame, last_observed: int | Column, anchors: Sequence[int] = ANCHORS) -> DataFrame:
    """One row per prediction to make: (term, anchor, id, day).

    The future term is predicted once (anchor NULL), each past term once per
    anchor. A narrow explode with at most five copies per row.
    """
    term = assign_term(F.col("d"), last_observed)
    past = F.array(*[F.lit(a) for a in anchors])
    future = F.array(F.lit(None).cast("int"))
    return (
        fact.withColumn("term", term)
        .where(F.col("term").isNotNull())
        .withColumn("anchor", F.explode(F.when(F.col("term") == TERMS[0], future).otherwise(past)))
    )


def backtest_errors(predictions: DataFrame, pred: str = "pred", target: str = "target", arrays: bool = False) -> DataFrame:
    """Prediction minus target on past terms (U1). With ``arrays``, a row holds all days of a term in each column."""
    past = predictions.where(F.col("anchor").isNotNull())
    return past.withColumn("err", F.zip_with(pred, target, lambda p, t: p - t) if arrays else F.col(pred) - F.col(target))


def moving_mean_errors(
    sales: DataFrame, first: int, last: int, window: int, anchors: Sequence[int] = ANCHORS, keys: Sequence[str] = ("id",)
) -> DataFrame:
    """Errors of a mean of ``window`` days that ends ``anchor`` days before the scored day: columns ``err_<d>``.

    One row per series and anchor. A sale adds to the days whose forecast it enters and is taken off its own day, all in one
    aggregate. A day that no sale reaches is NULL.
    """
    rows = sales.select(*keys, "d", F.col("sales").cast("double").alias("sales"), F.explode(F.array(*[F.lit(a) for a in anchors])).alias("anchor"))
    at, x = F.col("d") + F.col("anchor"), F.col("sales")

    def error(day: int) -> Column:
        return F.sum(F.when(at.between(day - window + 1, day), x / window).when(F.col("d") == day, -x)).alias(f"err_{day}")

    reached = rows.where((at + window - 1 >= first) & (F.col("d") <= last) & ((at <= last) | (F.col("d") >= first)))
    return reached.groupBy(*keys, "anchor").agg(*[error(day) for day in range(first, last + 1)])


def moving_mean_predictions(
    sales: DataFrame, first: int, last: int, window: int, anchors: Sequence[int] = ANCHORS, keys: Sequence[str] = ("id",), days: int = HORIZON
) -> DataFrame:
    """Means of ``window`` days that end ``anchor`` days before the scored day, beside what was sold.

    One row per series, anchor and block of ``days`` days from ``first`` to ``last``: ``first_day`` and the arrays ``pred`` and ``target``, with
    a place per day. The sales of a series, of which there is one per day at most, are gathered once. A day that none of them reaches is
    NULL in both arrays, a block without any other day has no row.
    """
    daily = sales.groupBy(*keys, "d").agg(F.sum(F.col("sales").cast("double")).alias("sales"))
    series = daily.groupBy(*keys).agg(F.collect_list(F.struct("d", "sales")).alias("sold"))
    blocks = [F.struct(F.lit(a).alias("anchor"), F.lit(b).alias("first_day")) for b in range(first, last + 1, days) for a in anchors]
    rows = series.select(*keys, "sold", F.inline(F.array(*blocks)))
    begin, end, anchor = F.col("first_day"), F.col("first_day") + days - 1, F.col("anchor")

    def reaches(s: Column) -> Column:
        at = s["d"] + anchor
        return ((at <= end) & (at + window > begin)) | s["d"].between(begin, end)

    rows = rows.withColumn("sold", F.filter("sold", reaches)).where(F.size("sold") > 0)

    def total(taken) -> Column:
        none = F.lit(None).cast("double")
        return F.aggregate("sold", none, lambda acc, s: F.when(taken(s["d"]), F.coalesce(acc, F.lit(0.0)) + s["sales"]).otherwise(acc))

    day = F.sequence(begin, end)
    rows = rows.withColumns(
        {
            "_sum": F.transform(day, lambda x: total(lambda d: (d + anchor <= x) & (d + anchor + window > x))),
            "_own": F.transform(day, lambda x: total(lambda d: d == x)),
        }
    )

    def either(value: Column, other: Column) -> Column:
        return F.coalesce(value, F.when(other.isNotNull(), F.lit(0.0)))

    pred = F.zip_with("_sum", "_own", lambda p, t: either(p / window, t))
    target = F.zip_with("_own", "_sum", lambda t, p: either(t, p))
    return rows.select(*keys, "anchor", "first_day", pred.alias("pred"), target.alias("target"))
