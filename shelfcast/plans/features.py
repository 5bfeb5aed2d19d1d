"""From the three source tables to training frames: one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions import calendar as fc
from shelfcast.functions import price as fp
from shelfcast.operators.calendar import calendar_features, flag_holidays, join_calendar, weeks_of
from shelfcast.operators.encode import encode, encoding_values, join_encodings, series_encodings
from shelfcast.operators.lags import add_rolls, moved_rolls, with_statistics
from shelfcast.operators.price import join_prices, price_features
from shelfcast.operators.reshape import melt_days, with_serial
from shelfcast.operators.target import add_baseline, add_residual, last_positive_day
from shelfcast.plans.manifests import base_manifest, lag_manifest
from shelfcast.schema import HORIZON, KEYS
from shelfcast.session import table_path
from shelfcast.sources import store
from shelfcast.sources.scan import SALES_KEYS, day_columns


def calendar_dimension(calendar: DataFrame) -> DataFrame:
    """Calendar with every date and event feature, keyed by the day number."""
    first = calendar.agg(F.min("date")).scalar()
    cal = calendar_features(calendar.withColumn("d", fc.day_serial(F.col("d"))), first, F.col("d"))
    return cal.withColumns(
        {
            "event_name_2": fc.coded(F.col("event_name_2"), fc.EVENT_NAME_2_CODES),
            "event_type_2": fc.coded(F.col("event_type_2"), fc.EVENT_TYPE_2_CODES),
        }
    )


def build_fact(
    sales_wide: DataFrame, calendar: DataFrame, prices: DataFrame, holidays: DataFrame, horizon: int = HORIZON, serial_buckets: int = 256
) -> DataFrame:
    """Long daily fact with calendar, event, price and target columns.

    The calendar is broadcast. The fact is shuffled twice: to meet its prices, and
    by id for the target, whose partitioning the lag columns reuse.
    """
    # Only the ids are ranked; the day columns stay where they are until they meet their number.
    wide = sales_wide.join(with_serial(sales_wide.select("id"), ["id"], buckets=serial_buckets), "id")
    days = day_columns(wide)
    fact = melt_days(wide, [*SALES_KEYS, "id_serial"], days, horizon)

    cal = calendar_dimension(calendar)
    fact = join_calendar(fact, cal)
    fact = fact.withColumns(
        {
            "snap_total": fc.state_pick(F.col("state_id"), {s: F.col(f"snap_{s}") for s in fc.LABEL_STATES}),
            "event_type_statecat_labelenc": fc.composite_label(F.col("state_id"), F.col("cat_id"), F.col("event_type_1")),
        }
    ).drop(*[f"snap_{s}" for s in fc.LABEL_STATES], "weekday", "event_type_1")
    fact = flag_holidays(fact, holidays)

    weekly = price_features(prices.withColumn("state_id", fp.state_of(F.col("store_id"))), weeks_of(cal)).drop("state_id")
    fact = join_prices(fact, weekly)
    fact = fact.withColumn("sell_price_minority12", fp.minor_digits(F.col("sell_price")))
    return add_residual(add_baseline(fact))


def base_frame(fact: DataFrame, term: str, cutoffs: dict[str, int]) -> DataFrame:
    """The 107 base columns of one term, plus ``d`` and ``baseline``.

    Encodings and the last-sale day see nothing from the term's cut-off on.
    """
    cutoff = cutoffs[term]
    series = fact.select("id", *KEYS).distinct()
    enc = encode(fact, {term: cutoff})
    framed = join_encodings(fact, series, enc, term)
    framed = framed.join(last_positive_day(fact, cutoff - 1), "id", "left")
    return framed.select(*base_manifest(), "d", "baseline")


def model_frame(fact: DataFrame, term: str, h: int, cutoffs: dict[str, int]) -> DataFrame:
    """Base and lag columns of one (term, horizon) in one frame.

    The lag columns are added to the same rows, so the two halves never meet by
    position and need no join.
    """
    base = base_frame(fact, term, cutoffs)
    return add_rolls(base, lag_manifest(h))


def _table_name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1].replace("-", "_")


def write_feature_table(fact: DataFrame, buckets: int) -> DataFrame:
    """The fact with the 30 statistics of each day, bucketed by id and partitioned by store.

    Written once; the frame of any (term, horizon) is a view of it (``frame_view``).
    """
    path = table_path(fact.sparkSession, "features")
    return store.write_bucketed(with_statistics(fact), _table_name(path), buckets, path=path, partition_by=["store_id"])


def write_encodings(fact: DataFrame, cutoffs: dict[str, int]) -> DataFrame:
    """Encodings of every term from one scan of the fact, written once for all its series tables."""
    return store.write_table(encode(fact, cutoffs), table_path(fact.sparkSession, "encodings"), ["term"])


def write_series_table(
    fact: DataFrame, encodings: DataFrame, term: str, cutoffs: dict[str, int], buckets: int, weights: DataFrame | None = None
) -> DataFrame:
    """What a term knows of each series: encodings, last day with sales, training weight; bucketed like the features.

    Encodings and the last-sale day see nothing from the term's cut-off on. One row per series.
    """
    series = fact.select("id", *KEYS).distinct()
    rows = series_encodings(series, encodings, term).join(last_positive_day(fact, cutoffs[term] - 1), "id", "left")
    if weights is not None:
        rows = rows.join(weights.select("id", "train_weight"), "id")
    path = table_path(fact.sparkSession, f"series-{term}")
    return store.write_bucketed(rows, _table_name(path), buckets, path=path)


def frame_view(features: DataFrame, series: DataFrame, h: int) -> DataFrame:
    """Manifest columns of one (term, horizon) as a view of the two tables (R5, R8, M5): no exchange, nothing written.

    Both tables are bucketed by id, so they meet bucket by bucket, and the lag columns are windows inside a bucket. A
    filter on ``store_id`` reads that store's files. The series table grows with the series and is never broadcast.
    """
    extra = [c for c in series.columns if c in ("train_weight",)]
    rows = moved_rolls(features, lag_manifest(h), by=("store_id", "id")).join(series.hint("merge"), "id").withColumns(encoding_values())
    return rows.select(*base_manifest(), "d", "baseline", *extra, *[r.name for r in lag_manifest(h)])
