"""Reshaping: melt, dense day grid, pivot, serial keys, type narrowing, manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.session import checkpointed


def melt_days(wide: DataFrame, ids: Sequence[str], days: Sequence[str], horizon: int = 0) -> DataFrame:
    """Wide day columns ``d_<n>`` to rows ``(ids, d, sales)``, plus empty future days.

    Works for a gap-free run of day columns. One array and one explode per series
    row: thousands of day columns stay one narrow step without a shuffle.
    """
    numbers = [int(c[2:]) for c in days]
    first = numbers[0]
    if numbers != list(range(first, first + len(numbers))):
        raise ValueError("day columns must be consecutive")
    value_type = wide.schema[days[0]].dataType
    values = F.array(*[F.col(c) for c in days])
    if horizon:
        values = F.concat(values, F.array_repeat(F.lit(None).cast(value_type), horizon))
    return wide.select(*ids, F.posexplode(values).alias("pos", "sales")).select(
        *ids, (F.col("pos") + F.lit(first)).alias("d"), "sales"
    )


def melt(wide: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    """Any set of named columns to rows."""
    return wide.unpivot(list(ids), list(values), name, value)


def dense_days(
    daily: DataFrame,
    first: int | Column,
    last: int | Column,
    horizon: int = 0,
    fill: float | None = 0.0,
    id_col: str = "id",
    keep: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """Fill the gaps of a sparse series so that each id has every day in ``first..last`` (R2).

    ``daily`` holds at most one row per (id, d) within those days. Days up to
    ``last`` without a row get ``fill``; ``horizon`` more days get NULL. ``keep``
    names columns that are constant per id.

    Each row generates itself and the gap up to the next row, so there is no spine
    to build and no join: one shuffle by id, and the output stays partitioned by id
    and can feed series windows without another one. A series is as long as the
    calendar at most, however hot its raw rows were.

    The shuffle keeps its number of partitions (``spark.sql.shuffle.partitions``
    unless given): the sparse rows that adaptive execution would measure and merge
    are many times smaller than the dense rows that come out of them.
    """
    if partitions is None:
        partitions = int(daily.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    daily = daily.repartition(partitions, id_col)
    w = Window.partitionBy(id_col).orderBy("d")
    first = first if isinstance(first, Column) else F.lit(first)
    last = last if isinstance(last, Column) else F.lit(last)
    end = (last + F.lit(horizon)).cast("int")
    bounded = daily.select(
        id_col,
        *keep,
        F.col("d").cast("int").alias("_at"),
        "sales",
        F.when(F.lag("d").over(w).isNull(), first).otherwise(F.col("d")).cast("int").alias("_from"),
        F.coalesce(F.lead("d").over(w) - 1, end).cast("int").alias("_to"),
    )
    filled = bounded.select(id_col, *keep, "_at", "sales", F.explode(F.sequence("_from", "_to")).alias("d"))
    empty = F.lit(fill).cast(daily.schema["sales"].dataType)
    value = F.when(F.col("d") == F.col("_at"), F.col("sales")).when(F.col("d") <= last, empty)
    return filled.select(id_col, *keep, "d", value.alias("sales"))


def day_gaps(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Ids whose days are not gap-free or repeat: the lag rewrite must not be used on them."""
    return (
        df.groupBy(id_col)
        .agg(F.count("*").alias("n_rows"), F.countDistinct("d").alias("n_days"), F.min("d").alias("lo"), F.max("d").alias("hi"))
        .where((F.col("n_rows") != F.col("n_days")) | (F.col("n_days") != F.col("hi") - F.col("lo") + 1))
    )


def pivot_sum(df: DataFrame, index: Sequence[str], columns: str, value: str, labels: Sequence, prefix: str) -> DataFrame:
    """Rows to columns with a fixed label list, so that no extra job looks for labels."""
    wide = df.groupBy(*index).pivot(columns, list(labels)).agg(F.sum(value))
    return wide.withColumnsRenamed({str(x): f"{prefix}{x}" for x in labels})


def pivot_first(df: DataFrame, index: Sequence[str], columns: str, value: str, labels: Sequence, prefix: str) -> DataFrame:
    """Rows to columns for values of any type, one row per cell."""
    wide = df.groupBy(*index).pivot(columns, list(labels)).agg(F.first(value))
    return wide.withColumnsRenamed({str(x): f"{prefix}{x}" for x in labels})


def with_serial(dim: DataFrame, order: Sequence[str], name: str = "id_serial", buckets: int = 256) -> DataFrame:
    """Consecutive numbers 0..N-1 in key order.

    A global rank would pass through one task. Here the rows are split into key
    ranges, each range is ranked on its own, and the range offsets are added back.
    The split is checkpointed first: range bounds are sampled, so counting and
    ranking must see the very same split.
    """
    ranged = checkpointed(dim.repartitionByRange(buckets, *order).withColumn("_range", F.spark_partition_id()))
    counts = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    # One row per range, at most `buckets` rows in total.
    offsets = counts.select(
        "_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_offset")
    )
    within = Window.partitionBy("_range").orderBy(*order)
    return (
        ranged.withColumn("_rank", F.row_number().over(within))
        .join(F.broadcast(offsets), "_range")
        .withColumn(name, (F.col("_offset") + F.col("_rank") - 1).cast("long"))
        .drop("_range", "_rank", "_offset")
    )


_INT_STEPS = ((T.ByteType(), 2**7), (T.ShortType(), 2**15), (T.IntegerType(), 2**31))


def column_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Minimum and maximum of each named column, one row per column, from one scan."""
    stats = df.agg(*[f(c).cast("double").alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"lo_{c}").alias("lo"), F.col(f"hi_{c}").alias("hi")) for c in columns]
    return stats.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def narrow_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Cast numeric columns to the narrowest type that holds their range.

    Bounds are strict, so -128 and 127 need SMALLINT. Spark has no half precision:
    floating columns become FLOAT. The ranges come from one aggregate row.
    """
    numeric = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
    wanted = [f for f in df.schema.fields if isinstance(f.dataType, numeric) and (columns is None or f.name in columns)]
    if not wanted:
        return df
    row = df.agg(*[g(f.name).alias(f"{n}_{f.name}") for f in wanted for n, g in (("lo", F.min), ("hi", F.max))]).first()
    casts = {}
    for f in wanted:
        lo, hi = row[f"lo_{f.name}"], row[f"hi_{f.name}"]
        if lo is None:
            continue
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            limit = 3.4028234663852886e38
            casts[f.name] = T.FloatType() if -limit < lo and hi < limit else T.DoubleType()
        else:
            casts[f.name] = next((t for t, b in _INT_STEPS if -b < lo and hi < b - 1), T.LongType())
    return df.withColumns({name: F.col(name).cast(t) for name, t in casts.items()})


def narrow_class(lo: Column, hi: Column) -> Column:
    """Name of the narrowest integer type for a range, as a column."""
    out = None
    for t, b in _INT_STEPS:
        cond = (lo > -b) & (hi < b - 1)
        out = F.when(cond, t.simpleString()) if out is None else out.when(cond, t.simpleString())
    return out.otherwise("bigint")


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN to NULL in every floating column: Spark aggregates skip NULL but not NaN."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def one_hot(df: DataFrame, column: str, labels: Sequence[str]) -> DataFrame:
    """0/1 columns for a short list of labels."""
    return df.withColumns({f"{column}_{x}": (F.col(column) == x).cast("int") for x in labels})


def first_by(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str]) -> DataFrame:
    """Keep the first row per key in the given order (R11): a combinable aggregate, no sort."""
    picked = F.min_by(F.struct(*values), F.col(order)).alias("p")
    return df.groupBy(*keys).agg(picked).select(*keys, "p.*")


def last_days(df: DataFrame, n: int, by: Sequence[str] = ()) -> DataFrame:
    """Rows of the last ``n`` days of the table (R27); the last day is a scalar subquery."""
    newest = df.agg(F.max("d")).scalar()
    return df.where(F.col("d") > newest - n)
