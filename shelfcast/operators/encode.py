"""Leakage-safe target encodings over hierarchy levels."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.price import has_price
from shelfcast.operators.hierarchy import UPPER, node_label, rollup
from shelfcast.schema import ENCODED_LEVELS, HORIZON, KEYS, TERMS

# Groupings inside a level: all days, per weekday, per day of month.
PARTS = {"all": (), "wday": ("wday",), "dom": ("day",)}


def term_cutoffs(last_observed: int, terms: Sequence[str] = TERMS, horizon: int = HORIZON) -> dict[str, int]:
    """First day a term must not see: the day after its training data end."""
    return {term: last_observed + 1 - i * horizon for i, term in enumerate(terms)}


def masked(value: str, cutoff: int, price: str | None) -> Column:
    """The value where a price is known and the day lies before the cut-off, else NULL."""
    keep = F.col("d") < cutoff
    if price is not None:
        keep = keep & has_price(F.col(price))
    return F.when(keep, F.col(value))


def _merged(i: int) -> list[Column]:
    """Aggregates over cells (count n, mean m, sum q of squares around the mean) of term number ``i``.

    The spread of the cell means comes from a weighted variance that is merged around running means, so nothing
    large is subtracted, whatever the mean of the values is.
    """
    n, m = F.col(f"n{i}"), F.coalesce(F.col(f"m{i}"), F.lit(0.0))
    # An empty cell weighs next to nothing: a group of empty cells only would be an error.
    spread = Summarizer.variance(array_to_vector(F.array(m)), F.greatest(n.cast("double"), F.lit(1e-300)))
    return [
        F.sum(n).alias(f"n{i}"), F.sum(n * m).alias(f"s{i}"), F.sum(f"q{i}").alias(f"q{i}"),
        F.sum((n * n).cast("double")).alias(f"w{i}"), spread.alias(f"v{i}"),
    ]


def _as_cells(df: DataFrame, terms: int) -> DataFrame:
    """The aggregates of ``_merged`` as cells again."""
    out = {}
    for i in range(terms):
        n = F.col(f"n{i}")
        between = F.get(vector_to_array(f"v{i}"), F.lit(0)) * (n - F.col(f"w{i}") / n)
        out[f"m{i}"] = F.when(n > 0, F.col(f"s{i}") / n)
        out[f"q{i}"] = F.when(n > 0, F.col(f"q{i}") + between).otherwise(F.lit(0.0))
    return df.withColumns(out).drop(*[f"{c}{i}" for c in "swv" for i in range(terms)])


def encode(
    fact: DataFrame,
    cutoffs: dict[str, int],
    value: str = "residual",
    price: str | None = "sell_price",
    levels: dict = ENCODED_LEVELS,
    parts: dict = PARTS,
    around: float = 0.0,
    by_item: bool = False,
) -> DataFrame:
    """Mean and sample deviation of a value per term, level, node and part (A4, A5).

    Needs the five key columns, ``d``, ``wday`` and ``day``. All cut-offs, levels
    and parts come from one scan. The fact is first reduced to cells of count, mean and squares
    around the mean per (leaf, weekday, day of month); levels merge cells, so a level
    with few, hot groups shuffles partial results and not rows.

    ``by_item`` says that the fact is partitioned by ``item_id``. Levels with an item then take count, mean and squares
    straight from its rows, where they lie; only the others merge cells, those of the (store, department) groups.

    A mean of a cell is rounded like any double. Values that lie far from zero and close together lose digits
    of their deviation to that, unless ``around`` names a place near them: it is taken off first and put back.
    """
    cells = []
    for i, cutoff in enumerate(cutoffs.values()):
        y = masked(value, cutoff, price) - F.lit(around)
        n = F.count(y)
        cells += [n.alias(f"n{i}"), F.avg(y).alias(f"m{i}"), (F.coalesce(F.var_pop(y), F.lit(0.0)) * n).alias(f"q{i}")]
    used = dict.fromkeys(c for cs in parts.values() for c in cs)
    terms = range(len(cutoffs))
    names = [f"{m}{i}" for i in terms for m in "nmq"]
    merges = [c for i in terms for c in _merged(i)]

    def merge(moments: DataFrame, chosen: dict) -> DataFrame:
        return rollup(moments, names, levels=chosen, parts=parts, aggregates=merges, finish=lambda df: _as_cells(df, len(terms)))

    fine = {n: k for n, k in levels.items() if by_item and "item_id" in k}
    coarse = {n: k for n, k in levels.items() if n not in fine}
    pieces = []
    if fine:
        pieces.append(rollup(fact, names, levels=fine, parts=parts, aggregates=cells, by_item=True))
    if coarse:
        pieces.append(merge(fact.groupBy(*(UPPER if by_item else KEYS), *used).agg(*cells), coarse))
    merged = reduce(DataFrame.unionByName, pieces)
    per_term = [
        F.struct(F.lit(term).alias("term"), F.col(f"n{i}").alias("n"), F.col(f"m{i}").alias("m"), F.col(f"q{i}").alias("q"))
        for i, term in enumerate(cutoffs)
    ]
    part_value = F.coalesce(*[F.col(c) for c in used]) if used else F.lit(None).cast("int")
    if "part" not in merged.columns:
        merged = merged.withColumn("part", F.lit(next(iter(parts))))
    long = merged.select("level", "node", "part", part_value.alias("part_value"), F.explode(F.array(*per_term)).alias("t"))
    n = F.col("t.n")
    return long.select(
        F.col("t.term").alias("term"),
        "level",
        "node",
        "part",
        "part_value",
        n.alias("n"),
        (F.col("t.m") + F.lit(around)).alias("mean"),
        F.when(n > 1, F.sqrt(F.col("t.q") / (n - 1))).alias("std"),
    )


def encoding_name(part: str, level: str, fn: str) -> str:
    middle = {"all": "", "wday": "week_", "dom": "day_"}[part]
    return f"enc_{middle}{level}_{fn}"


# Places of the arrays that hold the encodings of a part: weekdays 1-7, days of the month 1-31.
PLACES = {"wday": 7, "dom": 31}


def _node_arrays(encodings: DataFrame) -> DataFrame:
    """One row per node: ``enc``, a struct of the overall pair and two arrays of fixed length."""
    pair = F.struct("mean", "std")
    entry = F.struct(F.col("part_value"), pair.alias("v"))

    def places(part: str) -> Column:
        found = F.map_from_entries(F.collect_list(F.when(F.col("part") == part, entry)))
        return F.transform(F.sequence(F.lit(1), F.lit(PLACES[part])), lambda k: F.element_at(found, k))

    # At most 39 rows per node.
    arrays = F.struct(F.max(F.when(F.col("part") == "all", pair)).alias("all"), *[places(p).alias(p) for p in PLACES])
    return encodings.groupBy("level", "node").agg(arrays.alias("enc"))


def series_encodings(series: DataFrame, encodings: DataFrame, term: str, levels: dict = ENCODED_LEVELS) -> DataFrame:
    """The encodings of one term for each series: (id, one struct column per level).

    Levels without an item are looked up for the distinct (store, department) pairs, which the series then join
    once; with the three levels of items that makes four joins of the series and not eleven. The item lookups are
    merge joins: they grow with the items, so none of them is broadcast.
    """
    nodes = _node_arrays(encodings.where(F.col("term") == term))

    def looked_up(rows: DataFrame, chosen: dict, hint: str | None) -> DataFrame:
        for level, keys in chosen.items():
            one = nodes.where(F.col("level") == level).select(F.col("node").alias("_node"), F.col("enc").alias(level))
            rows = rows.join(one.hint(hint) if hint else one, node_label(keys) == F.col("_node"), "left").drop("_node")
        return rows

    fine = {n: k for n, k in levels.items() if "item_id" in k}
    coarse = {n: k for n, k in levels.items() if n not in fine}
    wide = series.select("id", *KEYS)
    if coarse:
        upper = [k for k in KEYS if k != "item_id"]
        groups = looked_up(wide.select(*upper).distinct(), coarse, None)
        wide = wide.join(groups, upper, "left")
    return looked_up(wide, fine, "merge").select("id", *levels)


def encoding_values(levels: dict = ENCODED_LEVELS) -> dict[str, Column]:
    """The 6 columns of each level, read from the structs of ``series_encodings`` by weekday and day of the month."""
    columns = {}
    for part in PARTS:
        for level in levels:
            place = {"wday": F.col("wday"), "dom": F.col("day")}.get(part)
            source = F.col(level)["all"] if place is None else F.get(F.col(level)[part], place - 1)
            for fn in ("mean", "std"):
                columns[encoding_name(part, level, fn)] = source[fn]
    return columns


def join_encodings(fact: DataFrame, series: DataFrame, encodings: DataFrame, term: str, levels: dict = ENCODED_LEVELS) -> DataFrame:
    """Fact with the 6 encoding columns of each level of one term, from one join by id."""
    joined = fact.join(series_encodings(series, encodings, term, levels), "id", "left")
    return joined.withColumns(encoding_values(levels)).drop(*levels)
