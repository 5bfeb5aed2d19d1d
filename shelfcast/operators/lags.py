"""Lags and "every k-th day" rolling statistics."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True, order=True)
class Roll:
    """Statistic ``fn`` over ``window`` values that lie ``stride`` days apart, ``shift`` days back.

    ``fn="lag"`` is the plain value ``shift`` days back.
    """

    stride: int
    window: int
    fn: str
    shift: int = 0

    @property
    def name(self) -> str:
        if self.fn == "lag":
            return f"shift_{self.shift}"
        return f"multi_{self.stride}_shift_{self.shift}_roll_{self.window}_{self.fn}"

    @property
    def unshifted(self) -> "Roll":
        return Roll(self.stride, self.window, self.fn, 0)


def lag(shift: int) -> Roll:
    return Roll(1, 1, "lag", shift)


# Consecutive-day windows of at least two blocks are put together from block statistics.
BLOCK = 7


SHAPES = ("skew", "kurt")


def _sample_shape(fn: str, n: int, m2: Column, m3: Column, m4: Column) -> Column:
    """Sample skewness or kurtosis from sums of powers around the mean."""
    if fn == "skew":
        return n**0.5 * m3 / F.sqrt(m2 * m2 * m2) * (n * (n - 1)) ** 0.5 / (n - 2)
    return (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * (n * m4 / (m2 * m2) - 3) + 6)


def _add(columns: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def _blocks(roll: Roll) -> int:
    """Number of whole blocks in a consecutive-day window, 0 if it is read day by day."""
    by_block = roll.stride == 1 and roll.fn in ("mean", "std", "max", "min", *SHAPES) and roll.window >= 2 * BLOCK
    return roll.window // BLOCK if by_block else 0


def _offsets(roll: Roll) -> list[int]:
    """Plain lags that a statistic reads: all its days, or only those outside whole blocks."""
    n = _blocks(roll)
    if n:
        return [*range(BLOCK), *range(n * BLOCK, roll.window)]
    return [roll.stride * i for i in range(roll.window)]


def _mean_of(roll: Roll) -> Roll:
    return Roll(roll.stride, roll.window, "mean")


def _pick_extreme(fn: str):
    return F.greatest if fn == "max" else F.least


def _from_days(roll: Roll, days: list[Column]) -> Column:
    """Statistic of a few values that are all present; deviations read the mean column."""
    if roll.fn == "mean":
        return _add(days) / roll.window
    if roll.fn == "std":
        mean = F.col(f"_{_mean_of(roll).name}")
        return F.sqrt(_add((x - mean) * (x - mean) for x in days) / (roll.window - 1))
    if roll.fn == "median":
        ordered = F.col(f"_sorted_{roll.name}")
        half = roll.window // 2
        if roll.window % 2:
            return F.get(ordered, F.lit(half))
        return (F.get(ordered, F.lit(half - 1)) + F.get(ordered, F.lit(half))) / 2
    if roll.fn in SHAPES:
        return F.when(F.greatest(*days) > F.least(*days), _sample_shape(roll.fn, roll.window, *_moment_columns(roll)))
    return _pick_extreme(roll.fn)(*days)


def _power(x: Column, k: int) -> Column:
    return reduce(lambda a, b: a * b, [x] * k)


def _block_needs(roll: Roll) -> set[tuple[str, int]]:
    """Block statistics, by name and offset, that a statistic is put together from."""
    starts = [BLOCK * i for i in range(_blocks(roll))]
    sums = {"max": [], "min": [], "mean": ["mean"], "std": ["mean", "square"]}.get(roll.fn, ["mean", "square", "cube", "fourth"])
    extremes = {"max": ["max"], "min": ["min"], "skew": ["max", "min"], "kurt": ["max", "min"]}.get(roll.fn, [])
    return {(n, o) for n in (*sums, *extremes) for o in starts}


def _from_blocks(roll: Roll, block, days: list[Column]) -> Column:
    """Statistic from block statistics ``block(name, offset)`` and the days left over."""
    starts = [BLOCK * i for i in range(_blocks(roll))]
    if roll.fn in ("max", "min"):
        return _pick_extreme(roll.fn)(*[block(roll.fn, o) for o in starts], *days)
    if roll.fn == "mean":
        return (_add(block("mean", o) for o in starts) * BLOCK + (_add(days) if days else F.lit(0.0))) / roll.window
    if roll.fn == "std":
        return F.sqrt(_moments(roll, block, days)[0] / (roll.window - 1))
    # Equal values have no shape; rounding could leave a spread, so they are told by their extremes.
    extremes = {fn: _pick_extreme(fn)(*[block(fn, o) for o in starts], *days) for fn in ("max", "min")}
    return F.when(extremes["max"] > extremes["min"], _sample_shape(roll.fn, roll.window, *_moment_columns(roll)))


def _moment_columns(roll: Roll) -> list[Column]:
    return [F.col(f"_m{k}_{roll.name}") for k in (2, 3, 4)]


def _moments(roll: Roll, block, days: list[Column]) -> list[Column]:
    """Sums of the second, third and fourth powers around the mean; ``days`` are those outside whole blocks."""
    starts = [BLOCK * i for i in range(_blocks(roll))]
    mean = F.col(f"_{_mean_of(roll).name}")
    if not starts:
        return [_add(_power(x - mean, k) for x in days) for k in (2, 3, 4)]
    # Within-block squares, plus the spread of block means and single days around the common mean:
    # nothing large is subtracted, so near-constant windows stay exact.
    within = _add(block("square", o) for o in starts)
    between = _add((block("mean", o) - mean) * (block("mean", o) - mean) for o in starts) * BLOCK
    single = _add((x - mean) * (x - mean) for x in days) if days else F.lit(0.0)
    m2 = within + between + single
    if roll.fn == "std":
        return [m2]
    # Powers around a block's mean, moved to the common mean.
    m3, m4 = F.lit(0.0), F.lit(0.0)
    for o in starts:
        off = block("mean", o) - mean
        m3 = m3 + block("cube", o) + off * (block("square", o) * 3 + off * off * BLOCK)
        m4 = m4 + block("fourth", o) + off * (block("cube", o) * 4 + off * (block("square", o) * 6 + off * off * BLOCK))
    for x in days:
        m3, m4 = m3 + _power(x - mean, 3), m4 + _power(x - mean, 4)
    return [m2, m3, m4]


SINCE = "_since"


def with_since(df: DataFrame, id_col: str = "id", name: str = SINCE) -> DataFrame:
    """The frame with the first day of the gap-free stretch that each row stands in.

    A missing or a repeated day starts a new stretch. The row s places back lies s days back exactly if the
    stretch reaches that far, so one comparison guards every lag; both passes share the sort by (id, d).
    """
    by_day = Window.partitionBy(id_col).orderBy("d")
    running = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    step = F.col("d") - F.lag("d").over(by_day)
    return df.withColumn(f"{name}_step", step).withColumn(name, F.max(stretch_start(f"{name}_step")).over(running)).drop(f"{name}_step")


def stretch_start(step: str) -> Column:
    """The day of a row that is not one ``step`` behind the row before it, else NULL."""
    return F.when(F.col(step).isNull() | (F.col(step) != 1), F.col("d"))


def safe_lag(column: str, shift: int, by_day, since: str = SINCE) -> Column:
    """The value ``shift`` days back; NULL if a gap lies between."""
    return F.when(F.col("d") - shift >= F.col(since), F.lag(column, shift).over(by_day)) if shift else F.col(column)


def _week_fields(bases: list[Roll]) -> dict[int, list[str]]:
    """By offset of a week: the days (``x0`` is its newest) and block statistics that are read there."""
    found = {(o - o % BLOCK, f"x{o % BLOCK}") for b in bases for o in _offsets(b)}
    found |= {(o, n) for b in bases if _blocks(b) for n, o in _block_needs(b)}
    return {week: sorted(f for w, f in found if w == week) for week in sorted({w for w, _ in found})}


def _with_weeks(df: DataFrame, bases: list[Roll], value: str, by_day) -> DataFrame:
    """The frame with all that the statistics of a day read, from two passes.

    ``_week_0`` holds the last seven days and the block statistics on them, ``_week_<o>`` is the same ``o`` days back, as one struct: a lag
    moves a week and not a day, and few columns go from one generated method to the next.
    ``_behind`` is how far back the gap-free stretch reaches, ``_run`` how many days in a row have a value.
    """
    fields = _week_fields(bases)
    names = {f for fs in fields.values() for f in fs if not f.startswith("x")}
    places = range(BLOCK) if names else sorted({int(f[1:]) for fs in fields.values() for f in fs})

    step = F.col("d") - F.lag("d").over(by_day)
    df = df.withColumns({"_step": step} | {f"_x{i}": F.lag(value, i).over(by_day) if i else F.col(value) for i in places})
    days = [F.col(f"_x{i}") for i in range(BLOCK)]
    simple = {"mean": _add(days) / BLOCK, "max": F.greatest(*days), "min": F.least(*days)} if names else {}
    df = df.withColumns({f"_{n}": c for n, c in simple.items() if n in names})
    powers = {"square": 2, "cube": 3, "fourth": 4}
    df = df.withColumns({f"_{n}": _add(_power(x - F.col("_mean"), k) for x in days) for n, k in powers.items() if n in names})
    df = df.withColumn("_week_0", F.struct(*[F.col(f"_{f}").alias(f) for f in [*[f"x{i}" for i in places], *sorted(names)]]))

    # No statistic of the weeks reads over a gap: it is NULL unless ``_run`` or ``_behind`` covers it.
    running = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    since = F.max(stretch_start("_step")).over(running)
    last_gap = F.max(F.when(F.col(value).isNull(), F.col("d"))).over(running)
    moved = {f"_week_{o}": F.lag("_week_0", o).over(by_day) for o in fields if o}
    df = df.withColumns({SINCE: since, "_last_gap": last_gap} | moved)
    run = F.col("d") - F.greatest("_last_gap", F.col(SINCE) - 1)
    return df.withColumns({"_behind": F.col("d") - F.col(SINCE), "_run": run})


def _of_week(df: DataFrame, offset: int, field: str) -> Column | None:
    """A field of the week ``offset`` days back, None if the frame does not hold it."""
    week = f"_week_{offset}"
    return F.col(week)[field] if week in df.columns and field in df.schema[week].dataType.names else None


def _with_stats(df: DataFrame, bases: list[Roll]) -> DataFrame:
    """The frame of ``_with_weeks`` plus one unshifted statistic per Roll, all read off the weeks of the row."""
    weeks = {(o, f): _of_week(df, o, f) for o, fs in _week_fields(bases).items() for f in fs}

    def day(offset: int) -> Column:
        return weeks[offset - offset % BLOCK, f"x{offset % BLOCK}"]

    def block(name: str, offset: int) -> Column:
        return weeks[offset, name]

    def outside(b: Roll) -> list[Column]:
        return [day(o) for o in range(_blocks(b) * BLOCK, b.window)] if _blocks(b) else [day(o) for o in _offsets(b)]

    def stat(b: Roll) -> Column:
        days = [day(o) for o in _offsets(b)]
        value_of = _from_blocks(b, block, outside(b)) if _blocks(b) else _from_days(b, days)
        if b.stride == 1:
            return F.when(F.col("_run") >= b.window, value_of)
        # A strided window may skip over days without a value.
        inside = F.col("_behind") >= (b.window - 1) * b.stride
        return F.when(inside if b.fn == "mean" else inside & _add(days).isNotNull(), value_of)

    # Means first: deviations and shapes read them as columns.
    df = df.withColumns({f"_{b.name}": stat(b) for b in bases if b.fn == "mean"})
    df = df.withColumns({f"_{b.name}": stat(b) for b in bases if b.fn not in ("mean", "median", *SHAPES)})
    # A column of its own, as a median may read two places: the sort is not repeated, nor its code.
    medians = [b for b in bases if b.fn == "median"]
    df = df.withColumns({f"_sorted_{b.name}": F.sort_array(F.array(*[F.coalesce(day(o), F.lit(0.0)) for o in _offsets(b)])) for b in medians})
    df = df.withColumns({f"_{b.name}": stat(b) for b in medians})
    # Columns of their own as well: a shape reads a moment more than once, and its code would be too long with that of others.
    for b in bases:
        if b.fn in SHAPES:
            df = df.withColumns({f"_m{k}_{b.name}": m for k, m in enumerate(_moments(b, block, outside(b)), 2)}).withColumn(f"_{b.name}", stat(b))
    return df


def add_rolls(df: DataFrame, rolls: Iterable[Roll], value: str = "residual", id_col: str = "id") -> DataFrame:
    """Add one column per Roll to a frame that has one row per (id, day).

    A statistic is NULL unless all its days have a value, and unless the days from its first one up to the row
    are there without a gap. On a gap-free daily grid,
    shifting and rolling commute, so each statistic is rolled once and then lagged
    for every shift that is asked for. Long windows are put together from seven-day blocks. So all
    columns, whatever their stride, come from three passes over one shuffle by id
    and one sort by (id, d), and no pass walks a frame of days per row. The length
    of a group is bounded by the calendar.

    What a pass costs is its lags, so they move as few and as wide values as can be: the first two passes bring the weeks
    behind a day into its row (``_with_weeks``), the last one moves all statistics of a day as one.
    """
    rolls = list(dict.fromkeys(rolls))
    by_day = Window.partitionBy(id_col).orderBy("d")
    kept = df.columns
    bases = {r.unshifted for r in rolls if r.fn != "lag"}
    bases = sorted(bases | {_mean_of(b) for b in bases if b.fn in ("std", *SHAPES)})
    lags = sorted({r.shift for r in rolls if r.fn == "lag" and r.shift})
    if not bases:
        df = with_since(df, id_col)
        return df.select(*kept, *[safe_lag(value, r.shift, by_day).alias(r.name) for r in rolls])
    df = _with_stats(_with_weeks(df, bases, value, by_day), bases)
    # Plain lags that lie in one of the weeks are read there.
    near = {s: _of_week(df, s - s % BLOCK, f"x{s % BLOCK}") for s in lags}
    near = {f"_lag_{s}": F.when(F.col("_behind") >= s, x) for s, x in near.items() if x is not None}
    shifts = sorted({r.shift for r in rolls if r.fn != "lag" and r.shift})
    unshifted = [b for b in bases if b in rolls]
    moved = sorted({r.unshifted for r in rolls if r.fn != "lag" and r.shift})
    stats = {"_stats": F.struct(*[F.col(f"_{b.name}") for b in moved])} if moved else {}
    df = df.select(*kept, "_behind", *[F.col(f"_{b.name}") for b in unshifted], *[c.alias(n) for n, c in (near | stats).items()])
    far = {f"_lag_{s}": F.lag(value, s).over(by_day) for s in lags if f"_lag_{s}" not in near}
    # Last pass: move the statistics to their shifts. Same partitioning and order.
    df = df.withColumns(far | {f"_stats_{s}": F.lag("_stats", s).over(by_day) for s in shifts})
    df = df.withColumns({n: F.when(F.col("_behind") >= int(n[5:]), F.col(n)) for n in far} | {f"_stats_{s}": F.when(F.col("_behind") >= s, F.col(f"_stats_{s}")) for s in shifts})

    def found(r: Roll) -> Column:
        if r.fn == "lag":
            return F.col(f"_lag_{r.shift}") if r.shift else F.col(value)
        return F.col(f"_stats_{r.shift}")[f"_{r.unshifted.name}"] if r.shift else F.col(f"_{r.name}")

    return df.select(*kept, *[found(r).alias(r.name) for r in rolls])


def column_sums(df: DataFrame, columns: Sequence[str], id_col: str = "id", digits: int = 3) -> DataFrame:
    """Rounded sum ``<c>`` and number of values ``n_<c>`` of each column, per series.

    Days with the same columns present are summed first and counted as one, so the aggregate over the days has half the columns, few
    enough for generated code. Few sets of present columns occur in a series, as most days have all.
    """
    words = {f"_present_{i}": columns[i : i + 62] for i in range(0, len(columns), 62)}
    present = [_add(F.when(F.col(c).isNotNull(), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")) for k, c in enumerate(w)).alias(n) for n, w in words.items()]
    sums = df.select(id_col, *columns, *present).groupBy(id_col, *words).agg(*[F.sum(c).alias(c) for c in columns], F.count("*").alias("_n"))
    counts = {c: F.sum(F.when(F.col(c).isNotNull(), F.col("_n")).otherwise(F.lit(0))) for c in columns}
    return sums.groupBy(id_col).agg(*[x for c, n in counts.items() for x in (F.round(F.sum(c), digits).alias(c), n.alias(f"n_{c}"))])


def with_statistics(df: DataFrame, value: str = "residual", id_col: str = "id") -> DataFrame:
    """The frame with the 30 statistics as of each day and ``_since``: all that ``moved_rolls`` needs.

    The other columns pass through the windows as one: a pass copies each row, and its generated method grows with the columns.
    """
    used = [id_col, "d", value]
    rest = [c for c in df.columns if c not in used]
    rows = with_since(add_rolls(df.select(*used, F.struct(*rest).alias("_rest")), ALL_ROLLS, value, id_col), id_col)
    found = [c for c in rows.columns if c not in (*used, "_rest")]
    return rows.select(*[c if c in used else F.col("_rest").getField(c).alias(c) for c in df.columns], *found)


def moved_rolls(table: DataFrame, rolls: Iterable[Roll], value: str = "residual", by: Sequence[str] = ("id",)) -> DataFrame:
    """Lag columns read off a table of ``with_statistics``: plain lags, nothing is rolled again.

    On a table that is bucketed by id this needs no exchange, whatever the horizon asks for. A column of ``by`` that
    belongs to the id, like its store, lets a filter on it pass to the scan.
    """
    by_day = Window.partitionBy(*by).orderBy("d")
    statistics = {r.name for r in ALL_ROLLS}
    kept = [c for c in table.columns if c not in statistics and c != SINCE]
    rolls = list(dict.fromkeys(rolls))
    columns = [safe_lag(value if r.fn == "lag" else r.unshifted.name, r.shift, by_day).alias(r.name) for r in rolls]
    return table.select(*kept, *columns)


# The statistics computed for every shift.
STRIDED_MEANS = [Roll(k, w, "mean") for k in (2, 3, 5) for w in (3, 6, 10)]
WEEKLY_MEANS = [Roll(7, w, "mean") for w in (2, 3, 4, 8, 12)]
WEEKLY_EXTREMES = [Roll(7, w, fn) for w in (4, 8) for fn in ("max", "min")]
DAILY_MEANS = [Roll(1, w, "mean") for w in (7, 14, 30, 60)]
DAILY_SPREADS = [Roll(1, w, fn) for w in (7, 30) for fn in ("std", "max", "min", "median")]
ALL_ROLLS = STRIDED_MEANS + WEEKLY_MEANS + WEEKLY_EXTREMES + DAILY_MEANS + DAILY_SPREADS
LAG_SHIFTS = range(1, 57)
ROLL_SHIFTS = range(1, 36)


def shifted(rolls: Iterable[Roll], shifts: Iterable[int]) -> list[Roll]:
    return [Roll(r.stride, r.window, r.fn, s) for s in shifts for r in rolls]


def all_lag_features() -> list[Roll]:
    """Every lag column of the feature store: 56 lags and 35 x 30 rolled ones."""
    return [lag(s) for s in LAG_SHIFTS] + shifted(ALL_ROLLS, ROLL_SHIFTS)
