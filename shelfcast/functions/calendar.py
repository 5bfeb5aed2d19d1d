"""Column expressions on dates and day numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Days of the recurring events, as day numbers of the retail calendar.
# Spans are (first day, last day).
FINALS_SPANS = [(123, 135), (501, 510), (860, 874), (1224, 1234), (1588, 1600), (1952, 1969)]
FASTING_SPANS = [(185, 214), (539, 568), (893, 922), (1248, 1277), (1602, 1631), (1957, 1969)]
MOTHERS_DAYS = [100, 471, 835, 1199, 1563, 1927]
ORTHODOX_EASTER_DAYS = [86, 443, 828, 1178, 1535, 1920]
EASTER_DAYS = [86, 436, 793, 1178, 1528, 1885]
INDEPENDENCE_COUNTDOWN_STARTS = [151, 517, 882, 1247, 1612]
COUNTDOWN_LENGTH = 10
FLAGGED_YEARS = [2012, 2016]
MOON_PHASE_AT_EPOCH = "0.20439731"
MOON_CYCLES_PER_DAY = "0.03386319269"
EVENT_NAME_2_CODES = {"Cinco De Mayo": 0, "Easter": 1, "Father's day": 2, "OrthodoxEaster": 3}
EVENT_TYPE_2_CODES = {"Cultural": 0, "Religious": 1}
LABEL_EVENT_TYPES = ["Sporting", "Cultural", "National", "Religious"]
LABEL_STATES = ["CA", "TX", "WI"]
LABEL_CATS = ["HOBBIES", "HOUSEHOLD", "FOODS"]


def day_serial(d: Column) -> Column:
    """``d_17`` -> 17."""
    return F.substring(d, 3, 10).cast("int")


def is_weekend(date: Column) -> Column:
    """1 on Saturday and Sunday."""
    return F.dayofweek(date).isin(1, 7).cast("int")


def week_serial(date: Column, first: Column, start: int = 2) -> Column:
    """Week number in blocks of seven calendar rows counted from the first row."""
    return (F.floor(F.datediff(date, first) / 7) + start).cast("int")


def week_of(date: Column, first: Column, unit: str) -> Column:
    """Week number inside the month (``unit="MM"``) or year (``"YYYY"``), from 1.

    The smallest week serial of a month belongs to its first calendar row, so it is
    computed from that date: no group, no window.
    """
    opening = F.greatest(F.trunc(date, unit), first)
    return week_serial(date, first) - week_serial(opening, first) + 1


def moon_phase(date: Column) -> Column:
    """Moon phase 0..7 in exact decimal arithmetic."""
    days = F.datediff(date, F.lit("2001-01-01").cast("date")).cast("decimal(9,0)")
    cycles = F.lit(MOON_PHASE_AT_EPOCH).cast("decimal(9,8)") + days * F.lit(MOON_CYCLES_PER_DAY).cast("decimal(12,11)")
    # Truncated remainder, as decimal arithmetic defines it for dates before the epoch.
    fraction = cycles % F.lit(1).cast("decimal(1,0)")
    return F.pmod(F.floor(fraction * 8 + F.lit("0.5").cast("decimal(2,1)")).cast("int"), F.lit(8))


def year_flag(date: Column, years: Sequence[int] = FLAGGED_YEARS) -> Column:
    """1 in the given years."""
    return F.year(date).isin(*years).cast("int")


def _chain(d: Column, branches: Sequence[tuple[Column, Column]]) -> Column:
    out = None
    for cond, value in branches:
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def span_flag(d: Column, spans: Sequence[tuple[int, int]]) -> Column:
    """1 inside any of the day spans."""
    return _chain(d, [(d.between(a, b), F.lit(1)) for a, b in spans])


def day_and_eve(d: Column, days: Sequence[int]) -> Column:
    """1 on the day, 2 on its eve, else 0."""
    return F.when(d.isin(*days), 1).when((d + 1).isin(*days), 2).otherwise(0)


def countdown(d: Column, starts: Sequence[int], length: int = COUNTDOWN_LENGTH) -> Column:
    """1..length from each start day on, else 0."""
    return _chain(d, [(d.between(s, s + length - 1), d - s + 1) for s in starts])


def event_columns(d: Column) -> dict[str, Column]:
    """The six day-number event features, by name."""
    return {
        "NBA_finals": span_flag(d, FINALS_SPANS),
        "Ramadan_Starts": span_flag(d, FASTING_SPANS),
        "Mothers_day": day_and_eve(d, MOTHERS_DAYS),
        "OrthodoxEaster": day_and_eve(d, ORTHODOX_EASTER_DAYS),
        "Easter": day_and_eve(d, EASTER_DAYS),
        "IndependenceDay": countdown(d, INDEPENDENCE_COUNTDOWN_STARTS),
    }


def coded(value: Column, codes: dict[str, int]) -> Column:
    """Dictionary code of a label, NULL if it is not listed."""
    out = None
    for label, code in codes.items():
        cond = value == label
        out = F.when(cond, code) if out is None else out.when(cond, code)
    return out


def composite_label(
    state: Column,
    cat: Column,
    event_type: Column,
    states: Sequence[str] = LABEL_STATES,
    cats: Sequence[str] = LABEL_CATS,
    types: Sequence[str] = LABEL_EVENT_TYPES,
) -> Column:
    """1.. for each (event type, state, category), 0 without a listed event."""
    s = coded(state, {x: i for i, x in enumerate(states)})
    c = coded(cat, {x: i for i, x in enumerate(cats)})
    t = coded(event_type, {x: i for i, x in enumerate(types)})
    return F.coalesce((t * len(states) + s) * len(cats) + c + 1, F.lit(0))


def state_pick(state: Column, columns: dict[str, Column]) -> Column:
    """The column that belongs to the row's state, 0 for other states."""
    return _chain(state, [(state == name, col) for name, col in columns.items()])
