"""Quality rules: a threshold table compiled into one projection.

Every statistic is a built-in column expression over the whole text, so the scan needs no shuffle, no
user function and no second pass; a row costs time linear in its words (times the logarithm of a sort).

Defined cases: a null text counts as empty; an empty text has statistics of 0 and fails ``min_words``.
Repeated rows are judged one by one. Rows keep their other columns; the statistics go into one struct
column, so no input column can clash with a statistic's name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.expressions import WORD, let, occurrences, ratio, text_of, words

SYMBOLS = "#*$%&|<>"
# Function words of four languages, as written inside a sentence; a parameter of the operator.
STOP_WORDS = (
    "the of and to in is that it was for on are as with be by this from or an a "
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als "
    "le la les de des un une et en du que qui dans pour au par sur est pas il elle "
    "el los las del y que en un una por con para se no es al lo como su"
).split()


@dataclass(frozen=True)
class Threshold:
    """A statistic must lie in [low, high]; None leaves a side open."""

    statistic: str
    low: float | None = None
    high: float | None = None


BASE = (Threshold("n_words", low=50), Threshold("repeat_word_ratio", high=0.5))
TABLE = (
    Threshold("mean_word_chars", low=2.0, high=15.0),
    Threshold("symbol_ratio", high=0.06),
    Threshold("exclamation_ratio", high=0.3),
    Threshold("capital_ratio", high=0.4),
    Threshold("stop_word_ratio", low=0.02),
    Threshold("dup_line_ratio", high=0.5),
)


def repeat_words(w: Column, width: int = 3) -> Column:
    """Words inside a window of ``width`` words that the text holds twice or more.

    Windows are sorted by (hash, position); equal neighbours are repeats. The words covered by the
    repeats are counted from their positions in order, so overlapping windows count a word once.
    Hash and position share one long (44 bits or more of hash), as primitive arrays sort fastest;
    texts of over 2**20 words keep them apart.
    """
    gap = F.lit(width)
    last = F.size(w) - width
    places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    window = lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)])
    mask = (1 << 20) - 1

    def repeats(s: Column, key, place) -> Column:
        same = lambda x, i: F.coalesce(key(F.get(s, i)) == key(x), F.lit(False))
        return F.transform(F.filter(s, lambda x, i: same(x, i - 1) | same(x, i + 1)), place)

    short = let(
        F.sort_array(F.transform(places, lambda i: window(i).bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long")))),
        lambda s: repeats(s, lambda x: F.shiftright(x, 20), lambda x: x.bitwiseAND(F.lit(mask)).cast("int")),
    )
    long = let(
        F.sort_array(F.transform(places, lambda i: F.struct(window(i).alias("h"), i.alias("p")))),
        lambda s: repeats(s, lambda x: x["h"], lambda x: x["p"]),
    )

    def covered(state: Column, p: Column) -> Column:
        return F.struct((state["n"] + F.least(gap, p - state["last"])).alias("n"), p.alias("last"))

    start = F.struct(F.lit(0).alias("n"), F.lit(-width).alias("last"))
    found = F.sort_array(F.when(last <= mask, short).otherwise(long))
    return F.aggregate(found, start, covered, lambda state: state["n"].cast("long"))


def statistics(text: Column, stop_words: Sequence[str] = STOP_WORDS, symbols: str = SYMBOLS) -> Column:
    """All statistics of a text as one struct."""
    stops = list(dict.fromkeys(stop_words))

    def counts(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.size(F.filter(w, lambda x: x.isin(stops))).cast("long").alias("n_stop_words"),
            repeat_words(w).alias("n_repeat_words"),
        )

    def line_counts(lines: Column) -> Column:
        n = F.size(lines)
        return F.struct(n.cast("long").alias("n_lines"), (n - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))

    def together(c: Column) -> Column:
        a, b, s = c["words"], c["lines"], c["symbols"]
        return F.struct(
            a["n_words"], a["word_chars"], s.alias("n_symbols"), b["n_dup_lines"], a["n_repeat_words"],
            ratio(a["word_chars"], a["n_words"]).alias("mean_word_chars"),
            ratio(s, a["word_chars"]).alias("symbol_ratio"),
            ratio(c["exclamations"], a["n_words"]).alias("exclamation_ratio"),
            ratio(c["capitals"], a["word_chars"]).alias("capital_ratio"),
            ratio(a["n_stop_words"], a["n_words"]).alias("stop_word_ratio"),
            ratio(b["n_dup_lines"], b["n_lines"]).alias("dup_line_ratio"),
            ratio(a["n_repeat_words"], a["n_words"]).alias("repeat_word_ratio"),
        )

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    parts = F.struct(
        let(words(text), counts).alias("words"),
        let(lines, line_counts).alias("lines"),
        occurrences(text, symbols).cast("long").alias("symbols"),
        occurrences(text, "!").alias("exclamations"),
        occurrences(text, "A-Z").alias("capitals"),
    )
    return let(parts, together)


def passes(stats: Column, table: Sequence[Threshold]) -> Column:
    """Whether the statistics lie inside every threshold of the table."""
    tests = []
    for t in table:
        if t.low is not None:
            tests.append(stats[t.statistic] >= F.lit(t.low))
        if t.high is not None:
            tests.append(stats[t.statistic] <= F.lit(t.high))
    return reduce(Column.__and__, tests, F.lit(True))


def apply_rules(
    docs: DataFrame, text: str = "text", base: Sequence[Threshold] = BASE, table: Sequence[Threshold] = TABLE,
    stop_words: Sequence[str] = STOP_WORDS, into: str = "quality",
) -> DataFrame:
    """docs with one struct column: the statistics, ``base_failed`` and ``kept``."""
    stats = statistics(text_of(text), stop_words)
    verdict = lambda s: F.struct(s.alias("stats"), (~passes(s, base)).alias("base_failed"), passes(s, [*base, *table]).alias("kept"))
    return docs.withColumn(into, let(stats, verdict))
