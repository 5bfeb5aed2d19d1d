"""Column expressions on texts that several operators share; no user functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITE = "\\x20\\x09-\\x0D"
WORD = f"[^{WHITE}]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value evaluated once per row, also when lambdas refer to it many times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_of(column: str) -> Column:
    """The text; a null one is empty."""
    return F.coalesce(F.col(column), F.lit(""))


def words(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space.

    Splitting at one plain character is several times faster than at a pattern.
    """
    for c in "\t\n\x0b\f\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def occurrences(text: Column, pattern: str) -> Column:
    """How many characters of the text match a class of ASCII characters."""
    return F.octet_length(text) - F.octet_length(F.regexp_replace(text, f"[{pattern}]+", ""))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 where the whole is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / whole.cast("double"))
