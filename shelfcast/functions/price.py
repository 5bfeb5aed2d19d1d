"""Column expressions on prices and on key text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: code of a missing price.
NO_PRICE_CODE = 9999


def state_of(store: Column) -> Column:
    """State key: the first two characters of a store key (F1)."""
    return F.substring(store, 1, 2)


def without_suffix(key: Column, n: int) -> Column:
    """Key without its last ``n`` characters (F2)."""
    return F.left(key, F.length(key) - n)


def fraction(price: Column) -> Column:
    """Fractional part of a price."""
    return price - F.floor(price)


def minor_digits(price: Column, as_text: bool = False) -> Column:
    """Digits after the decimal point as a number, ``NO_PRICE_CODE`` without a price.

    Prices are read as exact cents. ``as_text=True`` drops a trailing zero the way
    printing the fraction does: .50 gives 5 and not 50.
    """
    cents = ((price.cast("decimal(14,2)") * 100).cast("long") % 100).cast("int")
    if as_text:
        cents = F.when(cents % 10 == 0, (cents / 10).cast("int")).otherwise(cents)
    return F.coalesce(cents, F.lit(NO_PRICE_CODE))


def has_price(price: Column) -> Column:
    """True where a price is known (F26), never NULL."""
    return F.coalesce(price >= 0, F.lit(False))


def revenue(sales: Column, price: Column) -> Column:
    """Units times price."""
    return sales * price
