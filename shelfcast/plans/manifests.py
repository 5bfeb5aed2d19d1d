"""Which columns feed a model."""

from __future__ import annotations

from shelfcast.operators.encode import encoding_name
from shelfcast.operators.lags import (
    DAILY_MEANS,
    DAILY_SPREADS,
    Roll,
    STRIDED_MEANS,
    WEEKLY_EXTREMES,
    WEEKLY_MEANS,
    lag,
    shifted,
)
from shelfcast.schema import ENCODED_LEVELS

# The 40 basic columns of a training frame.
BASIC_COLUMNS = [
    "id_serial", "id", "is_weekend", "sell_start", "date", "snap_total", "day", "sell_price",
    "event_name_1", "week_of_month", "wday", "week_of_year", "sell_start_log", "Mothers_day",
    "national_holiday", "NBA_finals", "sell_price_minority12", "year", "month",
    "olympic_president_elec_year", "OrthodoxEaster", "store_id", "moon", "cat_id",
    "Ramadan_Starts", "IndependenceDay", "last_sales", "event_name_2", "event_type_2",
    "event_type_statecat_labelenc", "Easter", "item_id", "dept_id", "state_id",
    "price_unique_item_state", "price_momentum_m_item_state", "price_momentum_y_item_state",
    "price_unique_item_store", "price_momentum_m_item_store", "price_momentum_y_item_store",
]

# Columns that a model treats as categories.
CATEGORICAL_COLUMNS = [
    "id_serial", "cat_id", "dept_id", "event_name_1", "item_id", "wday", "day", "store_id",
    "state_id", "sell_price_minority12", "event_type_statecat_labelenc", "moon",
]

LABEL = "residual"
NOT_FEATURES = ("id", "date", LABEL)


def encoding_columns() -> list[str]:
    return [
        encoding_name(part, level, fn)
        for part in ("all", "wday", "dom")
        for level in ENCODED_LEVELS
        for fn in ("mean", "std")
    ]


def base_manifest() -> list[str]:
    """The 107 columns of a base frame: basics, one term's encodings, label."""
    return [*BASIC_COLUMNS, *encoding_columns(), LABEL]


def lag_shifts(h: int) -> list[int]:
    """Shifts of the rolled columns for horizon ``h``: itself and the next two whole weeks."""
    week = -(-h // 7) * 7
    return sorted({h, week, week + 7})


def lag_manifest(h: int) -> list[Roll]:
    """Lag columns of horizon ``h``: 65 if it is a whole number of weeks, else 86."""
    shifts = lag_shifts(h)
    return [
        *shifted(WEEKLY_MEANS + WEEKLY_EXTREMES, shifts),
        *shifted(STRIDED_MEANS, [h]),
        *shifted(DAILY_MEANS + DAILY_SPREADS, shifts),
        *[lag(s) for s in range(h, h + 14)],
    ]


def feature_columns(h: int) -> list[str]:
    """Model inputs of horizon ``h`` (R20): 169 or 190 names."""
    return [c for c in base_manifest() if c not in NOT_FEATURES] + [r.name for r in lag_manifest(h)]
