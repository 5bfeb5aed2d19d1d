"""Seeded small tables and plan helpers."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd

STORES = {"CA_1": "CA", "CA_2": "CA", "TX_1": "TX", "TX_2": "TX"}
ITEMS = ["FOODS_1_001", "FOODS_1_002", "HOBBIES_2_001"]


def series_table() -> pd.DataFrame:
    rows = []
    for store, state in STORES.items():
        for item in ITEMS:
            dept = item[:-4]
            rows.append((f"{item}_{store}", item, dept, dept[:-2], store, state))
    return pd.DataFrame(rows, columns=["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"])


def wide_sales(n_days: int, seed: int = 1) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    series = series_table()
    values = rng.poisson(1.2, size=(len(series), n_days)) * (rng.random((len(series), n_days)) < 0.6)
    values[0, :40] = 0
    values[1, :] = 0
    days = pd.DataFrame(values.astype(int), columns=[f"d_{i + 1}" for i in range(n_days)])
    return pd.concat([series, days], axis=1)


def long_sales(n_days: int, seed: int = 1) -> pd.DataFrame:
    wide = wide_sales(n_days, seed)
    keys = [c for c in wide.columns if not c.startswith("d_")]
    out = wide.melt(id_vars=keys, var_name="d", value_name="sales")
    out["d"] = out["d"].str[2:].astype(int)
    return out


def roll_pandas(df: pd.DataFrame, roll, value: str = "residual") -> pd.Series:
    """Shift by id, then roll inside (id, d mod k): the definition, not the plan."""
    df = df.sort_values(["id", "d"])
    moved = df.groupby("id")[value].shift(roll.shift)
    if roll.fn == "lag":
        return moved
    work = df.assign(v=moved, k=df["d"] % roll.stride)
    return work.groupby(["id", "k"])["v"].transform(lambda x: getattr(x.rolling(roll.window), roll.fn)())


def executed_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffled(rows: list, seed: int = 0) -> list:
    rows = list(rows)
    random.Random(seed).shuffle(rows)
    return rows
