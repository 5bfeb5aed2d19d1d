import numpy as np
import pandas as pd
import pytest
from helpers import executed_plan, long_sales, series_table

from shelfcast.operators.encode import PLACES, encode, encoding_name, join_encodings, series_encodings, term_cutoffs
from shelfcast.schema import ENCODED_LEVELS

PARTS = {"all": [], "wday": ["wday"], "dom": ["day"]}


def fact(n_days=150):
    df = long_sales(n_days)
    df["residual"] = df.sales - df.d % 5 / 4
    df["sell_price"] = np.where(df.d < 20, np.nan, 2.0)
    df["wday"] = df.d % 7 + 1
    df["day"] = df.d % 30 + 1
    return df


def to_spark(spark, df):
    return spark.createDataFrame(df.astype({"sell_price": object}).where(df.notna(), None), ", ".join(
        f"{c} {'string' if df[c].dtype == object else 'double' if df[c].dtype.kind == 'f' else 'int'}" for c in df.columns
    ))


def test_cutoffs():
    assert term_cutoffs(1941) == {"private": 1942, "public": 1914, "validation": 1886, "semival": 1858}


def test_encodings_against_pandas(spark):
    df = fact()
    cutoffs = term_cutoffs(150)
    rows = to_spark(spark, df)
    enc = encode(rows, cutoffs)
    for term in ("private", "semival"):
        got = join_encodings(rows, spark.createDataFrame(series_table()), enc, term).toPandas()
        got = got.sort_values(["id", "d"]).reset_index(drop=True)
        seen = df.sort_values(["id", "d"]).reset_index(drop=True)
        seen["y"] = seen.residual.where(seen.sell_price.notna() & (seen.d < cutoffs[term]))
        for level, keys in ENCODED_LEVELS.items():
            for part, extra in PARTS.items():
                for fn in ("mean", "std"):
                    want = seen.groupby([*keys, *extra]).y.transform(fn)
                    have = got[encoding_name(part, level, fn)].astype(float)
                    assert np.allclose(have, want, equal_nan=True, atol=1e-9), (term, level, part, fn)


def test_group_of_one_has_no_deviation(spark):
    one = pd.DataFrame([("a", "CA", "CA_1", "F", "F_1", "F_1_001", 1, 2.5, 1.0, 3, 9)],
                       columns=["id", "state_id", "store_id", "cat_id", "dept_id", "item_id", "d", "residual", "sell_price", "wday", "day"])
    rows = encode(to_spark(spark, one), {"t": 10}).collect()
    assert {(r.mean, r.std, r.n) for r in rows} == {(2.5, None, 1)}
    hidden = encode(to_spark(spark, one), {"t": 1}).collect()
    assert {(r.mean, r.std, r.n) for r in hidden} == {(None, None, 0)}


@pytest.mark.parametrize("spread, around, digits", [(0, 1e8, 1e-9), (1e8, 0.0, 1e-6)])
def test_deviation_beside_a_large_mean(spark, spread, around, digits):
    df = fact(60)
    df["residual"] = 1e8 + spread * (df.store_id == "CA_1") + df.d % 7 / 8 + (df.item_id == "FOODS_1_001") / 4
    rows = to_spark(spark, df)
    got = {(r.level, r.node, r.part, r.part_value): r for r in encode(rows, {"t": 61}, price=None, around=around).collect()}
    for level, keys in (("LEVEL3", ["store_id"]), ("LEVEL5", ["dept_id"]), ("LEVEL10", ["item_id"]), ("LEVEL12", ["item_id", "store_id"])):
        for part, extra in PARTS.items():
            for key, y in df.groupby([*keys, *extra]).residual:
                key = key if isinstance(key, tuple) else (key,)
                node = "_".join(key[: len(keys)]) + ("_X" if len(keys) == 1 else "")
                r = got[level, node, part, key[-1] if extra else None]
                assert r.n == len(y) and r["mean"] == pytest.approx(y.mean(), rel=1e-12)
                if y.nunique() == 1:
                    assert r["std"] < 1e-6
                    continue
                centred = (y - np.floor(y.mean())).std()
                assert r["std"] == pytest.approx(centred, rel=digits)


def test_one_lookup_for_all_levels_above_the_item(spark):
    rows = to_spark(spark, fact(60))
    plan = executed_plan(series_encodings(spark.createDataFrame(series_table()), encode(rows, {"t": 50}), "t"))
    assert "BroadcastHashJoin" in plan or "SortMergeJoin" in plan
    arrays = series_encodings(spark.createDataFrame(series_table()), encode(rows, {"t": 50}), "t").first()
    assert all(len(arrays[level][part]) == n for level in ENCODED_LEVELS for part, n in PLACES.items())
