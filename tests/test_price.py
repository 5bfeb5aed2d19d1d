import numpy as np
import pandas as pd
from helpers import ITEMS, STORES
from pyspark.sql import functions as F

from shelfcast.functions.price import has_price, minor_digits, without_suffix
from shelfcast.operators.price import join_prices, price_features


def price_table(n_weeks=30):
    rng = np.random.default_rng(3)
    rows = [
        (store, item, w, float(rng.choice([1.97, 2.5, 2.98])), state)
        for store, state in STORES.items()
        for item in ITEMS
        for w in range(n_weeks)
        if rng.random() < 0.8
    ]
    return pd.DataFrame(rows, columns=["store_id", "item_id", "wm_yr_wk", "sell_price", "state_id"])


def test_price_features_against_pandas(spark):
    p = price_table()
    weeks = pd.DataFrame({"wm_yr_wk": range(30), "month": [w // 4 % 12 + 1 for w in range(30)], "year": [2011 + w // 20 for w in range(30)]})
    got = price_features(spark.createDataFrame(p), spark.createDataFrame(weeks)).toPandas()
    p = p.merge(weeks, on="wm_yr_wk", how="left").sort_values(["store_id", "item_id", "wm_yr_wk"])
    for side, keys in (("state", ["state_id", "item_id"]), ("store", ["store_id", "item_id"])):
        p[f"price_unique_item_{side}"] = p.groupby(keys).sell_price.transform("nunique")
        for short, unit in (("m", "month"), ("y", "year")):
            p[f"price_momentum_{short}_item_{side}"] = p.sell_price / p.groupby([*keys, unit]).sell_price.transform("mean")
    p["sell_start"] = p.groupby(["store_id", "item_id"]).cumcount() + 1
    p["sell_start_log"] = np.log(p.sell_start)
    key = ["store_id", "item_id", "wm_yr_wk"]
    got = got.sort_values(key).reset_index(drop=True)
    p = p.sort_values(key).reset_index(drop=True)
    for c in got.columns:
        if got[c].dtype.kind in "if":
            assert np.allclose(got[c].astype(float), p[c].astype(float)), c


def test_week_without_price_stays(spark):
    fact = spark.createDataFrame([("CA_1", "A", 1), ("CA_1", "A", 2)], "store_id string, item_id string, wm_yr_wk int")
    price = spark.createDataFrame([("CA_1", "A", 1, 2.0)], "store_id string, item_id string, wm_yr_wk int, sell_price double")
    got = {x.wm_yr_wk: x.sell_price for x in join_prices(fact, price).collect()}
    assert got == {1: 2.0, 2: None}


def test_minor_digits(spark):
    df = spark.createDataFrame([(2.5,), (9.97,), (3.0,), (0.05,), (None,)], "p double")
    got = df.select(minor_digits(F.col("p")), minor_digits(F.col("p"), as_text=True), has_price(F.col("p"))).collect()
    assert [x[0] for x in got] == [50, 97, 0, 5, 9999]
    assert [x[1] for x in got] == [5, 97, 0, 5, 9999]
    assert [x[2] for x in got] == [True, True, True, True, False]
    assert spark.createDataFrame([("FOODS_3_090",)], "k string").select(without_suffix(F.col("k"), 4)).first()[0] == "FOODS_3"
