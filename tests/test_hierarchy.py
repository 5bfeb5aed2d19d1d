import pytest
from helpers import executed_plan, long_sales, series_table
from pyspark.sql import functions as F

from shelfcast.operators import hierarchy as h
from shelfcast.schema import LEVELS


def label(keys, row):
    if not keys:
        return "Total_X"
    return f"{row[keys[0]]}_X" if len(keys) == 1 else "_".join(row[k] for k in keys)


def expected(df, value, by=()):
    out = {}
    for level, keys in LEVELS.items():
        for _, row in df.iterrows():
            node = (level, label(keys, row), *[row[b] for b in by])
            out[node] = out.get(node, 0) + row[value]
    return out


def test_membership(spark):
    series = series_table()
    rows = h.membership(spark.createDataFrame(series)).collect()
    want = {(lv, label(k, r), r["id"]) for lv, k in LEVELS.items() for _, r in series.iterrows()}
    assert {tuple(r) for r in rows} == want and len(rows) == len(want)
    sizes = h.node_list(spark.createDataFrame(series)).groupBy("level").agg(F.sum("n_series").alias("n")).collect()
    assert {r.n for r in sizes} == {len(series)}


def test_rollup(spark):
    df = long_sales(4)
    got = {(r.level, r.node, r.d): r.sales for r in h.rollup(spark.createDataFrame(df), ["sales"], by=["d"]).collect()}
    assert got == expected(df, "sales", ["d"])


def test_rollup_without_extra_keys_and_with_null_keys(spark):
    df = long_sales(3)
    got = {(r.level, r.node): r.sales for r in h.rollup(spark.createDataFrame(df), ["sales"]).collect()}
    assert got == expected(df, "sales")
    root = {"LEVEL1": ()}
    assert h.rollup(spark.createDataFrame(df), ["sales"], levels=root).collect()[0].sales == df.sales.sum()


def test_rollup_with_one_hot_leaf(spark):
    keys = "state_id string, store_id string, cat_id string, dept_id string, item_id string, sales long"
    hot = spark.range(30000).select(
        F.lit("CA").alias("state_id"), F.lit("CA_1").alias("store_id"), F.lit("F").alias("cat_id"),
        F.lit("F_1").alias("dept_id"), F.lit("F_1_001").alias("item_id"), F.lit(1).cast("long").alias("sales"),
    )
    cold = spark.createDataFrame([("TX", "TX_1", "F", "F_1", "F_1_001", 5)], keys)
    got = {(r.level, r.node): r.sales for r in h.rollup(hot.unionByName(cold), ["sales"]).collect()}
    assert got["LEVEL1", "Total_X"] == got["LEVEL10", "F_1_001_X"] == 30005
    assert got["LEVEL12", "F_1_001_CA_1"] == 30000


def test_leaf_rows_are_not_copied_for_coarse_levels(spark):
    plan = executed_plan(h.rollup(spark.createDataFrame(long_sales(2)), ["sales"], by=["d"]))
    assert plan.count("Expand") == 2 and "Python" not in plan


def test_rolldown(spark):
    series = series_table()
    values = {}
    for level, keys in LEVELS.items():
        for _, r in series.iterrows():
            values.setdefault((level, label(keys, r)), float(len(values) + 1))
    nodes = spark.createDataFrame([(*k, v) for k, v in values.items()], "level string, node string, w double")
    got = {r.id: r.w for r in h.rolldown(spark.createDataFrame(series), nodes, "w").collect()}
    for _, r in series.iterrows():
        assert got[r["id"]] == pytest.approx(sum(values[lv, label(k, r)] for lv, k in LEVELS.items()))


def test_unique_leaf_rows_give_the_same_rollup(spark):
    rows = spark.createDataFrame(long_sales(3))
    usual = h.rollup(rows, ["sales"], by=["d"])
    short = h.rollup(rows, ["sales"], by=["d"], leaf_rows=True)
    assert sorted(map(tuple, usual.collect())) == sorted(map(tuple, short.select(usual.columns).collect()))


def test_few_lookups_for_twelve_levels(spark):
    series = spark.createDataFrame(series_table())
    values = h.membership(series).select("level", "node").distinct().withColumn("v", F.pmod(F.xxhash64("level", "node"), F.lit(100)) / 7)
    want = h.membership(series).join(values, ["level", "node"]).groupBy("id").agg(F.sum("v").alias("v"))
    got = {r.id: r.v for r in h.rolldown(series, values, "v").collect()}
    assert got == pytest.approx({r.id: r.v for r in want.collect()})
    days = series.crossJoin(spark.range(1, 4).select(F.col("id").alias("d")))
    daily = values.crossJoin(spark.range(1, 3).select(F.col("id").alias("d"))).withColumn("v", F.col("v") * F.col("d"))
    by_day = {(r.id, r.d): r.v for r in h.ancestor_sum(days, daily, "v", by=["d"]).collect()}
    assert by_day == pytest.approx({(i, d): (v * d if d < 3 else 0) for i, v in got.items() for d in (1, 2, 3)})
    assert "Python" not in executed_plan(h.rolldown(series, values, "v"))
