"""The model queries train every store on the manifest's features, with the weights of the series."""

import os

import pytest
from helpers import executed_plan
from pyspark.sql import functions as F

from shelfcast.catalog import model_queries as mq
from shelfcast.catalog import retail as r
from shelfcast.operators import model as om
from shelfcast.plans.manifests import feature_columns
from shelfcast.schema import ANCHORS, TERMS

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")


class NoTables:
    store_weights = None


def test_grids_hold_every_term_horizon_and_store():
    (final, p), (past, q) = mq.grids(["A", "B"], NoTables, range(1, 29), ANCHORS, TERMS, om.FINAL, om.BACKTEST)
    assert {(t.term, t.horizon, t.store) for t in final} == {(TERMS[0], h, s) for h in range(1, 29) for s in "AB"}
    assert {(t.term, t.horizon, t.store) for t in past} == {(t, h, s) for t in TERMS[1:] for h in ANCHORS for s in "AB"}
    assert (p.params.trees, q.params.trees, p.judge, q.judge.flag) == (1500, 1500, None, "in_eval")
    assert (p.overrides, q.overrides) == (om.FINAL_OVERRIDES, om.OVERRIDES)


def test_fact_and_weights(spark):
    inputs = mq.Inputs(spark, SF)
    fact = mq.retail_fact(spark, SF, inputs.leaf)
    days = fact.groupBy("id").agg(F.count("*").alias("n"), F.min("d").alias("lo"), F.max("d").alias("hi")).collect()
    assert len(days) > 50 and {(r.n, r.lo, r.hi) for r in days} == {(inputs.last_day + 28, 1, inputs.last_day + 28)}
    assert fact.select("store_id", "state_id").distinct().where(F.col("store_id") == F.col("state_id")).isEmpty()
    assert {len(feature_columns(h)) for h in (7, 9)} == {169, 190}
    total = inputs.store_weights.groupBy("store_id", "level").agg(F.sum("weight").alias("w")).collect()
    assert {r.store_id for r in total} == {r.store_id for r in inputs.leaf.select("store_id").distinct().collect()}
    assert all(r.w <= 1 / 12 + 1e-9 for r in total)
    assert inputs.train_weights.count() == inputs.leaf.select("id").distinct().count()


def test_type_sales_make_no_row_per_item(spark):
    """The sums of all items of a type, without a shuffle of line items by item."""
    got = r.type_sales(spark, SF)
    by_item = r.leaf_sales(spark, SF).groupBy("state_id", "store_id", "cat_id", "d").agg(F.sum("sales").alias("sales"), F.sum("cents").alias("cents"))
    columns = ["state_id", "store_id", "cat_id", "d", "sales", "cents"]
    assert {tuple(x) for x in got.select(columns).collect()} == {tuple(x) for x in by_item.select(columns).collect()}
    assert got.where("id <> concat(cat_id, '_', store_id) OR dept_id <> cat_id OR item_id <> cat_id").isEmpty()
    assert "REPARTITION_BY_NUM" not in executed_plan(got)
