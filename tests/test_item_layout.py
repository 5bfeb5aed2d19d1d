"""Steps on rows laid out by item: the same results as on long rows, and no day takes a row of its own in a shuffle."""

import os
import re

import pytest
from helpers import executed_plan, long_sales
from pyspark.sql import functions as F

from shelfcast.catalog import forecast_queries, hierarchy_queries
from shelfcast.catalog import retail as r
from shelfcast.operators import backtest as ob
from shelfcast.operators import encode as oe
from shelfcast.operators import forecast as of
from shelfcast.operators import hierarchy as oh
from shelfcast.operators import intervals as oi
from shelfcast.operators import metrics as om
from shelfcast.operators import target as ot
from shelfcast.plans.forecast import intervals
from shelfcast.schema import KEYS
from shelfcast.sources import store

SF = "/root/testdata/sf0.001"
N = 450


@pytest.fixture(scope="module")
def sparse(spark):
    df = long_sales(N)
    df["wday"], df["day"] = df.d % 7 + 1, df.d % 31 + 1
    rows = spark.createDataFrame(df[df.sales > 0]).repartition(3, "item_id")
    return rows.cache()


def found(df, keys, digits=9):
    values = [c for c in df.columns if c not in keys]
    return {tuple(r[k] for k in keys): tuple(None if r[v] is None else round(r[v], digits) for v in values) for r in df.collect()}


def wide_errors(sparse):
    days = range(N - 27, N + 1)
    wide = ot.baseline_columns(sparse, days[0], days[-1], keys=["id", *KEYS])
    return wide.select("id", *KEYS, *[(F.col(f"baseline_{d}") - F.col(f"sales_{d}")).alias(f"err_{d}") for d in days]), {d: f"err_{d}" for d in days}


def long_errors(sparse):
    rows = ot.baseline_on(sparse, N - 27, N, keep=KEYS)
    return rows.withColumn("err", F.col("baseline") - F.col("sales"))


def weights(sparse, scale):
    nodes = oh.rollup(sparse, ["sales"])
    return om.node_weights(scale, nodes.withColumn("weight", F.col("sales") / F.lit(1000.0)))


def test_scale_where_items_lie(sparse):
    usual = om.rmsse_scale(oh.rollup(sparse, ["sales"], by=["d"]), N)
    placed = om.hierarchy_scale(sparse, N)
    assert found(placed, ("level", "node")) == found(usual, ("level", "node"))
    fine = om.hierarchy_scale(sparse, N, levels={"LEVEL11": ("state_id", "item_id"), "LEVEL12": ("item_id", "store_id")})
    assert "Exchange" not in executed_plan(fine).split("InMemoryTableScan")[0]


def test_rmsse_and_residual_of_day_columns(sparse):
    w = weights(sparse, om.rmsse_scale(oh.rollup(sparse, ["sales"], by=["d"]), N))
    wide, columns = wide_errors(sparse)
    keys = ("level", "node")
    assert found(om.node_rmsse(wide, w, error=list(columns.values())), keys) == found(om.node_rmsse(long_errors(sparse), w), keys)
    got = om.hierarchical_residual(wide, w, columns)
    assert found(got, ("id", "d"), 7) == found(om.hierarchical_residual(long_errors(sparse), w), ("id", "d"), 7)


def test_backtest_errors_of_day_columns(sparse):
    """Absent days stay absent, so they sort as before and are counted as before."""
    first, last, window = N - 83, N, 28
    wide = ob.moving_mean_errors(sparse.where(F.col("item_id") != "FOODS_1_002"), first, last, window, keys=["id", *KEYS])
    columns = [f"err_{d}" for d in range(first, last + 1)]
    cells = F.inline(F.array(*[F.struct(F.lit(int(c[4:])).alias("d"), F.col(c).alias("err")) for c in columns]))
    rows = wide.select("id", *KEYS, "anchor", cells).where("err IS NOT NULL")
    sales = {(r.id, r.d): r.sales for r in sparse.collect()}
    for r in rows.where("id = 'FOODS_1_001_TX_1'").collect():
        mean = sum(sales.get((r.id, r.d - r.anchor - i), 0) for i in range(window)) / window
        assert r.err == pytest.approx(mean - sales.get((r.id, r.d), 0))
    usual = {(r.anchor, r.level, r.node): r.abs_err for r in oi.node_errors(rows).collect()}
    got = {(r.anchor, r.level, r.node): r.abs_err for r in oi.node_errors(wide, columns=columns).collect()}
    assert got.keys() == usual.keys() and all(got[k] == pytest.approx(usual[k], abs=1e-12) for k in usual)


def test_encodings_where_items_lie(sparse):
    args = dict(cutoffs={"a": 451, "b": 30}, value="sales", price=None)
    keys = ("term", "level", "node", "part", "part_value")
    assert found(oe.encode(sparse, by_item=True, **args), keys) == found(oe.encode(sparse, **args), keys)


@pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")
@pytest.mark.parametrize("name, step", [("node_rmsse", "Generate"), ("wrmsse_by_store", "Generate"), ("interval_halfwidth", "sequence(")])
def test_no_row_per_day(spark, name, step):
    """A series was multiplied by its 28 (or 84) days ahead of the shuffles; the five anchors still are rows."""
    import __spark_entry__ as entry

    assert step not in executed_plan(entry.queries()[name](spark, SF))


@pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")
def test_partitions_by_item_follow_the_line_items(spark, monkeypatch):
    columns = ["id", "d", "sales", "cents"]
    few = r.leaf_sales(spark, SF).select(columns)
    monkeypatch.setattr(r, "LINES_PER_PARTITION", 500)
    many = r.leaf_sales(spark, SF).select(columns)
    n = r.table(spark, SF, "lineitem").count()
    assert r.by_item(spark, SF).rdd.getNumPartitions() == r.by_item(spark, SF, first=2000).rdd.getNumPartitions() == -(-n // 500) > 4
    assert found(many, ("id", "d")) == found(few, ("id", "d"))


def test_forecasts_meet_where_items_lie(spark, sparse):
    rows = [("a", "a_1", 1, 2.0), ("a", "a_1", 28, 4.0), ("b", "b_1", 1, 6.0), ("x", "x_1", 1, 9.0)]
    keys = ("item_id", "id")
    placed = spark.createDataFrame(rows, "item_id string, id string, h int, forecast double").repartition(3, "item_id").cache()
    series = spark.createDataFrame([("a", "a_1"), ("a", "a_2"), ("b", "b_1")], "item_id string, id string").repartition(3, "item_id").cache()
    wide = of.forecast_wide(placed, index=keys)
    for out, part in ((of.wide_on(series, wide, keys), 1), (of.blend_wide([wide, of.forecast_wide(placed.where("id = 'a_1'"), index=keys)], series, keys=keys), 2)):
        assert {(x.id, x.F1, x.F2, x.F28) for x in out.collect()} == {("a_1", 2.0, 0.0, 4.0), ("a_2", 0.0, 0.0, 0.0), ("b_1", 6.0 / part, 0.0, 0.0)}


@pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")
def test_no_forecast_is_shuffled_by_id(spark):
    for query in (forecast_queries.submission_half, forecast_queries.blend_mean):
        assert not re.findall(r"Exchange hashpartitioning\((?:item_id#\d+, )?id#", executed_plan(query(spark, SF)))


def test_intervals_of_arrays(spark, sparse):
    """Predictions with the days of a term as arrays give the intervals of the same predictions with a row per day."""
    first, last, window, days = N - 83, N, 28, range(1, 29)
    # A series that is new in the last term, and one that is sold twice on a day.
    lines = sparse.where((F.col("item_id") != "FOODS_1_002") | (F.col("d") > N - 20)).unionByName(sparse.where("id = 'FOODS_1_001_TX_1'"))
    wide = ob.moving_mean_predictions(lines, first, last, window, keys=["id", *KEYS]).withColumn("term", ob.assign_term(F.col("first_day"), N))
    cells = F.posexplode(F.arrays_zip("pred", "target")).alias("at", "x")
    rows = wide.select("id", *KEYS, "term", "anchor", "first_day", cells).where("x.pred IS NOT NULL").select(
        "id", "term", "anchor", (F.col("first_day") + F.col("at")).alias("d"), "x.pred", "x.target"
    )
    sold = {}
    for x in lines.collect():
        sold[x.id, x.d] = sold.get((x.id, x.d), 0) + x.sales
    got = {(x.id, x.anchor, x.d): (x.pred, x.target, x.term) for x in rows.collect()}
    for (i, a, d), (pred, target, term) in got.items():
        assert pred == pytest.approx(sum(sold.get((i, d - a - k), 0) for k in range(window)) / window)
        assert target == sold.get((i, d), 0) and term == ["public", "validation", "semival"][(last - d) // 28]
    reached = {(i, a, t) for i, d in sold for a in (1, 7, 14, 21, 28) for t in [d, *range(d + a, d + a + window)] if first <= t <= last}
    assert reached == got.keys()

    series = sparse.select("id", *KEYS).distinct().repartition(3, "item_id").cache()
    points = series.where("id <> 'FOODS_1_001_CA_1'").withColumn("forecast", F.array(*[F.lit(float(h)) if h != 3 else F.lit(None).cast("double") for h in days]))
    long = points.select("id", F.posexplode("forecast").alias("h", "forecast")).where("forecast IS NOT NULL").withColumn("h", F.col("h") + 1)
    assert found(intervals(wide, points, series, partitions=3), ("id",), 7) == found(intervals(rows, long, series), ("id",), 7)


@pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")
def test_stored_predictions_have_no_row_per_day(spark):
    rows = forecast_queries.naive_predictions(spark, SF).groupBy("term", "anchor", "id").count()
    assert rows.where("count > 1").isEmpty() and not rows.where("anchor IS NULL").isEmpty()


def test_dealt_predictions_are_one_file_per_slot(spark, tmp_path):
    columns = "term string, anchor int, id string, pred double"
    rows = [(t, a, f"s{i}", float(i)) for t, a in (("public", 1), ("public", 7), ("private", None)) for i in range(20)]
    path = str(tmp_path / "predictions")
    table = store.write_predictions(spark.createDataFrame(rows, columns).repartition(5), path, files=2)
    assert sorted(map(tuple, table.select("term", "id", "pred").collect())) == sorted((t, i, p) for t, _, i, p in rows)
    assert {len(list(p.glob("*.parquet"))) for p in tmp_path.glob("predictions/*/*")} == {2}
    store.write_predictions(spark.createDataFrame([("public", 7, "s1", -1.0)], columns), path, files=2)
    assert store.read_predictions(spark, path).where("anchor = 7").count() == 1 and store.read_predictions(spark, path).count() == 41


@pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")
def test_lines_are_shuffled_once(spark):
    """They were shuffled by supplier first, and once more for the levels without an item."""
    setting = "spark.sql.adaptive.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    plan = executed_plan(hierarchy_queries.scale(spark, SF, by=["part"]))
    spark.conf.set(setting, before)
    assert "hashpartitioning(l_suppkey" not in plan and plan.count("lineitem.parquet") == 1


def test_scale_leaves_out_later_days(sparse):
    usual = om.rmsse_scale(oh.rollup(sparse.where(f"d <= {N - 50}"), ["sales"], by=["d"]), N - 50)
    assert found(om.hierarchy_scale(sparse, N - 50), ("level", "node")) == found(usual, ("level", "node"))


def test_membership_carries_the_store(spark, sparse):
    series = sparse.select("id", *KEYS).distinct().cache()
    rows = oh.membership(series, keep=["store_id"])
    joined = oh.membership(series).join(series.select("id", "store_id"), "id")
    columns = ["level", "node", "id", "store_id"]
    assert sorted(map(tuple, rows.select(columns).collect())) == sorted(map(tuple, joined.select(columns).collect()))
    assert not re.search("Join|Exchange", executed_plan(rows).split("InMemoryTableScan")[0])
