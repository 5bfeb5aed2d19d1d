"""Files in, training frame out, models, files back."""

from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from helpers import roll_pandas, wide_sales
from pyspark.sql import functions as F

from shelfcast.operators import model as om
from shelfcast.operators.backtest import term_windows
from shelfcast.operators.encode import encoding_name, term_cutoffs
from shelfcast.operators.metrics import wrmsse
from shelfcast.plans import grid
from shelfcast.plans.features import build_fact, frame_view, model_frame, write_encodings, write_feature_table, write_series_table
from shelfcast.plans.manifests import base_manifest, feature_columns, lag_manifest
from shelfcast.schema import KEYS
from shelfcast.sources import scan, store

N, FIRST = 520, date(2011, 1, 29)


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    wide_sales(N).to_csv(folder / "sales.csv", index=False)
    days = [FIRST + timedelta(days=i) for i in range(N + 28)]
    cal = pd.DataFrame({"date": days, "wm_yr_wk": [11101 + i // 7 for i in range(N + 28)], "weekday": [x.strftime("%A") for x in days]})
    cal["wday"] = [(x.weekday() + 2) % 7 + 1 for x in days]
    cal["month"], cal["year"] = [x.month for x in days], [x.year for x in days]
    cal["d"] = [f"d_{i + 1}" for i in range(N + 28)]
    cal["event_name_1"] = [None if i % 9 else "SuperBowl" for i in range(N + 28)]
    cal["event_type_1"] = [None if i % 9 else "Sporting" for i in range(N + 28)]
    cal["event_name_2"] = [None if i % 50 else "Easter" for i in range(N + 28)]
    cal["event_type_2"] = [None if i % 50 else "Religious" for i in range(N + 28)]
    for k, s in enumerate(("CA", "TX", "WI")):
        cal[f"snap_{s}"] = [int(i % 10 == k) for i in range(N + 28)]
    cal.to_csv(folder / "calendar.csv", index=False)
    series = wide_sales(1)[["store_id", "item_id"]]
    prices = [(r.store_id, r.item_id, w, 1.5 + w % 3) for r in series.itertuples() for w in sorted(set(cal.wm_yr_wk)) if w > 11103]
    pd.DataFrame(prices, columns=["store_id", "item_id", "wm_yr_wk", "sell_price"]).to_csv(folder / "prices.csv", index=False)
    return folder, cal


@pytest.fixture(scope="module")
def fact(spark, files, tmp_path_factory):
    folder, _ = files
    holidays = spark.createDataFrame([("CA", date(2011, 7, 4)), ("TX", date(2011, 12, 25))], "state_id string, date date")
    plan = build_fact(
        scan.read_sales_wide(spark, str(folder / "sales.csv")),
        scan.read_calendar(spark, str(folder / "calendar.csv")),
        scan.read_prices(spark, str(folder / "prices.csv")),
        holidays,
        serial_buckets=4,
    )
    return store.write_table(plan, str(tmp_path_factory.mktemp("facts") / "fact"), ["store_id"])


def test_scan_schema(spark, files):
    folder, _ = files
    sales = scan.read_sales_wide(spark, str(folder / "sales.csv"))
    assert dict(sales.dtypes)["d_17"] == "int" and len(scan.day_columns(sales)) == N
    assert dict(scan.read_calendar(spark, str(folder / "calendar.csv")).dtypes)["date"] == "date"


def test_fact(spark, files, fact):
    _, cal = files
    got = fact.toPandas()
    wide = wide_sales(N)
    assert len(got) == len(wide) * (N + 28)
    assert got[got.d > N].sales.isna().all() and got[got.d <= N].sales.notna().all()
    assert got.id_serial.nunique() == len(wide) and got.id_serial.max() == len(wide) - 1
    one = got[got.id == wide.id[0]].sort_values("d")
    assert (one.sales.values[:N] == wide.iloc[0, 6:].astype(float).values).all()
    snap = one.snap_total.values
    assert (snap == cal.snap_CA.values).all()
    assert (one.event_type_statecat_labelenc.values == np.where(cal.event_type_1.notna(), 3, 0)).all()
    assert one.sell_price.isna().sum() == 21 and (one.sell_price_minority12[one.sell_price.isna()] == 9999).all()
    assert got.national_holiday.sum() == (wide.state_id == "CA").sum() + (wide.state_id == "TX").sum()
    base = one.sales.astype(float).shift(28).rolling(365).mean()
    assert np.allclose(one.baseline.astype(float), base, equal_nan=True)


def test_model_frame(spark, fact):
    cutoffs = term_cutoffs(N)
    frame = model_frame(fact, "public", 9, cutoffs)
    assert set(frame.columns) == {*base_manifest(), "d", "baseline", *[r.name for r in lag_manifest(9)]}
    got = frame.toPandas().sort_values(["id", "d"]).reset_index(drop=True)
    base = got[["id", "d", "residual"]].astype({"residual": float})
    for roll in lag_manifest(9)[::11]:
        assert np.allclose(got[roll.name].astype(float), roll_pandas(base, roll), equal_nan=True, atol=1e-9), roll
    seen = got.residual.astype(float).where(got.sell_price.notna() & (got.d < cutoffs["public"]))
    want = seen.groupby([got.store_id, got.cat_id, got.wday]).transform("mean")
    assert np.allclose(got[encoding_name("wday", "LEVEL8", "mean")].astype(float), want, equal_nan=True)
    assert got.groupby("id").last_sales.first().max() < cutoffs["public"]


@pytest.fixture(scope="module")
def tables(spark, fact):
    """Feature table and the series table of one term, bucketed alike."""
    cutoffs = term_cutoffs(N)
    features = write_feature_table(fact, 4)
    weights = fact.select("id").distinct().withColumn("train_weight", F.lit(2.0))
    return features, write_series_table(features, write_encodings(features, cutoffs), "public", cutoffs, 4, weights)


def test_frame_is_a_view(spark, fact, tables, h=9):
    from helpers import executed_plan

    view = frame_view(*tables, h)
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "true")
    plan = executed_plan(view)
    assert "Exchange" not in plan and "Python" not in plan and plan.count("Sort [") <= 3
    pruned = executed_plan(view.where("store_id = 'CA_1'"))
    assert any("store_id#" in part.split("]")[0] for part in pruned.split("PartitionFilters")[1:])
    columns = [*base_manifest(), "d", "baseline", *[r.name for r in lag_manifest(h)]]
    assert view.columns == [*columns[:109], "train_weight", *columns[109:]]
    want = model_frame(fact, "public", h, term_cutoffs(N)).toPandas().sort_values(["id", "d"]).reset_index(drop=True)
    got = view.toPandas().sort_values(["id", "d"]).reset_index(drop=True)
    for c in columns:
        if got[c].dtype.kind in "fi" or want[c].dtype.kind in "fi":
            assert np.allclose(got[c].astype(float), want[c].astype(float), equal_nan=True, atol=1e-9), c
        else:
            assert (got[c].astype(str) == want[c].astype(str)).all(), c


def judge_weights(spark):
    """Two nodes of each store: its root and one department."""
    rows = [(level, node, s, 0.5, 2.0) for s in ("CA_1", "TX_1") for level, node in (("LEVEL1", "Total_X"), ("LEVEL5", "FOODS_1_X"))]
    return spark.createDataFrame(rows, "level string, node string, store_id string, weight double, scale double")


def test_grid_resumes(spark, tables, tmp_path):
    a, z = term_windows(N)["public"]
    seen = []

    def frame(term, h):
        seen.append((term, h))
        return frame_view(*tables, h).withColumns({"in_train": F.col("d") < a, "in_eval": F.col("d").between(a, z)})

    names = ["wday", "sell_price", "item_id", "store_id", "event_name_1", *[r.name for r in lag_manifest(7)[:3]]]
    params = om.TreeParams(step=0.3, trees=3, leaves=3, rows_per_leaf=5, bins=32, patience=1)
    spec = grid.Spec(lambda h: names, ["wday", "item_id"], params, {"TX_1": {"trees": 4}}, "train_weight", om.Judge("in_eval", judge_weights(spark)))
    tasks = om.model_grid(["public"], [7], ["CA_1", "TX_1"])
    folder = str(tmp_path)
    assert grid.run(spark, folder, tasks[:1], spec, frame, 2) == tasks[:1]
    assert grid.run(spark, folder, tasks, spec, frame, 2) == tasks[1:]
    rows = grid.scores(spark, folder, tasks, spec).toPandas()
    assert len(rows) == 2 * 3 * 28 and rows.pred.notna().all() and set(rows.store_id) == {"CA_1", "TX_1"}
    imp = grid.importances(spark, folder, tasks, spec).collect()
    assert len(imp) == 2 * len(names) and sum(r.importance for r in imp) == pytest.approx(2)

    before = len(seen)
    assert grid.run(spark, folder, tasks, spec, frame, 2) == [] and len(seen) == before
    again = grid.scores(spark, folder, tasks, spec).toPandas()
    assert (again.sort_values(["id", "d"]).pred.values == rows.sort_values(["id", "d"]).pred.values).all()
    other = grid.Spec(lambda h: names, ["wday", "item_id"], om.TreeParams(step=0.1, trees=2, leaves=3, rows_per_leaf=5, bins=32), {}, "train_weight")
    assert grid.pending(spark, folder, tasks, other) == tasks

    kept = {r.store_id: r for r in grid.open_ledger(spark, folder).collect()}
    for t in tasks:
        model = om.load_model(f"{folder}/models", t)
        assert model.getNumTrees == kept[t.store].trees == om.best_prefix(kept[t.store].wrmsse, 1)
        assert len(kept[t.store].wrmsse) == (4 if t.store == "TX_1" else 3)


def test_wrmsse_of_every_prefix(spark, tables):
    """Place k of the array is the WRMSSE of the first k + 1 trees, as the plain operator has it."""
    a, z = term_windows(N)["public"]
    frame = frame_view(*tables, 7).where("store_id = 'CA_1'").withColumns({"in_train": F.col("d") < a, "in_eval": F.col("d").between(a, z)})
    rows = om.design(frame.where("residual IS NOT NULL"), ["wday", "sell_price", "shift_7"]).cache()
    model = om.fit_trees(rows.where("in_train").select("features", "residual"), om.TreeParams(step=0.4, trees=4, leaves=7, rows_per_leaf=5, bins=32))
    held = rows.where("in_eval")
    judge = om.Judge("in_eval", judge_weights(spark))
    errors = om.prefix_errors(model, held.select("id", *KEYS, "d", "residual", "features"), judge, "CA_1")
    weights = judge.weights.where("store_id = 'CA_1'").drop("store_id")
    assert len(errors) == 4 and len(set(errors)) > 1
    for k in range(1, 5):
        scored = om.first_trees(model, k).transform(held).withColumn("err", F.col("pred") - F.col("residual"))
        plain = {r.level: r.wrmsse for r in wrmsse(scored.select("id", *KEYS, "d", "err"), weights).collect()}
        assert errors[k - 1] == pytest.approx(plain["all"], rel=1e-9)
    staged = om.staged_predictions(model, held).select("staged", "features").join(model.transform(held).select("features", "pred"), "features").collect()
    assert all(r.staged[-1] == pytest.approx(r.pred, rel=1e-12) for r in staged)


def test_wide_and_unseen_labels(spark):
    train = spark.createDataFrame([(f"i{i}", i % 3, float(i)) for i in range(60)], "item string, wday int, x double")
    indexers = om.fit_indexers(train, ["wday"], bins=32)
    assert indexers.stages[0].getInputCols() == ["wday"]
    out = om.design(train.limit(1).withColumn("wday", F.lit(9)), ["item", "wday", "x"], indexers).first()
    assert out.features[1] == 3.0 and out.item.startswith("i") and out.wday == 9
    with pytest.raises(ValueError):
        om.fit_indexers(train, ["item"], bins=32)


def test_best_prefix_has_patience():
    errors = [5.0, 4.0, 4.5, 4.4, 3.0, 3.5, 3.6, 3.7, 1.0]
    assert om.best_prefix(errors, 100) == 9
    assert om.best_prefix(errors, 3) == 5
    assert om.best_prefix(errors, 2) == 2


def test_parameters():
    with pytest.raises(ValueError):
        om.TreeParams(leaves=2**32).depth
    assert om.FINAL.depth == 11 and om.params_for("CA_2", om.FINAL, om.FINAL_OVERRIDES).depth == 8
    assert om.params_for("CA_3", om.FINAL, om.FINAL_OVERRIDES).step == 0.03
    assert om.params_for("CA_3", om.BACKTEST, om.OVERRIDES).step == 0.08
    assert om.params_for("TX_1", om.BACKTEST, om.OVERRIDES) == om.BACKTEST
    assert len(om.model_grid(["private"], range(1, 29), range(10))) == 280
    assert len(om.model_grid(["a", "b", "c"], [1, 7, 14, 21, 28], range(10))) == 150
    assert len(feature_columns(3)) == 190


def test_forecast_files(spark, tmp_path):
    cols = ", ".join(f"F{i} double" for i in range(1, 29))
    wide = spark.createDataFrame([("a", *[float(i) for i in range(28)])], f"id string, {cols}")
    for name in ("one", "two"):
        store.write_forecast(wide, str(tmp_path / name))
    back = scan.read_forecasts(spark, [str(tmp_path / "one"), str(tmp_path / "two")])
    assert back.select("file").distinct().count() == 2
    assert back.drop("file").distinct().collect() == wide.collect()
    assert [r.id for r in scan.read_layout(spark, str(tmp_path / "one")).collect()] == ["a"]


def test_column_store(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "id * 2 as twice", "cast(id % 2 as string) as part")
    store.write_table(df, str(tmp_path / "t"), ["part"])
    back = store.read_columns(spark, str(tmp_path / "t"), ["twice"])
    assert "ReadSchema: struct<twice:bigint>" in back._jdf.queryExecution().executedPlan().toString()
    assert back.agg(F.sum("twice")).first()[0] == 90


def test_bucketed_table_needs_no_shuffle(spark, tmp_path):
    from helpers import executed_plan

    from shelfcast.operators.target import add_baseline

    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    df = spark.range(100).selectExpr("cast(id % 5 as string) as id", "cast(id as int) as d", "1.0D as sales")
    table = store.write_bucketed(df, f"bucketed_{tmp_path.name.replace('-', '_')}", 4)
    try:
        assert "Exchange" not in executed_plan(add_baseline(table, 1, 2))
    finally:
        spark.sql(f"DROP TABLE bucketed_{tmp_path.name.replace('-', '_')}")


def test_weight_store_replaces_one_store(spark, tmp_path):
    rows = [("CA_1", "LEVEL1", "Total_X", 1.0), ("TX_1", "LEVEL1", "Total_X", 2.0)]
    frame = spark.createDataFrame(rows, "store_id string, level string, node string, x double")
    scale, weight = frame.withColumnRenamed("x", "scale"), frame.withColumnRenamed("x", "weight")
    members = spark.createDataFrame([("CA_1", "a"), ("TX_1", "b")], "store_id string, id string")
    path = str(tmp_path / "weights")
    store.write_weights(path, members, scale, weight)
    one = F.col("store_id") == "CA_1"
    store.write_weights(path, members.where(one), scale.where(one), weight.where(one).withColumn("weight", F.lit(9.0)))
    got_members, got_scale, got_weight = store.read_weights(spark, path)
    assert {(r.store_id, r.weight) for r in got_weight.collect()} == {("CA_1", 9.0), ("TX_1", 2.0)}
    assert {(r.store_id, r.scale) for r in got_scale.collect()} == {("CA_1", 1.0), ("TX_1", 2.0)} and got_members.count() == 2


def test_prediction_table_has_a_term_without_anchor(spark, tmp_path):
    rows = [("private", None, "a", 1, 0.5, None), ("public", 7, "a", 1, 0.25, 1.0), ("public", 28, "a", 1, 0.75, 1.0)]
    df = spark.createDataFrame(rows, "term string, anchor int, id string, d int, pred double, target double")
    path = str(tmp_path / "predictions")
    store.write_predictions(df, path)
    table = store.write_predictions(df.where("anchor = 7").withColumn("pred", F.lit(8.0)), path)
    assert {(r.term, r.anchor, r.pred) for r in table.collect()} == {("private", None, 0.5), ("public", 7, 8.0), ("public", 28, 0.75)}


def test_malformed_cells_are_rejected_not_lost(spark, tmp_path):
    head = ",".join(["id", *scan.SALES_KEYS[1:], "d_1", "d_2", "d_3"])
    lines = [head, "a,i,de,c,s,st,1,x2,", "b,i,de,c,s,st,4,5,6", "c,i,de,c,s,st,1.5,99999999999,-3"]
    (tmp_path / "wide.csv").write_text("\n".join(lines))
    good, bad = scan.read_sales_wide_checked(spark, str(tmp_path / "wide.csv"))
    assert {(r.id, r.d_1, r.d_2, r.d_3) for r in good.collect()} == {("a", 1, None, None), ("b", 4, 5, 6), ("c", None, None, -3)}
    assert {(r.id, r.column, r.text) for r in bad.collect()} == {("a", "d_2", "x2"), ("c", "d_1", "1.5"), ("c", "d_2", "99999999999")}
