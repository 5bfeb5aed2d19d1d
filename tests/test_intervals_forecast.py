from datetime import date

import numpy as np
import pytest
from helpers import series_table
from pyspark.sql import functions as F
from test_hierarchy import label

from shelfcast.operators import backtest as ob
from shelfcast.operators import forecast as of
from shelfcast.operators import intervals as oi
from shelfcast.plans.forecast import final_forecast, intervals, submission
from shelfcast.schema import ANCHORS, LEVELS, TAIL_RANKS


def test_terms():
    assert ob.term_windows(1941) == {
        "private": (1942, 1969), "public": (1914, 1941), "validation": (1886, 1913), "semival": (1858, 1885)
    }
    dates = ob.term_dates(date(2016, 5, 22), date(2012, 3, 28))
    assert dates["private"]["val_start"] == date(2016, 4, 25) and dates["private"]["val_end"] == date(2016, 5, 22)
    assert dates["private"]["eval_start"] == date(2016, 5, 23) and dates["private"]["eval_end"] == date(2016, 6, 19)
    assert dates["semival"]["train_end"] == date(2016, 2, 28) and dates["semival"]["eval_end"] == date(2016, 3, 27)
    assert ob.train_days(dates["public"]) == 1489


def test_assign_term_and_slots(spark):
    days = spark.range(1840, 1990).select(F.col("id").cast("int").alias("d"))
    got = {r.d: r.term for r in days.withColumn("term", ob.assign_term(F.col("d"), 1941)).collect()}
    windows = ob.term_windows(1941)
    for d, term in got.items():
        assert term == next((t for t, (a, z) in windows.items() if a <= d <= z), None)
    slots = ob.prediction_slots(days, 1941).groupBy("term").count().collect()
    assert {r.term: r["count"] for r in slots} == {"private": 28, "public": 140, "validation": 140, "semival": 140}


def test_split_flags(spark):
    dates = ob.term_dates(date(2016, 5, 22), date(2012, 3, 28))["private"]
    df = spark.createDataFrame([(date(2016, 5, 22),), (date(2016, 5, 23),)], "date date")
    got = df.select(*[c.alias(n) for n, c in ob.split_flags(F.col("date"), dates).items()]).collect()
    assert [tuple(r) for r in got] == [(True, True, False), (False, False, True)]


def test_anchor_and_bucket(spark):
    rows = spark.range(1, 29).select("id", oi.anchor_of(F.col("id")).alias("a"), oi.lag_bucket(F.col("id")).alias("b")).collect()
    want = [1] * 4 + [7] * 7 + [14] * 7 + [21] * 7 + [28] * 3
    assert [r.a for r in rows] == want == [oi.anchor_for(h) for h in range(1, 29)]
    assert [r.b for r in rows] == [7] * 7 + [14] * 7 + [21] * 7 + [28] * 7


def test_whole_interval_plan_against_numpy(spark):
    series = series_table()
    rng = np.random.default_rng(7)
    err = {a: rng.integers(-3, 4, size=(len(series), 84)) * (rng.random((len(series), 84)) < 0.3) for a in ANCHORS}
    point = rng.integers(0, 5, size=(len(series), 28)).astype(float)
    # Sparse: days without an error have no row.
    back = [
        (a, series.id[i], int(d) + 1, float(m[i, d]), 0.0) for a, m in err.items() for i in range(len(series)) for d in np.flatnonzero(m[i])
    ]
    fc = [(series.id[i], h + 1, float(point[i, h])) for i in range(len(series)) for h in range(28)]
    out = intervals(
        spark.createDataFrame(back, "anchor int, id string, d int, pred double, target double"),
        spark.createDataFrame(fc, "id string, h int, forecast double"),
        spark.createDataFrame(series),
    )
    rows = {r.id: r for r in out.collect()}
    nodes = {}
    for level, keys in LEVELS.items():
        for i, r in series.iterrows():
            nodes.setdefault((level, label(keys, r)), []).append(i)
    assert len(rows) == len(nodes) * 9 * 2
    for (_, node), members in nodes.items():
        p = point[members].sum(axis=0)
        for h in range(28):
            e = np.sort(np.abs(np.append(err[oi.anchor_for(h + 1)][members].sum(axis=0), 0)))
            for q, rank in TAIL_RANKS.items():
                for suffix in ("evaluation", "validation"):
                    assert rows[f"{node}_{q:.3f}_{suffix}"][f"F{h + 1}"] == pytest.approx(max(p[h] - e[rank], 0))
                    assert rows[f"{node}_{1 - q:.3f}_{suffix}"][f"F{h + 1}"] == pytest.approx(p[h] + e[rank])
            assert rows[f"{node}_0.500_evaluation"][f"F{h + 1}"] == p[h]


def test_layout_and_blend(spark):
    rows = [("a_validation", h, float(h)) for h in range(1, 29)]
    wide = of.forecast_wide(spark.createDataFrame(rows, "id string, h int, forecast double"))
    assert sorted(r.id for r in of.with_suffixes(wide).collect()) == ["a_evaluation", "a_validation"]
    one = spark.createDataFrame([("a", 1, 2.0), ("b", 1, 9.0)], "id string, h int, forecast double")
    two = spark.createDataFrame([("a", 1, 4.0)], "id string, h int, forecast double")
    assert [tuple(r) for r in of.blend([one, two]).collect()] == [("a", 1, 3.0)]
    half_empty = wide.withColumn("F2", F.lit(None).cast("double"))
    blended = of.blend_wide([wide, half_empty]).first()
    assert blended.F1 == 1.0 and blended.F2 is None
    assert [r.id for r in of.missing_ids(two, one).collect()] == ["b"]


def test_final_forecast_uses_each_model_for_its_own_day(spark):
    rows = [("private", h, "a", 100 + d, 10.0, float(h)) for h in (1, 2) for d in (1, 2)]
    preds = spark.createDataFrame(rows, "term string, horizon int, id string, d int, baseline double, pred double")
    fc = final_forecast(preds, 100)
    assert sorted(map(tuple, fc.collect())) == [("a", 1, 11.0), ("a", 2, 12.0)]
    assert submission(fc).count() == 2
