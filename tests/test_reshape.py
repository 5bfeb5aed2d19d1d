import pytest
from helpers import executed_plan, wide_sales
from pyspark.sql import functions as F

from shelfcast.operators import reshape as r


def test_melt_days(spark):
    wide = wide_sales(5)
    out = r.melt_days(spark.createDataFrame(wide), ["id"], [f"d_{i}" for i in range(1, 6)], horizon=2).toPandas()
    assert len(out) == len(wide) * 7
    assert out[out.d > 5].sales.isna().all()
    for i in range(1, 6):
        got = out[out.d == i].set_index("id").sales
        assert (got.loc[wide.id] == wide[f"d_{i}"].values).all()


def test_melt_days_rejects_holes(spark):
    with pytest.raises(ValueError):
        r.melt_days(spark.createDataFrame([("a", 1, 2)], "id string, d_1 int, d_3 int"), ["id"], ["d_1", "d_3"])


def test_dense_days(spark):
    sparse = spark.createDataFrame([("a", 3, 2.0), ("a", 5, 1.0), ("b", 1, 4.0), ("b", 6, 7.0)], "id string, d int, sales double")
    out = r.dense_days(sparse, 1, 6, horizon=2)
    got = {(x.id, x.d): x.sales for x in out.collect()}
    expect = {(i, d): 0.0 for i in "ab" for d in range(1, 7)} | {(i, d): None for i in "ab" for d in (7, 8)}
    expect |= {("a", 3): 2.0, ("a", 5): 1.0, ("b", 1): 4.0, ("b", 6): 7.0}
    assert got == expect
    assert r.day_gaps(out).count() == 0
    assert r.day_gaps(sparse).count() == 2
    assert "Join" not in executed_plan(out)


def test_serial_is_gap_free_with_a_hot_prefix(spark):
    ids = [f"HOT_{i:05d}" for i in range(400)] + [f"K{i}" for i in range(50)]
    out = r.with_serial(spark.createDataFrame([(i,) for i in ids], "id string"), ["id"], buckets=7).collect()
    assert {x.id: x.id_serial for x in out} == {v: i for i, v in enumerate(sorted(ids))}


def test_narrow_types(spark):
    df = spark.createDataFrame(
        [(126, 127, 40000, 2**40, 1.5, "x"), (-127, 0, 0, 0, None, "y")], "a int, b int, c long, d long, e double, f string"
    )
    got = dict(r.narrow_types(df).dtypes)
    assert got == {"a": "tinyint", "b": "smallint", "c": "int", "d": "bigint", "e": "float", "f": "string"}


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "x double")
    assert r.nan_to_null(df).agg(F.count("x"), F.avg("x")).first()[:] == (1, 1.0)


def test_first_by_and_last_days(spark):
    df = spark.createDataFrame([(1, 10, "b"), (1, 3, "a"), (2, 11, "c")], "w int, d int, v string")
    assert sorted(map(tuple, r.first_by(df, ["w"], "d", ["d", "v"]).collect())) == [(1, 3, "a"), (2, 11, "c")]
    assert r.last_days(df, 2).count() == 2


def test_pivot_and_one_hot(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 1, 3.0), ("b", 2, 1.0)], "id string, h int, v double")
    got = {x.id: (x.F1, x.F2) for x in r.pivot_sum(df, ["id"], "h", "v", [1, 2], "F").collect()}
    assert got == {"a": (5.0, None), "b": (None, 1.0)}
    assert r.one_hot(df, "id", ["a", "b"]).columns == ["id", "h", "v", "id_a", "id_b"]
