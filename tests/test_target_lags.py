import numpy as np
import pandas as pd
import pytest
from helpers import executed_plan, long_sales, roll_pandas

from shelfcast.operators import lags as ol
from shelfcast.operators import target as ot
from shelfcast.plans.manifests import lag_manifest


def close(a, b):
    return np.allclose(a.astype(float), b.astype(float), equal_nan=True, atol=1e-9)


@pytest.mark.parametrize("n_days", [392, 393, 450])
def test_baseline(spark, n_days):
    df = long_sales(n_days)
    got = ot.add_residual(ot.add_baseline(spark.createDataFrame(df))).toPandas().sort_values(["id", "d"])
    df = df.sort_values(["id", "d"])
    expect = df.groupby("id").sales.transform(lambda x: x.shift(28).rolling(365).mean())
    assert close(got.baseline.values, expect.values)
    assert close(got.residual.values, (df.sales - expect).values)
    assert got.baseline.notna().sum() == df.id.nunique() * max(0, n_days - 392)


def test_baseline_needs_all_days(spark):
    df = long_sales(20).astype({"sales": float})
    df.loc[df.d == 9, "sales"] = np.nan
    rows = spark.createDataFrame(df[["id", "d", "sales"]].astype(object).where(df[["id", "d", "sales"]].notna(), None), "id string, d long, sales double")
    got = ot.add_baseline(rows, shift=2, window=5).toPandas().sort_values(["id", "d"])
    expect = df.sort_values(["id", "d"]).groupby("id").sales.transform(lambda x: x.shift(2).rolling(5).mean())
    assert close(got.baseline.values, expect.values)


def test_baseline_on_sparse_rows(spark):
    df = long_sales(450)
    sparse = spark.createDataFrame(df[df.sales > 0])
    got = ot.baseline_on(sparse, 423, 450).toPandas().sort_values(["id", "d"])
    df = df.sort_values(["id", "d"])
    df["baseline"] = df.groupby("id").sales.transform(lambda x: x.shift(28).rolling(365).mean())
    expect = df[(df.d >= 423) & df.id.isin(got.id)]
    assert close(got.baseline.values, expect.baseline.values) and (got.sales.values == expect.sales.values).all()


def test_last_and_first_day(spark):
    df = long_sales(60)
    rows = spark.createDataFrame(df)
    last = ot.last_positive_day(rows, 30).toPandas().set_index("id").last_sales
    first = ot.first_positive_day(rows, ["id"]).toPandas().set_index("id").first_day
    for i, g in df.groupby("id"):
        sold = g[g.sales > 0].d
        assert last[i] == max(sold[sold <= 30], default=0)
        assert first[i] == min(sold, default=9999)


def residual_frame(with_hole):
    df = long_sales(150).rename(columns={"sales": "residual"})[["id", "d", "residual"]].astype({"residual": float})
    df["residual"] += df["d"] % 4 / 3
    df.loc[df.d <= 12, "residual"] = np.nan
    df.loc[df.id == df.id.iloc[0], "residual"] = 1.25
    if with_hole:
        df.loc[df.d == 70, "residual"] = np.nan
    return df.sort_values(["id", "d"]).reset_index(drop=True)


@pytest.mark.parametrize("with_hole", [False, True])
def test_rolls_against_pandas(spark, with_hole):
    df = residual_frame(with_hole)
    extra = [ol.Roll(1, 14, "skew", 3), ol.Roll(1, 30, "kurt", 2), ol.Roll(1, 9, "std", 1), ol.Roll(1, 16, "max", 0), ol.Roll(3, 4, "min", 2)]
    rolls = lag_manifest(7) + lag_manifest(9) + extra
    rows = spark.createDataFrame(df.astype(object).where(df.notna(), None), "id string, d long, residual double")
    got = ol.add_rolls(rows, rolls).toPandas().sort_values(["id", "d"]).reset_index(drop=True)
    for roll in dict.fromkeys(rolls):
        expect = roll_pandas(df, roll)
        if roll.fn in ("skew", "kurt"):
            varies = roll_pandas(df, ol.Roll(1, roll.window, "std", roll.shift)) > 1e-6
            assert close(got[roll.name][varies], expect[varies]), roll
            assert (got[roll.name].notna()[varies] == expect.notna()[varies]).all()
        else:
            assert close(got[roll.name], expect), roll


def test_one_shuffle_for_all_strides(spark):
    rows = spark.createDataFrame(residual_frame(False))
    plan = executed_plan(ol.add_rolls(rows, lag_manifest(9)))
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1
    assert "Python" not in plan


def gapped(spark):
    """One series with day 40 missing and day 90 twice, one whole one."""
    df = residual_frame(False)
    df = df[df.id.isin(df.id.unique()[1:3])]
    first = df.id.iloc[0]
    broken = pd.concat([df[~((df.id == first) & (df.d == 40))], df[(df.id == first) & (df.d == 90)]])
    rows = spark.createDataFrame(broken.astype(object).where(broken.notna(), None), "id string, d long, residual double")
    return df, first, rows


def test_no_value_reaches_over_a_gap(spark):
    df, first, rows = gapped(spark)
    rolls = [ol.lag(1), ol.lag(7), ol.Roll(1, 7, "mean", 2), ol.Roll(7, 3, "max", 1), ol.Roll(1, 30, "std", 3), ol.Roll(1, 7, "median", 1), ol.Roll(2, 3, "mean", 4)]
    plan = executed_plan(ol.add_rolls(rows, rolls))
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1
    got = ol.add_rolls(rows, rolls).toPandas()
    whole = ol.add_rolls(spark.createDataFrame(df.astype(object).where(df.notna(), None), "id string, d long, residual double"), rolls).toPandas()
    for roll in rolls:
        reach = roll.shift + (roll.window - 1) * roll.stride
        for r, g in got[got.id == first].groupby("d"):
            crosses = r - reach <= 40 < r or r - reach < 90 <= r if reach else False
            want = whole[(whole.id == first) & (whole.d == r)][roll.name].iloc[0]
            values = g[roll.name].astype(float)
            if crosses and r != 90:
                assert values.isna().all(), (roll, r)
            elif r != 90:
                assert np.allclose(values, want, equal_nan=True), (roll, r)
        assert close(got[got.id != first].sort_values("d")[roll.name], whole[whole.id != first].sort_values("d")[roll.name])


def test_table_of_statistics_gives_every_lag_column(spark):
    _, _, rows = gapped(spark)
    table = ol.with_statistics(rows)
    for h in (7, 9):
        a = ol.moved_rolls(table, lag_manifest(h)).toPandas().sort_values(["id", "d"]).reset_index(drop=True)
        b = ol.add_rolls(rows, lag_manifest(h)).toPandas().sort_values(["id", "d"]).reset_index(drop=True)
        assert list(a.columns) == list(b.columns)
        for c in a.columns[3:]:
            ok = ~a.d.isin([90])
            assert np.allclose(a[c][ok].astype(float), b[c][ok].astype(float), equal_nan=True), c


def test_what_lies_before_the_window_leaves_no_error(spark):
    values = [1e17 if d <= 30 else 0.1 for d in range(1, 501)]
    rows = spark.createDataFrame([("a", d, v) for d, v in enumerate(values, 1)], "id string, d int, sales double")
    got = {r.d: r.baseline for r in ot.add_baseline(rows).collect()}
    assert all(got[d] == pytest.approx(0.1, rel=1e-13) for d in range(30 + 28 + 365, 501))
    holed = ot.add_baseline(rows.where("d <> 300"), shift=5, window=40).collect()
    assert {r.d for r in holed if r.baseline is None} == {*range(1, 45), *range(301, 345)}


def test_a_lag_moves_a_week_and_not_a_day(spark):
    """Of the 65 columns each had lags of its own: about a hundred, in ten passes."""
    rows = spark.createDataFrame(residual_frame(False))
    for h in (7, 9):
        plan = executed_plan(ol.add_rolls(rows, lag_manifest(h)))
        assert plan.count("Window [") == 3 and plan.count("lag(") <= 25
    sales = spark.createDataFrame([("a", 1, 2.0)], "id string, d int, sales double")
    assert executed_plan(ot.add_baseline(sales)).count("Window [") == 3


def test_column_sums_of_holed_columns(spark):
    names = [f"c{i}" for i in range(70)]
    rng = np.random.default_rng(2)
    df = pd.DataFrame(np.where(rng.random((40, 70)) < 0.2, np.nan, rng.random((40, 70)).round(2)), columns=names)
    df["c3"], df["c69"] = np.nan, np.nan
    df.insert(0, "id", ["a", "b"] * 20)
    rows = spark.createDataFrame(df.astype(object).where(df.notna(), None), "id string, " + ", ".join(f"{c} double" for c in names))
    got = ol.column_sums(rows, names).toPandas().set_index("id")
    assert list(got.columns) == [x for c in names for x in (c, f"n_{c}")]
    for i, g in df.groupby("id"):
        assert close(got.loc[i, names], g[names].sum(min_count=1)) and (got.loc[i, [f"n_{c}" for c in names]].values == g[names].count().values).all()
