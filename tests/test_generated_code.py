"""Generated methods above 8,000 bytes are never compiled by the JVM: they run interpreted, row by row."""

import os
import re

import numpy as np
import pytest
from helpers import executed_plan
from pyspark.sql import functions as F
from test_target_lags import residual_frame

from shelfcast.catalog import forecast_queries
from shelfcast.operators import intervals as oi
from shelfcast.operators import lags as ol
from shelfcast.operators.forecast import horizon_columns
from shelfcast.plans.manifests import lag_manifest
from shelfcast.schema import TAIL_RANKS

SF = "/root/testdata/sf0.001"


@pytest.fixture
def longest_method(spark):
    """Size in bytes of the longest generated method of a plan."""
    settings = {"spark.sql.codegen.wholeStage": "true", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)

    def size(df):
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", df._jdf.queryExecution().explainString(mode)))

    yield size
    for k, v in before.items():
        spark.conf.set(k, v)


def test_interval_lines_are_compiled(spark, longest_method):
    forecast = spark.createDataFrame([("a", "b", *[1.0] * 28)], "level string, node string, " + ", ".join(f"{c} double" for c in horizon_columns()))
    half = spark.createDataFrame([(1, "a", "b", *[0.5] * 4)], "anchor int, level string, node string, " + ", ".join(f"{oi.halfwidth_name(q)} double" for q in TAIL_RANKS))
    assert longest_method(oi.interval_layout(forecast.na.fill(0.0), half)) < 8000


@pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")
def test_interval_quantiles_are_compiled(spark, longest_method):
    assert longest_method(forecast_queries.interval_quantiles(spark, SF)) < 8000


def test_lag_frames_are_compiled(spark, longest_method):
    rows = spark.createDataFrame(residual_frame(False))
    for rolls in (lag_manifest(7), lag_manifest(9), [ol.Roll(1, 14, "skew", 7), ol.Roll(1, 30, "kurt", 7), ol.Roll(1, 14, "std", 7), ol.Roll(1, 14, "max", 7)]):
        assert longest_method(ol.add_rolls(rows, rolls)) < 8000


def test_sums_of_lag_frames_are_compiled(spark, longest_method):
    rows = spark.createDataFrame(residual_frame(False)).withColumns({f"x{i}": F.col("d") + i for i in range(9)})
    for h in (7, 9):
        names = [r.name for r in lag_manifest(h)]
        sums = ol.column_sums(ol.add_rolls(rows, lag_manifest(h)), names)
        assert longest_method(sums) < 8000 and longest_method(ol.add_rolls(rows, lag_manifest(h))) < 8000
        # The aggregate over the days is generated code, which one of 130 columns is not.
        assert re.search(r"\*\(\d+\) HashAggregate\(keys=\[id#\d+, _present_0", executed_plan(sums))


def test_statistics_of_wide_facts_are_compiled(spark, longest_method):
    """However many columns a fact has, they pass through the windows as one."""
    rows = residual_frame(False)
    narrow = spark.createDataFrame(rows)
    wide = spark.createDataFrame(rows.assign(**{f"x{i}": rows.id + "_" + (rows.d + i).astype(str) for i in range(50)}))
    out = ol.with_statistics(wide)
    assert out.columns == [*wide.columns, *[r.name for r in ol.ALL_ROLLS], ol.SINCE]
    assert longest_method(out) < 8000
    same = out.where("d = 40").select("id", "d", "x0", "x49", ol.ALL_ROLLS[0].name, ol.ALL_ROLLS[-1].name)
    usual = ol.with_statistics(narrow).where("d = 40").select("id", "d", ol.ALL_ROLLS[0].name, ol.ALL_ROLLS[-1].name)
    assert {(x.id, x.d, *x[4:]) for x in same.collect()} == {tuple(x) for x in usual.collect()}
    assert all((x.x0, x.x49) == (f"{x.id}_{x.d}", f"{x.id}_{x.d + 49}") for x in same.collect())


def test_shapes_walk_no_frame_of_days(spark):
    rows = spark.createDataFrame(residual_frame(False))
    plan = executed_plan(ol.add_rolls(rows, [ol.Roll(1, 14, "skew"), ol.Roll(1, 30, "kurt")]))
    assert "skewness(" not in plan and "kurtosis(" not in plan


def test_equal_values_have_no_shape(spark):
    values = [0.1 + 1 / 3] * 60 + [float(i % 5) + 1e6 for i in range(60)]
    rows = spark.createDataFrame([("a", d, v) for d, v in enumerate(values)], "id string, d int, residual double")
    rolls = [ol.Roll(1, w, fn) for w in (9, 14, 30) for fn in ("skew", "kurt")]
    got = ol.add_rolls(rows, rolls).toPandas().set_index("d").sort_index()
    for roll in rolls:
        assert got[roll.name][:60].isna().all()
        for d in (75, 119):
            window = np.array(values[d - roll.window + 1 : d + 1])
            n, x = roll.window, window - window.mean()
            m2, m3, m4 = (x**2).mean(), (x**3).mean(), (x**4).mean()
            skew = m3 / m2**1.5 * (n * (n - 1)) ** 0.5 / (n - 2)
            kurt = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * (m4 / m2**2 - 3) + 6)
            assert got[roll.name][d] == pytest.approx(skew if roll.fn == "skew" else kurt, rel=1e-6, abs=1e-6)
