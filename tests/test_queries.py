"""Registered queries against their SQL in DuckDB, on the smallest tables.

One query per family by default; ``SHELFCAST_ALL_QUERIES=1`` runs all of them.
"""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

FAMILIES = [
    "melt_wide", "dense_spine", "narrow_types", "moon_phase", "week_of_month_year", "composite_event_label", "holiday_flag",
    "price_momentum_month", "price_minor_digits", "residual_target", "baseline_on_days", "roll_mean_stride235",
    "roll_stats_daily", "encode_cutoffs", "hierarchy_rollup", "rmsse_scale", "wrmsse", "backtest_errors",
    "interval_halfwidth", "backtest_chain", "forecast_files_blend", "category_index", "final_forecast", "ingest_wide",
]
NAMES = sorted(entry.oracle_sql()) if os.environ.get("SHELFCAST_ALL_QUERIES") else FAMILIES

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.fixture(autouse=True)
def generated_code(spark):
    """The catalog runs with whole-stage code generation, as in production."""
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    yield
    spark.conf.set("spark.sql.codegen.wholeStage", "false")


def cell(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, bool) or isinstance(x, str):
        return x
    try:
        return round(float(x), 4) + 0.0
    except (TypeError, ValueError):
        return str(x)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(cell(r[i]) for i in order) for r in data]
    return sorted(out, key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    ref = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in ref.description]
    assert sorted(df.columns) == sorted(columns)
    got, want = rows(df.columns, df.collect()), rows(columns, ref.fetchall())
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert all(x == y or (isinstance(x, float) and isinstance(y, float) and abs(x - y) < 2e-4) for x, y in zip(a, b)), (a, b)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_sql_only_for_registered_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
