"""Queries with SQL against DuckDB, odd rows of the quality rules, registration and the pipeline."""

import os
import re

import duckdb
import pytest
from conftest_data import ODD
from pyspark.sql import functions as F

import corpus_pipeline
from shelfcast.llm.quality_rules import apply_rules
from shelfcast.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(SQL[name])
    columns = sorted(x[0] for x in want.description)
    order = [[x[0] for x in want.description].index(c) for c in columns]
    want = sorted(str(tuple(r[i] for i in order)) for r in want.fetchall())
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == columns
    assert sorted(str(tuple(r)) for r in got.select(*columns).collect()) == want


def test_all_are_registered():
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES} == set(range(1, 14))


def brute_force(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    covered = {i + k for i, x in enumerate(grams) if grams.count(x) > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(map((text or "").count, "#*$%&|<>")), len(lines) - len(set(lines)), len(covered)


def test_quality_rules_on_odd_rows(spark, odd, empty):
    texts = ["a b c a b c a", "x x x x x", "# | $$\n# | $$\n\n \n", "one two three four one two three"]
    extra = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = apply_rules(odd.select("doc_id", "text").filter("doc_id IS NULL OR doc_id <> 906").union(extra).withColumn("stats", F.lit(1)))
    for r in rows.collect():
        s = r.quality.stats
        assert (s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words) == brute_force(r.text)
        assert r.quality.base_failed and not r.quality.kept
    assert apply_rules(empty).count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_duplicates", "mixing", "packing"]
    out = corpus_pipeline.run(spark, SF)
    rows = out.collect()
    assert rows and {r.doc_id for r in rows} <= {r.doc_id for r in docs.select("doc_id").collect()}
    fill = {}
    for r in rows:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= 4096


@pytest.mark.parametrize("stage", range(4))
def test_stages_keep_the_columns(spark, odd, empty, stage):
    name, run = corpus_pipeline.STAGES[stage]
    for docs in (odd, empty):
        out = run(spark, docs, SF)
        assert out.dtypes == docs.dtypes
        assert out.count() <= 3 * docs.count()
