import re
from collections import defaultdict

from conftest_data import FIELDS, ODD, corpus
from pyspark.sql import functions as F

from shelfcast.llm import line_dedup as d


def brute_force(rows, least=50):
    """Lines in a run of ``least`` words that occurs earlier; every run of every length is tried."""
    lines = {r[0]: r[1].split("\n") for r in rows}
    counts = {i: [len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in v] for i, v in lines.items()}
    runs = defaultdict(list)
    for i in sorted(lines):
        for a in range(len(lines[i])):
            total = 0
            for b in range(a, min(len(lines[i]), a + 60)):
                total += counts[i][b]
                if total >= least:
                    runs[tuple(lines[i][a : b + 1])].append((i, a))
    gone = defaultdict(set)
    for run, places in runs.items():
        first = min(places)
        for i, a in places:
            if i != first[0] or a >= first[1] + len(run):
                gone[i].update(range(a, a + len(run)))
    return gone


def texts(rows, gone):
    return {r[0]: "\n".join(x for j, x in enumerate(r[1].split("\n")) if j not in gone[r[0]]) for r in rows}


def test_runs(spark):
    line = "five words in this line"
    rows = corpus(160) + [(2000, "\n".join([line] * 37), "en", "s", 1), (2001, "head\n" + "\n".join([line] * 12) + "\ntail", "en", "s", 1)]
    got = d.drop_repeated_lines(spark.createDataFrame(rows, FIELDS).repartition(4), removed="gone").collect()
    gone = brute_force(rows)
    # A run that overlaps its first copy is compared window by window, so only these two differ from all runs.
    for r in got:
        if r.doc_id < 2000:
            assert set(r.gone) == gone[r.doc_id], r.doc_id
            assert r.text == texts(rows, gone)[r.doc_id]
    by_id = {r.doc_id: r for r in got}
    assert list(by_id[2000].gone) == list(range(10, 37))
    assert by_id[2001].text == "head\ntail"


def test_short_repeats_stay(spark):
    common = "a licence line of only eight words here"
    rows = [(i, f"{common}\nown text {i}", "en", "s", 1) for i in range(30)]
    got = d.drop_repeated_lines(spark.createDataFrame(rows, FIELDS)).collect()
    assert {r.doc_id: r.text for r in got} == {r[0]: r[1] for r in rows}


def test_odd_rows(spark, odd, empty):
    named = odd.withColumn("line", F.lit(1)).withColumn("rank", F.lit("x"))
    got = d.drop_repeated_lines(named)
    assert got.columns == named.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, named.collect()))
    assert d.drop_repeated_lines(empty).count() == 0
