import re

from conftest_data import FIELDS, ODD, corpus
from pyspark.sql import functions as F

from shelfcast.llm import mixing as m


def water_fill(sizes, weights=(1.0, 2.0, 3.0), most=3.0):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while total:
        level = (total - sum(most * sizes[s] for s in full)) / sum(weight[s] for s in order if s not in full)
        more = {s for s in order if s not in full and level * weight[s] > most * sizes[s]}
        if not more:
            return {s: most * sizes[s] if s in full else level * weight[s] for s in order}
        full |= more
    return dict.fromkeys(order, 0.0)


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_and_words(spark, monkeypatch):
    rows = corpus(200) + [r for r in ODD if r[0] != 906]
    df = spark.createDataFrame(rows, FIELDS).repartition(3)
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + words(r[1])
    want = water_fill(sizes)
    monkeypatch.setattr(m, "FAN_IN", 8)
    got = m.round_copies(m.document_sizes(df), m.source_targets(m.document_sizes(df)), fan_in=8).collect()
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(r[0]), words(r[1])) for r in rows)
    taken = {}
    for r in got:
        assert abs(r.target - want[r.source]) < 1e-6 and r.source_size == sizes[r.source]
        assert 0 <= r.copies <= 3
        taken[r.source] = taken.get(r.source, 0) + r.copies * r.size
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(0.05 * t, 12), (s, taken[s], t)


def test_reruns_agree_and_means_hold(spark, docs):
    one = sorted((r.doc_id, r.copies) for r in m.mix(docs, seed=5).collect())
    assert one == sorted((r.doc_id, r.copies) for r in m.mix(docs.repartition(5), seed=5).collect())
    assert one != sorted((r.doc_id, r.copies) for r in m.mix(docs, seed=6).collect())


def test_one_pair_is_fair(spark):
    """A transfer keeps the words of a pair and the expectation of both."""
    unit = lambda i, p: F.struct(F.lit(i).cast("long").alias("id"), F.lit(10.0).alias("words"), F.lit(1).cast("long").alias("n"), F.lit(p).alias("p"))
    rows = spark.range(4000).select(m._pair(F.struct(F.col("id"), F.lit(10.0).alias("words"), F.lit(1).cast("long").alias("n"), F.lit(0.3).alias("p")), unit(-1, 0.4), 0).alias("r"))
    both = rows.select("r.won.p", F.col("r.won.id").alias("a"), F.col("r.rest.p").alias("q")).collect()
    assert all(r.p in (0.0, 1.0) and abs(r.p + r.q - 0.7) < 1e-9 for r in both)
    first = sum((r.p if r.a >= 0 else r.q) for r in both) / 4000
    assert abs(first - 0.3) < 0.03


def test_documents_of_the_mix(spark, odd, empty):
    out = m.mixed_documents(odd.withColumn("size", F.lit(1)).withColumn("copies", F.lit("x")))
    assert out.columns == [*odd.columns, "size", "copies"]
    copies = {(r.doc_id, r.source, r.size): r.copies for r in m.mix(odd).collect()}
    want = sum(copies[(r[0], r[3], words(r[1]))] for r in ODD)
    assert out.count() == want
    assert m.mix(empty).count() == 0 and m.mixed_documents(empty).count() == 0


def test_no_words_at_all(spark):
    df = spark.createDataFrame([(1, "", "en", "a", 0), (2, None, "en", None, 0)], FIELDS)
    assert {(r.doc_id, r.target, r.copies) for r in m.mix(df).collect()} == {(1, 0.0, 0), (2, 0.0, 0)}


def test_a_document_that_rules_its_source(spark):
    """Three copies of the short ones meet a target that no number of copies of the long one does."""
    sizes = [(0, "a", 800)] + [(i, "a", 10) for i in range(1, 21)] + [(100, "b", 500), (101, "b", 10)]
    df = spark.createDataFrame(sizes, "doc_id long, source string, size long")
    targets = spark.createDataFrame([("a", 1000, 21, 600.0), ("b", 510, 2, 505.0)], "source string, source_size long, units long, target double")
    taken = {}
    for r in m.round_copies(df, targets).collect():
        assert 0 <= r.copies <= 3
        taken[r.source] = taken.get(r.source, 0) + r.copies * r.size
    assert taken["a"] == 600 and abs(taken["b"] - 505) <= 5
