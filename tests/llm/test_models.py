"""Held-out accuracy and defined cases of the three learned operators, and the compiled forms of their rules."""

import os
import random

import numpy as np
import pytest
from conftest_data import FIELDS, ODD
from pyspark.sql import functions as F

from shelfcast.llm import classifier_chain as c
from shelfcast.llm import language_id as g
from shelfcast.llm import rule_ensemble as r

SF = "/root/testdata/sf0.01"
with_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


@with_tables
def test_quality_held_out(spark, tables):
    from shelfcast.llm.q_rule_ensemble import op4_rule_ensemble

    docs, labels = tables
    rows = op4_rule_ensemble(spark, SF).join(labels, "doc_id").filter("held_out").collect()
    right = sum(x.predicted == x.quality for x in rows)
    assert len(rows) > 50 and right >= 0.95 * len(rows)


def test_rules_as_columns_equal_rules_in_numpy(spark, docs):
    names = r.STATISTICS
    table = docs.select("doc_id", r.text_statistics(F.col("text")).alias("s")).select("doc_id", "s.*").toPandas()
    x = table[list(names)].to_numpy(float)
    y = (x[:, 0] + 3 * x[:, 3] > np.median(x[:, 0] + 3 * x[:, 3])).astype(float)
    model = r.fit_rules(x, y)
    assert model.rules and all(1 <= len(rule.conditions) <= r.DEPTH for rule, _ in model.rules)
    want = dict(zip(table["doc_id"], model.score(dict(zip(names, x.T)))))
    got = {z.doc_id: z.score for z in r.score_quality(docs, model, into="score").collect()}
    assert all(abs(want[i] - got[i]) < 1e-9 for i in want)


def test_lasso_is_sparse():
    rng = np.random.default_rng(0)
    z = (rng.random((2000, 40)) < 0.3).astype(float)
    y = (rng.random(2000) < 1 / (1 + np.exp(-(4 * z[:, 3] - 2)))).astype(float)
    _, w = r.lasso_logistic(z, y, penalty=0.02)
    assert abs(w).argmax() == 3 and (abs(w) > 1e-4).sum() <= 5


def test_quality_defined_cases(spark, odd, empty):
    labels = spark.createDataFrame([(903, 1), (905, None), (None, 0)], "doc_id long, quality int")
    model = r.learn_quality(odd, labels, F.lit(True))
    scored = r.score_quality(odd.withColumn("symbols", F.lit(1)), model)
    assert scored.count() == len(ODD) and scored.filter("quality_score IS NULL").count() == 0
    nothing = r.learn_quality(empty, labels.limit(0), F.lit(True))
    assert nothing.score({"log_words": np.zeros(1)})[0] == pytest.approx(0.5)
    assert r.score_quality(empty, model).count() == 0


@with_tables
def test_toxic_held_out(spark, tables):
    from shelfcast.llm.q_classifier_chain import op9_classifier_chain

    rows = op9_classifier_chain(spark, SF).join(tables[1].withColumnRenamed("toxic", "label"), "doc_id").collect()
    clean = [x for x in rows if x.label == 0]
    assert sum(x.toxic for x in clean) <= 0.02 * len(clean)
    assert sum(x.toxic for x in rows if x.label == 1) >= 0.7 * sum(x.label for x in rows)


def test_chain_uses_earlier_categories():
    """The second label is the first one's negation; the words tell the first only."""
    rng = np.random.default_rng(1)
    first = rng.integers(0, 2, 600)
    rows, ids = np.arange(600), np.where(first == 1, 11, 22)
    chain = c.fit_chain(rows, ids, np.column_stack([first, 1 - first]))
    assert len(chain) == 2 and len(chain[1].earlier) == 1 and chain[1].earlier[0] < 0
    p = c._sigmoid(chain[0].margins(rows, ids, 600, np.zeros((600, 0))))
    assert ((p > 0.5) == first).all()


def test_chain_scores_do_not_follow_the_number_of_labels(spark):
    """A tenth is toxic; the sample takes a sixth to a half of it as the same texts come again under new ids."""
    rng = random.Random(6)
    texts = []
    for i in range(2400):
        words = [f"word{rng.randrange(40)}" for _ in range(6)]
        texts.append((" ".join([*words, "marked"] if rng.random() < (0.7 if i % 10 == 0 else 0.1) else words), int(i % 10 == 0)))
    fixed = spark.createDataFrame([(0, "word1 word2"), (1, "word3 marked"), (2, "marked")], "doc_id long, text string")
    whole = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    odds = []
    for times in (1, 2, 8):
        rows = [(i + 2400 * k, t, y) for k in range(times) for i, (t, y) in enumerate(texts)]
        table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
        chain = c.learn_chain(table.drop("toxic"), table.drop("text"), [("p", F.col("__toxic") == 1)], F.lit(True), rows=2400)
        p = np.array([x.p for x in c.score_chain(fixed, chain, ["p"]).orderBy("doc_id").collect()])
        odds.append(np.log(p / (1 - p)))
        assert abs(c.score_chain(whole, chain, ["p"]).agg(F.avg("p")).first()[0] - 0.1) < 0.03
    assert abs(odds[1] - odds[0]).max() < 0.4 and abs(odds[2] - odds[0]).max() < 0.4


def test_chain_defined_cases(spark, odd, empty):
    none = c.learn_chain(odd, spark.createDataFrame([], "doc_id long, toxic int"), [("p", F.col("__toxic") == 1)], F.lit(True))
    scored = c.score_chain(odd, none, ["p"])
    assert scored.columns == [*odd.columns, "p"] and {x.p for x in scored.collect()} == {0.5}
    assert c.score_chain(empty, none, ["p"]).count() == 0
    with pytest.raises(ValueError):
        c.score_chain(odd, none, ["text"])


def test_gradients_equal_differences():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 5, (6, 3)).astype(np.uint8)
    layer = g.Direction(rng.normal(size=(6, 256)), rng.normal(size=(6, 2)))
    goal = rng.normal(size=(6, 2, 3))
    trace = []
    layer.states(x, trace)
    dx, du = layer.gradients(x, trace, goal)
    for array, grad, at in ((layer.u, du, (4, 1)), (layer.u, du, (0, 0)), (layer.x, dx, (2, int(x[0, 0]))), (layer.x, dx, (5, int(x[3, 1])))):
        kept = array[at]
        values = []
        for step in (1e-5, -1e-5):
            array[at] = kept + step
            values.append((layer.states(x) * goal).sum())
        array[at] = kept
        assert abs((values[0] - values[1]) / 2e-5 - grad[at]) < 1e-6


def test_language_held_out_and_defined_cases(spark, odd, empty):
    rng = random.Random(4)
    alphabet = {"aa": "abcde", "bb": "vwxyz", "cc": "éàüöß"}
    rows = [(i, " ".join("".join(rng.choices(a, k=5)) for _ in range(40)), n, "s", 1) for i, (n, a) in enumerate(list(alphabet.items()) * 20)]
    docs = spark.createDataFrame(rows, FIELDS)
    network = g.learn_languages(docs, F.col("doc_id") < 45)
    got = g.predict_languages(docs, network).filter("doc_id >= 45").collect()
    assert all(x.lang_pred == x.lang and 0.5 < x.score <= 1 for x in got)
    marked = {x.text: (x.lang_pred, x.score) for x in g.predict_languages(odd, network).collect()}
    assert marked[None] == marked[""] == marked["123 456 !!!"] == ("und", 0.0)
    assert marked["one"][0] in alphabet
    assert g.predict_languages(empty, network).count() == 0
    assert g.learn_languages(empty, F.lit(True)) is None
    assert {x.lang_pred for x in g.predict_languages(odd, None).collect()} == {"und"}
