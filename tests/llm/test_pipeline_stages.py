"""run() stage by stage on a small fixture: what each stage keeps is compared with brute force on its input."""

import zlib
from collections import Counter

import numpy as np
import pytest
from conftest_data import FIELDS, corpus
from pyspark.sql import functions as F
from test_jaccard_join import brute_force as components
from test_line_dedup import brute_force as repeated_lines
from test_line_dedup import texts as without
from test_mixing import water_fill, words
from test_packing import check

import corpus_pipeline as cp
from shelfcast.llm.q_packing import tokenizer_path


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows of the documents and of what each stage of run() wrote, the fixture's folder."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows = corpus(160)
    spark.createDataFrame(rows, FIELDS).write.parquet(f"{folder}/documents.parquet")
    labels = [(r[0], int(words(r[1]) >= 12), 0) for r in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(cp, "table_path", lambda spark, name: f"{folder}/{name}")
        out = cp.run(spark, folder).collect()
    read = {n: spark.read.parquet(f"{folder}/{n}").collect() for n in ("quality", "line_dedup", "near_duplicates", "mixing", "packing")}
    assert Counter(out) == Counter(read["packing"])
    return {"documents": spark.read.parquet(f"{folder}/documents.parquet").collect(), **read}, folder


def test_quality_keeps_what_scores_enough(spark, stages):
    tables, folder = stages
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = cp.learn_quality(docs, spark.read.parquet(f"{folder}/labels.parquet"), F.lit(True))
    scores = {r.doc_id: r.s for r in cp.score_quality(docs, model, into="s").collect()}
    want = [r for r in tables["documents"] if scores[r.doc_id] >= cp.THRESHOLD]
    assert 0 < len(want) < len(tables["documents"])
    assert Counter(tables["quality"]) == Counter(want)


def test_line_dedup_drops_only_what_it_empties(stages):
    before, after = stages[0]["quality"], stages[0]["line_dedup"]
    cut = without(before, repeated_lines(before))
    had = {r.doc_id: words(r.text) for r in before}
    want = {i: t for i, t in cut.items() if words(t) or not had[i]}
    assert {r.doc_id: (r.text, r.n_chars) for r in after} == {i: (t, len(t)) for i, t in want.items()}
    assert len(after) == len(want) < len(before) and want != {i: t for i, t in cut.items()}


def test_no_emptied_document_is_packed(stages):
    texts = {r.doc_id: r.text for r in stages[0]["mixing"]}
    assert texts and all(words(t) for t in texts.values())
    assert {r.doc_id for r in stages[0]["packing"]} == set(texts)


def test_near_duplicates_keep_the_least_of_each_group(stages):
    before, after = stages[0]["line_dedup"], stages[0]["near_duplicates"]
    keep = {i for i, _, least in components(before) if i == least}
    assert 0 < len(keep) < len(before)
    assert Counter(after) == Counter(r for r in before if str(r.doc_id) in keep)


def test_mixing_takes_the_targets(stages):
    before, after = stages[0]["near_duplicates"], stages[0]["mixing"]
    assert set(after) <= set(before) and max(Counter(after).values()) <= 3
    sizes, taken = Counter(), Counter()
    for table, total in ((before, sizes), (after, taken)):
        for r in table:
            total[r.source] += words(r.text)
    longest = {s: max(words(r.text) for r in before if r.source == s) for s in sizes}
    for s, target in water_fill(sizes).items():
        assert abs(taken[s] - target) <= longest[s] / 2 + 1e-6, (s, taken[s], target)


def test_packing_holds_every_piece(stages):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    tokenizer.encode_special_tokens = True
    want = []
    for r in stages[0]["mixing"]:
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        parts = [(k, ids[k : k + 4096]) for k in range(0, len(ids), 4096)]
        want += [(r.doc_id, k // 4096, k, len(x), zlib.crc32(x.tobytes())) for k, x in parts]
    after = stages[0]["packing"]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in after) == sorted(want)
    check(after, 4096)
