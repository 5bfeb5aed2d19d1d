import re

import pytest
from conftest_data import FIELDS, ODD, corpus

from shelfcast.llm import jaccard_join as j

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_force(rows):
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), 1 << 60), r[0])
    return sorted((str(r[0]), len(sets[i]), str(least.get(find(i)) if sets[i] else r[0])) for i, r in enumerate(rows))


def result(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in df.collect())


def near_copies(n=60):
    """A chain of edits: neighbours link, the ends do not."""
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(n):
        words[(7 * i) % 120] = f"x{i}"
        rows.append((i + 5000, " ".join(words), "en", "s", 1))
    return rows


@pytest.mark.parametrize("long_list,at_once", [(64, 512), (3, 4)])
def test_components(spark, monkeypatch, long_list, at_once):
    """With small limits the same rows take the way of hot shingles and large components."""
    monkeypatch.setattr(j, "LONG_LIST", long_list)
    monkeypatch.setattr(j, "AT_ONCE", at_once)
    monkeypatch.setattr(j, "PIVOTS", 5)
    rows = corpus() + ODD + near_copies()
    df = spark.createDataFrame(rows, FIELDS).repartition(4)
    assert result(j.similar_components(df)) == brute_force(rows)


def test_texts_are_shuffled_when_ids_are_many(spark, docs, monkeypatch):
    monkeypatch.setattr(j, "BROADCAST_ROWS", 0)
    assert result(j.similar_components(docs)) == brute_force(corpus())


def test_empty(empty):
    assert j.similar_components(empty).count() == 0


def test_one_per_component(spark):
    rows = corpus() + ODD
    out = j.one_per_component(spark.createDataFrame(rows, FIELDS)).collect()
    keep = {r[0] for r in brute_force(rows) if r[0] == r[2] and r[0] != "None"}
    assert sorted(str(r.doc_id) for r in out if r.doc_id is not None) == sorted(keep)
    assert sum(r.doc_id is None for r in out) == 1


def test_a_row_without_id_is_a_bridge(spark):
    base = [f"w{i}" for i in range(60)]
    bridge = base[:52] + [f"y{i}" for i in range(4)] + base[56:]
    far = bridge[:4] + [f"z{i}" for i in range(3)] + bridge[7:]
    link = lambda a, b: 100 * len(shingles(a) & shingles(b)) >= 75 * len(shingles(a) | shingles(b))
    a, x, b = (" ".join(w) for w in (base, bridge, far))
    assert link(a, x) and link(x, b) and not link(a, b)
    rows = [(1, a, "en", "s", 1), (None, x, "en", "s", 1), (3, b, "en", "s", 1)]
    df = spark.createDataFrame(rows, FIELDS)
    assert result(j.similar_components(df)) == brute_force(rows)
    assert {(r.doc_id, r.component_id) for r in j.similar_components(df).collect()} == {(1, 1), (None, 1), (3, 1)}
    assert [r.doc_id for r in j.one_per_component(df).collect()] == [1]


def test_one_row_of_each_component_by_text_and_id(spark):
    texts = [" ".join(f"{c}{i}" for i in range(30)) for c in "abcd"]
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[0]), (None, texts[1]), (None, texts[2]), (None, texts[2]), (5, ""), (6, ""), (7, texts[3]), (7, texts[3])]
    df = spark.createDataFrame([(*r, "en", "s", i) for i, r in enumerate(rows)], FIELDS)
    got = sorted((str(r.doc_id), r.text) for r in j.one_per_component(df).collect())
    assert got == sorted((str(i), t) for i, t in [(1, texts[0]), (1, texts[1]), (None, texts[2]), (5, ""), (6, ""), (7, texts[3])])
