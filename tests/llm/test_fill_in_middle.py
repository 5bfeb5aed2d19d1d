"""Boundary sets against plain lists, cuts against string slices, round trips of odd texts."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import boundary_set as bs
from shelfcast.llm.fill_in_middle import FimParams, fill_in_middle, restored


@pytest.mark.parametrize("density", [0.001, 0.3, 0.97, 1.0])
def test_containers_select_as_a_sorted_list(density):
    rng = np.random.default_rng(5)
    mask = rng.random(bs.CHUNK) < density
    want = np.flatnonzero(mask)
    for kind in (bs.ArrayContainer, bs.BitmapContainer, bs.RunContainer):
        found = kind(mask)
        assert [found.select(k) for k in range(0, len(want), 997)] == want[::997].tolist()
        assert found.select(len(want) - 1) == want[-1]
    expected = {0.001: bs.ArrayContainer, 0.3: bs.BitmapContainer, 0.97: bs.RunContainer, 1.0: bs.RunContainer}
    assert type(bs.container_of(mask)) is expected[density]


def test_set_skips_empty_chunks():
    found, mask = bs.BoundarySet(), np.zeros(bs.CHUNK, bool)
    mask[[3, 9]] = True
    for key, m in ((0, mask), (1, np.zeros(bs.CHUNK, bool)), (4, mask)):
        found.add_chunk(key, m)
    assert [found.select(k) for k in range(len(found))] == [3, 9, 4 * bs.CHUNK + 3, 4 * bs.CHUNK + 9]
    with pytest.raises(IndexError):
        found.select(4)


@pytest.mark.parametrize("unit", ["a", "é", "日", "\U0001f600", "aé日\U0001f600", "a" * 50 + "é"])
@pytest.mark.parametrize("length", [0, 1, 2, bs.CHUNK - 1, bs.CHUNK, bs.CHUNK + 1, 100_000])
def test_boundaries_of_utf8(unit, length):
    text = (unit * (length // len(unit) + 1))[:length]
    found = bs.utf8_boundaries(text.encode())
    assert len(found) == length + 1
    rng = random.Random(length)
    for k in {0, length, *(rng.randint(0, length) for _ in range(30))}:
        assert found.select(k) == len(text[:k].encode())


def plain(key, text):
    """The contract by string slices."""
    n = len(text)
    h = hashlib.sha256(f"1:{key}".encode()).hexdigest()
    h = [int(h[i : i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, z = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:z], text[z:]
    if h[3] % 100 < 20:
        return n, "spm", a, z - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, z - a, f"<P>{p}<S>{s}<M>{m}"


def test_against_slices(spark, docs, odd):
    rng = random.Random(9)
    tricky = ["".join(rng.choice("<>PSM<é日\n\x00") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    more = spark.createDataFrame([(5000 + i, t) for i, t in enumerate(tricky)], "doc_id long, text string")
    rows = docs.select("doc_id", "text").union(odd.select("doc_id", "text")).union(more)
    out = fill_in_middle(rows).withColumn("back", restored(F.col("fim.output"), F.col("fim.form"))).collect()
    assert len(out) == rows.count()
    forms = set()
    for r in out:
        text = r.text or ""
        assert tuple(r.fim) == plain("" if r.doc_id is None else r.doc_id, text)
        assert r.back == text
        forms.add(r.fim.form)
    assert forms == {"plain", "psm", "spm"}


def test_parameters_and_clashes(spark, docs, empty):
    p = FimParams(fim_percent=100, spm_percent=100, prefix="<|p|>", suffix="<|s|>", middle="<|m|>", seed="x")
    rows = fill_in_middle(docs.withColumn("n", F.lit(1)), into="f", params=p).withColumn("back", restored(F.col("f.output"), F.col("f.form"), p))
    assert rows.where("back <> text").isEmpty() and rows.where("f.form <> 'spm' AND text <> ''").isEmpty()
    assert rows.columns[:-2] == [*docs.columns, "n"]
    assert fill_in_middle(empty).count() == 0
    with pytest.raises(ValueError):
        fill_in_middle(docs.withColumn("fim", F.lit(1)))
