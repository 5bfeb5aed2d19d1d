import zlib

import numpy as np
import pytest
from conftest_data import ODD, corpus
from pyspark.sql import functions as F

from shelfcast.llm import packing as p
from shelfcast.llm.q_packing import tokenizer_path

PATH = tokenizer_path()


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_ids_are_those_of_the_whole_text(tokenizer):
    odd = ["Don't it'S 'tis", "a'll. x,;y é́ ΑΣ Σ.", "\t\x0b x　z", "<|endoftext|> hi", "ﬁne İstanbul ǅ", ".... ,,a,,, 12,34 x", "naïve-co-op ÀÉ×ß", "K ½x²", "\x1c\x1d a\x85b", "X" * 3000]
    texts = odd + [r[1] or "" for r in corpus() + ODD]
    for _ in range(2):  # the second time from memory
        got = p._encoder(PATH)(texts)
        assert got == [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def check(rows, capacity):
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_seq)


def test_documents(spark, odd, tokenizer):
    capacity = 512
    rows = p.pack_documents(odd.select("doc_id", "text", "source"), PATH, capacity=capacity).collect()
    used = check(rows, capacity)
    want = []
    for r in ODD:
        ids = np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4")
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            want.append((str(r[0]), k // capacity, k, len(part), zlib.crc32(part.tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    assert used == -(-sum(w[3] for w in want) // capacity)


def test_levels_reach_the_bound(spark):
    items = spark.range(3000).select("id", (F.pmod(F.xxhash64("id"), F.lit(40)) + 1).alias("length"))
    rows = p.pack(items, capacity=100, group_size=400).collect()
    assert sorted(r.id for r in rows) == list(range(3000))
    assert check(rows, 100) <= -(-sum(r.length for r in rows) // 100) + 3


@pytest.mark.parametrize("seed", range(4))
def test_local_search_never_worsens(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(20, 70, 300)
    first = p.best_fit(lengths, 100)
    better = p.local_search([list(b) for b in first], lengths, 100)
    assert sorted(i for b in better for i in b) == list(range(300))
    assert all(lengths[b].sum() <= 100 for b in better) and len(better) <= len(first)


def test_two_for_one_exchange_empties_a_bin():
    lengths = np.array([50, 30, 20, 55, 25, 20])  # fill 100 only as 50+30+20 and 55+25+20
    bins = p.local_search([[0, 1], [3, 4], [2, 5]], lengths, 100)
    assert len(bins) == 2


def test_errors_and_empty(spark, empty):
    assert p.pack_documents(empty.select("doc_id", "text"), PATH).count() == 0
    with pytest.raises(ValueError):
        p.token_pieces(empty.select("doc_id", "text", F.lit(1).alias("piece")), PATH)
    with pytest.raises(ValueError):
        p.pack(empty.select(F.col("n_chars").alias("length"), F.lit(1).alias("offset")))
