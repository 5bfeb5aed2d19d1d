import hashlib
from collections import Counter

from conftest_data import ODD, corpus

from shelfcast.llm import weighted_sampling as w


def jaccard(a, b):
    a, b = Counter(a.split()), Counter(b.split())
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_fingerprints(spark, docs):
    rows = sorted(w.neighbour_fingerprints(docs).collect(), key=lambda r: r.doc_id)
    texts = [r[1] for r in corpus()]
    after = texts[1:] + texts[:1]
    edited = [t[: len(t) - len(t) // 4] + n[: len(t) // 4] for t, n in zip(texts, after)]
    assert [r.n_chars for r in rows] == [len(t) for t in texts]
    assert [r.edited_sha256 for r in rows] == [hashlib.sha256(e.encode()).hexdigest() for e in edited]
    error = [r.near_edited - jaccard(t, e) for r, t, e in zip(rows, texts, edited)]
    assert abs(sum(error) / len(error)) < 0.03
    assert (sum(e * e for e in error) / len(error)) ** 0.5 < 0.09
    by_text = {}
    for r, t in zip(rows, texts):
        assert by_text.setdefault(t, r.fingerprint) == r.fingerprint
        assert len(r.fingerprint) == w.SAMPLES * w.DIGITS
    # Texts that differ in one word of many may agree on all samples, others do not.
    assert len(set(by_text.values())) > 0.85 * len(by_text)


def test_odd_rows(spark, odd):
    rows = w.neighbour_fingerprints(odd).collect()
    assert len(rows) == len(ODD)
    ordered = sorted((((r[0] if r[0] is not None else -1), r[1] or "") for r in ODD))
    after = ordered[1:] + ordered[:1]
    want = sorted(hashlib.sha256((t[: len(t) - len(t) // 4] + n[: len(t) // 4]).encode()).hexdigest() for (_, t), (_, n) in zip(ordered, after))
    assert sorted(r.edited_sha256 for r in rows) == want
    twice = [r for r in rows if r.doc_id == 905]
    assert twice[0].fingerprint == twice[1].fingerprint
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)


def test_single_and_empty(spark, empty):
    assert w.neighbour_fingerprints(empty).count() == 0
    (row,) = w.neighbour_fingerprints(spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")).collect()
    assert row.near_next == 1.0 and row.n_chars == 7
