"""Licence scan against plain Python on whole texts, suppression against its definition."""

import random
import re

import pytest
from pyspark.sql import functions as F

from shelfcast.llm.license_rules import BASE, GATES, NAMES, PHRASES, Rule, rules
from shelfcast.llm.license_scan import ranked, scan_licenses

ORDER = ranked(rules())


def plain(text, order=ORDER):
    """Every detection (start, end, rank, kept) by the definition: whole text around each anchor, all pairs compared."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    found = []
    for i, x in enumerate(w):
        around = " " + " ".join(w[:i]) + " #" + x + " " + " ".join(w[i + 1 :]) + " "
        for rank, r in enumerate(order):
            hit = r.anchor == x and re.search(f" ({r.pattern}) ", around, re.ASCII)
            if hit:
                start = i - hit[1].split("#")[0].count(" ")
                found.append((start, start + hit[1].count(" ") + 1, rank))

    def covered(d):
        for e in found:
            p, q = order[e[2]].priority, order[d[2]].priority
            if e != d and e[0] <= d[0] and e[1] >= d[1] and (p > q or p == q and (e[:2] != d[:2] or e[2] < d[2])):
                return True
        return False

    return len(w), sorted((s, e, order[k].label, order[k].base or not covered((s, e, k))) for s, e, k in found)


def seen(r):
    return r.licenses.n_words, sorted((d.start, d.end, d.label, d.kept) for d in r.licenses.detections)


def sample(name):
    """A text that a name or phrase matches: options left out, first alternatives taken."""
    x = name.replace("#", "")
    while "(" in x:
        x = re.sub(r"\((?:\?:)?([^()|]*)(?:\|[^()]*)?\)(\?|\{0,8\})?", lambda m: "" if m[2] else m[1], x)
    return re.sub(r"\[(.).*?\]", r"\1", re.sub(r"\w\?", "", x)).replace("\\w+", "word")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    names = [sample(n) for _, n, _, _ in NAMES]
    out = ["The MIT License.", "mit License mit license MIT-LICENSE", "GNU Lesser General Public License, version 2.1", "licence", "SPDX-License-Identifier: MIT-0",
           "Licensed under the Apache License, Version 2.0.", "the mİt license", "Krt license", "general\npublic\x00license", "a license", "mit license",
           "Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "distributed under the terms of the GNU General Public License v3 license"]
    out += [sample(p) for _, p, _ in PHRASES] + [f"SPDX-License-Identifier: {sample(s)}" for *_, s in NAMES]
    out += [t.format(n) for n in names for t in ("{} license", "{} Licence", "license: {}", "Licensed under the terms of the {}", "released under the {} license")]
    words = "mit apache license licensed under the gnu general public lesser affero spdx identifier 2 0 version é".split()
    out += [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    return out


def test_every_rule_and_random_words(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    hit = set()
    for r in scan_licenses(rows).collect():
        assert seen(r) == plain(r.text), r.text
        hit |= {d.label for d in r.licenses.detections}
        kept = [d.weight for d in r.licenses.detections if d.kept]
        assert r.licenses.score == max(kept, default=0.0)
    assert hit == {r.label for r in rules()}
    assert len(rules()) > 300


def test_every_rule_holds_its_keyword_and_a_gate(spark, texts):
    for t in texts:
        n, found = plain(t)
        if found:
            assert any(g in t.lower() or g in re.sub(r"[^a-z0-9]+", " ", t.lower()) for g in GATES), t


def test_lesser_licence_suppresses_the_general_one_but_not_the_base(spark):
    text = "GNU Lesser General Public License"
    found = scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().licenses.detections
    assert {(d.label, d.base, d.kept) for d in found} == {("lgpl", False, True), ("gpl", True, True), ("gpl", False, False)}


def test_many_detections_in_one_text(spark):
    order = [*BASE, Rule("wide", "the mit #license now", "license", "mit", 3, 0.9)]
    text = "mit license apache license the MIT license now " * 700
    r = scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string"), all_rules=order).first()
    assert len(r.licenses.detections) == 700 * 4
    short = " ".join(text.split()[:9 * 60])
    assert seen(scan_licenses(spark.createDataFrame([(1, short)], "doc_id long, text string"), all_rules=order).first()) == plain(short, ranked(order))


def test_odd_rows(spark, odd, empty):
    rows = scan_licenses(odd).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert seen(r) == plain(r.text) and r.licenses.score == 0.0
    assert scan_licenses(empty).count() == 0
    with pytest.raises(ValueError):
        scan_licenses(odd.withColumn("licenses", F.lit(1)))
    kept = scan_licenses(odd.withColumn("label", F.lit("x")), into="found")
    assert kept.columns == [*odd.columns, "label", "found"] and kept.where("label <> 'x'").isEmpty()
