"""Licence scans by ordered signature rules, in column expressions only.

A text is normalised to words. Texts without any gate literal are done with that. In the others every anchor word is
looked up: the rules of that anchor whose keyword is among the words around it are matched on those words, so the work is
linear in the text and in the anchors, whatever the number of rules. The detections of a text are sorted by interval, and
one fold with the farthest end of each priority drops those inside a better one. There is no shuffle; memory follows
one text.

A detection is suppressed when another one of higher priority, or of the same priority and either longer or of an earlier
rule, covers its interval. Base rules are never suppressed.

Defined cases: a null text is empty; an empty one has no words, no detections and a score of 0. Repeated rows are scanned one
by one. Rows keep their columns; the result is one struct column, and an input column of its name, or of the
two working names ``__license_text`` and ``__license_found``, is an error.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.expressions import let, text_of
from shelfcast.llm.license_rules import GATES, REACH, Rule, rules

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OUTSIDE = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OUTSIDE_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_CHUNK = 256


def ranked(all_rules: Sequence[Rule]) -> list[Rule]:
    """The rules, best first: by priority, then in their order."""
    return sorted(all_rules, key=lambda r: -r.priority)


def normalised(text: Column) -> Column:
    """The words joined by single spaces; letters keep their case, so that texts without a gate cost one pass."""
    return F.trim(F.regexp_replace(text, OUTSIDE_ANY_CASE, " "))


def n_words(joined: Column) -> Column:
    return F.when(joined == "", F.lit(0)).otherwise(_spaces(joined) + 1).cast("long")


def _spaces(x: Column) -> Column:
    return F.octet_length(x) - F.octet_length(F.replace(x, F.lit(" "), F.lit("")))


def _gated(joined: Column, gates: Sequence[str]) -> Column:
    low = F.lower(joined)
    hit = F.lit(False)
    for g in gates:
        hit = hit | F.contains(low, F.lit(g))
    return hit


def _constant(value: object, kind: str) -> Column:
    """A table of rules as one literal: folded once, where hundreds of nested literals would slow down planning."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _by_anchor(order: Sequence[Rule]) -> Column:
    """Anchor word -> its rules as (rank, keyword, pattern)."""
    anchors: dict[str, list[dict]] = {}
    for rank, r in enumerate(order):
        anchors.setdefault(r.anchor, []).append({"rank": rank, "keyword": r.keyword, "pattern": f" ({r.pattern}) "})
    return _constant(anchors, "map<string, array<struct<rank:int,keyword:string,pattern:string>>>")


def _around(w: Column, i: Column, reach: int) -> Column:
    """The words around place i as one string, ``#`` before the word at i."""
    before = F.slice(w, F.greatest(i - reach, F.lit(0)) + 1, F.least(i, F.lit(reach)))
    after = F.slice(w, i + 2, F.lit(reach))
    return F.concat(F.lit(" "), F.array_join(before, " "), F.lit(" #"), F.get(w, i), F.lit(" "), F.array_join(after, " "), F.lit(" "))


def _found(joined: Column, order: Sequence[Rule], reach: int) -> Column:
    """All matches as sorted (start, -end, rank), ends exclusive."""
    table = _by_anchor(order)
    names = _constant(list(dict.fromkeys(r.anchor for r in order)), "array<string>")

    def at(w: Column, i: Column) -> Column:
        def match(around: Column) -> Column:
            near = F.filter(F.element_at(table, F.get(w, i)), lambda r: F.contains(around, r["keyword"]))
            hits = F.transform(near, lambda r: F.struct(r["rank"].alias("rank"), F.call_function("regexp_extract", around, r["pattern"], F.lit(1)).alias("x")))

            def placed(h: Column) -> Column:
                start = i - _spaces(F.substring_index(h["x"], "#", 1))
                return F.struct(start.alias("start"), (-(start + _spaces(h["x"]) + 1)).alias("neg_end"), h["rank"].alias("rank"))

            return F.transform(F.filter(hits, lambda h: h["x"] != ""), placed)

        return let(_around(w, i, reach), match)

    def scan(w: Column) -> Column:
        places = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.array_contains(names, F.get(w, i)))
        return F.sort_array(F.flatten(F.transform(places, lambda i: at(w, i))))

    return let(F.split(F.translate(joined, _UPPER, _LOWER), " "), scan)


def _kept(found: Column, order: Sequence[Rule]) -> Column:
    """For each detection of the sorted array: no better one covers it.

    What covers an interval stands before it in that order, so the farthest end of each priority so far decides. The
    fold runs in chunks, as appending to one long array would copy it for every element.
    """
    top = max(r.priority for r in order)
    level = _constant([r.priority for r in order], "array<int>")
    base = _constant([r.base for r in order], "array<boolean>")
    state = F.array(*[F.lit(0)] * top)
    none = F.array().cast("array<boolean>")

    def step(acc: Column, d: Column) -> Column:
        p = F.get(level, d["rank"])
        end = -d["neg_end"]
        covered = F.array_max(F.slice(acc["ends"], p, F.lit(top) - p + 1)) >= end
        ends = F.transform(acc["ends"], lambda e, i: F.when(i + 1 == p, F.greatest(e, end)).otherwise(e))
        return F.struct(ends.alias("ends"), F.concat(acc["flags"], F.array(F.get(base, d["rank"]) | ~covered)).alias("flags"))

    def chunk(acc: Column, i: Column) -> Column:
        part = F.slice(found, i * _CHUNK + 1, F.lit(_CHUNK))
        inner = F.aggregate(part, F.struct(acc["ends"].alias("ends"), none.alias("flags")), step)
        return let(inner, lambda r: F.struct(r["ends"].alias("ends"), F.concat(acc["done"], F.array(r["flags"])).alias("done")))

    start = F.struct(state.alias("ends"), F.array().cast("array<array<boolean>>").alias("done"))
    chunks = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / _CHUNK).cast("int"))
    return F.when(F.size(found) == 0, none).otherwise(F.flatten(F.aggregate(chunks, start, chunk)["done"]))


def scan_licenses(
    docs: DataFrame, text: str = "text", into: str = "licenses", all_rules: Sequence[Rule] | None = None, gates: Sequence[str] = tuple(GATES), reach: int = REACH
) -> DataFrame:
    """The rows with a struct column: n_words, score and detections (label, start, end, priority, weight, base, kept).

    ``start`` and ``end`` count words from 0, ``end`` exclusive. The score is the largest weight of a detection that was kept.
    ``gates`` are literals in lower case: a text that a rule can match must hold one; ``reach`` is at least the number of
    words of a rule on either side of its anchor.
    """
    order = ranked(rules() if all_rules is None else all_rules)
    working = ["__license_text", "__license_found"]
    clash = {into, *working} & set(docs.columns)
    if clash:
        raise ValueError(f"columns exist: {sorted(clash)}")
    joined, found = F.col(working[0]), F.col(working[1])
    kind = "array<struct<start:int,neg_end:int,rank:int>>"
    rows = docs.withColumn(working[0], normalised(text_of(text)))
    rows = rows.withColumn(working[1], F.when(_gated(joined, gates), _found(joined, order, reach)).otherwise(F.array().cast(kind)))
    facts = _constant(
        [{"label": r.label, "priority": r.priority, "weight": r.weight, "base": r.base} for r in order],
        "array<struct<label:string,priority:int,weight:double,base:boolean>>",
    )

    def detection(d: Column, kept: Column) -> Column:
        r = F.get(facts, d["rank"])
        return F.struct(
            r["label"].alias("label"), d["start"].alias("start"), (-d["neg_end"]).alias("end"), r["priority"].alias("priority"),
            r["weight"].alias("weight"), r["base"].alias("base"), kept.alias("kept"),
        )

    detections = F.when(F.size(found) > 0, F.zip_with(found, _kept(found, order), detection)).otherwise(
        F.array().cast("array<struct<label:string,start:int,end:int,priority:int,weight:double,base:boolean,kept:boolean>>")
    )
    score = let(detections, lambda ds: F.struct(
        n_words(joined).alias("n_words"),
        F.coalesce(F.array_max(F.transform(F.filter(ds, lambda d: d["kept"]), lambda d: d["weight"])), F.lit(0.0)).alias("score"),
        ds.alias("detections"),
    ))
    return rows.withColumn(into, score).drop(*working)


def labels(detections: Column) -> Column:
    """Distinct labels in order, joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(detections, lambda d: d["label"]))), ",")
