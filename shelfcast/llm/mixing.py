"""Mixing sources to target weights by pivotal dependent rounding, with built-in functions only.

Every document of a source is wanted a fractional number of times, ``target / source_size``. The whole
part is taken at once. The fractions meet in pairs: a random transfer of words from one to the other,
of which the expectation is zero, makes one of them 0 or 1, and the other goes on. A block of documents
is folded this way, the residuals of up to ``FAN_IN`` blocks form a block of the next level, until one
residual for each source is left, which is rounded to the nearer side. A transfer keeps the words of
the pair, so the words taken from a source miss its target by half a document at most.

Blocks are dealt by a hash, so a hot source is as many blocks as its size asks for, and no task
holds more than a block at a time. All random numbers are hashes of ids: reruns agree.

Defined cases: a null text has size 0; a null source is a source of its own, the last one; rows that
agree in source, id and size share one decision; empty texts are taken as often as the whole part says;
sources without words have target 0; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.expressions import let, text_of, words
from shelfcast.llm.tables import written
from shelfcast.operators.reshape import with_serial

FAN_IN = 256
LARGE = 100
MOST = 3.0
WEIGHTS = (1.0, 2.0, 3.0)
_EPS = 1e-9


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """source, source_size, units, target: the shares of all words, none above ``most`` times its source.

    Weights are dealt to the sources in code-point order, null last. The level at which the shares
    of the sources below their bound add up is found by rounds of one aggregate each; a round
    only ever bounds more sources, and the last one bounds none.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("units"))
    per = per.withColumn("__null", F.col("source").isNull().cast("int"))
    ranked = with_serial(per, ["__null", "source"], "rank", buckets=4).drop("__null")
    dealt = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = written(ranked.withColumn("weight", dealt), "sources")
    cap = F.col("source_size") * F.lit(float(most))
    total, weight = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    if not total:
        return ranked.select("source", "source_size", "units", F.lit(0.0).alias("target"))
    level, bounded = total / weight, 0
    while True:
        full = cap <= F.lit(level) * F.col("weight")
        row = ranked.agg(
            F.sum(full.cast("int")), F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if row[0] == bounded or row[2] is None:
            break
        bounded, level = row[0], (total - row[1]) / row[2]
    return ranked.select("source", "source_size", "units", F.least(cap, F.lit(level) * F.col("weight")).alias("target"))


def _uniform(*values: Column) -> Column:
    return (F.shiftrightunsigned(F.xxhash64(*values), 11).cast("double") + 0.5) / float(1 << 53)


def _pair(a: Column, b: Column, seed: int) -> Column:
    """(decided, bit, rest) of two open units; ``rest`` is null when both become integral."""
    up = lambda x, y: F.least(F.lit(1.0) - x["p"], y["p"] * y["words"] / x["words"])  # noqa: E731  x up, y down
    moves = F.struct(up(a, b).alias("raise"), F.least(a["p"], (F.lit(1.0) - b["p"]) * b["words"] / a["words"]).alias("lower"), _uniform(a["id"], a["words"], b["id"], b["words"], F.lit(seed)).alias("u"))

    def moved(m: Column) -> Column:
        rise = m["u"] * (m["raise"] + m["lower"]) < m["lower"]
        step = F.when(rise, m["raise"]).otherwise(-m["lower"])
        return F.struct((a["p"] + step).alias("pa"), (b["p"] - step * a["words"] / b["words"]).alias("pb"))

    def settled(m: Column) -> Column:
        distance = lambda p: F.least(F.abs(p), F.abs(F.lit(1.0) - p))
        first = distance(m["pa"]) <= distance(m["pb"])
        keep = lambda x, p: F.struct(x["id"].alias("id"), x["words"].alias("words"), x["n"].alias("n"), p.alias("p"))
        won = F.when(first, keep(a, F.round(m["pa"]))).otherwise(keep(b, F.round(m["pb"])))
        rest = F.when(first, keep(b, m["pb"])).otherwise(keep(a, m["pa"]))
        return F.struct(won.alias("won"), rest.alias("rest"))

    return let(let(moves, moved), settled)


_UNIT = "struct<id:bigint,words:double,n:bigint,p:double>"


def _fold(units: Column, seed: int) -> Column:
    """struct(done, rest): the units of a block paired one after the other, the longest first, so that a short one is left."""
    start = F.from_json(F.lit('{"done":[]}'), f"done array<{_UNIT}>, rest {_UNIT}")

    def step(state: Column, x: Column) -> Column:
        paired = lambda p: F.struct(F.concat(state["done"], F.array(p["won"])).alias("done"), p["rest"].alias("rest"))
        integral = (x["p"] < _EPS) | (x["p"] > 1.0 - _EPS)
        whole = F.struct(x["id"].alias("id"), x["words"].alias("words"), x["n"].alias("n"), F.round(x["p"]).alias("p"))
        return (
            F.when(integral, F.struct(F.concat(state["done"], F.array(whole)).alias("done"), state["rest"].alias("rest")))
            .when(state["rest"].isNull(), F.struct(state["done"].alias("done"), x.alias("rest")))
            .otherwise(let(_pair(state["rest"], x, seed), paired))
        )

    by_size = F.sort_array(F.transform(units, lambda x: F.struct(x["words"], x["id"], x["n"], x["p"])), False)
    units = F.transform(by_size, lambda x: F.struct(x["id"].alias("id"), x["words"].alias("words"), x["n"].alias("n"), x["p"].alias("p")))
    return F.aggregate(units, start, step)


def round_copies(sizes: DataFrame, targets: DataFrame, seed: int = 0, fan_in: int = FAN_IN, most: float = MOST) -> DataFrame:
    """source, doc_id, size, source_size, target, copies: one row for each row of ``sizes``.

    Documents of over 1/``LARGE`` of their source, of which there are fewer than ``LARGE``, meet first.
    What their rounding leaves of the target is shared by the others as whole copies and a fraction, and the last large one takes
    a number of copies whose remainder they can hold, if there is one; so only a short document's residual is left at the end.
    """
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    base = F.floor(wanted + _EPS)
    targets = targets.withColumns({"base": base, "p": F.greatest(wanted - base, F.lit(0.0))})
    keys = ["source", "source_size", "target", "base"]
    units = sizes.groupBy("source", "doc_id", "size").agg(F.count("*").alias("n"))
    same = F.col("s.source").eqNullSafe(F.col("t.source"))
    units = units.alias("s").join(targets.alias("t"), same).select("t.*", "s.doc_id", "s.size", "s.n")
    units = written(units.withColumn("words", (F.col("size") * F.col("n")).cast("double")), "units")
    unit = lambda p: F.struct(F.col("doc_id").cast("long").alias("id"), "words", "n", p.alias("p"))
    is_large = F.col("words") * LARGE > F.col("source_size")
    rounded = lambda r: F.struct(*[r[c].alias(c) for c in ("id", "words", "n")], F.round(r["p"]).alias("p"))

    large = units.filter((F.col("size") > 0) & is_large).groupBy(*keys, "p").agg(F.collect_list(unit(F.col("p"))).alias("units"))
    large = large.withColumn("f", _fold(F.col("units"), seed))
    # The last open one takes the copies nearest to its share among those whose remainder the other documents can hold.
    taken = F.aggregate("f.done", F.lit(0.0), lambda s, x: s + x["words"] * (F.col("base") + x["p"]))
    whole = F.aggregate("units", F.lit(0.0), lambda s, x: s + x["words"])
    room = F.lit(most) * (F.col("source_size") - whole)
    large = large.withColumns({"left": F.col("target") - taken, "room": room})
    words_of = lambda c: c * F.col("f.rest.words")
    miss = lambda c: F.round(F.greatest(F.lit(0.0), words_of(c) - F.col("left"), F.col("left") - words_of(c) - F.col("room")), 6)
    choices = F.transform(
        F.sequence(F.lit(0), F.lit(int(most))), lambda c: F.struct(miss(c).alias("miss"), F.abs(c - F.col("base") - F.col("f.rest.p")).alias("off"), c.alias("c"))
    )
    large = large.withColumn("pick", F.when(F.col("f.rest").isNotNull(), F.array_min(choices)["c"]))
    settled = F.struct(*[F.col("f.rest")[c].alias(c) for c in ("id", "words", "n")], (F.col("pick") - F.col("base")).cast("double").alias("p"))
    large = large.withColumn("done", F.when(F.col("pick").isNull(), F.col("f.done")).otherwise(F.concat("f.done", F.array(settled))))
    held = F.aggregate("done", F.lit(0.0), lambda s, x: s + x["words"])
    left = F.col("left") - F.coalesce(F.col("pick") * F.col("f.rest.words"), F.lit(0.0))
    others = F.col("source_size") - held
    share = F.when(others > 0, F.least(F.greatest(left / others, F.lit(0.0)), F.lit(most)))
    large = written(large.select(*keys, "done", share.alias("share")), "large")

    # The other documents take what the large ones leave of the target, each its share: whole copies and a fraction.
    small = units.filter((F.col("size") > 0) & ~is_large).alias("s").join(large.select("source", "share").alias("t"), same, "left")
    small = small.select("s.*", F.coalesce("t.share", F.col("base") + F.col("p")).alias("share"))
    small = small.withColumn("base", F.floor(F.col("share") + _EPS))
    p = F.greatest(F.col("share") - F.col("base"), F.lit(0.0))
    block = F.pmod(F.xxhash64("doc_id", "size", F.lit(seed)), F.ceil(F.col("units") / fan_in))
    most = targets.agg(F.max("units")).first()[0] or 0
    levels, open_units = [large.select(*keys, F.explode("done").alias("unit"))], small.select(*keys, block.alias("block"), unit(p).alias("unit"))
    level, width = 0, -(-most // fan_in)
    while True:
        folded = open_units.groupBy(*keys, "block").agg(F.collect_list("unit").alias("units"))
        folded = written(folded.select(*keys, "block", _fold(F.col("units"), seed + 1 + level).alias("f")), f"folded-{level}")
        levels.append(folded.select(*keys, F.explode("f.done").alias("unit")))
        rest = folded.filter("f.rest IS NOT NULL")
        if width <= 1:
            break
        open_units = rest.select(*keys, F.floor(F.col("block") / fan_in).cast("long").alias("block"), F.col("f.rest").alias("unit"))
        level, width = level + 1, -(-width // fan_in)
    levels.append(rest.select(*keys, rounded(F.col("f.rest")).alias("unit")))
    decided = reduce(DataFrame.unionByName, levels).select(
        *keys, F.col("unit.id").alias("doc_id"), F.round(F.col("unit.words") / F.col("unit.n")).cast("long").alias("size"),
        F.col("unit.n").alias("n"), (F.col("base") + F.col("unit.p")).cast("long").alias("copies"),
    )
    empty = units.filter("size = 0").select(*keys, "doc_id", "size", "n", F.col("base").cast("long").alias("copies"))
    every = decided.unionByName(empty)
    return every.withColumn("__i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).drop("__i", "n", "base")


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source and the number of words, written once: every later step reads only these."""
    return written(docs.select("doc_id", "source", F.size(words(text_of("text"))).cast("long").alias("size")), "sizes")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, seed: int = 0) -> DataFrame:
    """doc_id, source, size, source_size, target, copies of every document."""
    sizes = document_sizes(docs)
    return round_copies(sizes, written(source_targets(sizes, weights, most), "targets"), seed, most=most)


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, seed: int = 0) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of ``docs``."""
    sized = docs.withColumn("__size", F.size(words(text_of("text"))).cast("long"))
    plan = mix(docs, weights, most, seed).groupBy("source", "doc_id", "size").agg(F.max("copies").alias("__copies"))
    plan = plan.filter("__copies > 0").select(F.col("source").alias("__s"), F.col("doc_id").alias("__d"), F.col("size").alias("__n"), "__copies")
    same = F.col("source").eqNullSafe(F.col("__s")) & F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("__size") == F.col("__n"))
    taken = sized.join(plan, same)
    return taken.withColumn("__i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))).select(*docs.columns)
