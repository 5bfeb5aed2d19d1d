"""Document fingerprints by consistent weighted sampling, with built-in functions only.

A text is a set of words weighted by their counts. For every sample, each word draws two gamma
variates and a uniform one from a hash of (word, sample), so the same word draws the same values in
every text; the word with the least a = c / (y exp(r)) is the sample, together with the step t on which
its weight falls. Two texts agree on a sample with a probability equal to their generalised Jaccard
similarity, the sum of the smaller weights over the sum of the larger ones.

Plan of ``neighbour_fingerprints``: one shuffle of the texts into buckets of consecutive ids. The
window, the word counts, the minima of all samples and the comparison of neighbours keep that
partitioning. Words meet only words of their own text, so no key can become hot.

Defined cases: a null text counts as empty; texts without words have the fingerprint of one word of
their own; equal texts have equal fingerprints; rows with the same id follow each other by text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.expressions import text_of, words

SAMPLES = 64
RUN = 16
DIGITS = 4
_LOW = -(1 << 63)


def _uniform(bits: Column, shift: int, width: int) -> Column:
    """The bits from ``shift`` on as a number between 0 and 1, both excluded."""
    part = F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << width) - 1))
    return (part.cast("double") + 0.5) * (1.0 / (1 << width))


def sample_rank(term: Column, log_weight: Column, k: Column) -> Column:
    """ln a of the word in the upper bits of a long, 16 bits that name (word, t) in the lower ones.

    The least rank of a text is its sample.
    """
    bits, more = F.xxhash64(term, k), F.xxhash64(k, term)
    r = -F.log(_uniform(bits, 0, 32) * _uniform(bits, 32, 32))
    log_c = F.log(-F.log(_uniform(more, 0, 24) * _uniform(more, 24, 24)))
    beta = _uniform(F.xxhash64(bits), 0, 32)
    t = F.floor(log_weight / r + beta)
    log_a = log_c - r * (t - beta + 1.0)
    name = F.shiftrightunsigned(more, 48).bitwiseXOR(t * F.lit(40503)).bitwiseAND(F.lit(0xFFFF))
    upper = F.least(F.greatest(log_a + 512.0, F.lit(0.0)), F.lit(1023.0)) * float(1 << 36)
    return F.shiftleft(upper.cast("long"), 16).bitwiseOR(name)


def signature(ranks: list[Column]) -> Column:
    """Four hexadecimal digits for every sample."""
    parts = []
    for i in range(0, len(ranks), 4):
        four = [F.shiftleft(x.bitwiseAND(F.lit(0xFFFF)), 48 - 16 * j) for j, x in enumerate(ranks[i : i + 4])]
        parts.append(F.lpad(F.lower(F.hex(reduce(Column.bitwiseOR, four))), 16, "0"))
    return F.concat(*parts)


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of the samples that two fingerprints have in common."""
    same = [(F.substring(a, DIGITS * k + 1, DIGITS) == F.substring(b, DIGITS * k + 1, DIGITS)).cast("int") for k in range(samples)]
    return reduce(Column.__add__, same).cast("double") / float(samples)


def fingerprints(weights: DataFrame, part: str, key: str, carry: str, samples: int = SAMPLES) -> DataFrame:
    """(part, key, fingerprint, carry) from rows (part, key int, term long, weight, carry).

    A text has one row for each distinct term, with a null ``carry``, and may have one row whose
    ``carry`` is returned with the fingerprint. ``part`` must hold a bounded number of texts: a rank depends
    on the word and its weight alone, so it is worked out once for all texts of a part. The samples are dealt out
    in runs of ``RUN``, which keeps the generated code small enough to be compiled.
    """
    runs = -(-samples // RUN)
    shared = weights.groupBy(part, "term", "weight", carry).agg(F.collect_list(key).alias("texts"))
    shared = shared.withColumn("log_weight", F.log(F.col("weight").cast("double")))
    shared = shared.withColumn("run", F.explode(F.sequence(F.lit(0), F.when(F.col(carry).isNull(), runs - 1).otherwise(0))))
    names = [f"s{i}" for i in range(RUN)]
    ranks = [sample_rank(F.col("term"), F.col("log_weight"), F.col("run") * RUN + i).alias(n) for i, n in enumerate(names)]
    # A lambda keeps this projection out of the whole-stage method, which would be too long for the compiler.
    texts = F.filter("texts", lambda x: x.isNotNull()).alias("texts")
    least = shared.select(part, carry, "run", texts, *ranks).select(part, carry, "run", F.explode("texts").alias(key), *names)
    least = least.groupBy(part, key, "run", carry).agg(*[F.min(n).alias(n) for n in names])
    digits = F.when(F.col(carry).isNull(), signature([F.col(n) for n in names]))
    least = least.select(part, key, "run", carry, digits.alias("digits"))
    whole = [F.max(F.when(F.col("run") == i, F.col("digits"))) for i in range(runs)]
    return least.groupBy(part, key).agg(F.substring(F.concat(*whole), 1, DIGITS * samples).alias("fingerprint"), F.max(carry).alias(carry))


def _buckets(docs: DataFrame, count: int) -> tuple[Column, list[tuple[int, int]]]:
    """Bucket of an id, and (bucket, least id) of the buckets that have rows, in order.

    The driver sees ``count`` numbers: the bounds and the first id of each bucket.
    """
    ids = docs.select(F.coalesce(F.col("doc_id"), F.lit(_LOW)).alias("id"))
    shares = [i / count for i in range(1, count)]
    row = ids.agg(F.percentile_approx("id", shares, 10_000).alias("bounds")).first() if shares else None
    bounds = sorted(set(row["bounds"] or [])) if row else []
    array = F.array(*[F.lit(b) for b in bounds]) if bounds else None
    bucket = lambda c: F.size(F.filter(array, lambda b: b <= c)) if bounds else F.lit(0)
    starts = ids.groupBy(bucket(F.col("id")).alias("bucket")).agg(F.min("id").alias("id")).collect()
    return bucket(F.col("__id")), sorted((r["bucket"], r["id"]) for r in starts)


def neighbour_fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness to it and to the next text.

    The edited text is the text with its last quarter replaced by the beginning of the next document
    by id; the first one follows the last. The first rows of a bucket are copied into the bucket
    before it, so that every row finds its successor at hand.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", text_of("text").alias("text"))
    count = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucket, starts = _buckets(docs, count)
    if not starts:
        starts = [(0, 0)]
    before = {b: starts[i - 1][0] for i, (b, _) in enumerate(starts)}  # of the first: the last
    rows = docs.withColumn("__id", F.coalesce(F.col("doc_id"), F.lit(_LOW))).withColumn("b", bucket)
    first = F.element_at(F.create_map(*[F.lit(x) for pair in starts for x in pair]), F.col("b"))
    target = F.element_at(F.create_map(*[F.lit(x) for pair in before.items() for x in pair]), F.col("b"))
    own = F.struct(F.lit(0).alias("guest"), F.col("b").alias("b"))
    copy = F.struct(F.lit(1).alias("guest"), target.alias("b"))
    rows = rows.withColumn("at", F.explode(F.when(F.col("__id") == first, F.array(own, copy)).otherwise(F.array(own))))
    rows = rows.select("doc_id", "text", "__id", F.col("at.guest").alias("guest"), F.col("at.b").alias("b"))
    rows = rows.repartition(F.col("b"))
    order = Window.partitionBy("b").orderBy("guest", "__id", "text")
    rows = rows.withColumns({"next": F.lead("text").over(order), "row": F.row_number().over(order)})
    n, m = F.length("text"), F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - m), F.substring(F.coalesce(F.col("next"), F.lit("")), F.lit(1), m))
    rows = rows.withColumn("edited", edited)
    # A text and its edited text are the numbers 2 row and 2 row + 1 of the bucket. The digest and the id
    # travel as a third version without words, so that the texts are sorted once.
    meta = F.struct("guest", "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    kind = "struct<guest:int,doc_id:bigint,n_chars:bigint,edited_sha256:string>"
    versions = F.array(
        F.struct((2 * F.col("row")).alias("key"), words(F.col("text")).alias("w"), F.lit(None).cast(kind).alias("meta")),
        F.struct((2 * F.col("row") + 1).alias("key"), words(F.col("edited")).alias("w"), F.lit(None).cast(kind).alias("meta")),
        F.struct((2 * F.col("row")).alias("key"), F.array().cast("array<string>").alias("w"), meta.alias("meta")),
    )
    # The fields are taken apart before the words are exploded, or each word's row would hold all words.
    terms = rows.select("b", F.explode(versions).alias("x")).select("b", "x.key", "x.meta", "x.w")
    terms = terms.select("b", "key", "meta", F.explode_outer("w").alias("word"))
    term = F.when(F.col("word").isNotNull(), F.xxhash64("word")).otherwise(F.lit(0))
    weights = terms.select("b", "key", "meta", term.alias("term")).groupBy("b", "key", "meta", "term").agg(F.count("*").alias("weight"))
    prints = fingerprints(weights, "b", "key", "meta", samples)
    pick = lambda v: F.max(F.when(F.col("key") % 2 == v, F.col("fingerprint")))
    out = prints.groupBy("b", F.floor(F.col("key") / 2).alias("row"))
    out = out.agg(pick(0).alias("fingerprint"), pick(1).alias("edited_fingerprint"), F.max("meta").alias("meta"))
    following = F.lead("fingerprint").over(Window.partitionBy("b").orderBy("row"))
    out = out.withColumn("next", following).filter("meta.guest = 0")
    return out.select(
        "meta.doc_id", "meta.n_chars", "meta.edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
        F.coalesce(likeness(F.col("fingerprint"), F.col("next"), samples), F.lit(1.0)).alias("near_next"),
    )
