"""Toxicity by a classifier chain of linear models over hashed words and word beginnings.

Categories are predicted one after the other; the model of a category sees the probabilities of the
earlier ones. It is trained on their out-of-fold predictions, so that it learns to trust them as far as
they hold on texts that were not learned from. Features are the presence of words and of their first
four to six bytes. Fitting takes a bounded sample of labelled rows, in which each class weighs as much
as all its labels, so that probabilities follow the share of the class and not the size of the table;
scoring streams whole texts through numpy in Arrow batches, without a shuffle.

Defined cases: a null text counts as empty and has the rate of a text without features; rows with null
labels or ids are never learned from; a category with one class only has a constant probability; repeated
rows are scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm import text_hash as th

#: Bound of the sample that the chain learns from; half of it at most is positive.
SAMPLE_ROWS = 8_000
PREFIXES = (4, 5, 6)
HASH_BITS = 22
FEATURES = 2_048
FOLDS = 5
STEPS = 300
LASSO = 5e-4


def _features(column: pa.Array) -> Iterator[np.ndarray]:
    """The hashed features of every word of a row, repeats included."""
    for lo, hi, data, offsets in th.slices(column):
        hashes, upto = th.letter_features(data, offsets, PREFIXES)
        ids = (hashes >> np.uint64(64 - HASH_BITS)).astype(np.int64)
        for row in range(hi - lo):
            yield ids[upto[row] : upto[row + 1]].reshape(-1)


@dataclass(frozen=True)
class Linear:
    """Bias, weights of a few features, weights of the earlier categories' probabilities."""

    bias: float
    features: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray

    def margins(self, rows: np.ndarray, ids: np.ndarray, count: int, before: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.features, ids)
        at[at == len(self.features)] = 0
        hit = self.features[at] == ids if len(self.features) else np.zeros(len(ids), bool)
        return self.bias + np.bincount(rows[hit], self.weights[at[hit]] if hit.any() else None, count) + before @ self.earlier


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_linear(rows: np.ndarray, ids: np.ndarray, y: np.ndarray, before: np.ndarray, weight: np.ndarray | None = None) -> Linear:
    """Logistic regression on the features that tell the classes apart best; (rows, ids) are distinct pairs.

    ``weight`` is the number of labels that a row stands for. Features are chosen by the rows as they are.
    """
    n, positive = len(y), y.sum()
    weight = np.ones(n) if weight is None else weight * (n / weight.sum())
    none = np.zeros(0, np.int64)
    if positive == 0 or positive == n:
        rate = np.clip(positive / n if n else 0.5, 1e-3, 1 - 1e-3)
        return Linear(float(np.log(rate / (1 - rate))), none, none.astype(float), np.zeros(before.shape[1]))
    size = 1 << HASH_BITS
    with_, of_positive = np.bincount(ids, minlength=size), np.bincount(ids[y[rows] == 1], minlength=size)
    rate = positive / n
    lift = (of_positive - with_ * rate) / np.sqrt(with_ * rate * (1 - rate) + 1.0)
    lift[with_ < 3] = 0
    features = np.sort(np.argsort(-np.abs(lift), kind="stable")[:FEATURES])
    features = features[lift[features] != 0]
    where = np.full(size, -1)
    where[features] = np.arange(len(features))
    keep = where[ids] >= 0
    r, c = rows[keep], where[ids[keep]]
    rate = np.clip((y * weight).sum() / n, 1e-9, 1 - 1e-9)
    w, v, b = np.zeros(len(features)), np.zeros(before.shape[1]), float(np.log(rate / (1 - rate)))
    forward = lambda w, v, b: b + np.bincount(r, w[c], n) + before @ v
    back = lambda e: (np.bincount(c, e[r], len(w)), before.T @ e, e.sum())
    x = (np.ones(len(w)), np.ones(len(v)), 1.0)
    for _ in range(12):  # the largest curvature, by power iteration
        x = back(weight * forward(*x))
        norm = float(np.sqrt((x[0] ** 2).sum() + (x[1] ** 2).sum() + x[2] ** 2))
        x = (x[0] / norm, x[1] / norm, x[2] / norm)
    rate_, t, last = 3.5 * n / norm, 1.0, (w, v, b)
    # Accelerated proximal gradient; the lasso keeps words that many texts bear out.
    for _ in range(STEPS):
        gw, gv, gb = back(weight * (_sigmoid(forward(w, v, b)) - y) / n)
        nw = w - rate_ * gw
        new = (np.sign(nw) * np.maximum(np.abs(nw) - rate_ * LASSO, 0), v - rate_ * gv, b - rate_ * gb)
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        w, v, b = (p + (t - 1) / nt * (p - q) for p, q in zip(new, last))
        last, t = new, nt
    w, v, b = last
    return Linear(float(b), features, w, v)


def fit_chain(rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, weight: np.ndarray | None = None) -> list[Linear]:
    """One model per column of ``labels``; later ones learn from out-of-fold probabilities of the earlier ones."""
    n = len(labels)
    weight = np.ones(n) if weight is None else weight
    fold = np.arange(n) % FOLDS
    before, chain = np.zeros((n, 0)), []
    for j in range(labels.shape[1]):
        y, out = labels[:, j].astype(float), np.zeros(n)
        for k in range(FOLDS if j + 1 < labels.shape[1] else 0):
            index = np.cumsum(fold != k) - 1
            part = fold[rows] != k
            model = fit_linear(index[rows[part]], ids[part], y[fold != k], before[fold != k], weight[fold != k])
            out += np.where(fold == k, _sigmoid(model.margins(rows, ids, n, before)), 0)
        chain.append(fit_linear(rows, ids, y, before, weight))
        before = np.column_stack([before, out])
    return chain


def learn_chain(docs: DataFrame, labels: DataFrame, categories: Sequence[tuple[str, Column]], learned: Column, rows: int = SAMPLE_ROWS) -> list[Linear]:
    """Fit on at most ``rows`` labelled documents, positive ones of the label ``toxic`` first up to a half.

    A row of a class that is cut to its half stands for the labels of the class that were not taken.

    ``categories`` are (name, condition over text and __toxic), in the order of the chain.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & learned).select("doc_id", F.col("toxic").alias("__toxic"))
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    half = rows // 2
    full = {x["__toxic"]: x["count"] for x in known.filter("__toxic IN (0, 1)").groupBy("__toxic").count().collect()}
    parts = [known.filter(F.col("__toxic") == t).orderBy(*by_hash).limit(half).withColumn("__weight", F.lit(max(full.get(t, 0) / half, 1.0))) for t in (1, 0)]
    known = parts[0].union(parts[1]).dropDuplicates(["doc_id"])
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(known), "doc_id")  # SAMPLE_ROWS rows at most
    sample = sample.select("doc_id", "text", "__weight", *[c.cast("int").alias(n) for n, c in categories])
    names = [n for n, _ in categories]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(x).astype("<u4").tobytes() for x in _features(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("__weight"), *[batch.column(n) for n in names], pa.array(found, pa.binary())], ["doc_id", "weight", *names, "ids"])

    schema = ", ".join(["doc_id long", "weight double", *[f"{n} int" for n in names], "ids binary"])
    table = sample.mapInArrow(run, schema).toPandas().sort_values("doc_id", key=lambda s: th.mix(s.to_numpy(np.int64).view(np.uint64)))
    found = [np.frombuffer(b, "<u4").astype(np.int64) for b in table["ids"]]
    index = np.repeat(np.arange(len(found)), [len(x) for x in found])
    ids = np.concatenate(found) if found else np.zeros(0, np.int64)
    return fit_chain(index, ids, table[names].to_numpy().reshape(len(table), len(names)), table["weight"].to_numpy(float))


def score_chain(docs: DataFrame, chain: list[Linear], names: Sequence[str], text: str = "text") -> DataFrame:
    """``docs`` with a probability column per category."""
    clash = set(names) & set(docs.columns)
    if clash:
        raise ValueError(f"columns of the input have names of the result: {sorted(clash)}")
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]])
    wanted = np.unique(np.concatenate([m.features for m in chain])) if chain else np.zeros(0, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        useful = np.zeros(1 << HASH_BITS, bool)
        useful[wanted] = True
        for batch in batches:
            rows, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i, x in enumerate(_features(batch.column(batch.schema.get_field_index(text)))):
                hits = np.unique(x[useful[x]])
                rows.append(np.full(len(hits), i))
                ids.append(hits)
            r, c, before = np.concatenate(rows), np.concatenate(ids), np.zeros((batch.num_rows, 0))
            for model in chain:
                before = np.column_stack([before, _sigmoid(model.margins(r, c, batch.num_rows, before))])
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(p) for p in before.T]], names=[*batch.schema.names, *names])

    return docs.mapInArrow(run, schema)
