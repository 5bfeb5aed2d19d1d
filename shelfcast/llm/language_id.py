"""Language identification by a bidirectional gated recurrent network over bytes.

Two gated recurrent layers read windows of bytes, one in each direction. Every position gets a
distribution over the languages from both states; the probabilities of the positions that hold letters
are pooled over the whole text. The network is trained in numpy by back-propagation through time
on a bounded, balanced sample; scoring streams whole texts through numpy in Arrow batches, without a shuffle.

Defined cases: a null text, or one without letters, is ``und`` with score 0; rows without a language or
id are never learned from; without any language to learn everything is ``und``; with one language all texts
with letters have it; ties go to the first language in order of its name; repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm import text_hash as th

HIDDEN = 8
#: Bytes that the network reads at a time; a text is as many windows as it needs.
WINDOW = 128
TRAIN_WINDOW = 48
#: Bounds of the sample: documents of a language, characters of an excerpt, windows of an excerpt, languages.
SAMPLE_PER_LANGUAGE = 500
EXCERPT = 1_500
WINDOWS_PER_EXCERPT = 8
LANGUAGES = 200
BATCH = 192
STEPS = 260
RATE = 0.02
_LETTERS = np.zeros(256, bool)
_LETTERS[65:91] = _LETTERS[97:123] = _LETTERS[128:] = True


@dataclass
class Direction:
    """Input rows by byte (3H, 256) and recurrent weights (3H, H); gates in the order update, reset, new."""

    x: np.ndarray
    u: np.ndarray

    def states(self, bytes_: np.ndarray, trace: list | None = None) -> np.ndarray:
        """Hidden states (T, H, B) of windows (T, B); ``trace`` collects what the backward pass needs."""
        h_size, (steps, count) = self.u.shape[1], bytes_.shape
        h = np.zeros((h_size, count), self.x.dtype)
        out = np.empty((steps, h_size, count), self.x.dtype)
        for t in range(steps):
            x = np.take(self.x, bytes_[t], axis=1)
            hu = self.u @ h
            gates = np.tanh(0.5 * (x[: 2 * h_size] + hu[: 2 * h_size]))  # a logistic function in terms of tanh
            gates += 1
            gates *= 0.5
            z, r = gates[:h_size], gates[h_size:]
            n = np.tanh(x[2 * h_size :] + r * hu[2 * h_size :])
            if trace is not None:
                trace.append((h, z, r, n, hu[2 * h_size :]))
            h = n + z * (h - n)
            out[t] = h
        return out

    def gradients(self, bytes_: np.ndarray, trace: list, dout: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Back-propagation through time: gradients of x and u from those of the states."""
        h_size, (steps, count) = self.u.shape[1], bytes_.shape
        du, dx = np.zeros_like(self.u), np.empty((steps, 3 * h_size, count), self.x.dtype)
        carry = np.zeros((h_size, count), self.x.dtype)
        for t in range(steps - 1, -1, -1):
            h, z, r, n, hn = trace[t]
            dh = dout[t] + carry
            dn = dh * (1 - z) * (1 - n * n)
            dz, dr = dh * (h - n) * z * (1 - z), dn * hn * r * (1 - r)
            inner = np.concatenate([dz, dr, dn * r])
            dx[t] = np.concatenate([dz, dr, dn])
            du += inner @ h.T
            carry = dh * z + self.u.T @ inner
        flat = dx.transpose(1, 0, 2).reshape(3 * h_size, -1)
        index = bytes_.reshape(-1)
        return np.stack([np.bincount(index, row, 256) for row in flat]).astype(self.x.dtype), du


@dataclass
class Network:
    languages: list[str]
    forward: Direction
    backward: Direction
    out: np.ndarray
    bias: np.ndarray

    def pooled(self, windows: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Sum of the labels' probabilities over the masked positions of each window (C, B)."""
        ahead, behind = self.forward.states(windows), self.backward.states(windows[::-1])[::-1]
        h_size = self.forward.u.shape[1]
        total = np.zeros((len(self.bias), windows.shape[1]), np.float64)
        for t in range(len(windows)):
            p = self.out[:, :h_size] @ ahead[t] + self.out[:, h_size:] @ behind[t] + self.bias[:, None]
            np.exp(p - p.max(axis=0), out=p)
            p *= mask[t] / p.sum(axis=0)
            total += p
        return total


def train_network(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 7, steps: int = STEPS) -> Network:
    """Adam on the cross-entropy of every letter position; windows (N, T) of bytes, labels (N,)."""
    rng = np.random.default_rng(seed)
    kind, h = np.float32, HIDDEN
    shapes = [(3 * h, 256), (3 * h, h), (3 * h, 256), (3 * h, h), (len(languages), 2 * h), (len(languages),)]
    scales = [0.3, 0.4, 0.3, 0.4, 0.3, 0.0]
    p = [(rng.normal(size=s) * c).astype(kind) for s, c in zip(shapes, scales)]
    m, v = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p]
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(windows), BATCH)
        x, y = windows[pick].T, labels[pick]
        mask = _LETTERS[x].astype(kind)
        weight = mask / max(1.0, mask.sum())
        ahead, behind, ta, tb = Direction(p[0], p[1]), Direction(p[2], p[3]), [], []
        both = np.concatenate([ahead.states(x, ta), behind.states(x[::-1], tb)[::-1]], axis=1)
        score = np.einsum("ch,thb->tcb", p[4], both) + p[5][None, :, None]
        score = np.exp(score - score.max(axis=1, keepdims=True))
        error = score / score.sum(axis=1, keepdims=True)
        error[:, y, np.arange(len(y))] -= 1
        error *= weight[:, None, :]
        dboth = np.einsum("ch,tcb->thb", p[4], error)
        g = [*ahead.gradients(x, ta, dboth[:, :h]), *behind.gradients(x[::-1], tb, dboth[::-1, h:]), np.einsum("tcb,thb->ch", error, both), error.sum(axis=(0, 2))]
        rate = RATE * min(1.0, 2 * (1 - (step - 1) / steps))
        for i, d in enumerate(g):
            d = np.clip(d, -1, 1)
            m[i] = 0.9 * m[i] + 0.1 * d
            v[i] = 0.99 * v[i] + 0.01 * d * d
            p[i] = p[i] - (rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.99**step)) + 1e-8)).astype(kind)
    return Network(languages, Direction(p[0], p[1]), Direction(p[2], p[3]), p[4], p[5])


def learn_languages(docs: DataFrame, learned: Column, seed: int = 7) -> Network | None:
    """Train on excerpts of rows where ``learned`` holds; their language is the label, nothing else is seen."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}") & learned)
    start = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.greatest(F.lit(1), F.length("text") - EXCERPT)).cast("int") + 1
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    known = known.select("lang", "doc_id", F.substring("text", start, F.lit(EXCERPT)).alias("excerpt"))
    known = known.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= SAMPLE_PER_LANGUAGE)
    table = known.orderBy("place", "lang").limit(LANGUAGES * SAMPLE_PER_LANGUAGE).toPandas()
    languages = sorted(set(table["lang"]))
    if not languages:
        return None
    rng, windows, labels = np.random.default_rng(seed), [], []
    for lang, text in zip(table["lang"], table["excerpt"]):
        data = np.frombuffer(text.encode(), np.uint8)
        most = max(1, len(data) - TRAIN_WINDOW + 1)
        for at in rng.integers(0, most, min(WINDOWS_PER_EXCERPT, 1 + len(data) // TRAIN_WINDOW)):
            part = data[at : at + TRAIN_WINDOW]
            windows.append(np.pad(part, (0, TRAIN_WINDOW - len(part))))
            labels.append(languages.index(lang))
    # Every language has the same share of the windows.
    labels = np.array(labels)
    largest = np.bincount(labels).max()
    pick = np.concatenate([np.resize(np.flatnonzero(labels == c), largest) for c in range(len(languages))])
    return train_network(np.stack(windows)[pick], labels[pick], languages, seed)


def predict_languages(docs: DataFrame, network: Network | None, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score of every whole text."""
    if network is None:
        return docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    clash = {"lang_pred", "score", "__letters"} & set(docs.columns)
    if clash:
        raise ValueError(f"columns of the input have names of the result: {sorted(clash)}")
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pred, score = [], []
            for lo, hi, data, offsets in th.slices(batch.column(names.index(text))):
                # A text starts a window of its own; its last window is filled with zeros.
                size = np.diff(offsets)
                per_row = -(-size // WINDOW)
                owner = np.repeat(np.arange(hi - lo), per_row)
                nth = np.arange(len(owner)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
                total = np.zeros((len(network.languages), hi - lo))
                for at in range(0, len(owner), 4096):
                    row, n = owner[at : at + 4096], nth[at : at + 4096]
                    place = (offsets[:-1][row] + n * WINDOW)[None, :] + np.arange(WINDOW)[:, None]
                    inside = place < offsets[1:][row][None, :]
                    windows = np.where(inside, data[np.minimum(place, len(data) - 1)], 0)
                    sums = network.pooled(windows, (inside & _LETTERS[windows]).astype(np.float32))
                    for c in range(len(sums)):
                        total[c] += np.bincount(row, sums[c], hi - lo)
                share = total / np.maximum(total.sum(axis=0), 1e-30)
                pred += [network.languages[i] for i in share.argmax(axis=0)]
                score += np.clip(share.max(axis=0), 0, 1).tolist()
            letters = batch.column("__letters").to_pylist()
            pred = [p if ok else "und" for p, ok in zip(pred, letters)]
            score = [s if ok else 0.0 for s, ok in zip(score, letters)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(names))), pa.array(pred, pa.string()), pa.array(score, pa.float64())], schema.names)

    marked = docs.withColumn("__letters", F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    return marked.mapInArrow(run, schema)
