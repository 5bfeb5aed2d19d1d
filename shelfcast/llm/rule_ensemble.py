"""Quality classifier: a sparse rule ensemble over text statistics.

Statistics of whole texts are built-in column expressions. On a bounded sample of labelled rows, boosted
shallow trees give paths, every path is a conjunctive rule, and a lasso logistic regression keeps few of
them. Rules and weights become one Spark column, so scoring is a projection of the scan: no shuffle, no
user function, nothing that grows with the data on the driver.

Defined cases: a null text counts as empty and is scored like any other; rows without a label, or with a
null id, are never learned from; with one class or no label at all the score is the constant rate of the
labels (0.5 without labels). Repeated rows are scored alike.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.expressions import WORD, let, occurrences, ratio, text_of, words

#: Bound of the sample that rules are learned from; rows are chosen by a hash of their id.
SAMPLE_ROWS = 20_000
TREES = 24
DEPTH = 3
BINS = 24
RATE = 0.3
LASSO = 5e-4
STEPS = 400


def text_statistics(text: Column) -> Column:
    """One struct of doubles; counts enter on a log scale, so one very long text stays in range."""

    def of_words(w: Column) -> Column:
        n = F.size(w)
        return F.struct(
            n.alias("n"), F.octet_length(F.array_join(w, "")).alias("bytes"), F.size(F.array_distinct(w)).alias("distinct")
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).alias("n"), F.size(F.array_distinct(lines)).alias("distinct"))

    parts = F.struct(
        let(words(text), of_words).alias("w"),
        let(F.filter(F.split(text, "\\n"), lambda x: x.rlike(WORD)), of_lines).alias("l"),
        F.octet_length(text).alias("bytes"),
        occurrences(text, "#*$%&|<>").alias("symbols"),
        occurrences(text, "A-Z").alias("capitals"),
        occurrences(text, "0-9").alias("digits"),
        occurrences(text, "!?").alias("exclamations"),
        occurrences(text, ".,;:").alias("marks"),
    )

    def together(c: Column) -> Column:
        w, lines = c["w"], c["l"]
        return F.struct(
            F.log1p(w["n"].cast("double")).alias("log_words"),
            F.log1p(lines["n"].cast("double")).alias("log_lines"),
            ratio(w["bytes"], w["n"]).alias("word_bytes"),
            ratio(w["distinct"], w["n"]).alias("distinct_words"),
            ratio(lines["distinct"], lines["n"]).alias("distinct_lines"),
            ratio(w["n"], lines["n"]).alias("words_per_line"),
            ratio(c["symbols"], w["bytes"]).alias("symbols"),
            ratio(c["capitals"], w["bytes"]).alias("capitals"),
            ratio(c["digits"], w["bytes"]).alias("digits"),
            ratio(c["exclamations"], w["n"]).alias("exclamations"),
            ratio(c["marks"], w["n"]).alias("marks"),
        )

    return let(parts, together)


STATISTICS = (
    "log_words", "log_lines", "word_bytes", "distinct_words", "distinct_lines", "words_per_line",
    "symbols", "capitals", "digits", "exclamations", "marks",
)


@dataclass(frozen=True)
class Rule:
    """All conditions hold: (statistic, True for <= or False for >, bound)."""

    conditions: tuple[tuple[str, bool, float], ...]

    def column(self, stats: Column) -> Column:
        tests = [(stats[s] <= F.lit(v)) if below else (stats[s] > F.lit(v)) for s, below, v in self.conditions]
        return reduce(Column.__and__, tests)

    def rows(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return np.logical_and.reduce([(x[s] <= v) if below else (x[s] > v) for s, below, v in self.conditions])


@dataclass(frozen=True)
class RuleEnsemble:
    bias: float
    rules: tuple[tuple[Rule, float], ...]

    def column(self, stats: Column) -> Column:
        """The score as one expression: the logistic function of the weights of the rules that hold."""
        total = F.lit(self.bias)
        for rule, weight in self.rules:
            total = total + F.when(rule.column(stats), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def score(self, x: dict[str, np.ndarray]) -> np.ndarray:
        total = np.full(len(next(iter(x.values()))), self.bias)
        for rule, weight in self.rules:
            total += weight * rule.rows(x)
        return 1 / (1 + np.exp(-total))


def tree_rules(x: np.ndarray, names: tuple[str, ...], y: np.ndarray) -> list[Rule]:
    """The paths of boosted trees of logistic loss, splits on quantile bounds; without repeats, in order."""
    bounds = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(b, c, side="left") for b, c in zip(bounds, x.T)], axis=1)
    rate = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    margin = np.full(len(y), np.log(rate / (1 - rate)))
    found: dict[tuple, None] = {}

    def grow(rows: np.ndarray, path: tuple, depth: int, grad: np.ndarray, hess: np.ndarray) -> None:
        best = (1e-6, 0, 0)
        g, h = grad[rows].sum(), hess[rows].sum()
        if depth < DEPTH and len(rows) >= 20:
            for j, b in enumerate(bounds):
                if not len(b):
                    continue
                bins = binned[rows, j]
                gl = np.cumsum(np.bincount(bins, grad[rows], len(b) + 1))[:-1]
                hl = np.cumsum(np.bincount(bins, hess[rows], len(b) + 1))[:-1]
                n = np.cumsum(np.bincount(bins, minlength=len(b) + 1))[:-1]
                gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
                gain = np.where((n >= 5) & (n <= len(rows) - 5), gain, 0)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (float(gain[k]), j, k)
        if best[0] <= 1e-6:
            margin[rows] += RATE * g / (h + 1)
            return
        _, j, k = best
        below = binned[rows, j] <= k
        for side, part in ((True, rows[below]), (False, rows[~below])):
            longer = (*path, (names[j], side, float(bounds[j][k])))
            found.setdefault(longer)
            grow(part, longer, depth + 1, grad, hess)

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        grow(np.arange(len(y)), (), 0, y - p, p * (1 - p))
    return [Rule(path) for path in found]


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float = LASSO, steps: int = STEPS) -> tuple[float, np.ndarray]:
    """Bias and sparse weights by accelerated proximal gradient; the bias is not penalised."""
    n = len(y)
    mean = z.mean(axis=0)
    step = 4.0 / max(1.0, float(np.linalg.norm(z[: 4_000] - mean, 2) ** 2 / max(1, min(n, 4_000))) + 1.0)
    rate = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    w, b = np.zeros(z.shape[1]), float(np.log(rate / (1 - rate)))
    vw, vb, t = w.copy(), b, 1.0
    for _ in range(steps):
        error = 1 / (1 + np.exp(-(z @ vw + vb))) - y
        new = vw - step * (z.T @ error) / n
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        nb = vb - step * error.mean()
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb, t = new + (t - 1) / nt * (new - w), nb + (t - 1) / nt * (nb - b), nt
        w, b = new, nb
    return float(b), w


def fit_rules(x: np.ndarray, y: np.ndarray, names: tuple[str, ...] = STATISTICS) -> RuleEnsemble:
    """Trees, rules, lasso; classes of one kind only give the constant rate."""
    y = np.asarray(y, float)
    if not len(y) or y.min() == y.max():
        rate = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
        return RuleEnsemble(float(np.log(rate / (1 - rate))), ())
    columns = dict(zip(names, x.T))
    rules = tree_rules(x, names, y)
    z = np.stack([r.rows(columns) for r in rules], axis=1).astype(np.float64)
    bias, weights = lasso_logistic(z, y)
    kept = [(r, float(w)) for r, w in zip(rules, weights) if abs(w) > 1e-4]
    return RuleEnsemble(bias, tuple(kept))


def learn_quality(docs: DataFrame, labels: DataFrame, learned: Column, rows: int = SAMPLE_ROWS, seed: int = 0) -> RuleEnsemble:
    """Fit on labelled rows where ``learned`` holds, ``rows`` of them at most.

    ``labels`` are cut to the sample before they meet the texts, so only its statistics reach the driver.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & learned).select("doc_id", "quality")
    known = known.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(rows).dropDuplicates(["doc_id"])
    sample = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # SAMPLE_ROWS rows at most
    table = sample.select("quality", text_statistics(text_of("text")).alias("s")).select("quality", "s.*").toPandas()
    return fit_rules(table[list(STATISTICS)].to_numpy(float), table["quality"].to_numpy(float))


def score_quality(docs: DataFrame, model: RuleEnsemble, into: str = "quality_score", text: str = "text") -> DataFrame:
    """``docs`` with the score of every whole text."""
    return docs.withColumn(into, let(text_statistics(text_of(text)), model.column))
