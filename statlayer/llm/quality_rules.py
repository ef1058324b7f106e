"""Quality classifier: a sparse ensemble of rules over text statistics, compiled to Spark columns.

Statistics (lengths, shares of character classes, word repetition, line shape) are column expressions over
whole texts. On a bounded sample of labelled rows shallow trees are boosted; every path from a root to a
node becomes a conjunctive rule (``symbol share > 0.04 and distinct words <= 0.6``); logistic regression
with an L1 penalty keeps a few rules; and these are compiled to one column expression, so scoring is a
projection without Python, shuffle or state.

Sample: the ``SAMPLE_ROWS`` labelled training rows of smallest id hash.

Defined results: null text counts as empty, and every statistic of an empty text is 0; null ids or labels
train nothing; repeated rows are scored each; if no label is known the score is 0.5. Extra columns are
ignored.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import fold

SAMPLE_ROWS = 20_000
TREES, DEPTH, CUTS, LEAST_ROWS = 16, 3, 32, 20
PENALTIES = (0.03, 0.01, 0.003, 0.001)
THRESHOLD = 0.7

# Character classes whose share of a text is a statistic.
CLASSES = {
    "upper": "[A-Z]+",
    "digit": "[0-9]+",
    "symbol": r"[|*&$%#@~^_=<>/\\{}\[\]+]+",
    "mark": "[!?]+",
    "stop": "[.,;:]+",
    "odd": r"[\x00-\x08\x0E-\x1F\x7F�]+",
}
FEATURES = ("chars", "words", "word_length", "distinct", "line_length", "short_lines", *CLASSES)


def statistics(text: Column) -> tuple[list[Column], list[Column]]:
    """Two projections: first the parts that are costly to find, then the statistics as doubles."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    size = F.length(text)
    first = [size.alias("n_"), F.array_remove(F.split(text, r"\s+"), "").alias("w_"), F.split(text, "\n").alias("l_")]
    first += [(size - F.length(F.regexp_replace(text, p, ""))).alias(k) for k, p in CLASSES.items()]
    n = F.greatest(F.col("n_"), F.lit(1)).cast("double")
    words = F.greatest(F.size("w_"), F.lit(1)).cast("double")
    lines = F.greatest(F.size("l_"), F.lit(1)).cast("double")
    second = [
        F.log1p(F.col("n_").cast("double")).alias("chars"),
        F.log1p(F.size("w_").cast("double")).alias("words"),
        ((F.col("n_") - F.size("w_")) / words).alias("word_length"),
        (F.size(F.array_distinct("w_")) / words).alias("distinct"),
        F.log1p(n / lines).alias("line_length"),
        (F.size(F.filter("l_", lambda s: F.length(s) < 30)) / lines).alias("short_lines"),
    ] + [(F.col(k) / n).alias(k) for k in CLASSES]
    return first, second


def with_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """The kept columns and one column a statistic."""
    first, second = statistics(F.col("text"))
    return docs.select(*keep, *first).select(*keep, *second)


@dataclass(frozen=True)
class Rule:
    """Conditions (feature number, True for ``>``, cut), all of which must hold."""
    conditions: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), dtype=bool)
        for f, above, cut in self.conditions:
            out &= (x[:, f] > cut) == above
        return out

    def column(self) -> Column:
        out = None
        for f, above, cut in self.conditions:
            c = F.col(FEATURES[f]) > F.lit(cut) if above else F.col(FEATURES[f]) <= F.lit(cut)
            out = c if out is None else out & c
        return out


def tree_paths(x: np.ndarray, target: np.ndarray, cuts: list[np.ndarray], rows: np.ndarray, depth: int, path=()):
    """(paths, prediction) of a least-squares tree over the rows."""
    paths, value = ([Rule(tuple(sorted(path)))] if path else []), np.zeros(len(x))
    value[rows] = target[rows].mean()
    if depth == 0 or len(rows) < 2 * LEAST_ROWS:
        return paths, value
    t = target[rows]
    total, best = t.sum(), (1e-9, None, None)
    for f in range(x.shape[1]):
        if not len(cuts[f]):
            continue
        slot = np.searchsorted(cuts[f], x[rows, f], side="left")       # value > cut i  <=>  slot > i
        n = np.cumsum(np.bincount(slot, minlength=len(cuts[f]) + 1))[:-1]
        s = np.cumsum(np.bincount(slot, weights=t, minlength=len(cuts[f]) + 1))[:-1]
        m = len(rows) - n
        ok = (n >= LEAST_ROWS) & (m >= LEAST_ROWS)
        gain = np.where(ok, s ** 2 / np.maximum(n, 1) + (total - s) ** 2 / np.maximum(m, 1) - total ** 2 / len(rows), -1)
        i = int(gain.argmax())
        if gain[i] > best[0]:
            best = (gain[i], f, float(cuts[f][i]))
    if best[1] is None:
        return paths, value
    _, f, cut = best
    for above in (False, True):
        part = rows[(x[rows, f] > cut) == above]
        more, own = tree_paths(x, target, cuts, part, depth - 1, path + ((f, above, cut),))
        paths += more
        value[part] = own[part]
    return paths, value


def extract_rules(x: np.ndarray, y: np.ndarray, seed: int = 5) -> list[Rule]:
    """Rules of boosted trees, each on a random half of the rows."""
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, CUTS + 1)[1:-1])) for f in range(x.shape[1])]
    raw, rules = np.full(len(y), np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))), {}
    for _ in range(TREES):
        rest = y - 1 / (1 + np.exp(-raw))
        rows = np.sort(rng.permutation(len(y))[:max(len(y) // 2, min(len(y), 4 * LEAST_ROWS))])
        paths, _ = tree_paths(x, rest, cuts, rows, DEPTH)
        for r in paths:
            rules.setdefault(r)
        leaves = [r for r in paths if len(r.conditions) == DEPTH] or paths
        for r in leaves:
            at = r.holds(x)
            raw[at] += 2.0 * rest[at].mean() if at.any() else 0
    return list(rules)


def lasso_logistic(m: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and intercept by accelerated proximal gradient."""
    n, k = m.shape
    mean = m.mean(axis=0)
    c = m - mean
    rate = 4 / max(1e-9, np.linalg.norm(c.T @ c / n, 2))
    base = np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))
    w, b, v, vb, t = np.zeros(k), base, np.zeros(k), base, 1.0
    for _ in range(steps):
        g = (1 / (1 + np.exp(-np.clip(c @ v + vb, -30, 30))) - y) / n
        new = v - rate * (c.T @ g)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        nb = vb - 4 * g.sum()
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = new + (t - 1) / nt * (new - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = new, nb, nt
    return w, float(b - mean @ w)


@dataclass
class Model:
    rules: list[tuple[Rule, float]]
    intercept: float

    def predict(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for r, w in self.rules:
            z += w * r.holds(x)
        return 1 / (1 + np.exp(-z))

    def column(self) -> Column:
        """The score as an expression over the statistic columns."""
        z = F.lit(self.intercept)
        for r, w in self.rules:
            z = z + F.when(r.column(), F.lit(w)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def fit(x: np.ndarray, y: np.ndarray, seed: int = 5) -> Model:
    """Rules and weights; the penalty is chosen on a fifth of the sample, then all rows are used."""
    if not len(y):
        return Model([], 0.0)
    if y.min() == y.max():
        return Model([], 5.0 if y[0] else -5.0)
    rules = extract_rules(x, y, seed)
    if not rules:
        return Model([], float(np.log(y.mean() / (1 - y.mean()))))
    m = np.stack([r.holds(x) for r in rules], axis=1).astype(np.float64)
    check = np.arange(len(y)) % 5 == 0
    losses = []
    for p in PENALTIES:
        w, b = lasso_logistic(m[~check], y[~check], p)
        q = np.clip(1 / (1 + np.exp(-(m[check] @ w + b))), 1e-6, 1 - 1e-6)
        losses.append(-(y[check] * np.log(q) + (1 - y[check]) * np.log(1 - q)).mean())
    w, b = lasso_logistic(m, y, PENALTIES[int(np.argmin(losses))])
    return Model([(r, float(v)) for r, v in zip(rules, w) if abs(v) > 1e-6], b)


def train(docs: DataFrame, labels: DataFrame, holdout: tuple[int, int] = (4, 2)) -> Model:
    """Fit on the sample of labelled rows outside the held-out fold."""
    parts, held = holdout
    own = labels.select(F.col("doc_id").alias("id_"), F.col("quality").cast("double").alias("y_")) \
        .where("id_ is not null and y_ in (0, 1)").where(fold(F.col("id_"), parts) != held) \
        .orderBy(F.xxhash64("id_"), "id_", "y_").limit(SAMPLE_ROWS)
    rows = docs.select(F.col("doc_id").alias("id_"), "text").where(fold(F.col("id_"), parts) != held) \
        .join(F.broadcast(own), "id_")             # at most SAMPLE_ROWS pairs of numbers
    got = with_statistics(rows, "id_", "y_").orderBy(F.xxhash64("id_"), *FEATURES).limit(SAMPLE_ROWS).toPandas()
    return fit(got[list(FEATURES)].to_numpy(dtype=np.float64), got["y_"].to_numpy(dtype=np.float64))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0..1, higher: better) for every row."""
    return with_statistics(docs, "doc_id").select("doc_id", model.column().alias("score"))
