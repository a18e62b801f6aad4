"""Quality classifier as a sparse rule ensemble (operator 9).

Small regression trees are boosted on the logistic loss; each path from a root to a node below
it is a conjunctive rule over the statistics.  A logistic regression with an L1 penalty, fitted
by accelerated proximal gradient, gives most rules weight zero.  What stays is compiled into one
Spark expression: a sigmoid of weighted ``CASE`` terms.

Defined cases: null and empty texts have all statistics 0 and get the score of these; with no
usable labels every score is the prior, 0.5, and with one class only that class's smoothed
rate; repeated rows give repeated rows; an empty table gives no rows; extra columns are kept
by ``with_score`` and not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermoflux.llm.textstats import FEATURES, counts_of, feature_columns, labelled_sample

#: Labelled rows that the ensemble is learned from, at most.
SAMPLE_ROWS = 20_000
Condition = tuple[str, str, float]


@dataclass
class RuleEnsemble:
    intercept: float = 0.0
    rules: list[tuple[tuple[Condition, ...], float]] = field(default_factory=list)

    def score(self, x: pd.DataFrame) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for conditions, weight in self.rules:
            z += weight * covered(conditions, x)
        return 1 / (1 + np.exp(-z))

    def column(self, features: dict[str, Column]) -> Column:
        z = F.lit(self.intercept)
        for conditions, weight in self.rules:
            hit = F.lit(True)
            for name, sign, t in conditions:
                hit = hit & (features[name] <= F.lit(t) if sign == "<=" else features[name] > F.lit(t))
            z = z + F.when(hit, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def covered(conditions: tuple[Condition, ...], x: pd.DataFrame) -> np.ndarray:
    out = np.ones(len(x), bool)
    for name, sign, t in conditions:
        v = x[name].to_numpy()
        out &= v <= t if sign == "<=" else v > t
    return out


def best_split(x: np.ndarray, g: np.ndarray, h: np.ndarray, least: int) -> tuple[int, float] | None:
    """(feature, threshold) of the greatest gain of a Newton step."""
    best, found, total_g, total_h = 1e-6, None, g.sum(), h.sum()
    parent = total_g ** 2 / (total_h + 1)
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, cg, ch = x[order, f], np.cumsum(g[order]), np.cumsum(h[order])
        cut = np.flatnonzero(v[1:] != v[:-1])
        cut = cut[(cut + 1 >= least) & (len(v) - cut - 1 >= least)]
        if not len(cut):
            continue
        gain = cg[cut] ** 2 / (ch[cut] + 1) + (total_g - cg[cut]) ** 2 / (total_h - ch[cut] + 1) - parent
        k = int(np.argmax(gain))
        if gain[k] > best:
            best, found = float(gain[k]), (f, float((v[cut[k]] + v[cut[k] + 1]) / 2))
    return found


def tree_paths(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, least: int) -> tuple[list[tuple[Condition, ...]], np.ndarray]:
    """Every path of one tree, and the tree's step for each row."""
    paths: list[tuple[Condition, ...]] = []
    step = np.zeros(len(x))

    def grow(rows: np.ndarray, path: tuple[Condition, ...]) -> None:
        split = best_split(x[rows], g[rows], h[rows], least) if len(path) < depth and len(rows) >= 2 * least else None
        if path:
            paths.append(path)
        if split is None:
            step[rows] = g[rows].sum() / (h[rows].sum() + 1)
            return
        f, t = split
        low = x[rows, f] <= t
        grow(rows[low], (*path, (FEATURES[f], "<=", t)))
        grow(rows[~low], (*path, (FEATURES[f], ">", t)))

    grow(np.arange(len(x)), ())
    return paths, step


def lasso_logistic(r: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Intercept and weights minimising mean logistic loss + penalty * |weights|."""
    a = np.column_stack([np.ones(len(r)), r])
    size = max(np.linalg.norm(a, 2) ** 2 / (4 * len(a)), 1e-9)
    w = np.zeros(a.shape[1])
    v, t = w.copy(), 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-a @ v))
        u = v - a.T @ (p - y) / len(a) / size
        u[1:] = np.sign(u[1:]) * np.maximum(np.abs(u[1:]) - penalty / size, 0)
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = u + (t - 1) / t_next * (u - w), u, t_next
    return float(w[0]), w[1:]


def learn(sample: pd.DataFrame, label: str = "label", trees: int = 24, depth: int = 3, most_rules: int = 200, seed: int = 7) -> RuleEnsemble:
    """A sparse ensemble from features and 0/1 labels."""
    y = (sample[label].to_numpy() == 1).astype(float)
    if not len(y):
        return RuleEnsemble()
    prior = (y.sum() + 0.5) / (len(y) + 1)
    out = RuleEnsemble(float(np.log(prior / (1 - prior))))
    if y.all() or not y.any():
        return out
    x, rng = sample[FEATURES].to_numpy(float), np.random.default_rng(seed)
    least = max(3, len(y) // 500)
    z, rules = np.full(len(y), out.intercept), {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        rows = rng.permutation(len(y))[:max(2 * least, len(y) * 2 // 3)]
        paths, _ = tree_paths(x[rows], (y - p)[rows], (p * (1 - p))[rows], depth, least)
        paths_all = [(path, covered(path, sample)) for path in paths]
        for path, hit in paths_all:
            if len(rules) < most_rules and 0 < hit.sum() < len(y):
                rules.setdefault(hit.tobytes(), (path, hit))  # equal rules once
        leaf = {path for path in paths if not any(len(o) > len(path) and o[:len(path)] == path for o in paths)}
        for path, hit in paths_all:
            if path in leaf:
                z = z + 0.3 * hit * ((y - p)[hit].sum() / ((p * (1 - p))[hit].sum() + 1))
    if not rules:
        return out
    paths, hits = zip(*rules.values(), strict=True)
    r = np.column_stack(hits).astype(float)
    held = rng.permutation(len(y)) % 4 == 0
    best = (np.inf, 1e-3)
    for penalty in (3e-2, 1e-2, 3e-3, 1e-3, 3e-4):
        b, w = lasso_logistic(r[~held], y[~held], penalty)
        p = np.clip(1 / (1 + np.exp(-b - r[held] @ w)), 1e-6, 1 - 1e-6)
        loss = -(y[held] * np.log(p) + (1 - y[held]) * np.log(1 - p)).mean()
        best = min(best, (loss, penalty))
    b, w = lasso_logistic(r, y, best[1])
    return RuleEnsemble(b, [(path, float(x)) for path, x in zip(paths, w, strict=True) if abs(x) > 1e-6])


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text mod 4 is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> RuleEnsemble:
    return learn(labelled_sample(docs, labels, "quality", rows, ~held_out(F.col("doc_id"))))


def with_score(docs: DataFrame, model: RuleEnsemble, name: str = "score", text: str = "text") -> DataFrame:
    """``docs`` with the score as column ``name``; map-only."""
    counts = "__counts"
    while counts in docs.columns:
        counts += "_"
    wide = docs.withColumn(counts, counts_of(docs[text]))
    return wide.withColumn(name, model.column(feature_columns(F.col(counts)))).drop(counts)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted)."""
    scored = with_score(docs.select("doc_id", "text"), fit_quality(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
