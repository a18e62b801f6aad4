"""Quality rules as a learned decision list (operator 6).

Sequential covering: on labelled statistics a conjunction of thresholds is grown greedily by
information gain on two thirds of the rows still uncovered, pruned from its end on the other
third, and added if it is precise enough there; the rows it covers go and the next rule is
learned, for rejecting first and then for keeping.  The list becomes one ordered Spark
``CASE WHEN`` over the statistics; what no rule covers gets the majority verdict of the rest
(keep, if fewer than 20 rows are left).

Defined cases: null and empty texts have all counts 0 and fail the base rule; with no labels,
or labels of one class only, the list keeps everything; repeated rows give repeated rows; an
empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermoflux.llm.textstats import FEATURES, counts_of, feature_columns, labelled_sample

#: Labelled rows that the list is learned from, at most.
SAMPLE_ROWS = 20_000


@dataclass
class Rule:
    """``conditions``: (feature, "<=" or ">", threshold); ``keep``: the verdict."""

    conditions: list[tuple[str, str, float]]
    keep: bool

    def covers(self, x: pd.DataFrame) -> np.ndarray:
        out = np.ones(len(x), bool)
        for name, sign, t in self.conditions:
            v = x[name].to_numpy()
            out &= v <= t if sign == "<=" else v > t
        return out

    def column(self, features: dict[str, Column]) -> Column:
        out = F.lit(True)
        for name, sign, t in self.conditions:
            out = out & (features[name] <= F.lit(t) if sign == "<=" else features[name] > F.lit(t))
        return out

    def __str__(self) -> str:
        return f"{'keep' if self.keep else 'reject'} if " + " and ".join(f"{n} {s} {t:g}" for n, s, t in self.conditions)


@dataclass
class DecisionList:
    rules: list[Rule] = field(default_factory=list)
    default: bool = True

    def predict(self, x: pd.DataFrame) -> np.ndarray:
        out, open_rows = np.full(len(x), self.default), np.ones(len(x), bool)
        for r in self.rules:
            hit = open_rows & r.covers(x)
            out[hit] = r.keep
            open_rows &= ~hit
        return out

    def column(self, features: dict[str, Column]) -> Column:
        """The ordered conditional expression."""
        if not self.rules:
            return F.lit(self.default)
        out = F.when(self.rules[0].column(features), F.lit(self.rules[0].keep))
        for r in self.rules[1:]:
            out = out.when(r.column(features), F.lit(r.keep))
        return out.otherwise(F.lit(self.default))


def best_condition(x: pd.DataFrame, y: np.ndarray) -> tuple[float, tuple[str, str, float] | None]:
    """The threshold condition of the greatest gain: covered positives times the rise of the
    logarithm of precision."""
    base, best, found = np.log2(max(y.sum(), 1e-9) / len(y)), 1e-9, None
    for name in x.columns:
        v = x[name].to_numpy()
        order = np.argsort(v, kind="stable")
        s, hits = v[order], np.cumsum(y[order])
        cut = np.flatnonzero(s[1:] != s[:-1])
        if not len(cut):
            continue
        middle = (s[cut] + s[cut + 1]) / 2
        for sign, p, n in (("<=", hits[cut], cut + 1.0), (">", hits[-1] - hits[cut], len(s) - cut - 1.0)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / n) - base), -1)
            k = int(np.argmax(gain))
            if gain[k] > best:
                best, found = float(gain[k]), (name, sign, float(middle[k]))
    return best, found


def grow_and_prune(x: pd.DataFrame, y: np.ndarray, keep: bool, rng: np.random.Generator, conditions: int = 4) -> tuple[Rule, float, int]:
    """A rule for ``y``, its precision on the pruning rows and how many it covers there."""
    held = rng.permutation(len(x)) % 3 == 0
    grow_x, grow_y, rule = x[~held], y[~held], Rule([], keep)
    while len(rule.conditions) < conditions and grow_y.any() and not grow_y.all():
        _, c = best_condition(grow_x, grow_y)
        if c is None:
            break
        rule.conditions.append(c)
        hit = Rule([c], keep).covers(grow_x)
        grow_x, grow_y = grow_x[hit], grow_y[hit]
    best, best_worth = rule, -2.0
    for k in range(len(rule.conditions), 0, -1):  # drop conditions from the end while it pays
        short = Rule(rule.conditions[:k], keep)
        hit = short.covers(x[held])
        p = int(y[held][hit].sum())
        worth = (2 * p - hit.sum()) / max(1, hit.sum())
        if worth >= best_worth:
            best, best_worth = short, worth
    hit = best.covers(x[held])
    return best, (float(y[held][hit].mean()) if hit.any() else 0.0), int(hit.sum())


def learn(sample: pd.DataFrame, label: str = "label", precision: float = 0.9, least: int = 3, most: int = 12, seed: int = 7) -> DecisionList:
    """An ordered list from features and 0/1 labels (1: keep)."""
    x, y = sample[FEATURES].reset_index(drop=True), sample[label].to_numpy() == 1
    out, rng = DecisionList(), np.random.default_rng(seed)
    if not len(x) or y.all() or not y.any():
        return out
    for keep in (False, True):
        failed = 0
        while len(out.rules) < most and failed < 3 and len(x) >= 3 * least:
            target = y == keep
            if target.sum() < least or target.all():
                break
            rule, precise, n = grow_and_prune(x, target, keep, rng)
            if not rule.conditions or precise < precision or n < least:
                failed += 1
                continue
            hit = rule.covers(x)
            out.rules.append(rule)
            x, y = x[~hit].reset_index(drop=True), y[~hit]
    out.default = bool(len(y) < 20 or 2 * y.sum() >= len(y))  # a small rest says nothing: keep
    return out


def fit_rules(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DecisionList:
    return learn(labelled_sample(docs, labels, "quality", rows))


def apply_rules(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """(doc_id, base statistics, base_failed, kept) for each row of ``docs``; map-only."""
    with_counts = docs.select("doc_id", counts_of(F.col("text")).alias("c"))
    c = F.col("c")
    failed = (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])
    verdict = rules.column(feature_columns(c))
    return with_counts.select("doc_id", *[c[n].alias(n) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                              failed.alias("base_failed"), F.when(failed, F.lit(False)).otherwise(verdict).alias("kept"))
