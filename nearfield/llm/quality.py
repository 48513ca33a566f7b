"""Quality classifier as a sparse rule ensemble.

1. Statistics of a text, as Column expressions (``statistics``).
2. Shallow decision trees are grown on a bounded sample of labelled rows; each path from the root to any node below it is a
   rule, a conjunction of thresholds on statistics.
3. A logistic model with a lasso penalty weighs the rules; most weights become zero.
4. The rules left are compiled into one Column expression, so that scoring is a map over the table without Python.

Learning uses up to ``PER_CLASS`` labelled rows of each label, never a row whose crc32(id) mod 5 is 0, weighted
back to the labels' own shares. Scores use the statistics of the text only.

Defined results: null text is the empty text, all its statistics are 0 and it has a score like any other; without
labelled rows of both kinds every text scores the share of label 1 (0.5 without any); repeated rows each give a row; null ids
stay null and are not held out; an empty table gives an empty result; other columns play no role. Texts are read whole.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfield.llm.common import BLANKS, held_out, text_of
from nearfield.llm.learning import logistic, sample_labels

PER_CLASS = 10_000
TREES, DEPTH, LEAF, CUTS = 12, 3, 20, 24
LASSO = 2e-3


def statistics(text: str) -> dict[str, Column]:
    """Name -> expression over the text column ``text`` (no nulls)."""
    t = F.col(text)
    n = F.length(t)
    some = F.greatest(n, F.lit(1))
    words = F.split(F.trim(t), BLANKS)
    lines = F.split(t, "\n")
    share = lambda chars: (n - F.length(F.regexp_replace(t, f"[{chars}]+", ""))) / some
    return {
        "log_chars": F.log1p(n.cast("double")),
        "blank_share": share(r"\x20\x09-\x0D"),
        "upper_share": share(r"\p{Lu}"),
        "digit_share": share("0-9"),
        "stop_share": share(".,;:?'\"-"),
        "symbol_share": share(r"#$%&*|!<>{}=~^+@/_\\\[\]"),
        "distinct_words": F.when(n > 0, F.size(F.array_distinct(words)) / F.size(words)).otherwise(0.0),
        "distinct_lines": F.when(n > 0, F.size(F.array_distinct(lines)) / F.size(lines)).otherwise(0.0),
        "log_line": F.log1p(n / F.size(lines)),
        "word_length": F.when(n > 0, n / F.size(words)).otherwise(0.0),
    }


Rule = tuple  # of (statistic number, True: above / False: at most, threshold)


def _grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, columns: np.ndarray, depth: int, path: Rule, rules: list) -> None:
    """Adds the paths of a tree below ``path``; splits lower the weighted Gini impurity most."""
    if path:
        rules.append(path)
    if depth == 0 or len(y) < 2 * LEAF or len(set(y.tolist())) < 2:
        return
    best = None
    for c in columns:
        for cut in np.unique(np.quantile(x[:, c], np.linspace(0, 1, CUTS + 2)[1:-1])):
            left = x[:, c] <= cut
            if LEAF <= left.sum() <= len(y) - LEAF:
                impurity = 0.0
                for side in (left, ~left):
                    total, ones = w[side].sum(), (w * y)[side].sum()
                    impurity += ones * (total - ones) / total
                if best is None or impurity < best[0] - 1e-12:
                    best = (impurity, c, float(cut), left)
    if best:
        _, c, cut, left = best
        _grow(x[left], y[left], w[left], columns, depth - 1, (*path, (int(c), False, cut)), rules)
        _grow(x[~left], y[~left], w[~left], columns, depth - 1, (*path, (int(c), True, cut)), rules)


def tree_rules(x: np.ndarray, y: np.ndarray, w: np.ndarray, seed: int = 7) -> list[Rule]:
    """The distinct paths of ``TREES`` trees, each grown on half the rows and two thirds of the statistics."""
    random, rules = np.random.default_rng(seed), []
    for _ in range(TREES):
        rows = random.random(len(y)) < 0.5
        columns = np.sort(random.choice(x.shape[1], max(1, 2 * x.shape[1] // 3), replace=False))
        _grow(x[rows], y[rows], w[rows], columns, DEPTH, (), rules)
    return list(dict.fromkeys(rules))


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    return np.logical_and.reduce([x[:, c] > cut if above else x[:, c] <= cut for c, above, cut in rule])


@dataclass
class Model:
    names: list[str]
    rules: list[Rule] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    bias: float = 0.0

    def column(self) -> Column:
        """The score as an expression over columns named like the statistics."""
        z = F.lit(self.bias)
        for rule, weight in zip(self.rules, self.weights):
            test = F.lit(True)
            for c, above, cut in rule:
                test = test & (F.col(self.names[c]) > cut if above else F.col(self.names[c]) <= cut)
            z = z + F.when(test, F.lit(weight)).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", per_class: int = PER_CLASS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learns the rules and their weights."""
    stats = statistics("text")
    model = Model(list(stats))
    learnable = labels.filter(F.col(target).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    totals = {r[0]: r[1] for r in learnable.groupBy(F.col(target).cast("int")).count().collect()}
    n = sum(totals.values())
    if len(totals) < 2:
        model.bias = 0.0 if not n else 30.0 if 1 in totals else -30.0
        return model
    sample = sample_labels(labels, target, per_class, id_col)  # bounded: at most 2 * per_class ids
    rows = (docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
            .join(F.broadcast(sample), "doc_id").select("doc_id", "y", "text"))
    got = sorted((tuple(r) for r in rows.select("doc_id", "y", *[c.alias(k) for k, c in stats.items()]).collect()))  # bounded like the sample
    y = np.array([r[1] for r in got], float)
    x = np.array([r[2:] for r in got], float).reshape(len(got), len(stats))
    if not len(y):
        model.bias = math.log((totals[1]) / totals[0])
        return model
    w = np.where(y == 1, totals[1] / n / max(1.0, y.sum()), totals[0] / n / max(1.0, (1 - y).sum()))
    rules = tree_rules(x, y, w)
    if not rules:
        model.bias = math.log(totals[1] / totals[0])
        return model
    weights, model.bias = logistic(np.stack([holds(r, x) for r in rules], axis=1).astype(float), y, l1=LASSO, weights=w)
    kept = [(r, float(v)) for r, v in zip(rules, weights) if abs(v) > 1e-6]
    model.rules, model.weights = [r for r, _ in kept], [v for _, v in kept]
    return model


def quality(docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of each text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), text_of(text_col).alias("text"))
    rows = rows.select("doc_id", "held_out", *[c.alias(k) for k, c in statistics("text").items()])
    scored = rows.select("doc_id", "held_out", model.column().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
