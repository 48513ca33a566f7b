"""Fitting of small logistic models on the driver, from bounded samples of labelled rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfield.llm.common import held_out


def sample_labels(labels: DataFrame, target: str, per_class: int, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, y): up to ``per_class`` rows of label 1 and of label 0 that may be learned from, by a hash of the id."""
    rows = (labels.filter(F.col(target).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
            .groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.max(target).cast("int").alias("y")))
    order = F.xxhash64("doc_id")
    parts = [rows.filter(F.col("y") == y).orderBy(order, "doc_id").limit(per_class) for y in (1, 0)]
    return parts[0].unionByName(parts[1])


def logistic(x: np.ndarray, y: np.ndarray, l1: float = 0.0, l2: float = 0.0, steps: int = 2000, weights: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model by accelerated proximal gradient; penalties are per row, the bias has none."""
    if not len(y):
        return np.zeros(x.shape[1]), 0.0
    share = np.ones(len(y)) if weights is None else weights
    share = share / share.sum()
    a = np.hstack([x, np.ones((len(y), 1))])
    rate = 1.0 / (0.25 * np.linalg.eigvalsh((a * share[:, None]).T @ a)[-1] + l2 + 1e-12)
    w = np.zeros(a.shape[1])
    ahead, t = w, 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ ahead, -30, 30)))
        g = a.T @ (share * (p - y))
        g[:-1] += l2 * ahead[:-1]
        new = ahead - rate * g
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * l1, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, moved = new + (t - 1) / t_new * (new - w), np.abs(new - w).max()
        w, t = new, t_new
        if moved < 1e-7:
            break
    return w[:-1], float(w[-1])
