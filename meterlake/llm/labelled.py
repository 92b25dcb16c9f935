"""Labelled rows for the classifiers: folds by document id, and bounded samples."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether nothing may be learned from this document: crc32 of its id as text leaves 1 modulo 3, or it has no id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def training_labels(labels: DataFrame, label: str, rows: int, doc_id: str = "doc_id") -> DataFrame:
    """(id, y) of at most about ``rows`` labelled documents outside the held-out fold, alike on every run.

    An id labelled more than once counts once, with its largest label; null labels and ids are left out.
    """
    known = labels.where(~held_out(doc_id)).where(F.col(label).isNotNull())
    known = known.groupBy(F.col(doc_id).alias("id")).agg(F.max(label).cast("int").alias("y"))
    total = known.count()
    if total > rows:
        known = known.where(F.pmod(F.xxhash64(F.lit("label sample"), "id"), F.lit(1_000_000)) < int(1e6 * rows / total))
    return known


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights of a logistic regression on standardised columns, the intercept last, expressed for the raw columns."""
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return np.append(np.zeros(x.shape[1]), np.log(share / (1 - share)))
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    ridge = np.full(len(w), penalty)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(ridge)
        w -= np.linalg.solve(hessian, z.T @ (p - y) + ridge * w)
    raw = w[:-1] / spread
    return np.append(raw, w[-1] - (raw * mean).sum())
