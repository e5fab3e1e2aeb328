"""Bounded labelled samples and small calibration tools shared by the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, bound: int, allowed: Column | None = None) -> DataFrame:
    """(doc_id, text, y) of at most ``bound`` labelled ids, lowest hash of the id first.

    Labels with a null id or value are left out, repeated labels of an id count as
    their maximum.  The ids, at most ``bound`` of them, are broadcast to the scan.
    """
    l = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(target).cast("int").alias("y")).where("doc_id is not null and y is not null")
    if allowed is not None:
        l = l.where(allowed)
    l = l.groupBy("doc_id").agg(F.max("y").alias("y"))
    ids = l.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return d.join(F.broadcast(ids), "doc_id")


def isotonic(score: np.ndarray, y: np.ndarray, weight: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators fit; equal scores are pooled first. Knots (score, rate)."""
    s, inv = np.unique(score, return_inverse=True)
    if len(s) == 0:
        return np.array([0.0]), np.array([0.5])
    n, k = np.bincount(inv).astype(float), np.bincount(inv, weights=y)
    blocks: list[list[float]] = []
    for i in range(len(s)):
        blocks.append([n[i], k[i], s[i], s[i]])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][0] >= blocks[-1][1] / blocks[-1][0]:
            b = blocks.pop()
            a = blocks[-1]
            a[0], a[1], a[3] = a[0] + b[0], a[1] + b[1], b[3]
    base = (y.sum() + weight) / (len(y) + 2 * weight)
    xs, ys = [], []
    for c, t, lo, hi in blocks:
        p = (t + weight * base) / (c + weight)
        xs += [lo, hi] if hi > lo else [lo]
        ys += [p, p] if hi > lo else [p]
    return np.array(xs), np.maximum.accumulate(np.array(ys))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def platt(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of P(y = 1), never falling in the score.

    Scores are standardised and targets smoothed, so separable labels have a finite fit;
    Newton steps are halved until they lower the loss.
    """
    mean, spread = float(score.mean()), float(score.std()) or 1.0
    n1 = float(y.sum())
    n0 = len(y) - n1
    t = np.where(y > 0.5, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([(score - mean) / spread, np.ones_like(score)], 1)
    loss = lambda v: float(np.sum(np.logaddexp(0, x @ v) - t * (x @ v)) + 5e-4 * v @ v)
    v = np.array([1.0, 0.0])
    for _ in range(100):
        p = sigmoid(x @ v)
        g = x.T @ (p - t) + 1e-3 * v
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step, size = np.linalg.solve(h, g), 1.0
        while size > 1e-6 and loss(v - size * step) > loss(v):
            size /= 2
        v = v - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    slope = max(float(v[0]), 0.0) / spread
    return slope, float(v[1]) - slope * mean
