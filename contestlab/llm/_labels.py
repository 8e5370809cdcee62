"""Labelled samples, hashed features and calibration shared by the trained operators.

Only rows whose ``crc32(doc_id as text) mod 5`` is not 0 are learned from. A model is fitted on at most ``per_class`` rows
of each class, the first in the order of a hash of the id: a bounded sample, whatever the size of the tables. Fits run in
tasks; the driver sees only class counts, weights of fixed size and scores of the sample.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PER_CLASS = 2000


def held_out(id_col: str = "doc_id") -> Column:
    """True where the remainder is 0; a null id is not held out (and never has a label)."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int = PER_CLASS, seed: int = 1) -> tuple[DataFrame, tuple[int, int]]:
    """``(doc_id, text, y, fold)`` of at most ``per_class`` rows of each class, and how many labelled rows each class has.

    ``fold`` (0 to 4) is a hash of the text, so copies of a text share it. An id with several labels counts once, with
    the largest; of rows that repeat an id one is taken; null texts count as empty.
    """
    y = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    counts = {r.y: r.n for r in y.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    first = [y.where(F.col("y") == c).orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(per_class) for c in (0, 1)]
    chosen = F.broadcast(first[0].unionByName(first[1]))  # at most 2 * per_class ids
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = docs.select("doc_id", text.alias("text")).join(chosen, "doc_id").groupBy("doc_id", "y").agg(F.max("text").alias("text"))
    return found.withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(5)).cast("int")), (counts.get(0, 0), counts.get(1, 0))


def calibrate(z: np.ndarray, y: np.ndarray, counts: tuple[int, int], steps: int = 50) -> tuple[float, float]:
    """``(a, b)`` so that ``1 / (1 + exp(-(a z + b)))`` is the chance of label 1 in the labelled rows: logistic regression
    by Newton's method with smoothed targets, each class weighted to its number in ``counts``. Without both classes the
    score is the smoothed share of label 1 for every text."""
    share = (counts[1] + 1) / (counts[0] + counts[1] + 2)
    if len(np.unique(y)) < 2:
        return 0.0, float(np.log(share / (1 - share)))
    n0, n1 = (y == 0).sum(), (y == 1).sum()
    w = np.where(y == 1, share / n1, (1 - share) / n0) * len(y)
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    center, scale = z.mean(), z.std() or 1.0
    x = np.stack([(z - center) / scale, np.ones(len(z))])
    ab = np.array([0.0, np.log(share / (1 - share))])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(ab @ x, -30, 30)))
        grad = x @ (w * (p - t)) + 1e-3 * ab
        hess = (x * (w * p * (1 - p) + 1e-9)) @ x.T + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        ab = ab - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(ab[0] / scale), float(ab[1] - ab[0] * center / scale)


def chance(z: np.ndarray, ab: tuple[float, float]) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(ab[0] * z + ab[1], -30, 30)))


def sums(values: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Sum of the values between consecutive bounds."""
    total = np.zeros(len(values) + 1)
    np.cumsum(values, out=total[1:])
    return total[bound[1:]] - total[bound[:-1]]
