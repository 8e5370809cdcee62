"""Toxicity scores by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features. ASCII letters are folded to lower case and ASCII punctuation separates words; a text's features are its words,
pairs of neighbouring words and pairs with one word between them, hashed to ``BUCKETS`` weights. Each distinct feature of
the whole text counts once; the score is a bias plus the sum of their weights, almost all of which are exactly zero.

Model. FTRL-proximal keeps, for each coordinate, a sum of adjusted gradients and of squared gradients: the learning rate
falls with the second, and a coordinate stays exactly zero until the first passes the L1 limit. One task learns the
bounded sample of labelled rows (``per_class`` of each class, never held-out ones) in several passes, in the order of a
hash. What is left is a short list of (bucket, weight), at most ``BUCKETS`` long, which is broadcast. One fold of the
sample is kept for the calibration of scores to chances.

Scale. Scoring is one pass over Arrow batches without a shuffle.

Defined cases: null text counts as empty; a text without words gets the score of the bias alone; without labels of both
classes every text gets the share of label 1; repeated rows, null ids and other columns change nothing; an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._labels import calibrate, chance, held_out, labelled_sample
from ._text import Block, blocks, mix, small_batches, words

BUCKETS = 1 << 18
PASSES = 8
PER_CLASS = 4000
#: Learning rate, its offset, and the L1 and L2 limits of FTRL-proximal.
ALPHA, BETA, L1, L2 = 0.3, 1.0, 30.0, 0.1
THRESHOLD = 0.5

_U = np.uint64
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_FOLD[[c for c in range(33, 128) if not chr(c).isalnum()]] = 32


def features(k: Block):
    """Three families (words, pairs, skip-pairs): buckets in text order and the bounds of each row's."""
    w = words(Block(k.lo, k.hi, _FOLD[k.data], k.off))
    low = _U(BUCKETS - 1)
    out = [((w.hash & low).astype(np.int64), w.first[:-1], w.first[1:])]
    for gap, factor in ((1, 3), (2, 5)):
        if len(w.hash) > gap:
            same = w.row[gap:] == w.row[:-gap]
            both = mix(w.hash[:-gap] * _U(factor) + w.hash[gap:])[same]
            bound = np.concatenate([[0], np.cumsum(same)])[np.minimum(w.first, len(same))]
        else:
            both, bound = w.hash[:0], np.zeros(len(k.off), np.int64)
        out.append(((both & low).astype(np.int64), bound[:-1], bound[1:]))
    return out


def raw_score(k: Block, weight: np.ndarray, bias: float) -> np.ndarray:
    found = []
    for bucket, lo, hi in features(k):
        at = np.flatnonzero(weight[bucket])
        found.append((np.searchsorted(hi, at, "right")) * BUCKETS + bucket[at])
    code = np.unique(np.concatenate(found))  # each feature of a row once
    return bias + np.bincount(code // BUCKETS, weight[code % BUCKETS], len(k.off) - 1)


def learn(texts: list[str], y: np.ndarray, passes: int = PASSES) -> tuple[np.ndarray, float]:
    """Weights and bias; texts come in the order in which they are learned."""
    grad = np.zeros(BUCKETS + 1)
    square = np.zeros(BUCKETS + 1)
    rows = []
    for k in blocks(pa.array(texts, pa.large_string()), 1 << 20):
        families = features(k)
        for r in range(k.hi - k.lo):
            found = np.concatenate([b[lo[r] : hi[r]] for b, lo, hi in families])
            rows.append(np.append(np.unique(found), BUCKETS))
    share = {c: len(y) / (2 * max(1, (y == c).sum())) for c in (0, 1)}

    def weights(at):
        g, s = grad[at], square[at]
        l1 = np.where(at == BUCKETS, 0.0, L1)
        return np.where(np.abs(g) <= l1, 0.0, -(g - np.sign(g) * l1) / ((BETA + np.sqrt(s)) / ALPHA + L2))

    for _ in range(passes):
        for at, t in zip(rows, y, strict=True):
            w = weights(at)
            g = share[int(t)] * (1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - t)
            sigma = (np.sqrt(square[at] + g * g) - np.sqrt(square[at])) / ALPHA
            grad[at] += g - sigma * w
            square[at] += g * g
    w = weights(np.arange(BUCKETS + 1))
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[np.ndarray, float, tuple[float, float]]:
    """Weights, bias and calibration. Fold 0 of the sample is for the calibration only."""
    sample, share = labelled_sample(docs, labels, "toxic", per_class)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["turn", "doc_id"])
        weight, bias = learn(pdf["text"].tolist(), pdf["y"].to_numpy())
        at = np.flatnonzero(weight)
        return pd.DataFrame({"bucket": np.append(at, BUCKETS), "weight": np.append(weight[at], bias)})

    def rest(pdf: pd.DataFrame) -> pd.DataFrame:
        z = [raw_score(k, weight, bias) for k in blocks(pa.array(pdf["text"].tolist(), pa.large_string()))]
        return pd.DataFrame({"z": np.concatenate(z), "y": pdf["y"].to_numpy()})

    turn = sample.where("fold > 0").select("*", F.xxhash64("doc_id", F.lit(5)).alias("turn"), F.lit(0).alias("one"))
    found = turn.groupBy("one").applyInPandas(one, "bucket int, weight double").collect()  # at most BUCKETS + 1 rows
    weight, bias = np.zeros(BUCKETS, np.float32), 0.0
    for r in found:
        if r.bucket == BUCKETS:
            bias = r.weight
        else:
            weight[r.bucket] = r.weight
    found = sample.where("fold = 0").groupBy("fold").applyInPandas(rest, "z double, y int").toPandas()  # of the bounded sample
    return weight, bias, calibrate(found["z"].to_numpy(float), found["y"].to_numpy(int), share)


def toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(train(rows, labels, per_class))

    def run(batches):
        weight, bias, ab = model.value
        for b in batches:
            z = [raw_score(k, weight, bias) for k in blocks(b.column("text"), 1 << 20)]
            score = chance(np.concatenate(z) if z else np.zeros(0), ab)
            cols = [b.column("doc_id"), b.column("held_out"), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "held_out", "score", "predicted"])

    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int"
    return rows.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(run, schema)
