"""Quality rules: counts of each text against fixed limits, and a logistic regression over hashed word and character
n-grams, calibrated to a probability and held against a fixed threshold.

Counts (whole text): words ``[^\\x20\\x09-\\x0D]+``, code points in words, characters of ``[#*$%&|<>]``, lines with a word
that are equal to an earlier line, and words in 5-word windows that the text has twice or more. A text fails when it has
fewer than ``MIN_WORDS`` words or when more than ``MAX_REPEATED`` percent of its words are in repeated windows.

Model. Features are words, pairs of neighbouring words and character (byte) 4-grams, hashed to ``BUCKETS`` weights; a
text's score is a bias plus the scaled mean weight of its word features and of its character features, so length does
not count by itself. Weights are fitted by full-batch gradient steps in one task over a bounded sample of labelled rows
(``per_class`` of each class, never held-out ones); one fold of the sample is kept for the calibration. Texts that pass
the counts are kept when the chance of quality 1 is at least ``THRESHOLD``.

Scale. Training reads a bounded sample. Scoring is one pass over Arrow batches without a shuffle; weights (1 MB, fixed)
are a broadcast variable.

Defined cases: null text counts as empty, and empty texts fail by ``n_words``; without labels of both classes every text
gets the share of label 1; repeated rows, null ids and other columns change nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._labels import PER_CLASS, calibrate, chance, labelled_sample, sums
from ._text import _SEPARATOR, Block, Words, blocks, covered, mix, once, prefix_hash, small_batches, window_hash, words

MIN_WORDS = 10
MAX_REPEATED = 20
WINDOW = 5
THRESHOLD = 0.3
BUCKETS = 1 << 18
SCALE = 20.0

_U = np.uint64
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def counts(k: Block, w: Words) -> dict[str, np.ndarray]:
    rows = len(k.off) - 1
    inside = ~_SEPARATOR[k.data]
    n_words = np.diff(w.first)
    dup = np.zeros(rows, np.int64)
    raw = k.data.tobytes()
    for r in range(rows):
        lines = [x for x in raw[k.off[r] : k.off[r + 1]].split(b"\n") if x.strip()]
        dup[r] = len(lines) - len(set(lines))
    at = np.flatnonzero(w.position + WINDOW <= n_words[w.row]) if len(w.row) else np.zeros(0, np.int64)
    key = mix(window_hash(prefix_hash(w.hash), at, WINDOW) ^ mix(w.row[at].astype(_U) + _U(1)))
    single, _ = once(key)
    again = covered(len(w.row), at[~single], WINDOW)
    return {
        "n_words": n_words,
        "word_chars": sums(inside & ((k.data & 0xC0) != 0x80), k.off).astype(np.int64),
        "n_symbols": sums(_SYMBOL[k.data], k.off).astype(np.int64),
        "n_dup_lines": dup,
        "n_repeat_words": sums(again, w.first).astype(np.int64),
    }


def failed(c: dict[str, np.ndarray]) -> np.ndarray:
    return (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEATED * c["n_words"])


def features(k: Block, w: Words):
    """Two families: buckets in text order and the bounds of each row's, for words with pairs, and for 4-grams."""
    low = _U(BUCKETS - 1)
    one = w.hash
    two = mix(one[:-1] * _U(3) + one[1:]) if len(one) > 1 else one[:0]
    same = w.row[1:] == w.row[:-1]
    pair_bound = np.concatenate([[0], np.cumsum(same)])[np.maximum(w.first - 1, 0)]
    n = len(k.data)
    d = k.data.astype(np.uint32)
    gram = (d[: n - 3] | d[1 : n - 2] << 8 | d[2 : n - 1] << 16 | d[3:] << 24) if n > 3 else d[:0]
    gram = ((gram * np.uint32(0x9E3779B1)) ^ (gram >> 15)) * np.uint32(0x85EBCA6B) >> np.uint32(32 - 18)
    last = np.maximum(k.off[:-1], k.off[1:] - 3)
    return [
        ((one & low).astype(np.int64), w.first[:-1], w.first[1:]),
        ((two[same] & low).astype(np.int64), pair_bound[:-1], pair_bound[1:]),
        (gram, np.minimum(k.off[:-1], len(gram)), np.minimum(last, len(gram))),
    ]


def raw_score(k: Block, w: Words, weight: np.ndarray, bias: float) -> np.ndarray:
    z = np.full(len(k.off) - 1, bias)
    for bucket, lo, hi in features(k, w):
        total = np.concatenate([[0.0], np.cumsum(weight[bucket], dtype=np.float64)])
        z += SCALE * (total[hi] - total[np.minimum(lo, hi)]) / np.maximum(1, hi - lo)
    return z


def sparse(texts: list[str]):
    """(row, bucket, value) of all features of some texts."""
    out = []
    for k in blocks(pa.array(texts, pa.large_string())):
        for bucket, lo, hi in features(k, words(k)):
            n = np.maximum(0, hi - lo)
            row = np.repeat(np.arange(len(n)), n)
            ends = np.cumsum(n)
            at = np.arange(ends[-1]) - np.repeat(ends - n, n) + np.repeat(lo, n)
            code, count = np.unique(row * BUCKETS + bucket[at].astype(np.int64), return_counts=True)
            r = code // BUCKETS
            out.append((r + k.lo, code % BUCKETS, SCALE * count / n[r]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def fit(texts: list[str], y: np.ndarray, rounds: int = 80, rate: float = 0.1, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch steps with running moments of the gradient; classes weigh the same."""
    weight, bias = np.zeros(BUCKETS, np.float32), 0.0
    if len(np.unique(y)) < 2:
        return weight, bias
    row, bucket, value = sparse(texts)
    used, col = np.unique(bucket, return_inverse=True)
    share = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    w = np.zeros(len(used) + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        z = np.bincount(row, value * w[col], len(y)) + w[-1]
        d = share * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        g = np.append(np.bincount(col, value * d[row], len(used)), d.sum()) + l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    weight[used] = w[:-1]
    return weight, float(w[-1])


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[np.ndarray, float, tuple[float, float]]:
    """Weights, bias and calibration. Fold 0 of the sample is for the calibration only."""
    sample, share = labelled_sample(docs, labels, "quality", per_class)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id")
        learn = pdf["fold"] > 0 if (pdf["fold"] > 0).any() else pdf["fold"] >= 0
        weight, bias = fit(pdf["text"][learn].tolist(), pdf["y"][learn].to_numpy())
        z, rest = [], pdf[~learn] if not learn.all() else pdf
        for k in blocks(pa.array(rest["text"].tolist(), pa.large_string())):
            z.append(raw_score(k, words(k), weight, bias))
        return pd.DataFrame({"weight": [weight.tobytes()], "bias": [bias], "z": [np.concatenate(z).tolist()], "y": [rest["y"].tolist()]})

    found = sample.withColumn("one", F.lit(0)).groupBy("one").applyInPandas(one, "weight binary, bias double, z array<double>, y array<int>").collect()
    if not found:
        return np.zeros(BUCKETS, np.float32), 0.0, calibrate(np.zeros(0), np.zeros(0), share)
    r = found[0]
    return np.frombuffer(r.weight, np.float32), r.bias, calibrate(np.array(r.z), np.array(r.y), share)


def _scorer(docs: DataFrame, labels: DataFrame, per_class: int):
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, per_class))

    def score(text: pa.Array) -> dict[str, np.ndarray]:
        weight, bias, ab = model.value
        parts = []
        for k in blocks(text, 1 << 20):
            w = words(k)
            c = counts(k, w)
            c["base_failed"] = failed(c)
            c["score"] = chance(raw_score(k, w, weight, bias), ab)
            parts.append(c)
        out = {n: np.concatenate([p[n] for p in parts]) if parts else np.zeros(0) for n in [*COUNTS, "base_failed", "score"]}
        out["kept"] = ~out["base_failed"].astype(bool) & (out["score"] >= THRESHOLD)
        return out

    return score


def quality_rules(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the five counts, ``base_failed``, ``kept`` and ``score``."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    score = _scorer(rows, labels, per_class)

    def run(batches):
        for b in batches:
            s = score(b.column("text"))
            cols = [b.column("doc_id"), *(pa.array(s[n].astype(np.int64)) for n in COUNTS), *(pa.array(s[n].astype(bool)) for n in ("base_failed", "kept")), pa.array(s["score"])]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", *COUNTS, "base_failed", "kept", "score"])

    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {', '.join(n + ' long' for n in COUNTS)}, base_failed boolean, kept boolean, score double"
    return rows.mapInArrow(run, schema)


def quality_filter(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    small_batches(docs.sparkSession)
    score = _scorer(docs.select("doc_id", F.col("text").cast("string").alias("text")), labels, per_class)

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(score(b.column("text"))["kept"].astype(bool)))

    return docs.mapInArrow(run, docs.schema)
