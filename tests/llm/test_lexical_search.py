import math
import random
import re

import numpy as np
import pytest
from cases import frame, rows

from contestlab.llm import lexical_search as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, queries, k):
    """By the formula, every document against every query."""
    held = [(i, t) for i, text in docs if (t := terms(text))]
    n_docs, n_terms = len(held), sum(len(t) for _, t in held)
    df = {}
    for _, t in held:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in sorted(set(queries), key=str):
        scores = []
        for i, t in held:
            m = 10 + (90 * len(t) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((10**9 * t.count(x)) // (1000 * t.count(x) + 8 * m)) for x in set(terms(text)) if x in df)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def corpus(seed=3, n=900):
    r = random.Random(seed)
    word = lambda: f"w{int(r.paretovariate(0.6)) % 400}"
    out = [(r.randrange(2000), r.choice([" ", "\n", "-"]).join(word() for _ in range(r.choice([1, 3, 30, 200])))) for _ in range(n)]
    return out + out[:20] + [(None, "w1 w2"), (None, None), (5, ""), (6, "...")]


@pytest.mark.parametrize("shard_rows,query_bytes", [(1 << 16, 1 << 22), (100, 50)])
def test_matches_brute_force(spark, shard_rows, query_bytes):
    """Also over many small shards, and with the queries cut into blocks."""
    r = random.Random(1)
    docs = [(r.randrange(1000), "Ünï café CAFÉ naïve " * r.randrange(3)) for _ in range(30)] + corpus()
    queries = [(i, " ".join(f"W{int(r.paretovariate(0.5)) % 400}" for _ in range(r.randrange(1, 12)))) for i in range(8)]
    queries += [(1, "café, naïve; w3"), (1, "w2"), (7, None), (8, ""), (9, "unknown words"), queries[0], (None, "w5 w5 w5")]
    index = L.build_index(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), shard_rows=shard_rows)
    got = L.search(index, spark.createDataFrame(queries, "item_id long, text string"), k=10, query_bytes=query_bytes)
    assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, [q for q in queries if q[1] is not None], 10)


def test_awkward_rows(spark):
    """Clashing column names, nulls, repeated rows and very long texts."""
    data = rows()
    queries = spark.createDataFrame([(1, "a1 the2 x3", "s"), (2, "naïve7 é9", None)], "item_id int, text string, shard string")
    got = L.lexical_search(frame(spark, data), queries, k=7)
    assert sorted(map(tuple, got.collect()), key=str) == brute([r[:2] for r in data], [(1, "a1 the2 x3"), (2, "naïve7 é9")], 7)


def test_empty_tables(spark):
    q = spark.createDataFrame([(1, "x")], "item_id long, text string")
    assert L.lexical_search(frame(spark, []), q).count() == 0
    assert L.lexical_search(frame(spark, [(1, None, *[None] * 7)]), q).count() == 0
    assert L.lexical_search(frame(spark), spark.createDataFrame([], q.schema)).count() == 0
    assert L.lexical_search(frame(spark), spark.createDataFrame([(1, "!")], q.schema)).count() == 0


def test_terms():
    for text in ["Grün-X9 a_b\x7f\x00É É ", "日本語 テ{キ}スト", "", None, "AbC" * 9]:
        assert L.terms_of(text) == terms(text)


def test_varints():
    x = np.array([0, 1, 127, 128, 16383, 16384, 1 << 34, 5, (1 << 40) - 1])
    data, off = L.varints(x)
    assert (L.numbers(data) == x).all() and off[-1] == len(data)
    assert (L.numbers(data[off[3] : off[6]]) == x[3:6]).all()


def test_blocks_are_rejected_without_decompression():
    """A rare term with good scores makes the common list non-essential: most of its blocks stay compressed."""
    n = 200_000
    m = np.full(n, 100)
    rng = np.random.default_rng(0)

    def postings(docs, tf, weight):
        place = np.arange(len(docs))
        gap = np.diff(docs, prepend=0)
        pair = np.stack([gap, tf], axis=1).ravel()
        data, byte = L.varints(pair)
        blk = np.flatnonzero(place % L.BLOCK == 0)
        last = docs[np.append(blk[1:], len(docs)) - 1]
        return L.Postings(weight, len(docs), last, np.maximum.reduceat(tf, blk), np.full(len(blk), 10), byte[2 * blk], data.tobytes(), 1, 9)

    common = postings(np.arange(n), np.ones(n, np.int64), 10)
    rare_docs = np.sort(rng.choice(n, 500, replace=False))
    rare = postings(rare_docs, rng.integers(1, 9, 500), 5000)
    score, doc = L.top_documents([common, rare], m, 10)
    total = np.zeros(n, np.int64)
    common_all = postings(np.arange(n), np.ones(n, np.int64), 10)
    for p in (common_all, rare):
        p.decode(np.arange(len(p.last)), m)
        total[p.doc] += p.score
    best = np.lexsort((np.arange(n), -total))[:10]
    assert doc.tolist() == best.tolist() and score.tolist() == total[best].tolist()
    assert common.ready.mean() < 0.1
