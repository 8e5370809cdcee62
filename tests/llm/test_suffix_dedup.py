import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from cases import frame, rows

from contestlab.llm.suffix_dedup import borders, repeated_windows, suffix_dedup, window_runs


def brute(data, length):
    texts = [(r[1] or "").encode() for r in data]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for r, t in zip(data, texts, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((r[0], len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def key(r):
    return tuple((x is None, x or 0) if not isinstance(x, str) else x for x in r)


@pytest.mark.parametrize("length,anchor,step,most", [(400, 64, 128, 4096), (40, 8, 12, 4096), (40, 8, 12, 1), (30, 30, 30, 2), (9, 3, 4, 5)])
def test_matches_brute_force(spark, length, anchor, step, most):
    got = suffix_dedup(frame(spark), length, anchor, step, most).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows(), length), key=key)


def test_empty_table(spark):
    assert suffix_dedup(frame(spark, [])).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_common_prefixes(seed):
    """Borders against a plain suffix sort, and repeated windows against a count."""
    r = random.Random(seed)
    length = r.choice([9, 12, 20])
    letters = r.choice([b"ab", b"abcdef", b"a", bytes(range(200))])
    base = [bytes(r.choice(letters) for _ in range(r.randrange(1, 60))) for _ in range(4)]
    strings = [b"".join(r.choice(base) for _ in range(r.randrange(1, 4))) for _ in range(r.randrange(1, 12))]
    weights = np.array([r.choice([1, 1, 2]) for _ in strings])
    seen = Counter()
    for s, w in zip(strings, weights, strict=True):
        for i in range(len(s) - length + 1):
            seen[s[i : i + length]] += w
    want = {(j, i) for j, s in enumerate(strings) for i in range(len(s) - length + 1) if seen[s[i : i + length]] > 1}
    string, first, number = repeated_windows(strings, weights, length)
    assert {(j, f + i) for j, f, n in zip(string, first, number, strict=True) for i in range(n)} == want
    text = np.frombuffer(b"\xff".join(strings) + b"\xff", np.uint8)
    order, border = borders(text, length)
    raw = text.tobytes()
    for i in range(1, len(raw)):
        a, b = raw[order[i - 1] :][:length], raw[order[i] :][:length]
        if b"\xff" not in a and b"\xff" not in b:
            assert border[i] == (a != b)


def test_runs_depend_on_content_only():
    r = random.Random(5)
    body = bytes(r.choice(b"abcd ") for _ in range(900))
    where = {}
    for lead in (b"", b"xyz" * 50):
        data = np.frombuffer(lead + body + b"tail" * 30, np.uint8)
        h, _, start, number = window_runs(data, np.array([0, len(data)]), 100, 16, 32)
        for g, s, n in zip(h, start, number, strict=True):
            for i in range(s, s + n):
                where.setdefault(bytes(data[i : i + 100]), set()).add(int(g))
    assert all(len(g) == 1 for g in where.values())
