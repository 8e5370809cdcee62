import hashlib
import re
from collections import Counter

import pytest
from cases import frame, rows


from contestlab.llm.substring_dedup import COVERS, substring_dedup


def brute(data, length):
    split = [re.findall(r"[^\x20\x09-\x0D]+", r[1] or "") for r in data]
    seen = Counter(tuple(w[i : i + length]) for w in split for i in range(len(w) - length + 1))
    out = []
    for r, w in zip(data, split, strict=True):
        gone = set()
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                gone.update(range(i, i + length))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((r[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


def key(r):
    return tuple((x is None, x or 0) if not isinstance(x, str) else x for x in r)


@pytest.mark.parametrize("length,period", [(35, None), (35, 13), (8, 3), (3, None)])
def test_matches_brute_force(spark, length, period):
    got = substring_dedup(frame(spark), length, period, texts=True).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows(), length), key=key)


def test_covers():
    for v, d in COVERS.items():
        assert {(a - b) % v for a in d for b in d} == set(range(v))


def test_empty_table(spark):
    assert substring_dedup(frame(spark, [])).count() == 0


def test_repeats_known_only_across_blocks(spark):
    """Same answer when each text is a task of its own, so nothing is settled inside a block."""
    df = frame(spark).repartition(60)
    assert sorted((tuple(r) for r in substring_dedup(df, 8, texts=True).collect()), key=key) == sorted(brute(rows(), 8), key=key)
