import random
import re

import numpy as np
import pytest
from cases import frame, rows

from contestlab.llm.ngram_join import components, matched_lengths, ngram_join, one_of_each_class, prefix_length, shared_values


def grams(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_classes(data):
    """The class of each row, as the least row number in it."""
    return _named(data)[0]


def _named(data):
    sets = [grams(r[1]) for r in data]
    link = [[j for j in range(len(data)) if j != i and sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(len(data))]
    name = list(range(len(data)))
    changed = True
    while changed:
        changed = False
        for i, js in enumerate(link):
            m = min([name[i], *(name[j] for j in js)])
            changed |= m != name[i]
            name[i] = m
    return name, link


def brute(data):
    (name, link), out = _named(data), []
    for i, r in enumerate(data):
        ids = [data[j][0] for j in range(len(data)) if name[j] == name[i]]
        out.append((r[0], min((x for x in ids if x is not None), default=None), len(ids), len(link[i])))
    return sorted(out, key=str)


def near_copies():
    r = random.Random(11)
    word = lambda: "w" + str(r.randrange(500))
    data = []
    for _ in range(12):
        base = [word() for _ in range(r.randrange(30, 200))]
        for _ in range(r.choice([1, 2, 5, 40])):
            text = list(base)
            for _ in range(r.randrange(0, 6)):
                text[r.randrange(len(text))] = word()
            data.append((len(data) + 1000, " ".join(text), "", "", 0, 0, 0, "", ""))
    return data


@pytest.mark.parametrize("block", [768, 7])
def test_matches_brute_force(spark, block):
    """Also with families cut into many blocks."""
    data = [*rows(), *near_copies()]
    got = sorted((tuple(r) for r in ngram_join(frame(spark, data), block=block).collect()), key=str)
    assert got == brute(data)
    if block == 768:
        # a key of its own for each row: ids may be null or repeated
        data = [(*r[:4], i, *r[5:]) for i, r in enumerate(data)]
        kept = one_of_each_class(frame(spark, data).repartition(3)).collect()
        assert list(kept[0].asDict()) == frame(spark, []).columns
        classes = brute_classes(data)
        assert sorted(classes[r.n_chars] for r in kept) == sorted(set(classes))


def test_one_of_each_class_keeps_columns_of_any_name(spark):
    text = " ".join(f"w{i}" for i in range(40))
    data = [(2, text, "k2", "t2", "r2", "d2"), (1, text + " tail", "k1", "t1", "r1", "d1"), (3, "other words", "k3", "t3", "r3", "d3"), (4, None, None, "t4", "r4", "d4")]
    docs = spark.createDataFrame(data, "doc_id long, text string, key string, _tag string, row string, _key string")
    kept = one_of_each_class(docs)
    assert kept.schema == docs.schema
    assert sorted(map(tuple, kept.collect())) == [data[1], data[2], data[3]]


def test_empty_table(spark):
    assert ngram_join(frame(spark, [])).count() == 0


def test_prefix_length():
    assert prefix_length(0.8, 16, 8, 0.9995) == 4
    assert 1 - (1 - 0.8**4) ** 16 > 0.9995


def test_matched_lengths_are_longer_in_crowded_branches_and_keep_the_recall():
    floor, trees, lengths = 3, 16, 6
    empty = np.ones((trees, lengths), int)
    crowded = np.tile([5000, 900, 80, 9, 2, 2], (trees, 1))
    mixed = np.where(np.arange(trees)[:, None] < 6, crowded, empty)
    out = matched_lengths(np.stack([empty, crowded, mixed]), floor, 0.8, 0.9995)
    assert (out[0] == 3).all()  # nothing to gain from long prefixes
    assert (out[1] == 4).all()  # crowded everywhere: only as short as the recall asks for
    assert (out[2, 6:] == 3).all() and (out[2, :6] > 4).all()  # empty trees make up for the crowded ones
    for row in out:
        assert 1 - np.prod([1 - 0.8**d for d in row if d]) >= 0.9995


def test_matched_lengths_where_whole_signatures_agree():
    """A group of copies larger than any neighbourhood tried at first is still matched."""
    sizes = np.full((1, 16, 6), 100_000)
    assert (matched_lengths(sizes, 3, 0.8, 0.9995) == 3).all()


def test_shared_values():
    sigs = np.random.default_rng(3).integers(0, 3, (150, 128)).astype(np.uint16)
    want = [[int((a == b).sum()) for b in sigs] for a in sigs]
    assert shared_values(sigs).tolist() == want
    assert shared_values(sigs[:4]).tolist() == [row[:4] for row in want[:4]]


def test_components(spark):
    r = random.Random(2)
    pairs = [(f"{r.randrange(200):03d}", f"{r.randrange(200):03d}") for _ in range(150)] + [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(60)]
    name = {}
    for a, b in pairs:
        name.setdefault(a, a), name.setdefault(b, b)
    for _ in range(300):
        for a, b in pairs:
            name[a] = name[b] = min(name[a], name[b])
    got = {x.v: x.root for x in components(spark, spark.createDataFrame(pairs, "a string, b string")).collect()}
    assert got == {v: m for v, m in name.items() if v != m}
