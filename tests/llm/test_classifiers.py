import random
import re
import zlib
from collections import Counter

import pytest
from cases import frame, rows

from contestlab.llm import compression_quality as op3
from contestlab.llm import quality_rules as op10
from contestlab.llm import toxicity as op9

LABELS = "doc_id long, quality int, toxic int, text string, y int"


def corpus(n=600):
    r = random.Random(3)
    vocabulary = ["".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 7))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        words = [r.choice(vocabulary) for _ in range(r.randrange(20, 150))]
        bad, toxic = i % 5 == 0, i % 7 == 0
        if bad:
            words = [w.upper() + "!!" for w in words]
        if toxic:
            for _ in range(len(words) // 20 + 2):
                words[r.randrange(len(words))] = r.choice(["Zorg,", "zorg", "blix.", "blix"])
        docs.append((i, " ".join(words), "en", "s", 1, 0, 0, "", ""))
        labels.append((i, int(not bad), int(toxic), "", 0))
    return docs, [*labels, (None, 1, 1, "", 0), (5, None, None, "", 0), (10**6, 1, 0, "", 0), labels[3]]


def run(spark, op, docs, labels):
    return op(frame(spark, docs), spark.createDataFrame(labels, LABELS)).collect()


@pytest.mark.parametrize("op,label,threshold", [(op3.compression_quality, 1, 0.3), (op9.toxicity, 2, 0.5)])
def test_held_out_rows(spark, op, label, threshold):
    docs, labels = corpus()
    truth = {x[0]: x[label] for x in labels if x[0] is not None and x[label] is not None}
    got = run(spark, op, docs, labels)
    assert sorted(r.doc_id for r in got) == list(range(600))
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= threshold)
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) > 0.93 * len(held)


@pytest.mark.parametrize("op", [op3.compression_quality, op9.toxicity, op10.quality_rules])
def test_awkward_rows_and_few_labels(spark, op):
    data = rows()
    for labels in ([], [(1, 1, 0, "", 0)], [(i, i % 2, i % 2, "", 0) for i in range(12)]):
        got = run(spark, op, data, labels)
        assert len(got) == len(data)
        assert all(0 <= r.score <= 1 for r in got)
        assert len(labels) > 1 or len({r.score for r in got}) == 1
    assert op(frame(spark, []), spark.createDataFrame([], LABELS)).count() == 0


def test_held_out_labels_are_not_learned(spark):
    """Turning the labels of the held-out rows round changes no score."""
    docs, labels = corpus(300)
    other = [(i, 1 - q, 1 - t, "", 0) if i is not None and q is not None and zlib.crc32(str(i).encode()) % 5 == 0 else (i, q, t, "", 0) for i, q, t, _, _ in labels]
    for op in (op3.compression_quality, op9.toxicity, op10.quality_rules):
        assert sorted((r.doc_id, r.score) for r in run(spark, op, docs, labels)) == sorted((r.doc_id, r.score) for r in run(spark, op, docs, other))


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    again = {j for i in range(len(words) - 4) if seen[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again), n < 10 or 100 * len(again) > 20 * n)


def test_counts_match_brute_force(spark):
    data = [*rows(), (900, "a b\n\n \na b\n a b\na b\n" * 3, "", "", 0, 0, 0, "", ""), (901, "x y é z #*$%&|<> " * 4, "", "", 0, 0, 0, "", "")]
    docs, labels = corpus(200)
    got = run(spark, op10.quality_rules, [*data, *docs], labels)
    have = sorted(((r.doc_id is None, r.doc_id or 0), (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)) for r in got)
    assert have == sorted(((d[0] is None, d[0] or 0), plain_counts(d[1])) for d in [*data, *docs])
    assert all(not r.kept for r in got if r.base_failed)


def test_filter_keeps_rows_and_columns(spark):
    docs, labels = corpus(300)
    df = frame(spark, docs)
    kept = op10.quality_filter(df, spark.createDataFrame(labels, LABELS))
    assert kept.schema == df.schema
    verdict = {r.doc_id for r in op10.quality_rules(df, spark.createDataFrame(labels, LABELS)).collect() if r.kept}
    assert {r.doc_id for r in kept.collect()} == verdict
    good = {x[0] for x in labels if x[1] == 1} & set(range(300))
    assert len(verdict & good) > 0.95 * len(good)
