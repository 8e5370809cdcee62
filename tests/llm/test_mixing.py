import random
from collections import defaultdict

import pytest
from cases import frame, rows

from contestlab.llm import mixing
from contestlab.llm.mixing import default_targets, mix_report, mix_sources, mixed, rake, with_probability


def test_raking_matches_plain_loops(spark):
    r = random.Random(4)
    cells = [(s, l, t, r.randrange(1, 5000)) for s in ["a", "b", "c", None] for l in ["en", "de"] for t in range(3) if r.random() < 0.9]
    targets = {"source": {"a": 3.0, "b": 1.0, "c": 1.0, None: 1.0, "none": 9.0}, "lang": {"en": 1.0, "de": 1.0}, "topic": {0: 2.0, 1: 1.0, 2: 1.0}}
    w = {c[:3]: float(c[3]) for c in cells}
    total = sum(w.values())
    for _ in range(200):
        for i, m in enumerate(("source", "lang", "topic")):
            now = defaultdict(float)
            for k, v in w.items():
                now[k[i]] += v
            scale = total / sum(t for x, t in targets[m].items() if x in now)
            w = {k: v * targets[m][k[i]] * scale / now[k[i]] for k, v in w.items()}
    df = spark.createDataFrame(cells, "source string, lang string, topic int, tokens long")
    kind = {"source": "string", "lang": "string", "topic": "int"}
    frames = {m: spark.createDataFrame(list(t.items()), f"{m} {kind[m]}, target double") for m, t in targets.items()}
    got = {(x.source, x.lang, x.topic): x.weight for x in rake(df, frames, rounds=8, tolerance=1e-5).collect()}
    assert got.keys() == w.keys()
    assert all(abs(got[k] - w[k]) < 2e-3 * total for k in w)


def corpus(n=3000):
    r = random.Random(9)
    return [(i, " ".join(r.choice(["alphabet", "bicycles", "cat", "dandelion", "of"]) for _ in range(r.randrange(1, 60))), r.choice(["en", "en", "en", "de"]), r.choice(["s0"] * 6 + ["s1", "s2"]), 0, 0, 0, "", "") for i in range(n)]


def test_sample_meets_budget_and_targets(spark):
    data = corpus()
    got = mix_sources(frame(spark, data), budget=0.5).collect()
    assert len(got) == len(data)
    total, taken = sum(r.tokens for r in got), sum(r.tokens for r in got if r.sampled)
    expected = sum(r.tokens * r.probability for r in got)
    assert abs(expected - 0.5 * total) < 1e-3 * total and abs(taken - expected) < 0.05 * total
    share = lambda rows, m, f: {v: sum(f(r) for r in rows if r[m] == v) / sum(map(f, rows)) for v in {r[m] for r in rows}}
    before, after = share(got, "source", lambda r: r.tokens), share(got, "source", lambda r: r.tokens * r.probability)
    assert after["s0"] < before["s0"] - 0.03 and all(0 < r.probability <= 1 for r in got)
    assert [(r.doc_id, r.sampled) for r in sorted(got)] == [(r.doc_id, r.sampled) for r in sorted(mix_sources(frame(spark, data).repartition(7), budget=0.5).collect())]


def test_awkward_rows(spark):
    data = rows()
    df = frame(spark, data)
    got = mix_sources(df).collect()
    assert len(got) == len(data) and all(r.probability is not None for r in got)
    kept = mixed(df)
    assert kept.columns == df.columns
    assert kept.count() == sum(r.sampled for r in got)
    assert mix_sources(frame(spark, [])).count() == 0 and mixed(frame(spark, [])).count() == 0


def skewed():
    """A large source and language, small ones that are associated."""
    r = random.Random(3)
    out = []
    for i in range(2400):
        s = r.choice(["hot"] * 30 + ["mid"] * 10 + ["small"] * 2 + ["tiny"])
        lang = r.choice(["en"] * 12 + ["de"] * (1 if s == "hot" else 4))
        out.append((i, " ".join(r.choice(["alphabet", "bicycles", "dandelion", "of"]) for _ in range(r.randrange(5, 40))), lang, s, 0, 0, 0, "", ""))
    return out


def test_expected_shares_meet_targets_that_are_cut_at_one(spark):
    df = frame(spark, skewed())
    kind = {"source": "string", "lang": "string"}
    goal = {"source": {"hot": 0.645, "mid": 0.255, "small": 0.07, "tiny": 0.03}, "lang": {"en": 0.84, "de": 0.16}}
    targets = {m: spark.createDataFrame(list(t.items()), f"{m} {kind[m]}, target double") for m, t in goal.items()}
    got = mix_sources(df, targets, budget=0.75).collect()
    assert max(r.probability for r in got) == 1 and any(r.probability == 1 for r in got)  # the bound matters
    expected = sum(r.tokens * r.probability for r in got)
    assert abs(expected / sum(r.tokens for r in got) - 0.75) < 2e-3
    for m, t in goal.items():
        for v, share in t.items():
            assert abs(sum(r.tokens * r.probability for r in got if r[m] == v) / expected - share) < 3e-3 * share, (m, v)
            assert all(abs(r[f"{m}_miss"]) < 3e-3 for r in got if r[m] == v)


def test_infeasible_targets_are_said(spark):
    df = frame(spark, skewed())
    wanted = spark.createDataFrame([("hot", 1.0), ("mid", 1.0), ("small", 1.0), ("tiny", 1.0)], "source string, target double")
    with pytest.warns(UserWarning, match="ask for more tokens"):
        report = {(r.margin, r.value): r for r in mix_report(df, {"source": wanted}, budget=0.5).collect()}
    tokens = {v: report["source", v].tokens for v in ["hot", "mid", "small", "tiny"]}
    total = sum(tokens.values())
    for v in ("mid", "small", "tiny", "hot"):
        r = report["source", v]
        assert abs(r.wanted - total / 8) < 1e-6 * total and r.feasible == (tokens[v] >= r.wanted)
        assert r.feasible == (v in ("hot", "mid")) and abs(r.miss - (r.reached / r.wanted - 1)) < 1e-9
        assert abs(r.reached - r.goal) < 3e-3 * r.goal
    assert report["source", "tiny"].goal == tokens["tiny"] and abs(sum(report["source", v].reached for v in tokens) - total / 2) < 2e-3 * total


def associated():
    """Cells near the diagonal: margins settle slowly."""
    return [(f"s{i}", f"l{j}", 0, 1000 if i == j else 10 if abs(i - j) == 1 else 0) for i in range(4) for j in range(4)]


def test_raking_goes_on_until_margins_settle(spark):
    cells = spark.createDataFrame(associated(), "source string, lang string, topic int, tokens long").where("tokens > 0")
    goal = {"source": {"s0": 0.3, "s1": 0.2, "s2": 0.25, "s3": 0.25}, "lang": {"l0": 0.26, "l1": 0.24, "l2": 0.23, "l3": 0.27}}
    kind = {"source": "string", "lang": "string"}
    targets = {m: spark.createDataFrame(list(t.items()), f"{m} {kind[m]}, target double") for m, t in goal.items()}
    targets["topic"] = spark.createDataFrame([(0, 1.0)], "topic int, target double")

    def worst(rounds):
        got = rake(cells, targets, **rounds).collect()
        total = sum(r.weight for r in got)
        return max(abs(sum(r.weight for r in got if r[m] == v) / total - share) / share for m, t in goal.items() for v, share in t.items())

    assert worst({"rounds": 8}) > 1e-2  # the former limit
    assert worst({}) < 2e-3


def test_both_fits_take_the_same_steps(spark, monkeypatch):
    cells = spark.createDataFrame([("a", "x", 0, 600), ("a", "y", 1, 100), ("b", "x", 1, 200), ("b", "y", 0, 150), (None, "x", 0, 30), ("c", "y", 1, 0)], "source string, lang string, topic int, tokens long")
    targets = {m: default_targets(cells, m) for m in ("source", "lang", "topic")}
    targets["topic"] = targets["topic"].where("topic = 0")
    got = []
    for here in (0, 10):
        monkeypatch.setattr(mixing, "HERE", here)
        out, _ = with_probability(cells, targets, 0.8, rounds=3)
        got.append({r[:3]: r.probability for r in out.collect()})
    assert len(got[0]) == 6 and got[0]["c", "y", 1] == 0.8 and got[0][None, "x", 0] == pytest.approx(1)
    assert got[0] == pytest.approx(got[1])


def test_mixed_keeps_columns_of_any_name(spark):
    from contestlab.llm.mixing import mixed

    data = [(i, f"some words of text {i}", "en", "s", f"d{i}", f"x{i}", f"r{i}") for i in range(60)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, _draw string, draw string, row string")
    kept = mixed(docs)
    assert kept.schema == docs.schema
    assert 0 < kept.count() < 60 and set(map(tuple, kept.collect())) <= set(data)
