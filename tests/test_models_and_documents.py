"""Multiple regression, exact up-sampling, ROC curves by fold, pages and documents, on literal inputs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from contestlab.operators import evaluation, ml, nested, stats
from contestlab.plans import documents


def test_multiple_regression_equals_least_squares(spark):
    r = random.Random(3)
    data = []
    for i in range(300):
        a, b, c = r.gauss(1e6, 2), r.gauss(0, 1), r.random()
        data.append((a, b + c / 2, c, 3 + 0.5 * a - 2 * b + r.gauss(0, 1)))
    data += [(None, 1.0, 1.0, 1.0), (1.0, 1.0, 1.0, None)]
    df = spark.createDataFrame(data, "a double, b double, c double, y double").repartition(7)
    got = {x.term: x for x in stats.multiple_regression(df, "y", ["a", "b", "c"], digits=6).collect()}
    x = np.array([(1.0, *row[:3]) for row in data[:300]])
    y = np.array([row[3] for row in data[:300]])
    centre = x.copy()
    centre[:, 1] -= 1e6  # for a reference that does not lose digits
    beta, rss, _, _ = np.linalg.lstsq(centre, y, rcond=None)
    cov = np.linalg.inv(centre.T @ centre) * rss[0] / (300 - 4)
    for j, term in enumerate(["(intercept)", "a", "b", "c"]):
        if j:
            assert got[term].estimate == pytest.approx(beta[j], abs=2e-6)
            assert got[term].std_error == pytest.approx(math.sqrt(cov[j, j]), abs=2e-6)
            assert got[term].t_value == pytest.approx(beta[j] / math.sqrt(cov[j, j]), abs=1e-3)
        assert got[term].n == 300
    assert got["a"].r2 == pytest.approx(1 - rss[0] / ((y - y.mean()) ** 2).sum(), abs=2e-6)


def test_multiple_regression_without_a_solution(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 1.0, float(i * i)) for i in range(20)], "a double, b double, c double, y double")
    for xs in (["a", "b"], ["c"]):
        with pytest.raises(ValueError):
            stats.multiple_regression(df, "y", xs)
    with pytest.raises(ValueError):
        stats.multiple_regression(df.limit(2), "y", ["a"])


@pytest.mark.parametrize("t,df,p", [(0.0, 5, 1.0), (1.0, 1, 0.5), (2.570582, 5, 0.05), (1.959964, 10**7, 0.05), (-2.0, 30, 0.054625), (60.0, 100, 0.0)])
def test_t_distribution(t, df, p):
    assert stats.t_two_sided(t, df) == pytest.approx(p, abs=2e-5)


def test_upsampling_is_exact_and_does_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(i, int(i < 30), float(i)) for i in range(500)], "id long, y int, v double")
    out = ml.upsample(df, "y", 1, "id").collect()
    assert sum(r.y == 1 for r in out) == sum(r.y == 0 for r in out) == 470
    again = ml.upsample(df.repartition(9), "y", 1, "id").collect()
    assert sorted(out) == sorted(again)
    times = [sum(r.id == i for r in out) for i in range(30)]
    assert min(times) >= 1 and len(set(times)) > 3  # every row stays, the draws differ
    assert ml.upsample(df, "y", 1, "id", ratio=0.5).where("y = 1").count() == 235
    assert ml.upsample(df, "y", 7, "id").count() == 500  # an absent class
    assert ml.upsample(df.where("y = 1"), "y", 1, "id").count() == 30
    assert ml.upsample(df.limit(0), "y", 1, "id").count() == 0


def test_roc_by_fold_equals_the_single_curves(spark):
    r = random.Random(8)
    data = [(i % 4 if i % 9 else None, round(r.random(), 2), r.randrange(2)) for i in range(600)]
    df = spark.createDataFrame(data, "fold int, prob double, truth int")
    got = {}
    for x in evaluation.roc_points_by(df, "fold").collect():
        got.setdefault(x.curve, set()).add((x.threshold, x.tp, x.fp, x.tpr, x.fpr))
    assert got["all"] == {tuple(x) for x in evaluation.roc_points(df).collect()}
    for f in range(4):
        assert got[str(f)] == {tuple(x) for x in evaluation.roc_points(df.where(F.col("fold") == f)).collect()}
    assert got[None] == {tuple(x) for x in evaluation.roc_points(df.where("fold is null")).collect()}


def test_pages_repeat_headers_leave_cells_out_and_are_bounded(spark):
    rows = spark.createDataFrame([(i, i % 2, f"n{i}", None if i % 3 else str(i)) for i in range(400)], "id long, g int, name string, extra string")
    pages = documents.table_pages(rows, ["g"], "id", ["id", "name", "extra"], [F.col("id").cast("string"), F.col("name"), F.col("extra")])
    assert pages.count() > 2
    html = pages.select("html").first()[0]
    assert html.count("<th>id</th>") > 1
    back = nested.cells_to_columns(documents._read(pages, ["g"], 3), ["id", "name", "extra"], ["g"])
    assert {tuple(r) for r in back.collect()} == {(i % 2, str(i), f"n{i}", None if i % 3 else str(i)) for i in range(400)}
    assert back.count() == 400
    assert documents.table_pages(rows.limit(0), ["g"], "id", ["id"], [F.col("name")]).count() == 0


def test_standings_document_is_nested_text(spark):
    record = spark.createDataFrame(
        [(2020, "A", "home", 1, 20, 10), (2020, "B", "away", 0, 10, 20), (2020, "B", "home", 1, 9, 3), (2020, "A", "away", 0, 3, 9)],
        "season long, team string, home_away string, win long, own_score long, opp_score long",
    )
    teams = spark.createDataFrame([(1, "A", 5), (2, "B", 5)], "team_id long, team string, league int")
    text = documents.standings_documents(record, teams).first().json
    assert text.startswith('{"children":[{"abbreviation":"5","standings":{"season":2020,"entries":[')
    got = {r.team_abb: r for r in documents.standings_rows(record, teams).collect()}
    assert (got["A"].wins, got["A"].home_wins, got["A"].away_losses, got["A"].pts_diff, got["A"].win_pct, got["A"].seed) == (1, 1, 1, 4, 0.5, 1)
    assert (got["B"].g_behind, got["B"].seed, got["B"].conf) == (0, 2, "5")


def test_race_fits_only_survivors():
    """Scores by fold are given: a clear loser goes after the burn-in, a close candidate stays, equal ones stay."""
    asked = []
    noise = [0.01, -0.02, 0.015, 0.0, -0.01, 0.02, 0.005, -0.005, 0.01, 0.0]

    def score(i, f):
        asked.append((i, f))
        return [0.9 + noise[f], 0.6 + noise[-f], 0.9 + noise[(f + 3) % 10], 0.9 + noise[f], 0.88 + noise[f]][i]

    found = ml.race_folds(score, 5, 10, burn_in=3)
    assert len(asked) < 50 and {f for i, f in asked if i == 1} == {0, 1, 2}
    assert {0, 2, 3} <= set(found.kept) and 1 not in found.kept
    assert 4 not in found.kept  # always 0.02 behind the leader: its differences do not vary
    assert [s[:2] for s in found.steps] == asked
    assert all(alive == (i in found.kept) for i, f, _, alive in found.steps if f == 9)
    assert not ml.trails([0.5], [0.1]) and not ml.trails([0.5, 0.6], [0.6, 0.5]) and ml.trails([0.5, 0.6], [0.4, 0.5])
